"""Late and re-versioned data (J5): recompute exactly the partitions an increment touches.

A daily fact partitioned by event date must not be rebuilt from the increment
alone (earlier rows of the same date would vanish). Instead:

1. ``touched_partitions``: the event dates of the increment's rows, plus the
   dates where earlier versions of the same keys live (a corrected row can move
   to another date, which must lose it).
2. ``recompute_partitions``: rebuild those dates from the full, current silver
   table (partition pruning / a semi-join limits the read) and keep every other
   date of the previous result as it was.

The touched set holds partition values (dates): it is broadcast after a size check.

Facts with trailing frames reach further: a day that changes in a series also changes the rows whose frame holds it,
the next ``n`` observed rows (or the days up to ``n`` later). For these:

1. ``touched_days``: the (series, day) pairs of the increment and of earlier versions of its keys.
2. ``recompute_groups``: the daily grain, rebuilt for those pairs only.
3. ``rolling_patch``: the rows to put in place of others, computed from the touched series alone, and
   of those only from the first frame that holds a touched day to the last.
4. ``publish_patch``: only the partitions that the patch touches are written, in one step.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshelf.operators.joins import null_safe_semi
from lakeshelf.session import materialize
from lakeshelf.sinks.published import Pointer, current, publish, read_published
from lakeshelf.sinks.tables import partition_folder


def touched_partitions(previous_rows: DataFrame, increment: DataFrame, keys: Sequence[str], part_col: str) -> DataFrame:
    """Distinct partition values affected by ``increment``."""
    keys = list(keys)
    inc_keys = increment.select(*keys).distinct()
    # An increment is usually small: broadcast its keys (size-checked) so the
    # previous rows are only scanned, not shuffled.
    moved_from = null_safe_semi(previous_rows, inc_keys, keys, "left_semi").select(part_col)
    return increment.select(part_col).union(moved_from).distinct()


def recompute_partitions(
    previous_result: DataFrame,
    current_rows: DataFrame,
    touched: DataFrame,
    part_col: str,
    build: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The result after the increment: untouched partitions of ``previous_result``
    plus ``build`` over the current rows of the touched partitions."""
    t = touched.select(part_col).distinct()
    kept = null_safe_semi(previous_result, t, [part_col], "left_anti")
    redo = build(null_safe_semi(current_rows, t, [part_col], "left_semi"))
    return kept.unionByName(redo)


# --- facts with trailing frames ---------------------------------------------------------------


def touched_days(previous_rows: DataFrame, increment: DataFrame, keys: Sequence[str], series: Sequence[str], date_col: str) -> DataFrame:
    """Distinct (series, day) pairs that ``increment`` changes: where its rows lie, and where earlier versions of their keys lay."""
    cols = [*series, date_col]
    moved_from = null_safe_semi(previous_rows, increment.select(*keys).distinct(), list(keys), "left_semi").select(*cols)
    return increment.select(*cols).union(moved_from).distinct()


def recompute_groups(previous_result: DataFrame, current_rows: DataFrame, touched: DataFrame, cols: Sequence[str],
                     build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``recompute_partitions`` for groups of several columns."""
    redo = build(null_safe_semi(current_rows, touched, cols, "left_semi"))
    return null_safe_semi(previous_result, touched, cols, "left_anti").unionByName(redo)


@dataclass
class Patch:
    """``rows`` take the place of all rows with one of the ``keys``."""

    rows: DataFrame
    keys: DataFrame

    def applied(self, previous: DataFrame) -> DataFrame:
        return null_safe_semi(previous, self.keys, self.keys.columns, "left_anti").unionByName(self.rows)


def _reached(daily: DataFrame, touched: DataFrame, series: Sequence[str], date_col: str, n: int, frame: str) -> DataFrame:
    """Rows of the touched series whose frame holds a touched day (``__reached``), and those that their frames need.

    Touched days stand as markers before the row of their day. A marker after s rows reaches the next n rows, and one more if its
    own day has a row (that row itself); with day frames, the n - 1 days after it.
    """
    mark = "__mark"
    rows = null_safe_semi(daily, touched.select(*series).distinct(), list(series), "left_semi").withColumn(mark, F.lit(False))
    marks = touched.select(*series, date_col).distinct().withColumn(mark, F.lit(True))
    events = rows.unionByName(marks, allowMissingColumns=True)
    order = Window.partitionBy(*series).orderBy(date_col, F.col(mark).desc())
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    if frame == "rows":
        here = F.count_if(~F.col(mark)).over(so_far)
        own_day = F.lead(date_col).over(order).eqNullSafe(F.col(date_col)) & ~F.lead(mark, 1, True).over(order)
        reach = here + n + own_day.cast("int")
        need = n
    else:
        here = F.datediff(F.col(date_col), F.lit("1970-01-01").cast("date"))
        reach = here + n - 1
        need = n - 1
    events = events.withColumn("__at", here).withColumn("__to", F.when(F.col(mark), reach))
    events = events.withColumn("__reached", ~F.col(mark) & F.coalesce(F.col("__at") <= F.max("__to").over(so_far), F.lit(False)))
    whole = Window.partitionBy(*series)
    place = F.when(F.col("__reached"), F.col("__at"))
    events = events.withColumns({"__first": F.min(place).over(whole) - need, "__last": F.max(place).over(whole)})
    wanted = ~F.col(mark) & F.col("__at").between(F.col("__first"), F.col("__last"))
    return events.filter(wanted).select(*daily.columns, "__reached")


def rolling_patch(daily: DataFrame, touched: DataFrame, series: Sequence[str], date_col: str, n: int,
                  build: Callable[[DataFrame], DataFrame], frame: str = "rows", result_date: str | None = None) -> Patch:
    """What a change of the ``touched`` days does to a fact that ``build`` computes from the daily grain with frames of up to
    ``n`` rows before the current one (``frame="rows"``) or ``n`` days (``"days"``).

    ``daily`` is the grain after the change. Only touched series are read, and ``build`` sees of each only the rows
    from ``n`` before its first reached row to its last, so the work grows with the change. Days that the change
    emptied vanish. ``result_date`` names the day in the fact, if not ``date_col``. A window holds one series: one row per day.
    """
    day = result_date or date_col
    keys = [*series, day]
    reached = materialize(_reached(daily, touched, series, date_col, n, frame))
    changed = reached.filter("__reached").select(*series, F.col(date_col).alias(day))
    rows = build(reached.drop("__reached"))
    changed = changed.withColumn(day, F.col(day).cast(rows.schema[day].dataType))
    gone = touched.select(*series, F.col(date_col).cast(rows.schema[day].dataType).alias(day))
    return Patch(materialize(null_safe_semi(rows, changed, keys, "left_semi")), changed.union(gone).distinct())


def publish_patch(spark: SparkSession, path: str, patch: Patch, partition_by: Sequence[str], partitions: DataFrame,
                  base: Pointer | None = None) -> Pointer:
    """Apply a patch to a published table, writing only the ``partitions`` (distinct values of the partition columns) that hold its
    keys or rows. Partitions that it empties go. ``base``: see ``publish``."""
    at = base or current(spark, path)
    parts = list(partition_by)
    touched = materialize(partitions.select(*parts).distinct())
    now = materialize(patch.applied(null_safe_semi(read_published(spark, path, at), touched, parts, "left_semi")))
    emptied = null_safe_semi(touched, now.select(*parts).distinct(), parts, "left_anti")
    drop = [partition_folder(spark, r.asDict()) for r in emptied.toLocalIterator()]  # partitions, one after the other
    return publish(spark, now, path, parts, "partitions", at, drop)
