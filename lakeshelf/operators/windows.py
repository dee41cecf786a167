"""Rolling windows over a daily series (H2-H5) and day densification.

Windows here always run on an already aggregated daily grain, partitioned by
the series key (store, product). A partition therefore holds at most one row
per calendar day, however large the raw data is: the per-task sort is bounded
by the length of the calendar, not by the volume of sales.

Frames count rows by default ("30 days" is 31 observed rows, as the source
semantics define it); ``frame="days"`` gives a true n-day window via
``rangeBetween`` on the day number.

Averages of money use ``exact_avg``: the sum runs in DECIMAL (exact, so the
result does not depend on the order the engine adds rows) and is divided once.

Sums that are exact (whole numbers, DECIMAL) over a ``Trailing`` frame are the difference of two running sums, so a row
costs the same whatever the length of the frame; Spark adds up a sliding frame anew for every row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def series_window(keys: Sequence[str], order: str, n: int, frame: str = "rows") -> WindowSpec:
    """Trailing window: ``n`` preceding rows and the current one, or the ``n``
    calendar days ending on the current row's day when ``frame="days"``."""
    base = Window.partitionBy(*keys)
    if frame == "rows":
        return base.orderBy(order).rowsBetween(-n, 0)
    if frame == "days":
        return base.orderBy(F.unix_date(F.col(order))).rangeBetween(-(n - 1), 0)
    raise ValueError(f"frame must be 'rows' or 'days', not {frame!r}")


@dataclass(frozen=True)
class Trailing:
    """The frame of ``series_window`` for exact sums: whole numbers and DECIMAL, never floating point. A series' running sum
    has to fit the type of its sum (BIGINT, DECIMAL(38, s))."""

    keys: tuple[str, ...]
    order: str
    n: int
    frame: str = "rows"

    def sum_count(self, x: Column) -> tuple[Column, Column]:
        """Sum (NULL without values) and number of the non-NULL values in the frame."""
        day = F.col(self.order)
        if self.frame == "rows":
            base, first = Window.partitionBy(*self.keys).orderBy(self.order), -self.n
            to_here, before = (base.rowsBetween(Window.unboundedPreceding, end) for end in (0, first - 1))
            left = lambda c: c.over(before)
        elif self.frame == "days":
            base, first = Window.partitionBy(*self.keys).orderBy(F.unix_date(day)), -(self.n - 1)
            to_here, before = (base.rangeBetween(Window.unboundedPreceding, end) for end in (0, first - 1))
            left = lambda c: F.when(day.isNotNull(), c.over(before))  # noqa: E731  rows without a day are a frame of their own
        else:
            raise ValueError(f"frame must be 'rows' or 'days', not {self.frame!r}")
        count = F.count(x).over(to_here) - F.coalesce(left(F.count(x)), F.lit(0))
        total = F.sum(x).over(to_here) - F.coalesce(left(F.sum(x)), F.lit(0))
        return F.when(count > 0, total), count

    def sum(self, x: Column | str) -> Column:
        return self.sum_count(F.col(x) if isinstance(x, str) else x)[0]

    def avg(self, x: Column | str) -> Column:
        total, count = self.sum_count(F.col(x) if isinstance(x, str) else x)
        return F.try_divide(total.cast("double"), count)


def exact_sum(c: Column | str, scale: int, over: WindowSpec | Trailing | None = None, precision: int = 28) -> Column:
    """Sum in DECIMAL(precision, scale), returned as DOUBLE."""
    x = (F.col(c) if isinstance(c, str) else c).cast(f"decimal({precision},{scale})")
    if isinstance(over, Trailing):
        return over.sum(x).cast("double")
    s = F.sum(x)
    return (s.over(over) if over is not None else s).cast("double")


def exact_avg(c: Column | str, scale: int, over: WindowSpec | Trailing | None = None, precision: int = 28) -> Column:
    """Average of the non-NULL values, summed exactly in DECIMAL then divided once."""
    x = (F.col(c) if isinstance(c, str) else c).cast(f"decimal({precision},{scale})")
    if isinstance(over, Trailing):
        return over.avg(x)
    s, n = F.sum(x), F.count(x)
    if over is not None:
        s, n = s.over(over), n.over(over)
    return F.try_divide(s.cast("double"), n)


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    specs: dict[str, tuple[str, str, int]],
    frame: str = "rows",
    round_to: int | None = 2,
    money_scale: int | None = None,
) -> DataFrame:
    """Add rolling columns: ``specs = {out: (fn, column, n)}`` with fn ``avg`` or ``sum``.

    All frames share one partitioning and ordering, so Spark sorts once.
    ``money_scale`` switches averages and sums of that column to the exact
    DECIMAL path. Columns of whole numbers are summed by running sums; other types keep their sliding frame.
    """
    cols, types = {}, dict(df.dtypes)
    for out, (fn, c, n) in specs.items():
        w, exact = series_window(keys, order, n, frame), Trailing(tuple(keys), order, n, frame)
        if fn == "avg":
            e = exact_avg(c, money_scale, exact) if money_scale is not None else exact.avg(c) if types[c] in _WHOLE else F.avg(c).over(w)
        elif fn == "sum":
            e = exact_sum(c, money_scale, exact) if money_scale is not None else exact.sum(c) if types[c] in _WHOLE else F.sum(c).over(w)
        else:
            raise ValueError(fn)
        cols[out] = F.round(e, round_to) if (round_to is not None and fn == "avg") else e
    return df.withColumns(cols)


# A calendar of about 60 years: a series that spans more has a wrong date in it.
MAX_SERIES_DAYS = 22_000


def densify_days(df: DataFrame, keys: Sequence[str], date_col: str, fill: dict[str, object], max_days: int = MAX_SERIES_DAYS) -> DataFrame:
    """Give every series one row per day between its first and last observed day.

    Missing days get ``fill`` values (e.g. units_sold = 0). Each observed row brings the days up to the next one of its series
    (at most one row per calendar day), so rows are moved once, by series, before they become many, and frames over the same
    series find them in place. A series of more than ``max_days`` days fails the job with its bounds in the
    message: one date of the year 9999 would otherwise give millions of rows. Rows without a date are left out. A series
    with a NULL in its keys has its days, but none of its rows is a series' observation.
    """
    keys = list(keys)
    order = Window.partitionBy(*keys).orderBy(date_col)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = df.filter(F.col(date_col).isNotNull()).withColumns({
        "__lo": F.min(date_col).over(whole), "__hi": F.max(date_col).over(whole), "__next": F.lead(date_col).over(order)})
    wide = F.datediff("__hi", "__lo") >= max_days
    said = F.concat(F.lit(f"densify_days: {date_col} from "), F.col("__lo").cast("string"), F.lit(" to "), F.col("__hi").cast("string"))
    keyless = reduce(or_, [F.col(k).isNull() for k in keys], F.lit(False))
    until = F.when(wide, F.raise_error(said).cast("date")).otherwise(F.greatest(F.col(date_col), F.date_sub("__next", 1)))
    days = F.sequence(F.col(date_col), until, F.expr("interval 1 day"))
    once = F.when(keyless & F.coalesce(F.col("__next") == F.col(date_col), F.lit(False)), F.array().cast("array<date>")).otherwise(days)
    others = [c for c in df.columns if c not in (*keys, date_col)]
    observed = (F.col("__day") == F.col(date_col)) & ~keyless
    out = seen.select(*keys, date_col, *others, F.explode(once).alias("__day"))
    out = out.select(*keys, F.col("__day").alias(date_col), *[F.when(observed, F.col(c)).alias(c) for c in others])
    return out.fillna({k: v for k, v in fill.items()})
