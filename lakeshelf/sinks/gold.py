"""Writing dimensions and facts: required columns, audit columns, partitions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.schemas import REQUIRED, audit_columns, split_required
from lakeshelf.sinks.published import current, publish
from lakeshelf.sinks.tables import counted, numbers
from lakeshelf.sinks.writers import overwrite


def write_gold(spark: SparkSession, df: DataFrame, table: str, path: str, run_id: str, partition_by: Sequence[str] = (),
               only_partitions: bool = False, now: Column | None = None) -> int:
    """Store a dimension or fact with its audit columns; returns how many rows were set aside.

    Rows with a NULL in a required column go to ``<path>__rejected`` (with the columns' names), never
    silently. Dimensions and fully recomputed facts replace the table; ``only_partitions`` replaces just the
    partitions that ``df`` has (daily facts). Either way readers (``read_published``) see the change in one step.
    Rows set aside are counted by the write itself; only if there are any does a second pass fetch them.
    """
    has_null = reduce(or_, [F.col(c).isNull() for c in REQUIRED[table] if c in df.columns], F.lit(False))
    seen_df, seen = counted(df, rejected=F.count_if(has_null))
    good, _ = split_required(seen_df, table)
    at, run = audit_columns(table)
    good = good.withColumns({at: now if now is not None else F.current_timestamp(), run: F.lit(run_id)})
    publish(spark, good, path, partition_by, "partitions" if only_partitions and current(spark, path) is not None else "replace")
    bad = split_required(df, table)[1]
    bad, seen_bad = counted(bad if numbers(seen).get("rejected", 0) else bad.limit(0), rows=F.count("*"))
    overwrite(bad, path.rstrip("/") + "__rejected")
    return numbers(seen_bad).get("rows", 0)
