"""Joins whose broadcast side is bounded by a checked row count.

``broadcast()`` bypasses Spark's size threshold, so it is applied only after
``fits(df, max_rows)`` proved the side small. The check is ``take(max_rows + 1)``
of a zero-column projection: Spark scans partitions incrementally (1, then
4x more, ...) and stops as soon as the bound is exceeded, so on a huge side it
reads a few partitions, not every split; the driver receives at most
``max_rows + 1`` empty rows. The bound is ``lakeshelf.broadcast.maxRows`` (default 500,000) tightened by
``lakeshelf.broadcast.maxBytes`` (default 64 MB) over the schema's estimated
row width, so wide sides get a smaller row bound. Beyond the bound the join is left to the planner
(sort-merge, or AQE's runtime broadcast from measured shuffle sizes).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BROADCAST_ROWS = 500_000
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
_CONF_KEY = "lakeshelf.broadcast.maxRows"
_CONF_BYTES = "lakeshelf.broadcast.maxBytes"

# Estimated bytes per value (Spark's default sizes; variable-length types at their defaults).
_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
    T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8, T.StringType: 20,
    T.BinaryType: 100,
}


def _width(dt: T.DataType) -> int:
    if isinstance(dt, T.DecimalType):
        return 8 if dt.precision <= 18 else 16
    if isinstance(dt, T.ArrayType):
        return 4 * _width(dt.elementType)
    if isinstance(dt, T.MapType):
        return 4 * (_width(dt.keyType) + _width(dt.valueType))
    if isinstance(dt, T.StructType):
        return sum(_width(f.dataType) for f in dt.fields)
    return _WIDTH.get(type(dt), 20)


def max_broadcast_rows(spark: SparkSession, schema: T.StructType | None = None) -> int:
    """Row bound for explicit broadcasts: ``lakeshelf.broadcast.maxRows`` and, when
    a schema is given, ``lakeshelf.broadcast.maxBytes`` divided by its estimated row width."""
    v = spark.conf.get(_CONF_KEY, None)
    rows = int(v) if v else DEFAULT_MAX_BROADCAST_ROWS
    if schema is None:
        return rows
    b = spark.conf.get(_CONF_BYTES, None)
    max_bytes = int(b) if b else DEFAULT_MAX_BROADCAST_BYTES
    return max(1, min(rows, max_bytes // max(1, 16 + _width(schema))))


def fits(df: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``df`` has at most the bound of rows (reads at most bound + 1)."""
    bound = max_rows if max_rows is not None else max_broadcast_rows(df.sparkSession, df.schema)
    return len(df.select().take(bound + 1)) <= bound


def maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def null_safe_semi(df: DataFrame, keys: DataFrame, on: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Semi or anti join in which NULL equals NULL; ``keys`` is broadcast if it is proven small."""
    other = keys.select(*[F.col(c).alias(f"__o_{c}") for c in on])
    return df.join(maybe_broadcast(other, fits(other)), reduce(and_, [F.col(c).eqNullSafe(F.col(f"__o_{c}")) for c in on]), how)


def join_dim(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    max_rows: int | None = None,
    check: bool = True,
) -> DataFrame:
    """Join a fact to a dimension, broadcasting the dimension only when its size is proven.

    ``check=False`` skips the explicit check (for sides whose size is only known
    after an aggregation): the planner then uses statistics, and AQE converts
    the join to a broadcast at runtime when the measured shuffle output of the
    side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
    """
    return fact.join(maybe_broadcast(dim, check and fits(dim, max_rows)), on, how)


def left_join_nonnull(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    max_rows: int | None = None,
) -> DataFrame:
    """Left join in which rows with a NULL key bypass the join.

    A NULL key never matches, but in a shuffled join all NULL-key rows hash to
    one task: with many anonymous rows (say a third of all sales) that task
    would hold a third of the data. Here they skip the join and get NULL
    dimension columns directly, and the rest joins as usual (broadcast when
    the dimension is proven small).
    """
    keys = [on] if isinstance(on, str) else list(on)
    has_null = None
    for k in keys:
        c = F.col(k).isNull()
        has_null = c if has_null is None else (has_null | c)
    small = fits(dim, max_rows)
    matched = fact.filter(~has_null).join(maybe_broadcast(dim, small), keys, "left")
    extra = [f for f in dim.schema.fields if f.name not in keys]
    unmatched = fact.filter(has_null).select(
        *fact.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra]
    )
    return matched.unionByName(unmatched)


def strategy_for(df: DataFrame, strategy: str = "auto", max_rows: int | None = None) -> str:
    """Resolve ``auto`` once for a chain of operators sharing the same batch."""
    if strategy != "auto":
        return strategy
    return "broadcast" if fits(df, max_rows) else "shuffle"
