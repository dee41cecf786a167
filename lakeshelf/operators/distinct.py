"""Several exact distinct counts at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact_distincts(df: DataFrame, keys: Sequence[str], distincts: dict[str, str], aggs: Sequence[Column] = ()) -> DataFrame:
    """``keys``, the distinct values of each column (``{output: column}``, NULLs not counted), and ``aggs`` (named, not distinct).

    Two or more ``count_distinct`` in one aggregation make Spark write out every raw row once per column (Expand) before the shuffle.
    Here each column is reduced to its (group, value) pairs by a partial aggregation in the map tasks and shuffled by the pair: a group
    that holds a third of all rows is spread by its values. Only then are pairs counted by group, again with partial counts, and the
    few results of a group put together. A NULL key is a group.
    """
    keys = list(keys)
    parts = [df.groupBy(*keys).agg(F.count("*").alias("__n"), *aggs)]
    plain = [c for c in parts[0].columns if c not in (*keys, "__n")]
    for out, c in distincts.items():
        pairs = df.filter(F.col(c).isNotNull()).select(*keys, F.col(c).alias("__value")).distinct()
        parts.append(pairs.groupBy(*keys).agg(F.count("*").alias(out)))
    put = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return put.groupBy(*keys).agg(*[F.coalesce(F.sum(out), F.lit(0)).cast("long").alias(out) for out in distincts],
                                  *[F.first(c, ignorenulls=True).alias(c) for c in plain])
