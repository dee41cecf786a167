"""One row per key.

The survivor is ``row_number() = 1`` over the key, ordered by a total order
(the requested ordering, then every remaining column), so it is deterministic.
Filtering ``row_number() = 1`` lets Spark (>= 3.5) insert a partial
``WindowGroupLimit`` *before* the shuffle: every input partition forwards at
most one row per key, the same map-side reduction a partial aggregate gives,
so a key holding a third of all rows costs one row per map task in the
exchange, not a third of the data in one task. (A grouped ``min(struct(...))``
has the same property but runs as an interpreted SortAggregate, about twice
as slow here.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# An ordering item is a column name, or (name, "asc" | "desc"). NULLs sort last
# in both directions, matching SQL's "NULLS LAST".
Order = Sequence[str | tuple[str, str]]


def _norm(order: Order) -> list[tuple[str, bool]]:
    out = []
    for o in order:
        if isinstance(o, str):
            out.append((o, False))
        else:
            out.append((o[0], o[1].lower() == "desc"))
    return out


def _window_order(order: Order) -> list[Column]:
    return [F.col(n).desc_nulls_last() if d else F.col(n).asc_nulls_last() for n, d in _norm(order)]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Order, settled: Sequence[str] = ()) -> DataFrame:
    """Keep the first row of each key under ``order``; remaining ties are broken
    by every other (orderable) column ascending. Output keeps the input's columns.

    ``settled`` columns follow from other columns of the same row, so they decide no tie: they are not sorted by, and a plan
    that does not read them never computes them."""
    keys = list(keys)
    named = {n for n, _ in _norm(order)} | set(settled)
    rest = [
        F.col(f.name).asc_nulls_last()
        for f in df.schema.fields
        if f.name not in keys and f.name not in named and not isinstance(f.dataType, T.MapType)
    ]
    w = Window.partitionBy(*keys).orderBy(*_window_order(order), *rest)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_any(df: DataFrame, keys: Sequence[str], tie_break: Order | None = None) -> DataFrame:
    """one row per key. The survivor is the smallest row under ``tie_break``
    (default: all non-key columns ascending), so reruns pick the same row."""
    order = tie_break or [c for c in df.columns if c not in keys]
    return first_per_key(df, keys, order)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tie_break: Order = ()) -> DataFrame:
    """the most recently loaded row per key."""
    return first_per_key(df, keys, [(ts, "desc"), *tie_break])


# Lifecycle rank of a purchase-order status (unknown statuses rank 0).
PO_STATUS_PRIORITY = {"pending": 1, "shipped": 2, "delivered": 3, "cancelled": 3}


def status_priority(c: Column | str, priority: dict[str, int] = PO_STATUS_PRIORITY) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for status, rank in priority.items():
        expr = F.when(col == status, rank) if expr is None else expr.when(col == status, rank)
    return expr.otherwise(0)


def furthest_state(
    df: DataFrame, keys: Sequence[str], status: str, tie_break: Order, priority: dict[str, int] = PO_STATUS_PRIORITY,
    settled: Sequence[str] = (),
) -> DataFrame:
    """per key, the row in the furthest lifecycle state (ties at the top rank
    broken by ``tie_break``; for ``settled`` see ``first_per_key``)."""
    ranked = df.withColumn("_prio", status_priority(status, priority))
    return first_per_key(ranked, keys, [("_prio", "desc"), *tie_break], settled).drop("_prio")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """the distinct key set (partial aggregation before the shuffle)."""
    return df.select(*keys).distinct()
