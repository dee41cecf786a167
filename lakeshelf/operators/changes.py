"""Keyed table changes as DataFrame operators.

Each operator takes the current table state and an incoming batch and returns
the next state with an ``_op`` column:

  insert  row came from the batch and was absent
  update  row existed and was changed by the batch
  ignore  row existed, the batch matched it, nothing changed
  keep    row existed and the batch did not touch it
  close   SCD2: the previous current version, now closed
  delete  row is removed (kept in the frame so metrics can count it)

``live(state)`` drops deleted rows and ``_op`` before a write; ``change_metrics``
counts the operations in one pass. Writing the state is a sink's job.

Plan shape: when the batch is provably small (``fits``), it is broadcast and
the large target is only streamed through broadcast hash joins, so the target
is never shuffled. Otherwise a shuffled full outer join on the keys does the
whole merge in one pass. Keys are unique on both sides (batches are
deduplicated first), so no key is hot inside the join.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshelf.functions.columns import any_changed, row_hash
from lakeshelf.operators.joins import fits, maybe_broadcast, strategy_for

OP = "_op"
_S = "__s_"  # prefix of batch columns inside a merge


def _is_small(df: DataFrame, strategy: str, max_rows: int | None) -> bool:
    if strategy == "broadcast":
        return True
    if strategy == "shuffle":
        return False
    return fits(df, max_rows)


def live(state: DataFrame) -> DataFrame:
    """Rows that remain in the table, without the ``_op`` column."""
    if OP not in state.columns:
        return state
    return state.filter(F.col(OP) != "delete").drop(OP)


def _base(df: DataFrame) -> DataFrame:
    return df.drop(OP) if OP in df.columns else df


def _same(keys: Sequence[str], prefix: str, null_safe: bool = True) -> Column:
    """Null-safe equality of the keys with their renamed copies: a row with a NULL key meets
    itself on a replay instead of being inserted once more."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(prefix + k)) if null_safe else F.col(k) == F.col(prefix + k) for k in keys])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    update: Sequence[str] | str | None = None,
    strategy: str = "auto",
    max_rows: int | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Merge a batch (unique per key) into a table.

    * ``compare=None, update=None``: insert-only (E1); matched rows are ignored.
    * ``compare=[...]``: matched rows whose compared columns differ (NULL-safe)
      get the ``update`` columns (default: the compared ones) from the batch (E2, E3).
    * ``update="*"``: matched rows take every batch column, unconditionally (E4).

    Unmatched batch rows are inserted; columns the batch lacks are NULL.
    """
    keys = list(keys)
    target = _base(target)
    tcols = target.columns
    scols = [c for c in tcols if c in source.columns]
    src = source.select(*scols)
    if update == "*":
        upd = [c for c in scols if c not in keys]
        cmp: list[str] = []
        always = True
    else:
        cmp = list(compare or [])
        upd = list(update) if update is not None else list(cmp)
        always = False
    s_ren = src.select(*[F.col(c).alias(_S + c) for c in scols], F.lit(True).alias("__hit"))

    hit = F.col("__hit").isNotNull()
    if always:
        changed = F.lit(True)
    elif cmp:
        changed = any_changed([(F.col(c), F.col(_S + c)) for c in cmp])
    else:
        changed = F.lit(False)

    def merged_cols(is_insert: Column) -> list[Column]:
        out = []
        for c in tcols:
            if c in keys:
                out.append(F.coalesce(F.col(c), F.col(_S + c)).alias(c))
                continue
            s_val = F.col(_S + c) if c in scols else F.lit(None).cast(target.schema[c].dataType)
            if c in upd and c in scols:
                v = F.when(is_insert | (hit & changed), s_val).otherwise(F.col(c))
            else:
                v = F.when(is_insert, s_val).otherwise(F.col(c))
            out.append(v.alias(c))
        op = (
            F.when(is_insert, "insert")
            .when(hit & changed, "update")
            .when(hit, "ignore")
            .otherwise("keep")
        )
        return out + [op.alias(OP)]

    if _is_small(src, strategy, max_rows):
        # Target streams past the broadcast batch: no shuffle of the target.
        annotated = target.join(F.broadcast(s_ren), _same(keys, _S), "left").select(*merged_cols(F.lit(False)))
        s_keys = F.broadcast(s_ren.select(*[_S + k for k in keys]))
        matched_keys = target.select(*keys).join(s_keys, _same(keys, _S), "left_semi").select(*[F.col(k).alias("__m_" + k) for k in keys])
        inserts = src.join(matched_keys, _same(keys, "__m_"), "left_anti")
        ins = inserts.select(
            *[
                (F.col(c) if c in scols else F.lit(None).cast(target.schema[c].dataType)).alias(c)
                for c in tcols
            ],
            F.lit("insert").alias(OP),
        )
        return annotated.unionByName(ins)

    def merged(t: DataFrame, s: DataFrame, safe: bool) -> DataFrame:
        joined = t.withColumn("__t", F.lit(True)).join(s, _same(keys, _S, safe), "full_outer")
        return joined.select(*merged_cols(F.col("__t").isNull()))

    if not null_safe:
        return merged(target, s_ren, False)
    # Plain equality finds a batch that was deduplicated by these keys where it lies; rows with a NULL key are few and merged apart.
    null, s_null = (reduce(or_, [F.col(p + k).isNull() for k in keys]) for p in ("", _S))
    return merged(target.filter(~null), s_ren.filter(~s_null), False).unionByName(merged(target.filter(null), s_ren.filter(s_null), True))


def merge_bucketed(target: DataFrame, source: DataFrame, keys: Sequence[str], **kw) -> DataFrame:
    """``upsert`` of a large batch into a table stored in buckets of ``keys`` (``publish(..., keys=, buckets=)``): the batch is dealt out
    to the table's buckets and the table's rows stay where they are. Write the result with ``laid_out=True`` and the same
    buckets, and they are not moved then either. Rows with a NULL key are few and merged apart, NULL-safe."""
    null = reduce(or_, [F.col(k).isNull() for k in keys])
    main = upsert(target.filter(~null), source.filter(~null), keys, strategy="shuffle", null_safe=False, **kw)
    return main.unionByName(upsert(target.filter(null), source.filter(null), keys, **kw))


def delete_unmatched(state: DataFrame, batch: DataFrame, scope: str, max_rows: int | None = None) -> DataFrame:
    """E5 right after ``upsert`` with the same batch: a row it left as ``keep`` has no row in the batch, so those whose ``scope``
    value occurs there are deleted. Keys are not joined again; only the scope values (dates) are, broadcast if proven small."""
    scopes = batch.select(F.col(scope).alias("__c_" + scope)).distinct().withColumn("__in", F.lit(True))
    found = state.join(maybe_broadcast(scopes, fits(scopes, max_rows)), _same([scope], "__c_"), "left")
    gone = F.col("__in").isNotNull() & (F.col(OP) == "keep")
    return found.select(*[c for c in state.columns if c != OP], F.when(gone, "delete").otherwise(F.col(OP)).alias(OP))


def delete_missing(
    state: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    scope: str,
    strategy: str = "auto",
    max_rows: int | None = None,
) -> DataFrame:
    """E5: mark as deleted the rows whose ``scope`` value occurs in the batch but
    whose key does not (e.g. a transaction cancelled from a day's reissued file).
    Scope is the exact set of values in the batch, so gap days are untouched."""
    keys = list(keys)
    if OP not in state.columns:
        state = state.withColumn(OP, F.lit("keep"))
    strategy = strategy_for(batch, strategy, max_rows)
    scope_vals = batch.select(F.col(scope).alias("__c_" + scope)).distinct().withColumn("__in", F.lit(True))
    present = batch.select(*[F.col(k).alias("__p_" + k) for k in keys]).distinct().withColumn("__present", F.lit(True))
    in_scope, is_present = _same([scope], "__c_"), _same(keys, "__p_")
    cols = [c for c in state.columns if c != OP]

    def mark(df: DataFrame) -> DataFrame:
        gone = F.col("__in").isNotNull() & F.col("__present").isNull() & (F.col(OP) != "delete")
        return df.select(*cols, F.when(gone, "delete").otherwise(F.col(OP)).alias(OP))

    if strategy == "broadcast":
        # Scope and keys are at most as many as the batch's rows: one pass over
        # the table through two broadcast joins, no shuffle.
        return mark(state.join(F.broadcast(scope_vals), in_scope, "left").join(F.broadcast(present), is_present, "left"))
    # Large batch: only in-scope rows meet the shuffled key join.
    flagged = state.join(scope_vals, in_scope, "left")
    outside = flagged.filter(F.col("__in").isNull()).withColumn("__present", F.lit(None).cast("boolean"))
    inside = flagged.filter(F.col("__in").isNotNull()).join(present, is_present, "left")
    return mark(outside).unionByName(mark(inside))


def deleted_keys(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys an operator marked for deletion (an anti-join result; never collected)."""
    return state.filter(F.col(OP) == "delete").select(*keys)


# --- SCD type 2 ---------------------------------------------------------------

SCD_COLS = ("scd_hash", "valid_from", "valid_to", "is_current")


def _ts(now) -> Column:
    if isinstance(now, Column):
        return now
    if isinstance(now, _dt.datetime):
        now = now.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(now)).cast("timestamp")


def with_scd_hash(df: DataFrame, tracked: Sequence[str], hash_col: str = "scd_hash") -> DataFrame:
    """Change-detection hash over the tracked columns (NULL-safe, see ``row_hash``)."""
    return df.withColumn(hash_col, row_hash(list(tracked)))


def scd2_classify(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str],
    strategy: str = "auto",
    max_rows: int | None = None,
) -> DataFrame:
    """Batch rows (unique per key) with ``_action``: new, changed or same,
    against the current versions of ``target``."""
    key = list(key)
    s = with_scd_hash(source, tracked)
    current = _base(target).filter(F.col("is_current")).select(*key, F.col("scd_hash").alias("__old"))
    s_keys = s.select(*key, F.col("scd_hash").alias("__new"))
    small = _is_small(s_keys, strategy, max_rows)
    matched = current.join(F.broadcast(s_keys) if small else s_keys, key, "inner")
    action = (
        F.when(F.col("__old").isNull(), "new").when(F.col("__old") != F.col("scd_hash"), "changed").otherwise("same")
    )
    return s.join(matched.select(*key, "__old"), key, "left").withColumn("_action", action).drop("__old")


def scd2_apply(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str],
    now,
    strategy: str = "auto",
    max_rows: int | None = None,
) -> DataFrame:
    """Close the current version of changed keys at ``now`` and open a new
    version for new and changed keys; unchanged keys are ignored.

    ``target`` has the source's columns plus ``scd_hash, valid_from, valid_to,
    is_current``. Returns the full next state with ``_op`` (keep, close, insert).
    The classification frame is reused for both branches.
    """
    key = list(key)
    now_c = _ts(now)
    base = _base(target)
    strategy = strategy_for(source, strategy, max_rows)
    classified = scd2_classify(base, source, key, tracked, strategy, max_rows)
    changed = classified.filter(F.col("_action") == "changed").select(*key).withColumn("__chg", F.lit(True))
    small = _is_small(source, strategy, max_rows)
    t = base.join(F.broadcast(changed) if small else changed, key, "left")
    closing = F.col("is_current") & F.col("__chg").isNotNull()
    existing = t.select(
        *[
            (
                F.when(closing, now_c).otherwise(F.col(c)).alias(c)
                if c == "valid_to"
                else F.when(closing, F.lit(False)).otherwise(F.col(c)).alias(c)
                if c == "is_current"
                else F.col(c)
            )
            for c in base.columns
        ],
        F.when(closing, "close").otherwise("keep").alias(OP),
    )
    opened = classified.filter(F.col("_action") != "same").select(
        *[
            (
                now_c.alias(c)
                if c == "valid_from"
                else F.lit(None).cast("timestamp").alias(c)
                if c == "valid_to"
                else F.lit(True).alias(c)
                if c == "is_current"
                else (F.col(c) if c in classified.columns else F.lit(None).cast(base.schema[c].dataType)).alias(c)
            )
            for c in base.columns
        ],
        F.lit("insert").alias(OP),
    )
    return existing.unionByName(opened)


def empty_scd_table(source_like: DataFrame) -> DataFrame:
    """An empty versioned table with the batch's columns plus the SCD2 columns."""
    base = source_like.limit(0)
    for name, typ in (("scd_hash", "string"), ("valid_from", "timestamp"), ("valid_to", "timestamp")):
        base = base.withColumn(name, F.lit(None).cast(typ))
    return base.withColumn("is_current", F.lit(None).cast("boolean"))


def as_of(versions: DataFrame, ts) -> DataFrame:
    """The version of each key that was valid at ``ts``."""
    t = _ts(ts)
    return _base(versions).filter(
        (F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (t < F.col("valid_to")))
    )


# --- metrics -------------------------------------------------------------------


def change_metrics(state: DataFrame) -> DataFrame:
    """One row of operation counts, computed in a single aggregation pass."""
    op = F.col(OP)
    return state.agg(
        F.count_if(op == "insert").alias("rows_inserted"),
        F.count_if(op == "update").alias("rows_updated"),
        F.count_if(op == "delete").alias("rows_deleted"),
        F.count_if(op == "ignore").alias("rows_ignored"),
        F.count_if(op == "close").alias("versions_closed"),
        F.count_if(op == "keep").alias("rows_untouched"),
    )
