"""Incremental pipelines on Structured Streaming.

* ``bronze_files``: landing folder -> typed rows + lineage -> checkpointed,
  date-partitioned Parquet append (A1-A3, A9, A10, B1, J1, J3).
* ``bronze_messages``: message stream (binary JSON ``value``) -> typed rows ->
  the same append (A4).
* ``silver_pos_stream``: the bronze table read as a stream; each micro-batch
  is cleaned, deduplicated and inserted-if-absent into silver (A7, B2, J4). The
  insert-only upsert is idempotent, so the at-least-once replay of a
  micro-batch after a failure writes nothing twice.
* ``silver_pos_batch``: the daily batch reconciles the same table: inserts,
  corrections and cancellations, rewriting only the touched dates (J6, E5).

Late events land in the partition of their event date, not the arrival date
(J5); ``plans.late`` recomputes the touched dates downstream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeshelf.operators import changes
from lakeshelf.operators.joins import null_safe_semi
from lakeshelf.plans import silver
from lakeshelf.schemas import CORRUPT, as_text, rejection_reasons
from lakeshelf.session import materialize
from lakeshelf.sinks.keyindex import KeyIndex, key_index
from lakeshelf.sinks.tables import append_inserts, read_or_empty, table_exists, write_state
from lakeshelf.sinks.writers import append, append_feed, append_stream, foreach_batch, overwrite
from lakeshelf.sources.files import ingest_stream, stream_table, with_lineage, with_source
from lakeshelf.sources.messages import decode_messages


def bronze_files(
    spark: SparkSession,
    landing: str,
    fmt: str,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    run_id: str,
    partition_by: Sequence[str] = ("ingested_date",),
    tag: str | None = None,
    available_now: bool = True,
    feed: str | None = None,
) -> StreamingQuery:
    """Append every new landing file once to the bronze table. Name the ``feed`` where
    several streams share the table (see ``append_feed``)."""
    rows = with_lineage(ingest_stream(spark, landing, fmt, schema), run_id, date_column="ingested_date" in partition_by)
    if tag:
        rows = with_source(rows, tag)
    if feed:
        return append_feed(rows, table, feed, checkpoint, partition_by, available_now)
    return append_stream(rows, table, checkpoint, partition_by, available_now)


def bronze_checked(
    spark: SparkSession,
    landing: str,
    fmt: str,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    run_id: str,
    required: Sequence[str] = (),
    feed: str = "files",
    tag: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """C1 + K5 at ingest: typed records go to ``table``, all others to ``<table>__rejected`` with the record as it was read,
    its file and the reasons. No value becomes NULL silently.

    CSV and JSON lines are read as text and typed field by field; Parquet files must have the schema's types (Spark
    refuses others), so only ``required`` is checked there. Each micro-batch replaces its own folder in both tables, as in ``append_feed``.
    """
    text = fmt != "parquet"
    raw = with_lineage(ingest_stream(spark, landing, fmt, as_text(schema) if text else schema, {"columnNameOfCorruptRecord": CORRUPT} if text else None),
                       run_id, date_column=False)
    if tag:
        raw = with_source(raw, tag)
    lineage = [c for c in raw.columns if c not in (*schema.fieldNames(), CORRUPT)]

    def write(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn("reasons", rejection_reasons(batch, schema, required)).persist()  # parsed once; files are there to read again
        try:
            fine = marked.filter(F.size("reasons") == 0)
            typed = fine.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) if text else F.col(f.name) for f in schema.fields], *lineage)
            record = F.to_json(F.struct(*schema.fieldNames()))
            record = F.coalesce(F.col(CORRUPT), record) if text else record
            bad = marked.filter(F.size("reasons") > 0).select(record.alias("record"), "reasons", *lineage)
            for rows, path in ((typed, table), (bad, table.rstrip("/") + "__rejected")):
                overwrite(rows, f"{path.rstrip('/')}/_feed={feed}/_batch={batch_id}")
        finally:
            marked.unpersist()

    return foreach_batch(raw, write, checkpoint, available_now)


def bronze_messages(
    messages: DataFrame,
    schema: T.StructType,
    topic: str,
    table: str,
    checkpoint: str,
    run_id: str,
    tag: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Decode a message stream and append it; ``source_file`` is ``kafka://<topic>``."""
    rows = decode_messages(messages, schema, topic).withColumns({
        "ingested_at": F.current_timestamp(),
        "pipeline_run_id": F.lit(run_id),
    }).withColumn("ingested_date", F.to_date("ingested_at").cast("string"))
    if tag:
        rows = with_source(rows, tag)
    return append_stream(rows, table, checkpoint, ["ingested_date"], available_now)


def _silver_like(batch: DataFrame, tag: str) -> DataFrame:
    return silver.with_audit(silver.clean_pos(batch.limit(0), tag), "")


POS_KEY = ["transaction_id"]


def pos_key_index(spark: SparkSession, path: str, batch: DataFrame, buckets: int = 256) -> KeyIndex:
    """The key index of a silver POS table, for batches that look like ``batch``."""
    return key_index(spark, path, _silver_like(batch, silver.POS_STREAM_TAG), POS_KEY, buckets)


def _insert_new(spark: SparkSession, batch: DataFrame, silver_table: str, index: KeyIndex, stamp: str, partition_by: Sequence[str]) -> None:
    """Insert-if-absent by the key index: silver itself is read only where this very micro-batch may have written before.

    Rows go to silver first and then to the index. If a run breaks off in between, its replay finds them by their stamp: the
    scan is pruned to the batch's dates and, by the files' statistics, to files with that stamp.
    """
    like = _silver_like(batch, silver.POS_STREAM_TAG)
    rows = materialize(silver.dedup_pos(silver.clean_pos(silver.pos_stream_rows(batch), silver.POS_STREAM_TAG)))
    if not index.exists() and table_exists(spark, silver_table):
        index.rebuild(read_or_empty(spark, silver_table, like).select(*POS_KEY))
    keys = rows.select(*POS_KEY)
    written = read_or_empty(spark, silver_table, like).filter(F.col("pipeline_run_id") == stamp)
    if "transaction_date" in partition_by:
        days = [r[0] for r in rows.select("transaction_date").distinct().collect()]  # bounded by the calendar
        written = written.filter(F.col("transaction_date").isin([d for d in days if d is not None]) | F.col("transaction_date").isNull())
    known = index.look_up(keys).union(written.select(*POS_KEY))
    new = materialize(null_safe_semi(rows, known.distinct(), POS_KEY, "left_anti"))
    append(silver.with_audit(new, stamp).select(*like.columns), silver_table, list(partition_by))
    index.record(new, True)


def silver_pos_stream(
    spark: SparkSession,
    bronze_table: str,
    bronze_schema: T.StructType,
    silver_table: str,
    checkpoint: str,
    available_now: bool = True,
    run_id: str = "stream",
    partition_by: Sequence[str] = ("transaction_date",),
    index_path: str | None = None,
    buckets: int = 256,
) -> StreamingQuery:
    """Stream-feed rows of the bronze POS table, inserted once into silver
    (partitioned by event date unless ``partition_by`` says otherwise). With ``index_path``, keys already there are looked
    up in a key index that is kept beside the table, instead of a scan of all its keys."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        if index_path:
            index = pos_key_index(spark, index_path, batch, buckets)
            _insert_new(spark, batch, silver_table, index, f"{run_id}:{batch_id}", partition_by)
            return
        state = read_or_empty(spark, silver_table, _silver_like(batch, silver.POS_STREAM_TAG))
        changed = silver.stamp(silver.apply_pos_stream(state, batch), f"{run_id}:{batch_id}")
        append_inserts(changed, silver_table, list(partition_by))

    return foreach_batch(stream_table(spark, bronze_table, bronze_schema), apply, checkpoint, available_now)


def silver_pos_batch(
    spark: SparkSession,
    bronze_batch: DataFrame,
    silver_table: str,
    run_id: str = "batch",
    partition_by: Sequence[str] = ("transaction_date",),
    index_path: str | None = None,
    buckets: int = 256,
) -> dict:
    """Reconcile the silver POS table with a daily batch; returns change counts. A key index is told of new keys before
    the table is written and of cancelled ones after it, so a run that breaks off and is repeated leaves both in step."""
    state = read_or_empty(spark, silver_table, _silver_like(bronze_batch, silver.POS_BATCH_TAG))
    changed = silver.stamp(silver.apply_pos_batch(state, bronze_batch), run_id)
    if not index_path:
        return write_state(spark, changed, silver_table, list(partition_by))
    index = pos_key_index(spark, index_path, bronze_batch, buckets)
    if not index.exists() and table_exists(spark, silver_table):
        index.rebuild(state.select(*POS_KEY))
    moves = materialize(changed.filter(F.col(changes.OP).isin("insert", "delete")).select(*POS_KEY, changes.OP))
    index.record(moves.filter(F.col(changes.OP) == "insert"), True)
    counts = write_state(spark, changed, silver_table, list(partition_by))
    index.record(moves.filter(F.col(changes.OP) == "delete"), False)
    return counts
