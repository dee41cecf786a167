"""Two parameterised incremental jobs in place of one hand-written job per table.

``incremental_job`` finds what is new by a load stamp past the last run's mark. A writer whose rows are stamped earlier but
committed later stays behind that mark; where writers may cross, use ``file_progress_job``: progress is the set
of source files seen, kept in the file source's own checkpoint, so commits count and stamps do not.

A run of either:

1. append a RUNNING record to the run log;
2. read what is new (A6), or everything on a first run, once: rows, their number and the mark;
3. an empty increment is a normal, successful run (nothing written);
4. compute the next state with ``apply(current_state, increment)`` (an
   operator chain returning ``_op``) and write only what changed
   (``sinks.tables.write_state``);
5. close the run with SUCCESS, the change counts and the new mark (the largest
   load time actually read, so rows landing during the run are not skipped; or the micro-batch); or
   with FAILED and the error text (a typed value, never spliced into SQL).

The target is a published table (or a plain partitioned one): if another job changed it between reading and writing, the run fails with
``ConcurrentWrite`` and leaves it as it is.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf import runlog
from lakeshelf.session import materialize
from lakeshelf.sinks.published import current
from lakeshelf.sinks.tables import counted, numbers, read_or_empty, write_state
from lakeshelf.sinks.writers import foreach_batch
from lakeshelf.sources.files import mark_column, read_since, stream_table

Apply = Callable[[DataFrame, DataFrame], DataFrame]


def incremental_job(
    spark: SparkSession,
    pipeline: str,
    source: DataFrame,
    target_path: str,
    target_like: DataFrame,
    apply: Apply,
    runlog_path: str,
    ts_col: str = "ingested_at",
    partition_by: Sequence[str] = (),
) -> dict:
    """Run one increment of ``pipeline``; returns the run summary."""
    run_id = runlog.start(spark, runlog_path, pipeline, target=target_path)
    try:
        mark = runlog.watermark(spark, runlog_path, pipeline)
        increment, read = _read_once(read_since(source, ts_col, mark), mark=mark_column(source, ts_col))
        counts = _apply(spark, increment, target_path, target_like, apply, partition_by) if read.get("rows") else {}
        return _close(spark, runlog_path, run_id, pipeline, read.get("rows", 0), counts, read.get("mark", mark) if read.get("rows") else mark)
    except Exception as e:
        runlog.finish(spark, runlog_path, run_id, pipeline, "FAILED", error=str(e))
        raise


def file_progress_job(
    spark: SparkSession,
    pipeline: str,
    source_path: str,
    source_schema: T.StructType,
    target_path: str,
    target_like: DataFrame,
    apply: Apply,
    runlog_path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
) -> list[dict]:
    """Bring the target up to all files committed to ``source_path`` (an append-only Parquet folder); returns the summaries of
    the micro-batches run, none where no file is new.

    A micro-batch that broke off after the target was published is run again by Spark under the same number: its
    tag (the checkpoint's query and the batch) shows that it is in, and nothing is written twice. Plain partitioned targets
    have no tags: there ``apply`` must be idempotent, as the merges are.
    """
    done: list[dict] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        run_id = runlog.start(spark, runlog_path, pipeline, target=target_path, source=source_path)
        try:
            tag = (_query_id(spark, checkpoint), batch_id)
            base = current(spark, target_path)
            if base is not None and base.tags.get(tag[0], -1) >= batch_id:
                done.append(_close(spark, runlog_path, run_id, pipeline, 0, {}, batch_id))
                return
            increment, read = _read_once(batch)
            counts = _apply(spark, increment, target_path, target_like, apply, partition_by, tag) if read.get("rows") else {}
            done.append(_close(spark, runlog_path, run_id, pipeline, read.get("rows", 0), counts, batch_id))
        except Exception as e:
            runlog.finish(spark, runlog_path, run_id, pipeline, "FAILED", error=str(e))
            raise

    foreach_batch(stream_table(spark, source_path, source_schema), run, checkpoint).awaitTermination()
    return done


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that Spark keeps in a checkpoint: a fresh one replays everything under new tags."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0])["id"]


def _read_once(rows: DataFrame, **more) -> tuple[DataFrame, dict]:
    """The rows as stored scratch, with what was counted while they were read."""
    watched, seen = counted(rows, rows=F.count("*"), **more)
    return materialize(watched), numbers(seen)


def _apply(spark: SparkSession, increment: DataFrame, target_path: str, like: DataFrame, apply: Apply, partition_by: Sequence[str],
           tag: tuple[str, int] | None = None) -> dict:
    base = current(spark, target_path)
    return write_state(spark, apply(read_or_empty(spark, target_path, like, base), increment), target_path, partition_by, base, tag)


def _close(spark: SparkSession, path: str, run_id: str, pipeline: str, rows_read: int, counts: dict, mark: int | None) -> dict:
    written = sum(v for k, v in counts.items() if k in ("insert", "update", "delete", "close"))
    runlog.finish(spark, path, run_id, pipeline, "SUCCESS", rows_read=rows_read, rows_written=written, watermark=mark, extra=counts)
    return {"run_id": run_id, "status": "SUCCESS", "rows_read": rows_read, "counts": counts}
