"""Append-only run log (B6) with a data-based high-water mark.

A run appends a RUNNING record when it starts and a second record when it
ends; the state of a run is its latest record. Nothing is updated in place, so
concurrent writers and retried tasks only ever add rows. The mark stored on a
successful run is the largest load time the run actually read.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.operators.dedup import latest_per_key

RUNLOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("pipeline_name", T.StringType(), False),
    T.StructField("target_table", T.StringType(), True),
    T.StructField("source_table", T.StringType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("recorded_at", T.TimestampType(), False),
    T.StructField("rows_read", T.LongType(), True),
    T.StructField("rows_written", T.LongType(), True),
    T.StructField("watermark", T.LongType(), True),  # microseconds, see sources.files.high_water_mark
    T.StructField("error_message", T.StringType(), True),
    T.StructField("extra_metadata", T.MapType(T.StringType(), T.StringType()), True),
])


def _append(spark: SparkSession, path: str, row: dict) -> None:
    rec = {f.name: row.get(f.name) for f in RUNLOG_SCHEMA.fields}
    spark.createDataFrame([rec], RUNLOG_SCHEMA).write.mode("append").parquet(path)


def start(spark: SparkSession, path: str, pipeline: str, target: str | None = None, source: str | None = None) -> str:
    run_id = str(uuid.uuid4())
    _append(spark, path, {
        "run_id": run_id, "pipeline_name": pipeline, "target_table": target, "source_table": source,
        "status": "RUNNING", "recorded_at": _dt.datetime.now(_dt.timezone.utc),
    })
    return run_id


def finish(
    spark: SparkSession,
    path: str,
    run_id: str,
    pipeline: str,
    status: str,
    rows_read: int | None = None,
    rows_written: int | None = None,
    watermark: int | None = None,
    error: str | None = None,
    extra: dict | None = None,
) -> None:
    """Append the closing record. Error text is a typed value, never spliced into SQL."""
    _append(spark, path, {
        "run_id": run_id, "pipeline_name": pipeline, "status": status,
        "recorded_at": _dt.datetime.now(_dt.timezone.utc),
        "rows_read": rows_read, "rows_written": rows_written, "watermark": watermark,
        "error_message": error, "extra_metadata": {k: str(v) for k, v in (extra or {}).items()} or None,
    })


def run_states(log: DataFrame) -> DataFrame:
    """The current state of every run: its latest record."""
    return latest_per_key(log, ["run_id"], "recorded_at", tie_break=["status"])


def last_success(log: DataFrame, pipeline: str) -> DataFrame:
    """The latest successful run of a pipeline (order desc, limit 1)."""
    states = run_states(log).filter((F.col("pipeline_name") == pipeline) & (F.col("status") == "SUCCESS"))
    return states.orderBy(F.col("recorded_at").desc(), F.col("run_id")).limit(1)


def watermark(spark: SparkSession, path: str, pipeline: str):
    """The mark of the latest successful run, or None on a first run."""
    from lakeshelf.sinks.tables import table_exists

    if not table_exists(spark, path):  # first run: no log yet
        return None
    log = spark.read.schema(RUNLOG_SCHEMA).parquet(path)
    row = last_success(log, pipeline).select("watermark").first()
    return row["watermark"] if row else None

