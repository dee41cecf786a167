"""File scans: incremental (Structured Streaming) and batch, plus lineage columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Reader options per format. CSV holding quoted JSON needs escape='"', or the
# JSON is cut at its first comma and later columns shift.
# maxFileAge: by default the file source skips files a week older than the newest it saw, such as a slow writer's or a backfill's.
_ANY_AGE = "36500d"
_FORMAT_OPTIONS = {
    "csv": {"header": "true", "escape": '"', "mode": "PERMISSIVE"},
    "json": {"mode": "PERMISSIVE"},
    "parquet": {},
}


def ingest_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType,
    options: dict | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A1-A3: an unbounded frame over a landing folder; each file is read once
    (progress is kept by the sink's checkpoint). The schema is always explicit."""
    opts = {**_FORMAT_OPTIONS[fmt], "maxFileAge": _ANY_AGE, **(options or {})}
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    return spark.readStream.format(fmt).schema(schema).options(**opts).load(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A5: batch scan of a Parquet table (filters and projections push into the scan)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def stream_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An append-only Parquet table read as a stream; progress is the files seen, whenever they were stamped or committed."""
    return spark.readStream.schema(schema).option("maxFileAge", _ANY_AGE).parquet(path)


def _is_wall_clock(df: DataFrame, ts_col: str) -> bool:
    return isinstance(df.schema[ts_col].dataType, T.TimestampNTZType)


def read_since(df: DataFrame, ts_col: str, mark: int | None) -> DataFrame:
    """Rows loaded after the high-water mark; everything when ``mark`` is None.

    ``mark`` is what ``high_water_mark`` gave: microseconds since 1970-01-01 (of the instant, or of
    the wall clock for a TIMESTAMP_NTZ column). It becomes a literal of the column's type without
    passing the driver's or the session's time zone, and is pushed to the scan.
    """
    if mark is None:
        return df
    if _is_wall_clock(df, ts_col):
        at = F.timestamp_add("MICROSECOND", F.lit(mark), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    else:
        at = F.timestamp_micros(F.lit(mark))
    return df.filter(F.col(ts_col) > at)


def mark_column(df: DataFrame, ts_col: str) -> Column:
    """The largest load time in microseconds since 1970-01-01, as an aggregate."""
    if _is_wall_clock(df, ts_col):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.max(ts_col))
    return F.unix_micros(F.max(ts_col))


def high_water_mark(df: DataFrame, ts_col: str) -> int | None:
    """The largest load time actually read, in microseconds since 1970-01-01 (a
    single aggregated value), to be stored as the next run's mark. Using the data's own maximum, not the run's
    clock, means rows that land while a run is in flight are not skipped."""
    return df.agg(mark_column(df, ts_col).alias("m")).first()["m"]


def with_lineage(df: DataFrame, run_id: str, date_column: bool = True) -> DataFrame:
    """Source file path, load time, load date (text) and run id."""
    out = df.withColumns({
        "source_file": F.col("_metadata.file_path"),
        "ingested_at": F.current_timestamp(),
        "pipeline_run_id": F.lit(run_id),
    })
    if date_column:
        out = out.withColumn("ingested_date", F.to_date("ingested_at").cast("string"))
    return out


def with_source(df: DataFrame, tag: str | Column) -> DataFrame:
    """A10: tag rows with the feed they came from, so two feeds can share a table."""
    return df.withColumn("_source", F.lit(tag) if isinstance(tag, str) else tag)


def route(df: DataFrame, tag: str) -> DataFrame:
    """The rows of one feed."""
    return df.filter(F.col("_source") == tag)
