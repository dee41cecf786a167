"""Sinks (B1-B5, B7). Writes are plain Parquet; the helpers fix the options that
matter for correctness (dynamic partition overwrite per writer, explicit
checkpoint locations, schema never evolved silently)."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeshelf.operators.joins import fits, maybe_broadcast
from lakeshelf.session import scratch_path


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Group rows of a partition value into few tasks before a partitioned write
    (few files per partition) while letting AQE split a hot partition value
    into several right-sized tasks (a third of all rows on one date must not
    become one task)."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table (optionally partitioned)."""
    w = rebalanced(df, partition_by).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``; others stay. The mode
    is a writer option, so it cannot leak into other writes of the session."""
    (
        rebalanced(df, partition_by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def overwrite_ordered(df: DataFrame, path: str, order: Sequence[str], files: int) -> None:
    """The table in order of ``order`` (ascending, NULLs first), within its files and from file to file by name.

    Rows are dealt by ranges of the order columns, then of a hash of the row, so a value that a third of the rows share still goes
    to several tasks; each task sorts its own range and nothing is collected or sorted in one task.
    """
    spread = F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")])
    df.repartitionByRange(files, *order, spread).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def out_of_order(spark: SparkSession, path: str, order: Sequence[str]) -> DataFrame:
    """I3 checked: rows of a stored table that come before their predecessor in the file, and files that begin before the
    end of the one named before them (``file``, ``row``; null for a file)."""
    at = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"), F.struct(*order).alias("at"))
    in_file = Window.partitionBy("file").orderBy("row")
    rows = at.withColumn("before", F.lag("at").over(in_file)).filter(F.col("before") > F.col("at")).select("file", "row")
    ends = at.groupBy("file").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    files = ends.withColumn("before", F.lag("hi").over(Window.orderBy("file"))).filter(F.col("before") > F.col("lo"))  # one row a file
    return rows.unionByName(files.select("file", F.lit(None).cast("long").alias("row")))


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = rebalanced(df, partition_by).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    available_now: bool = True,
    query_name: str | None = None,
) -> StreamingQuery:
    """Checkpointed append of a stream into a Parquet folder. With
    ``available_now`` the query processes what is there and stops; otherwise it
    runs continuous micro-batches. The checkpoint makes a rerun read only new files."""
    w = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    return w.start(path)


def append_feed(
    df: DataFrame,
    path: str,
    feed: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    available_now: bool = True,
) -> StreamingQuery:
    """A10 + B1 for a table that several streams share.

    Spark's file sink keeps one log of batches in the folder, so a second query that writes there
    counts its first batches as done and loses them. Here each micro-batch replaces a folder of
    its own, ``_feed=<feed>/_batch=<n>``: a replay writes the same rows once, feeds never
    meet, and a reader of ``path`` sees all of them, with ``_feed`` and ``_batch`` as columns.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        overwrite(batch, f"{path.rstrip('/')}/_feed={feed}/_batch={batch_id}", partition_by)

    return foreach_batch(df, write, checkpoint, available_now)


def foreach_batch(
    df: DataFrame,
    fn: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """B2: call ``fn(batch_df, batch_id)`` per micro-batch. Delivery is
    at-least-once, so ``fn`` must be idempotent (an insert-only upsert is)."""
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


# Boundaries of each clustering column: 2 ** CURVE_BITS ranges, from a sample of so many rows (as Spark's own range
# partitioner takes one). They only decide which rows lie together.
CURVE_BITS, CURVE_SAMPLE = 6, 20_000


def curve_key(df: DataFrame, columns: Sequence[str], n_rows: int) -> Column:
    """A number that orders rows along a Z-curve through the ranks of ``columns``: rows that are near in every one of
    them are near in it, so files cut from that order are narrow in each column, not only in the first."""
    few = df.select(*columns).sample(fraction=min(1.0, CURVE_SAMPLE / max(1, n_rows)), seed=7).limit(2 * CURVE_SAMPLE)
    few = few.agg(*[F.array_sort(F.collect_list(c)).alias(c) for c in columns]).first()
    key = F.lit(0).cast("long")

    def placed(c: str, bounds: list, lo: int, hi: int, bits: Callable[[int], int]) -> Column:
        """The key's bits for the number of bounds up to the value, found by halves (NULL: before all of them)."""
        if lo == hi:
            return F.lit(bits(lo)).cast("long")
        mid = (lo + hi) // 2
        return F.when(F.col(c) >= F.lit(bounds[mid]), placed(c, bounds, mid + 1, hi, bits)).otherwise(placed(c, bounds, lo, mid, bits))

    for place, c in enumerate(columns):
        values, ranges = few[c], 1 << CURVE_BITS
        bounds = sorted({values[len(values) * k // ranges] for k in range(1, ranges)}) if values else []
        step = ranges // (len(bounds) + 1)  # few values take the high bits too, or a column of many would outweigh them
        spread = lambda n, step=step, place=place: sum((n * step >> bit & 1) << bit * len(columns) + place for bit in range(CURVE_BITS))
        key = key + placed(c, bounds, 0, len(bounds), spread)
    return key


def compact(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] | None,
    target_rows_per_file: int,
    partitions: DataFrame | None = None,
    out_path: str | None = None,
) -> dict:
    """Rewrite partitions as few files, rows clustered on ``cluster_by`` (Parquet min/max statistics then skip files on
    those columns): in their order for one column, along a Z-curve through their ranks for several. A hash of the row comes last in
    the range key, so equal cluster values (a column of four tiers, one date) still split into several files.

    A published table gets a new version, all of it or ``partitions`` only; a change of these partitions meanwhile is a
    ``ConcurrentWrite`` and nothing is lost. A plain one is written whole to ``out_path`` (default: a sibling folder), which a
    reader then switches to. With ``partitions``, the new files of those are first written
    to the shared checkpoint folder and then replace the old ones in the table itself (dynamic
    partition overwrite), so the table stays complete. Returns ``{"path", "files_removed", "files_added"}``.
    """
    from lakeshelf.sinks.published import current, publish, read_published

    at = current(spark, path)
    df = read_published(spark, path, at) if at is not None else spark.read.parquet(path)
    if partitions is not None:
        chosen = partitions.select(*[F.col(c).alias(f"__c_{c}") for c in partition_by]).distinct()
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__c_{c}")) for c in partition_by])
        df = df.join(maybe_broadcast(chosen, fits(chosen)), same, "left_semi")
    files = F.count_distinct(F.col("_metadata.file_path")).alias("f")
    before = df.agg(files, F.count("*").alias("n")).first()
    n_files = max(1, -(-before["n"] // max(1, target_rows_per_file)))
    cluster = list(cluster_by or [])
    spread = F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")])
    if len(cluster) > 1:
        df, cluster = df.withColumn("__curve", curve_key(df, cluster, before["n"])), ["__curve"]
    order = [F.col(c) for c in (*partition_by, *cluster)]
    columns = [c for c in df.columns if c != "__curve"]
    lay_out = lambda x: (x.repartitionByRange(n_files, *order, spread).sortWithinPartitions(*order) if order else x.repartition(n_files))
    if at is not None:
        state = publish(spark, lay_out(df).select(*columns), path, partition_by, "replace" if partitions is None else "partitions", at, laid_out=True)
        now = read_published(spark, path, dataclasses.replace(state, folders=tuple(f for f in state.folders if f not in at.folders)))
        return {"path": path, "files_removed": before["f"], "files_added": now.agg(files).first()["f"]}
    dest = path if partitions is not None else out_path or path.rstrip("/") + "__compacted"
    first = scratch_path(spark, "compacted") if partitions is not None else dest
    laid_out = lay_out(df) if partitions is not None else lay_out(df).select(*columns)
    w = laid_out.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(first)
    if partitions is not None:
        again = lay_out(spark.read.schema(df.schema).parquet(first)).select(*columns)
        again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    added = spark.read.schema(df.schema).parquet(first).agg(files).first()["f"]
    return {"path": dest, "files_removed": before["f"], "files_added": added}


def maintain(spark: SparkSession, tables: dict[str, tuple], target_rows_per_file: int) -> dict:
    """Compact every table ``name -> (path, partition columns[, clustering columns])``; one failing table does not stop the others."""
    out = {}
    for name, (path, parts, *cluster) in tables.items():
        try:
            out[name] = {"status": "SUCCESS", **compact(spark, path, parts, cluster[0] if cluster else None, target_rows_per_file)}
        except Exception as e:  # noqa: BLE001 - reported per table
            out[name] = {"status": "FAILED", "error": str(e)}
    return out
