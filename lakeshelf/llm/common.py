"""Helpers shared by the training-data operators."""

from __future__ import annotations

import threading
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.session import scratch_path

# Words are maximal runs of characters other than these six (space, \t \n \v \f \r).
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[ \t-\r]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class _Scratch(threading.local):
    """Scratch tables that this thread has written, in order: queries in other threads have lists of their own."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_scratch = _Scratch()


def fresh(columns: Iterable[str], name: str) -> str:
    """``name``, or with underscores more, so that no column has it (in any case of its letters)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back:
    cuts the lineage, survives lost executors, and gives the planner real sizes."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    _scratch.paths.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def written() -> int:
    """How many scratch tables this thread has so far, for ``release``."""
    return len(_scratch.paths)


def release(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Delete the scratch tables written after the first ``since``, but for ``keep`` (results of
    ``stored``). Call it where nothing else that is still to run reads them."""
    needed = [df._scratch_path for df in keep]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in _scratch.paths[since:]:
        if path not in needed:
            p = hadoop(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    _scratch.paths[since:] = needed


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Tables written in here leave no shuffle files: else these stay until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    if before == "true":  # of the session, or of another thread that sets it back
        yield
        return
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Lower the session's Arrow batch size: batches of long texts are held several times over, in the
    executor's JVM and in each Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: Column) -> Column:
    """Array of the words of a text; no words for null, empty or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")
