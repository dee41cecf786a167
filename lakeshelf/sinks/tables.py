"""Writing a computed table state back to a Parquet table.

Published tables (``sinks.published``) change in one step: unpartitioned ones are written as a new version,
partitioned ones get new folders for the partitions that differ. Plain partitioned folders (those that streams append to)
are changed in place: only partitions that differ are rewritten, and their new contents are first written as
Parquet to the shared ``spark.checkpoint.dir`` (never a machine-local folder): that cuts the
lineage to the table being overwritten, so the overwrite never reads what it
is replacing, and a lost executor is recovered from those files.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeshelf.operators.changes import OP, live
from lakeshelf.session import scratch_path
from lakeshelf.sinks.published import Pointer, current, publish, read_published
from lakeshelf.sinks.writers import append, overwrite_partitions, rebalanced

OPS = ("insert", "update", "delete", "ignore", "close", "keep")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table, published or plain. Looks only, and never repairs anything."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_or_empty(spark: SparkSession, path: str, like: DataFrame, at: Pointer | None = None) -> DataFrame:
    """The table at ``path`` (``at`` a pointer, if given), or an empty frame with ``like``'s columns on a first run."""
    at = at or current(spark, path)
    if at is not None:
        return read_published(spark, path, at).select(*like.columns)
    if table_exists(spark, path):
        # The explicit schema keeps partition columns in their table type
        # (a text date stays text instead of being inferred as DATE).
        return spark.read.schema(like.schema).parquet(path).select(*like.columns)
    return like.limit(0)


def partition_folder(spark: SparkSession, values: dict) -> str:
    """The folder name of a partition, as Spark escapes it."""
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join(name(k, None if v is None else str(v)) for k, v in values.items())


def _drop_partition(spark: SparkSession, path: str, values: dict) -> None:
    """Remove the folder of a partition that a change emptied (a dynamic overwrite
    only replaces partitions that still have rows). Spark's own naming of partition folders is used."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{partition_folder(spark, values)}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def replace_table(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str] = (), base: Pointer | None = None,
                  tag: tuple[str, int] | None = None) -> Pointer:
    """``df`` becomes the table, in one step for its readers (``read_published``)."""
    return publish(spark, df, path, partition_by, "replace", base, tag=tag)


def counted(df: DataFrame, **counts) -> tuple[DataFrame, Observation]:
    """``df`` with numbers that its next write counts on the way; read them from the observation's ``get`` after it. Nothing may be
    shuffled between here and the write: a lost executor would have rows of that shuffle counted again."""
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in counts.items()]), seen


def numbers(seen: Observation) -> dict:
    """What a finished write counted; nothing where Spark knew beforehand that there are no rows."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return {}


def _op_counts(state: DataFrame) -> tuple[DataFrame, Observation]:
    return counted(state, **{op: F.count_if(F.col(OP) == op) for op in OPS})


def _positive(seen: Observation) -> dict[str, int]:
    return {op: n for op, n in numbers(seen).items() if n}


def _digest(df: DataFrame, parts: Sequence[str], prefix: str, *more: str) -> DataFrame:
    """Rows and an order-free hash of each partition (and ``more``)."""
    rest = sorted(c for c in df.columns if c not in (*parts, OP))
    h = F.xxhash64(*rest) if rest else F.lit(0)
    return df.groupBy(*parts, *more).agg(F.count("*").alias(prefix + "n"), F.sum(h.cast("decimal(38,0)")).alias(prefix + "h"))


def write_state(spark: SparkSession, state: DataFrame, path: str, partition_by: Sequence[str] = (), base: Pointer | None = None,
                tag: tuple[str, int] | None = None) -> dict:
    """Persist an operator's next state (with ``_op``) to ``path``; returns the change counts.

    Unpartitioned tables: one pass writes the new version and counts the operations on the way. ``base`` is the pointer
    that the state was computed from: if the table was replaced since then, ``ConcurrentWrite`` is raised. ``tag``: see ``publish``.

    Partitioned tables: only partitions whose rows differ from the stored ones are rewritten. They are found by
    comparing row counts and hashes by partition (NULL included), so a row that moved
    leaves its old partition too. One pass over the state gives digests and counts; a second one
    writes the differing partitions: as new folders of a published table, or to the shared checkpoint folder and then
    over those of a plain one, so the overwrite never reads what it replaces. Partition values are not collected; only the
    folders of emptied partitions are named on the driver, one after the other.
    """
    parts = list(partition_by)
    if not parts:
        rows, seen = _op_counts(state)
        replace_table(spark, live(rows), path, base=base, tag=tag)
        return _positive(seen)
    if not table_exists(spark, path):
        rows, seen = _op_counts(rebalanced(state, parts))
        live(rows).write.partitionBy(*parts).parquet(path)
        return _positive(seen)
    at = base or current(spark, path)
    digests = _scratch(_digest(state, parts, "new_", OP), "digests")
    counts = {r[OP]: r["n"] for r in digests.groupBy(OP).agg(F.sum("new_n").alias("n")).collect()}
    new = digests.filter(F.col(OP) != "delete").groupBy(*parts).agg(F.sum("new_n").alias("new_n"), F.sum("new_h").alias("new_h"))
    old = _digest(read_or_empty(spark, path, live(state), at), parts, "old_").toDF(*[f"__o_{p}" for p in parts], "old_n", "old_h")
    same = reduce(and_, [F.col(p).eqNullSafe(F.col(f"__o_{p}")) for p in parts])
    differ = new.join(old, same, "full_outer").filter(~(F.col("new_n").eqNullSafe(F.col("old_n")) & F.col("new_h").eqNullSafe(F.col("old_h"))))
    differ = _scratch(differ.select(*[F.when(F.col("new_n").isNull(), F.col(f"__o_{p}")).otherwise(F.col(p)).alias(f"__d_{p}") for p in parts],
                                    F.col("new_n").isNull().alias("__empty")), "partitions")
    touched = reduce(and_, [F.col(p).eqNullSafe(F.col(f"__d_{p}")) for p in parts])
    rows = live(state).join(differ, touched, "left_semi")
    empty = ({p: r[f"__d_{p}"] for p in parts} for r in differ.filter("__empty").toLocalIterator())
    if at is not None:
        publish(spark, rows, path, parts, "partitions", at, [partition_folder(spark, values) for values in empty], tag)
        return counts
    overwrite_partitions(_scratch(rows, "rows"), path, parts)
    for values in empty:
        _drop_partition(spark, path, values)
    return counts


def _scratch(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_inserts(state: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Insert-only changes are appends: write just the inserted rows (one run of the merge)."""
    append(state.filter(F.col(OP) == "insert").drop(OP), path, partition_by)
