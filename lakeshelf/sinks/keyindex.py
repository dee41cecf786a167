"""Which keys a large table has, without reading the table.

``<path>`` is an append-only Parquet folder of key changes, dealt into folders by a hash of the key:

    <path>/_bucket=<0 .. buckets - 1>/*.parquet      key columns, present, at

A look-up reads the folders of its keys alone (a partition filter that prunes the scan), and of those only the key
columns. The newest change of a key (``at``, ascending by writer) says whether it is there, so removed keys can come back.
Choose ``buckets`` so that a folder stays well above the size of a file and a usual micro-batch has fewer keys than there are folders; with more
keys than folders the whole index is read, which is still keys only. ``compact`` rewrites folders as one file each and leaves out
superseded changes.

A NULL key is a key as any other.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.operators.joins import fits, maybe_broadcast
from lakeshelf.session import materialize
from lakeshelf.sinks.writers import append, overwrite_partitions

BUCKET = "_bucket"


@dataclass
class KeyIndex:
    spark: SparkSession
    path: str
    keys: T.StructType  # the key columns and their types
    buckets: int = 256

    @property
    def names(self) -> list[str]:
        return self.keys.fieldNames()

    def _dealt(self, keys: DataFrame) -> DataFrame:
        return keys.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.names]), F.lit(self.buckets)).cast("int"))

    def _schema(self) -> T.StructType:
        return T.StructType([*self.keys.fields, T.StructField("present", T.BooleanType()), T.StructField("at", T.LongType()), T.StructField(BUCKET, T.IntegerType())])

    def exists(self) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def record(self, keys: DataFrame, present: bool) -> None:
        """Append that these keys came (or went). Replays add nothing that a look-up could see."""
        at = F.lit(time.time_ns())
        append(self._dealt(keys.select(*self.names)).withColumns({"present": F.lit(present), "at": at}), self.path, [BUCKET])

    def look_up(self, wanted: DataFrame) -> DataFrame:
        """Those of the ``wanted`` keys (key columns, distinct) that are present."""
        if not self.exists():
            return wanted.limit(0)
        dealt = self._dealt(wanted.select(*self.names))
        folders = sorted(r[0] for r in dealt.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
        renamed = wanted.select(*[F.col(k).alias(f"__w_{k}") for k in self.names])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__w_{k}")) for k in self.names])
        changes = self.spark.read.schema(self._schema()).parquet(self.path).filter(F.col(BUCKET).isin(folders))
        hits = changes.join(maybe_broadcast(renamed, fits(renamed)), same, "left_semi")
        return hits.groupBy(*self.names).agg(F.max_by("present", "at").alias("present")).filter("present").select(*self.names)

    def rebuild(self, table_keys: DataFrame) -> None:
        """Build the index of an existing table in one pass over its key columns."""
        self.record(table_keys, True)

    def compact(self) -> None:
        """One change per key, and one file per folder (or a few, where it is large)."""
        changes = self.spark.read.schema(self._schema()).parquet(self.path)
        newest = changes.groupBy(BUCKET, *self.names).agg(F.max_by("present", "at").alias("present"), F.max("at").alias("at"))
        overwrite_partitions(materialize(newest.select(*[f.name for f in self._schema()])), self.path, [BUCKET])


def key_index(spark: SparkSession, path: str, like: DataFrame, keys: Sequence[str], buckets: int = 256) -> KeyIndex:
    """The index at ``path`` for the key columns of ``like``."""
    return KeyIndex(spark, path, T.StructType([T.StructField(k, like.schema[k].dataType) for k in keys]), buckets)
