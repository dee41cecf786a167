"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every lakeshelf job relies on: UTC wall clock (oracle comparisons and
# date partitions), ANSI arithmetic, and AQE for partition coalescing, skew-join
# splitting and runtime broadcast conversion.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app: str = "lakeshelf",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the lakeshelf defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (AQE coalesces small ones); locally it defaults to the core count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local-mode session without one
    (tests, laptops) gets a private temporary folder; a cluster session without
    one is an error, because a machine-local folder would not survive the loss
    of the executor that wrote it.
    """
    global _LOCAL_FALLBACK
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
        if _LOCAL_FALLBACK is None:
            _LOCAL_FALLBACK = tempfile.mkdtemp(prefix="lakeshelf-ckpt-")
        d = _LOCAL_FALLBACK
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


_LOCAL_FALLBACK: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "lakeshelf", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet to the shared checkpoint folder and
    continue from those files, so later scans prune columns and push filters down.
    Used where a stored table sits between two stages of a flow."""
    path = scratch_path(df.sparkSession, "stage")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
