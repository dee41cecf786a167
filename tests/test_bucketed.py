"""Merging large batches into a table stored in buckets of its key: its rows are not moved."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from lakeshelf.operators import changes
from lakeshelf.sinks.published import publish, read_published


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def moved(spark, df, column):
    """Whether an exchange in the plan lies above the scan that reads ``column`` (which only the table has)."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda x: len(re.match(r"[ :|+\-]*", x)[0])
    for i, line in enumerate(plan):
        if "FileScan" in line and column in line:
            at = depth(line)
            for up in reversed(plan[:i]):
                if depth(up) < at:
                    at = depth(up)
                    if "Exchange" in up:
                        return True
    return False


@pytest.fixture()
def table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v"), F.lit("x").alias("only_here"))
    df = df.union(spark.createDataFrame([(None, -1, "x")], "k string, v long, only_here string"))
    publish(spark, df, path, keys=["k"], buckets=6)
    batch = spark.range(2000, 4000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), (F.col("id") * 10).alias("v"))
    return path, df, batch.union(spark.createDataFrame([(None, -5)], "k string, v long"))


def test_merge_does_not_move_the_table(spark, table):
    path, df, batch = table
    old = read_published(spark, path)
    assert rows(old) == rows(df) and len(glob.glob(f"{path}/_data/*/*.parquet")) == 6
    for kw in ({"update": "*"}, {"compare": ["v"]}, {}):
        state = changes.merge_bucketed(read_published(spark, path), batch, ["k"], **kw)
        assert rows(state) == rows(changes.upsert(df, batch, ["k"], strategy="shuffle", **kw))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        main = changes.upsert(read_published(spark, path).filter("k is not null"), batch.filter("k is not null"), ["k"], update="*", strategy="shuffle", null_safe=False)
        assert not moved(spark, main, "only_here")
        assert moved(spark, changes.upsert(df.coalesce(1), batch, ["k"], update="*", strategy="shuffle"), "only_here") is False  # no scan there
        plain = os.path.join(os.path.dirname(path), "plain")
        df.write.parquet(plain)
        assert moved(spark, changes.upsert(spark.read.parquet(plain), batch, ["k"], update="*", strategy="shuffle"), "only_here")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    publish(spark, changes.live(changes.merge_bucketed(read_published(spark, path), batch, ["k"], update="*")), path, keys=["k"], buckets=6, laid_out=True)
    again = read_published(spark, path)
    assert rows(again) == rows(changes.live(changes.upsert(df, batch, ["k"], update="*"))) and rows(old) == rows(df)
    newest = max(glob.glob(f"{path}/_data/*"), key=os.path.getmtime)
    assert len(glob.glob(newest + "/*.parquet")) <= 7  # a file a bucket, and one of the rows without a key
    assert not moved(spark, changes.upsert(again.filter("k is not null"), batch.filter("k is not null"), ["k"], strategy="shuffle", null_safe=False), "only_here")


def test_history_of_a_bucketed_table(spark, tmp_dir):
    """Closing and opening versions leaves the stored versions in their buckets too."""
    path = os.path.join(tmp_dir, "scd")
    load = lambda n, f: spark.range(n).select(F.concat(F.lit("k"), F.col("id")).alias("k"), (F.col("id") * f).alias("v"))
    first = changes.scd2_apply(changes.empty_scd_table(load(1, 1)), load(500, 1), ["k"], ["v"], "2024-01-01 00:00:00")
    publish(spark, changes.live(first), path, keys=["k"], buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state = changes.scd2_apply(read_published(spark, path), load(700, 2), ["k"], ["v"], "2024-02-01 00:00:00", strategy="shuffle")
        assert not moved(spark, state, "valid_to")
        assert rows(state) == rows(changes.scd2_apply(changes.live(first), load(700, 2), ["k"], ["v"], "2024-02-01 00:00:00", strategy="shuffle"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_delete_unmatched_is_delete_missing(spark):
    state = spark.createDataFrame([(1, "d1", 1), (2, "d1", 1), (3, "d2", 1), (4, None, 1), (5, "d3", 1), (None, "d1", 1)], "k int, d string, v int")
    batch = spark.createDataFrame([(1, "d1", 2), (9, "d1", 2), (8, None, 2), (5, "d2", 2)], "k int, d string, v int")
    for strategy in ("broadcast", "shuffle"):
        merged = changes.upsert(state, batch, ["k"], compare=["v"], strategy=strategy)
        want = changes.delete_missing(merged, batch, ["k"], "d", strategy=strategy)
        assert rows(changes.delete_unmatched(merged, batch, "d")) == rows(want)
