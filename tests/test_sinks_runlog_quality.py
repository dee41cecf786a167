import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from lakeshelf import runlog
from lakeshelf.operators import quality
from lakeshelf.sinks import writers


def test_overwrite_partitions_keeps_others(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    writers.overwrite(spark.createDataFrame([("d1", 1), ("d2", 2)], "d string, v int"), path, ["d"])
    writers.overwrite_partitions(spark.createDataFrame([("d2", 20), ("d3", 30)], "d string, v int"), path, ["d"])
    got = sorted((r["d"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [("d1", 1), ("d2", 20), ("d3", 30)]


def test_compact_same_rows_fewer_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.range(2000).select((F.col("id") % 3).cast("string").alias("d"), F.col("id").alias("v"))
    df.repartition(40).write.partitionBy("d").parquet(path)
    before = len(glob.glob(f"{path}/*/*.parquet"))
    res = writers.compact(spark, path, ["d"], ["v"], target_rows_per_file=1000)
    out = res["path"]
    after = len(glob.glob(f"{out}/*/*.parquet"))
    assert after < before and res["files_removed"] == before and res["files_added"] == after
    assert sorted(spark.read.parquet(out).collect()) == sorted(spark.read.parquet(path).collect())
    # Within a file, rows are clustered (sorted) on the clustering column.
    first = sorted(glob.glob(f"{out}/d=0/*.parquet"))[0]
    vals = [r["v"] for r in spark.read.parquet(first).collect()]
    assert vals == sorted(vals)


def test_maintain_reports_each_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pos")
    spark.range(100).select(F.lit("S1").alias("store_id"), F.col("id").cast("string").alias("product_id"),
                            F.lit("2024-01-01").alias("transaction_date")).write.partitionBy(
        "transaction_date").parquet(path)
    res = writers.maintain(spark, {"silver_pos_transactions": (path, ["transaction_date"]),
                                   "missing": (os.path.join(tmp_dir, "nope"), [])}, 1000)
    assert res["silver_pos_transactions"]["status"] == "SUCCESS" and res["missing"]["status"] == "FAILED"


def test_run_log_latest_success_and_watermark(spark, tmp_dir):
    log = os.path.join(tmp_dir, "runlog")
    assert runlog.watermark(spark, log, "p") is None
    r1 = runlog.start(spark, log, "p")
    runlog.finish(spark, log, r1, "p", "SUCCESS", rows_read=3, watermark=1_704_067_200_000_000)
    r2 = runlog.start(spark, log, "p")
    runlog.finish(spark, log, r2, "p", "FAILED", error="it's broken; 'quoted'")
    assert runlog.watermark(spark, log, "p") == 1_704_067_200_000_000
    states = {r["run_id"]: r["status"] for r in runlog.run_states(spark.read.parquet(log)).collect()}
    assert states == {r1: "SUCCESS", r2: "FAILED"}


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "online", 5.0), (1, "mail", -1.0), (2, None, None)], "k int, channel string, amt double")
    rules = {"channel": "channel IN ('online', 'offline')", "amount": "amt >= 0"}
    fails = {r["rule"]: r["failed_rows"] for r in quality.rule_failures(df, rules).collect()}
    assert fails == {"channel": 1, "amount": 1}  # NULL passes, as with CHECK constraints
    bad = quality.failing_rows(df, rules).collect()
    assert len(bad) == 1 and sorted(bad[0]["failed_rules"]) == ["amount", "channel"]
    assert quality.duplicate_keys(df, ["k"]).collect()[0]["n"] == 2
    assert quality.null_counts(df, ["channel", "amt"]).collect()[0].asDict() == {"channel_nulls": 1, "amt_nulls": 1}
    with pytest.raises(quality.QualityError):
        quality.enforce(df, rules)
    with pytest.raises(quality.QualityError):
        quality.assert_not_empty(df.limit(0))


def test_fixed_calendar(spark):
    from lakeshelf.plans.dims import fixed_calendar

    cal = fixed_calendar(spark)
    assert cal.count() == 4018
    row = cal.filter("date = DATE'2024-01-07'").collect()[0]
    assert (row["day_of_week"], row["is_weekend"], row["year_quarter"], row["season"]) == (1, True, "2024-Q1", "Winter")


def test_write_state_rewrites_touched_and_drops_emptied_partitions(spark, tmp_dir):
    from lakeshelf.sinks.tables import write_state

    path = os.path.join(tmp_dir, "t")
    writers.overwrite(spark.createDataFrame([(1, "d1"), (2, "d2"), (3, "d3")], "k int, d string"), path, ["d"])
    d1_files = sorted(glob.glob(f"{path}/d=d1/*.parquet"))
    state = spark.createDataFrame(
        [(1, "d1", "keep"), (2, "d2", "delete"), (3, "d3", "update"), (4, "d3", "insert")], "k int, d string, _op string")
    counts = write_state(spark, state, path, ["d"])
    assert counts == {"keep": 1, "delete": 1, "update": 1, "insert": 1}
    assert not os.path.exists(f"{path}/d=d2")  # emptied by the change
    assert sorted(glob.glob(f"{path}/d=d1/*.parquet")) == d1_files  # untouched partition not rewritten
    got = sorted((r["k"], r["d"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, "d1"), (3, "d3"), (4, "d3")]
