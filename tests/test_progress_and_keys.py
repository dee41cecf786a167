"""Increments by files seen, and inserts by a key index in place of a scan of all keys."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf import runlog
from lakeshelf.operators import changes
from lakeshelf.plans.jobs import file_progress_job, incremental_job
from lakeshelf.sinks import keyindex
from lakeshelf.sinks.keyindex import key_index
from lakeshelf.sinks.published import current, read_published
from lakeshelf.streaming import ingest

LOADED = "k string, v int, ingested_at timestamp"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def load(spark, path, values, stamp):
    spark.createDataFrame([(*v, stamp) for v in values], LOADED).coalesce(1).write.mode("append").parquet(path)


def merge(state, batch):
    return changes.upsert(state, batch, ["k"], update="*")


def test_crossed_stamps_and_commits_lose_nothing(spark, tmp_dir):
    """Writer A stamps first and commits last. The mark skips it; progress by files does not."""
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    schema = T._parse_datatype_string(LOADED)
    like = spark.createDataFrame([], LOADED)
    b, t, u, log, ck = (os.path.join(tmp_dir, n) for n in ("bronze", "by_files", "by_mark", "log", "ck"))
    run = lambda: file_progress_job(spark, "files", b, schema, t, like, merge, log, ck)
    by_mark = lambda: incremental_job(spark, "mark", spark.read.parquet(b), u, like, merge, log)
    load(spark, b, [("B1", 1), ("B2", 2)], late)
    assert run()[0]["counts"] == {"insert": 2} and by_mark()["rows_read"] == 2
    load(spark, b, [("A1", 3), ("B2", 4)], early)
    old = glob.glob(b + "/*.parquet")
    os.utime(max(old, key=os.path.getmtime), (0, 0))  # not even the file's own time counts
    assert [x["counts"] for x in run()] == [{"insert": 1, "update": 1, "keep": 1}] and by_mark()["rows_read"] == 0
    assert run() == []
    assert [(r.k, r.v) for r in read_published(spark, t).orderBy("k").collect()] == [("A1", 3), ("B1", 1), ("B2", 4)]
    assert read_published(spark, u).count() == 2
    states = runlog.run_states(spark.read.parquet(log)).filter("pipeline_name = 'files'")
    assert rows(states.select("status", "rows_read", "rows_written", "watermark")) == [("SUCCESS", 2, 2, 0), ("SUCCESS", 2, 2, 1)]


def test_a_batch_that_broke_off_after_publishing_is_not_written_twice(spark, tmp_dir):
    schema, like = T._parse_datatype_string(LOADED), spark.createDataFrame([], LOADED)
    b, t, log, ck = (os.path.join(tmp_dir, n) for n in ("bronze", "t", "log", "ck"))
    add = lambda state, batch: changes.upsert(state, batch, ["k"]).unionByName(  # noqa: E731  not idempotent: every run adds a row
        batch.limit(1).select(F.lit("run").alias("k"), "v", "ingested_at", F.lit("insert").alias(changes.OP)))
    run = lambda: file_progress_job(spark, "p", b, schema, t, like, add, log, ck)
    load(spark, b, [("x", 1)], dt.datetime(2024, 1, 1))
    run()
    before = rows(read_published(spark, t))
    os.remove(f"{ck}/commits/0")  # as if the run had died before Spark noted the batch as done
    for f in glob.glob(f"{ck}/commits/.0.crc"):
        os.remove(f)
    assert [x["rows_read"] for x in run()] == [0] and rows(read_published(spark, t)) == before
    load(spark, b, [("y", 1)], dt.datetime(2023, 1, 1))
    assert len(run()) == 1 and read_published(spark, t).count() == len(before) + 2
    assert current(spark, t).number == 2


def test_key_index(spark, tmp_dir):
    ids = lambda *k: spark.createDataFrame([(x,) for x in k], "k string")
    index = key_index(spark, os.path.join(tmp_dir, "keys"), ids(), ["k"], 8)
    assert index.look_up(ids("a")).collect() == []
    index.record(ids("a", "b", None), True)
    index.record(ids("a"), False)
    index.record(ids("c"), True)
    assert rows(index.look_up(ids("a", "b", "c", "d", None))) == [("b",), ("c",), (None,)]
    index.record(ids("a"), True)
    index.compact()
    assert rows(index.look_up(ids("a", "b", "c", "d", None))) == [("a",), ("b",), ("c",), (None,)]
    assert spark.read.parquet(index.path).count() == 4


def test_look_up_prunes_the_scan(spark, tmp_dir):
    """A third of the keys hit; only the folders of the batch's keys are listed and read."""
    index = key_index(spark, os.path.join(tmp_dir, "keys"), spark.createDataFrame([], "id long"), ["id"], 64)
    index.record(spark.range(20_000).coalesce(2), True)
    batch = spark.createDataFrame([(i,) for i in (5, 20_001, 20_002, 77, 30_000, 30_001)], "id long")
    found = index.look_up(batch)
    assert rows(found) == [(5,), (77,)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "_bucket" in x)
    assert "_bucket" in scan.split("PartitionFilters: [")[1].split("]")[0] and "ReadSchema: struct<id:bigint,present:boolean,at:bigint>" in scan
    folders = index._dealt(batch).select(keyindex.BUCKET).distinct().count()
    assert folders <= 6
    read = spark.read.parquet(index.path).filter(F.col(keyindex.BUCKET).isin([r[0] for r in index._dealt(batch).select(keyindex.BUCKET).distinct().collect()]))
    assert read.select("_metadata.file_path").distinct().count() <= 2 * folders < len(glob.glob(index.path + "/*/*.parquet"))


POS = ("transaction_id string, store_id string, product_id string, customer_id string, timestamp string, quantity int, "
       "unit_price double, total_amount double, payment_method string, channel string, ingested_at timestamp_ntz, _source string")


def sale(key, day, qty=1):
    return (key, "s", "p", "c", f"2024-01-{day:02d}T10:00:00Z", qty, 10.0, 10.0 * qty, "cash", "online", dt.datetime(2024, 1, day), "pos_realtime_stream")


@pytest.mark.parametrize("partition_by", [["transaction_date"], []])
def test_indexed_stream_and_batch(spark, tmp_dir, partition_by):
    bronze, target, keys = (os.path.join(tmp_dir, n) for n in ("b", "t", "k"))
    land = lambda sales: spark.createDataFrame(sales, POS).coalesce(1).write.mode("append").parquet(bronze)
    stream = lambda ck: ingest.silver_pos_stream(spark, bronze, T._parse_datatype_string(POS), target, os.path.join(tmp_dir, ck), partition_by=partition_by, index_path=keys, buckets=8).awaitTermination()
    now = lambda: sorted((r.transaction_id or "", r.quantity) for r in spark.read.parquet(target).collect())
    land([sale("t1", 1), sale("t1", 1), sale("t2", 2), sale(None, 3)])
    stream("c1")
    land([sale("t2", 2), sale("t3", 3), sale("t4", 1)])  # a third of the keys are there
    stream("c1")
    stream("c2")  # a fresh checkpoint replays both
    assert now() == [("", 1), ("t1", 1), ("t2", 1), ("t3", 1), ("t4", 1)]
    if not partition_by:
        return
    # The batch corrects t1, cancels t4 and brings t5; a replay of the stream brings t4 back, as without an index, and t5 not twice.
    batch = spark.createDataFrame([sale("t1", 1, 5), sale("t5", 1)], POS)
    counts = ingest.silver_pos_batch(spark, batch, target, index_path=keys, buckets=8)
    assert (counts["insert"], counts["update"], counts["delete"]) == (1, 1, 1)
    assert now() == [("", 1), ("t1", 5), ("t2", 1), ("t3", 1), ("t5", 1)]
    land([sale("t5", 1), sale("t4", 1)])
    stream("c1")
    assert now() == [("", 1), ("t1", 5), ("t2", 1), ("t3", 1), ("t4", 1), ("t5", 1)]


def test_a_stream_that_broke_off_between_table_and_index(spark, tmp_dir, monkeypatch):
    bronze, target, keys, ck = (os.path.join(tmp_dir, n) for n in ("b", "t", "k", "c"))
    spark.createDataFrame([sale("t1", 1), sale("t2", 2)], POS).write.parquet(bronze)
    run = lambda: ingest.silver_pos_stream(spark, bronze, T._parse_datatype_string(POS), target, ck, index_path=keys, buckets=8).awaitTermination()
    with monkeypatch.context() as m:
        m.setattr(keyindex.KeyIndex, "record", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception):
            run()
    assert spark.read.parquet(target).count() == 2
    run()  # Spark runs the batch again under its number
    assert sorted(r.transaction_id for r in spark.read.parquet(target).collect()) == ["t1", "t2"]
