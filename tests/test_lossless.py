"""Rows that must not get lost: NULL partitions, moved rows, odd folder names, shared raw tables, marks, NULL keys."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.functions.columns import row_hash
from lakeshelf.operators import changes
from lakeshelf.plans import late
from lakeshelf.sinks import writers
from lakeshelf.sinks.published import read_published
from lakeshelf.sinks.tables import write_state
from lakeshelf.sources.files import high_water_mark, read_since
from lakeshelf.streaming import ingest


def _rows(spark, path):
    return sorted(((r["k"], r["v"], r["d"]) for r in spark.read.schema("k int, v string, d string").parquet(path).collect()), key=repr)


def test_write_state_keeps_null_partitions_and_moves_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    table = spark.createDataFrame([(1, "a", "d1"), (2, "a", "a:b/c"), (3, "a", None), (4, "a", "d4")], "k int, v string, d string")
    writers.overwrite(table, path, ["d"])
    batch = spark.createDataFrame([(1, "b", "d2"), (5, "n", None), (2, "b", "d1")], "k int, v string, d string")
    state = changes.upsert(spark.read.schema(table.schema).parquet(path), batch, ["k"], update="*")
    untouched = glob.glob(f"{path}/d=d4/*.parquet")
    counts = write_state(spark, state, path, ["d"])
    assert counts == {"update": 2, "insert": 1, "keep": 2}
    assert _rows(spark, path) == sorted([(1, "b", "d2"), (2, "b", "d1"), (3, "a", None), (4, "a", "d4"), (5, "n", None)], key=repr)
    assert glob.glob(f"{path}/d=d4/*.parquet") == untouched
    state = changes.upsert(spark.read.schema(table.schema).parquet(path), batch.filter("k < 0"), ["k"], update="*")
    gone = state.withColumn("_op", F.when(F.col("d").isNull(), "delete").otherwise(F.col("_op")))
    write_state(spark, gone, path, ["d"])
    assert [r[0] for r in _rows(spark, path)] == [1, 2, 4] and not glob.glob(f"{path}/d=__HIVE*/*.parquet")


@pytest.mark.parametrize("kind", ["bytes", "tiers"])
def test_compact_some_partitions_keeps_the_table_whole(spark, tmp_dir, kind):
    path = os.path.join(tmp_dir, "t")
    df = spark.range(4000).select(F.col("id").alias("k"), F.concat(F.lit("t"), F.col("id") % 2).alias("tier"), F.concat(F.lit("d"), F.col("id") % 3).alias("d"))
    df.repartition(8).write.partitionBy("d").parquet(path)
    before = {d: sorted(glob.glob(f"{path}/d={d}/*.parquet")) for d in ("d0", "d1", "d2")}
    if kind == "bytes":
        out = writers.compact(spark, path, ["d"], ["tier"], 10_000, partitions=spark.createDataFrame([("d1",)], "d string"))
        assert out["path"] == path and out["files_removed"] == 8 and out["files_added"] == 1
        assert {d: sorted(glob.glob(f"{path}/d={d}/*.parquet")) == before[d] for d in before} == {"d0": True, "d1": False, "d2": True}
    else:
        out = writers.compact(spark, path, [], ["tier"], 400)
        assert out["files_added"] >= 8  # ten wanted, though the column has two values
    assert spark.read.parquet(out["path"]).select("k").distinct().count() == 4000 == spark.read.parquet(out["path"]).count()


def test_two_feeds_share_a_table(spark, tmp_dir):
    table = os.path.join(tmp_dir, "bronze")
    schema = T._parse_datatype_string("k int, v string")
    for feed, ext in (("a", "json"), ("b", "csv")):
        os.makedirs(os.path.join(tmp_dir, feed))
        with open(os.path.join(tmp_dir, feed, "1." + ext), "w") as f:
            f.write("".join(json.dumps({"k": i, "v": feed}) + "\n" for i in range(3)) if ext == "json" else "k,v\n7,b\n8,b\n")
    for again in range(2):
        for feed, fmt in (("a", "json"), ("b", "csv")):
            ingest.bronze_files(spark, os.path.join(tmp_dir, feed), fmt, schema, table, os.path.join(tmp_dir, "c" + feed), "r", tag=feed, feed=feed).awaitTermination()
    rows = spark.read.parquet(table)
    assert sorted((r["k"], r["_source"]) for r in rows.collect()) == [(0, "a"), (1, "a"), (2, "a"), (7, "b"), (8, "b")]
    # A fresh checkpoint replays batch 0: it replaces its own folder.
    ingest.bronze_files(spark, os.path.join(tmp_dir, "a"), "json", schema, table, os.path.join(tmp_dir, "c-new"), "r", tag="a", feed="a").awaitTermination()
    assert spark.read.parquet(table).count() == 5


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_marks_do_not_depend_on_time_zones(spark, kind):
    df = spark.range(24).select(F.expr(f"timestamp_ntz'2024-03-10 00:00:00' + make_dt_interval(0, int(id))").cast(kind).alias("at"), "id")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        mark = high_water_mark(df.filter("id <= 11"), "at")
        old = os.environ.get("TZ")
        for tz in ("Asia/Tokyo", "America/New_York", "UTC"):
            os.environ["TZ"] = tz
            assert isinstance(mark, int) and sorted(r["id"] for r in read_since(df, "at", mark).collect()) == list(range(12, 24))
        os.environ.pop("TZ") if old is None else os.environ.update(TZ=old)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert read_since(df, "at", None).count() == 24 and high_water_mark(df.limit(0), "at") is None


def test_replays_with_null_keys_insert_once(spark):
    state = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(None, "n"), (1, "b"), (2, "c")], "k int, v string")
    for strategy in ("broadcast", "shuffle"):
        now = state
        for _ in range(3):
            now = changes.live(changes.upsert(now, batch, ["k"], strategy=strategy))
        assert sorted(map(tuple, now.collect()), key=repr) == sorted([(1, "a"), (2, "c"), (None, "n")], key=repr)
        gone = changes.delete_missing(now.withColumn("d", F.lit(None).cast("string")), batch.filter("k = 1").withColumn("d", F.lit(None).cast("string")), ["k"], "d", strategy)
        assert sorted(map(tuple, changes.live(gone).select("k").collect()), key=repr) == [(1,)]


def test_late_recompute_keeps_rows_without_a_date(spark):
    rows = spark.createDataFrame([(1, None, 5), (2, "d1", 7), (3, "d2", 1)], "k int, d string, q int")
    build = lambda df: df.groupBy("d").agg(F.sum("q").alias("q"))
    now = rows.union(spark.createDataFrame([(4, None, 10)], rows.schema))
    touched = late.touched_partitions(rows, now.filter("k = 4"), ["k"], "d")
    out = late.recompute_partitions(build(rows), now, touched, "d", build)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(None, 15), ("d1", 7), ("d2", 1)], key=repr)


def test_row_hash_tells_rows_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("", None), (None, ""), ("1:a", "-"), ("-", "1:a"), (None, None)]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(row_hash(["x", "y"]).alias("h")).distinct().count() == len(rows)


def test_densify_refuses_absurd_dates(spark):
    from lakeshelf.operators.windows import densify_days

    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), 2), (1, dt.date(9999, 12, 31), 2)], "k int, d date, q int")
    with pytest.raises(Exception, match="9999-12-31"):
        densify_days(df, ["k"], "d", {"q": 0}).collect()
    assert densify_days(df.filter("d < DATE'2025-01-01'"), ["k"], "d", {"q": 0}).count() == 1


def test_write_gold_adds_audit_columns_and_sets_rows_aside(spark, tmp_dir):
    from lakeshelf.sinks.gold import write_gold

    path = os.path.join(tmp_dir, "fact")
    df = spark.createDataFrame([("s", "p", "2024-01-01", 1), ("s", None, "2024-01-01", 2), ("s", "p", "2024-01-02", 3)],
                               "store_id string, product_id string, snapshot_date string, units_sold int")
    assert write_gold(spark, df, "gold.fact_inventory_kpis", path, "r1", ["snapshot_date"]) == 1
    assert [r["null_columns"] for r in spark.read.parquet(path + "__rejected").collect()] == [["product_id"]]
    day = df.filter("units_sold = 3").withColumn("units_sold", F.lit(9))
    assert write_gold(spark, day, "gold.fact_inventory_kpis", path, "r2", ["snapshot_date"], only_partitions=True) == 0
    rows = read_published(spark, path)
    assert sorted((r["units_sold"], r["pipeline_run_id"]) for r in rows.collect()) == [(1, "r1"), (9, "r2")]
    assert rows.filter("_gold_processed_at is null").count() == 0
    with pytest.raises(ValueError, match="supplier_id"):
        write_gold(spark, df, "gold.dim_supplier", path, "r3")


def test_misfits_are_counted(spark):
    from lakeshelf.schemas import misfits

    df = spark.createDataFrame([("1", "x"), ("one", "y"), (None, None)], "quantity string, note string")
    schema = T._parse_datatype_string("quantity int, note string, channel string")
    assert misfits(df, schema).first().asDict() == {"quantity": 1, "note": 0, "channel": 3}
