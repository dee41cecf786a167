import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.plans import late
from lakeshelf.sources.messages import encode_messages
from lakeshelf.streaming import ingest


def test_touched_dates_include_where_a_key_moved_from(spark):
    before = spark.createDataFrame([("t1", "d1", 5), ("t2", "d2", 7), ("t3", "d3", 1)], "k string, d string, v int")
    increment = spark.createDataFrame([("t1", "d4", 6), ("t9", "d2", 2)], "k string, d string, v int")
    touched = sorted(r["d"] for r in late.touched_partitions(before, increment, ["k"], "d").collect())
    assert touched == ["d1", "d2", "d4"]  # d1 loses t1, d2 gains t9, d4 gains t1; d3 untouched

    now = before.filter("k != 't1'").unionByName(increment)

    def total(df):
        return df.groupBy("d").agg(F.sum("v").alias("v"))

    result = late.recompute_partitions(total(before), now, late.touched_partitions(before, increment, ["k"], "d"),
                                       "d", total)
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, total(now).collect()))


def test_bronze_messages_stream(spark, tmp_dir):
    src_dir, table, ckpt = (os.path.join(tmp_dir, n) for n in ("msgs", "bronze", "ckpt"))
    events = spark.createDataFrame([(1, "view"), (2, "click")], "event_id long, event_type string")
    encode_messages(events, ["event_id", "event_type"], "events").write.parquet(src_dir)
    stream = spark.readStream.schema("topic string, value binary").parquet(src_dir)
    schema = T._parse_datatype_string("event_id long, event_type string")
    ingest.bronze_messages(stream, schema, "events", table, ckpt, "run-m", tag="pos_realtime_stream").awaitTermination()
    rows = spark.read.parquet(table).collect()
    assert sorted((r["event_id"], r["event_type"]) for r in rows) == [(1, "view"), (2, "click")]
    assert {r["source_file"] for r in rows} == {"kafka://events"} and {r["_source"] for r in rows} == {"pos_realtime_stream"}
