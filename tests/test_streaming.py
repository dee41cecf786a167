import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.plans import silver
from lakeshelf.schemas import BRONZE, conform
from lakeshelf.sources.messages import decode_messages, encode_messages
from lakeshelf.streaming import ingest

POS_SCHEMA = BRONZE["pos_transactions"]


def _pos(tid, day, qty=1, amount=10.0):
    return {"transaction_id": tid, "store_id": "S1", "product_id": "P1", "customer_id": None,
            "timestamp": f"2024-01-{day:02d}T10:00:00Z", "quantity": qty, "unit_price": 10.0,
            "total_amount": amount, "payment_method": "cash", "channel": "online"}


def _write_jsonl(path, rows):
    with open(path, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def test_file_ingest_reads_each_file_once(spark, tmp_dir):
    landing, table, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "bronze", "ckpt"))
    os.makedirs(landing)
    _write_jsonl(os.path.join(landing, "a.jsonl"), [_pos("t1", 1), _pos("t2", 1)])
    q = ingest.bronze_files(spark, landing, "json", POS_SCHEMA, table, ckpt, "run-1", tag="pos_realtime_stream")
    q.awaitTermination()
    _write_jsonl(os.path.join(landing, "b.jsonl"), [_pos("t3", 2)])
    q = ingest.bronze_files(spark, landing, "json", POS_SCHEMA, table, ckpt, "run-2", tag="pos_realtime_stream")
    q.awaitTermination()
    df = spark.read.parquet(table)
    assert df.count() == 3
    runs = {r["transaction_id"]: r["pipeline_run_id"] for r in df.collect()}
    assert runs == {"t1": "run-1", "t2": "run-1", "t3": "run-2"}
    assert df.filter(F.col("source_file").endswith("b.jsonl")).count() == 1


def test_csv_with_quoted_json_keeps_columns(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "csv")
    os.makedirs(landing)
    with open(os.path.join(landing, "po.csv"), "w") as f:
        f.write('po_id,delivery_notes,quantity\n')
        f.write('PO1,"{""carrier"":""UPS"",""notes"":""a, b""}",5\n')
    schema = "po_id string, delivery_notes string, quantity int"
    table, ckpt = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "c")
    ingest.bronze_files(spark, landing, "csv", T._parse_datatype_string(schema), table, ckpt, "r").awaitTermination()
    row = spark.read.parquet(table).collect()[0]
    assert row["quantity"] == 5 and json.loads(row["delivery_notes"])["notes"] == "a, b"


def test_message_decode_round_trip(spark):
    src = spark.createDataFrame([(1, "view", 2.5), (2, None, None)], "id long, kind string, v double")
    msgs = encode_messages(src, ["id", "kind", "v"], "topic1").union(
        spark.createDataFrame([("topic1", bytearray(b"not json"))], "topic string, value binary"))
    out = decode_messages(msgs, T._parse_datatype_string("id long, kind string, v double"), "topic1")
    rows = sorted(out.collect(), key=lambda r: (r["id"] is None, r["id"]))
    assert [(r["id"], r["kind"], r["v"]) for r in rows] == [(1, "view", 2.5), (2, None, None), (None, None, None)]
    assert {r["source_file"] for r in rows} == {"kafka://topic1"}


def test_silver_stream_is_idempotent_and_batch_reconciles(spark, tmp_dir):
    landing, bronze, silver_t = (os.path.join(tmp_dir, n) for n in ("landing", "bronze", "silver"))
    os.makedirs(landing)
    _write_jsonl(os.path.join(landing, "a.jsonl"), [_pos("t1", 1), _pos("t1", 1), _pos("t2", 2), _pos("t3", 3)])
    ingest.bronze_files(spark, landing, "json", POS_SCHEMA, bronze, os.path.join(tmp_dir, "c1"), "r1",
                        tag="pos_realtime_stream").awaitTermination()
    bronze_schema = spark.read.parquet(bronze).schema
    for ck in ("c2", "c3"):  # a fresh checkpoint replays every micro-batch: nothing may be written twice
        ingest.silver_pos_stream(spark, bronze, bronze_schema, silver_t, os.path.join(tmp_dir, ck)).awaitTermination()
    s = spark.read.parquet(silver_t)
    assert sorted(r["transaction_id"] for r in s.collect()) == ["t1", "t2", "t3"]
    # Daily batch for Jan 1 and Jan 2: t1 corrected, t2 cancelled (absent), t4 new; Jan 3 untouched.
    batch = spark.createDataFrame([_pos("t1", 1, qty=5, amount=50.0), _pos("t4", 2)], POS_SCHEMA)
    counts = ingest.silver_pos_batch(spark, batch, silver_t, run_id="daily-1")
    assert counts.get("update") == 1 and counts.get("delete") == 1 and counts.get("insert") == 1
    final = {r["transaction_id"]: (r["quantity"], r["pipeline_run_id"]) for r in spark.read.parquet(silver_t).collect()}
    # Changed rows carry the batch run; the untouched stream row keeps its micro-batch stamp.
    assert final["t1"] == (5, "daily-1") and final["t4"] == (1, "daily-1")
    assert final["t3"][0] == 1 and final["t3"][1].startswith("stream:")
    assert set(final) == {"t1", "t3", "t4"}


def test_clean_pos_malformed_values_become_null(spark):
    df = spark.createDataFrame([_pos("t1", 1), {**_pos("t2", 1), "timestamp": "garbage"}], POS_SCHEMA)
    rows = {r["transaction_id"]: r for r in silver.clean_pos(df, "x").collect()}
    assert rows["t1"]["transaction_date"] == "2024-01-01" and rows["t2"]["transaction_ts"] is None


def test_conform_projects_to_schema(spark):
    df = spark.createDataFrame([("t1", "7", "x", "extra")], "transaction_id string, quantity string, channel string, junk string")
    out = conform(df, POS_SCHEMA)
    assert out.columns == [f.name for f in POS_SCHEMA.fields]
    row = out.collect()[0]
    assert row["quantity"] == 7 and row["store_id"] is None and dict(out.dtypes)["quantity"] == "int"
    bad = conform(spark.createDataFrame([("t2", "seven")], "transaction_id string, quantity string"), POS_SCHEMA)
    assert bad.collect()[0]["quantity"] is None
