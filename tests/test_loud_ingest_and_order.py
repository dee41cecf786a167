"""Records that do not fit, exact distinct counts, ordered files, continuous micro-batches."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.operators.distinct import exact_distincts
from lakeshelf.sinks import writers
from lakeshelf.sources.files import ingest_stream
from lakeshelf.streaming import ingest
from lakeshelf.streaming.continuous import Progress, drained


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


SALES = "id string, qty int, price double, note string"


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_records_that_do_not_fit_are_set_aside_with_reasons(spark, tmp_dir, fmt):
    land, table, ck = (os.path.join(tmp_dir, n) for n in ("land", "t", "ck"))
    schema = T._parse_datatype_string(SALES)
    if fmt == "csv":
        write(land, "1.csv", 'id,qty,price,note\na,1,2.5,fine\nb,two,2.5,x\n,3,1.0,no id\nc,4,1e3,"{""k"": 1, ""z"": 2}"\nd,5\ne,9.5,dear,x\n')
    else:
        write(land, "1.json", '{"id": "a", "qty": 1, "price": 2.5, "note": "fine"}\n{"id": "b", "qty": "two", "price": 2.5, "note": "x"}\n'
              '{"qty": 3, "price": 1.0, "note": "no id"}\n{"id": "c", "qty": 4, "price": 1e3, "note": "{\\"k\\": 1, \\"z\\": 2}"}\n{"id": "d", \n'
              '{"id": "e", "qty": 9.5, "price": "dear", "note": "x"}\n')
    run = lambda: ingest.bronze_checked(spark, land, fmt, schema, table, ck, "r1", ["id"], feed="f", tag="src").awaitTermination()
    run()
    run()
    good = spark.read.parquet(table)
    assert rows(good.select("id", "qty", "price", "note")) == [("a", 1, 2.5, "fine"), ("c", 4, 1000.0, '{"k": 1, "z": 2}')]
    assert dict(good.dtypes)["qty"] == "int" and good.filter("source_file is null or _source <> 'src'").count() == 0
    bad = spark.read.parquet(table + "__rejected")
    reasons = {tuple(r.reasons): r.record for r in bad.collect()}
    assert ("qty: not int",) in reasons and ("id: missing",) in reasons and ("qty: not int", "price: not double") in reasons
    assert [k for k in reasons if k[0] == "malformed record"] and len(reasons) == 4
    assert "two" in reasons["qty: not int",] and bad.filter("source_file is null").count() == 0
    # A replay from a fresh checkpoint replaces the same folders.
    ingest.bronze_checked(spark, land, fmt, schema, table, ck + "2", "r1", ["id"], feed="f", tag="src").awaitTermination()
    assert spark.read.parquet(table).count() == 2 and spark.read.parquet(table + "__rejected").count() == 4


def test_parquet_landing_is_checked_for_required_fields(spark, tmp_dir):
    land, table = os.path.join(tmp_dir, "land"), os.path.join(tmp_dir, "t")
    spark.createDataFrame([("a", 1), (None, 2)], "id string, qty int").write.parquet(land)
    ingest.bronze_checked(spark, land, "parquet", T._parse_datatype_string("id string, qty int"), table, os.path.join(tmp_dir, "ck"), "r", ["id"]).awaitTermination()
    assert rows(spark.read.parquet(table).select("id", "qty")) == [("a", 1)]
    assert [r.reasons for r in spark.read.parquet(table + "__rejected").collect()] == [["id: missing"]]


def test_exact_distincts(spark):
    r = random.Random(1)
    data = [(r.choice(["hot", "hot", "hot", "a", None]), r.choice(["x", "y", None]), r.randrange(40), r.choice([None, 1, 2, 3]), r.randrange(5)) for _ in range(500)] + [("none", "x", 1, None, 2)]
    df = spark.createDataFrame(data, "k string, l string, a int, b int, v int")
    out = exact_distincts(df, ["k", "l"], {"na": "a", "nb": "b"}, [F.sum("v").alias("v"), F.max("a").alias("top")])
    want = df.groupBy("k", "l").agg(F.count_distinct("a").alias("na"), F.count_distinct("b").alias("nb"), F.sum("v").alias("v"), F.max("a").alias("top"))
    assert rows(out.select(*want.columns)) == rows(want)
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan(want) and "Expand" not in plan(out)


def test_ordered_files_with_a_hot_value(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.xxhash64("id") % 100).cast("int").alias("a"), "id")
    writers.overwrite_ordered(df.repartition(5), path, ["a"], 12)
    assert writers.out_of_order(spark, path, ["a"]).count() == 0
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 6000 // 3  # the hot value lies in several files
    assert rows(spark.read.parquet(path)) == rows(df)
    wrong = os.path.join(tmp_dir, "w")
    df.filter("a is not null").orderBy(F.desc("a")).coalesce(1).write.parquet(wrong)
    assert writers.out_of_order(spark, wrong, ["a"]).count() > 50


def test_continuous_query_goes_on_after_two_restarts(spark, tmp_dir):
    land, table, ck = (os.path.join(tmp_dir, n) for n in ("land", "t", "ck"))
    schema = T._parse_datatype_string("k int")
    with Progress(spark) as progress:
        runs = []
        for n in range(3):
            write(land, f"{n}.json", "".join(f'{{"k": {10 * n + i}}}\n' for i in range(4)))
            query = writers.append_stream(ingest_stream(spark, land, "json", schema), table, ck, available_now=False)
            if n == 1:  # input that comes while the query runs
                query.processAllAvailable()
                write(land, "1b.json", '{"k": 19}\n')
            runs.append(drained(query, progress))
            assert not query.isActive
    assert len(set(runs)) == 3 and [progress.rows[r] for r in runs] == [4, 5, 4] and progress.errors == {}
    assert [len(progress.batches[r]) for r in runs] == [1, 2, 1]
    assert rows(spark.read.parquet(table)) == sorted([(10 * n + i,) for n in range(3) for i in range(4)] + [(19,)], key=repr)
