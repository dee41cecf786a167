"""Merges and late inputs move and deduplicate their rows once."""

import re

from pyspark.sql import functions as F

from lakeshelf.checks import queries
from lakeshelf.operators import changes, dedup
from lakeshelf.plans import silver
from lakeshelf.sinks import writers

SF_SMALL = "/root/testdata/sf0.001"


def test_a_deduplicated_batch_is_merged_where_it_lies(spark):
    target = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    batch = spark.createDataFrame([("a", 5), ("a", 4), (None, 9), ("c", 7)], "k string, v int")
    state = changes.upsert(target, dedup.first_per_key(batch, ["k"], ["v"]), ["k"], compare=["v"], strategy="shuffle")
    assert sorted(map(tuple, state.collect()), key=repr) == sorted(
        [("a", 4, "update"), (None, 9, "update"), ("b", 3, "keep"), ("c", 7, "insert")], key=repr)
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[k#\d+\], \[__s_k#\d+\], FullOuter", plan)
    assert not re.search(r"Exchange hashpartitioning\(__s_k#", plan)


def test_the_size_of_a_batch_is_looked_up_before_deduplication(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(silver, "strategy_for", lambda df, strategy="auto", max_rows=None: asked.append(df) or "shuffle")
    stream = queries._bronze_pos(queries.fixture(spark, SF_SMALL, "fx_pos_stream"))
    silver.apply_pos_stream(silver.clean_pos(stream, silver.POS_STREAM_TAG).limit(0), stream)
    assert len(asked) == 1 and "Window" not in asked[0]._jdf.queryExecution().optimizedPlan().toString()


def test_late_inputs_deduplicate_raw_rows_once(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(queries, "materialize", lambda df: stored.append(df) or df)
    got = queries.late_inputs(spark, SF_SMALL)
    assert len(stored) == 2
    raw = silver.clean_pos(queries.fixture(spark, SF_SMALL, "fx_pos"), F.col("_source"), "ts_iso")
    late = F.col("ingested_at") >= F.lit(queries.INCREMENT_FROM).cast("timestamp_ntz")
    for df, rows in zip(got, (raw.filter(~late), raw, raw.filter(late)), strict=True):
        want = silver.dedup_pos(rows).withColumn("transaction_date", F.to_date("transaction_ts"))
        assert df.columns == want.columns and df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty()


def test_curve_ranks_are_found_by_halves(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x"), F.when(F.col("id") % 9 > 0, (F.col("id") % 4).cast("string")).alias("y"))
    key = writers.curve_key(df, ["x", "y"], 1000)
    assert str(key).count(" + ") + str(key).count("+(") < 10  # not one term a bound
    rows = df.select("x", "y", key.alias("k")).collect()
    bits = lambda k, place: sum((k >> bit * 2 + place & 1) << bit for bit in range(writers.CURVE_BITS))
    for place, c in enumerate("xy"):
        by_value = sorted((r[c] is not None, r[c] or 0 if c == "x" else r[c] or "", bits(r.k, place)) for r in rows)
        ranks = [b for *_, b in by_value]
        assert ranks == sorted(ranks) and len(set(ranks)) > 2
