"""Plan-shape and skew checks: the properties the operators promise at scale."""
from pyspark.sql import functions as F

from lakeshelf.operators import changes, dedup
from lakeshelf.operators.joins import fits


def _plan(df):
    df.write.format("noop").mode("overwrite").save()  # let AQE settle
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_batch_merge_does_not_shuffle_the_target(spark):
    target = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    batch = spark.range(50).select((F.col("id") * 400).alias("k"), F.lit(99).alias("v"))
    state = changes.upsert(target, batch, ["k"], compare=["v"])
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    counts = {r["_op"]: r["count"] for r in state.groupBy("_op").count().collect()}
    assert counts == {"update": 50, "keep": 19950}


def test_large_batch_merge_uses_one_shuffled_outer_join(spark):
    target = spark.range(2000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    batch = spark.range(1000, 3000).select(F.col("id").alias("k"), F.lit(2).alias("v"))
    state = changes.upsert(target, batch, ["k"], compare=["v"], max_rows=10)
    assert "FullOuter" in state._jdf.queryExecution().executedPlan().toString()
    counts = {r["_op"]: r["count"] for r in state.groupBy("_op").count().collect()}
    assert counts == {"keep": 1000, "update": 1000, "insert": 1000}


def test_hot_key_dedup_is_correct(spark):
    # One key holds a third of all rows (with many distinct versions).
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ts"),
    ).repartition(12)
    out = dedup.latest_per_key(df, ["k"], "ts")
    assert out.count() == n - n // 3 + 1
    assert out.filter("k = -1").collect()[0]["ts"] == n - 3
    plan = _plan(out)
    assert "WindowGroupLimit" in plan


def test_fits_reads_little_of_a_large_side(spark):
    big = spark.range(0, 10_000_000, 1, 200)
    assert not fits(big, 1000)
    assert fits(spark.range(10), 1000)


def test_inventory_fact_plan_shape(spark):
    import __spark_entry__ as entry

    df = entry.queries()["fact_inventory_full"](spark, "/root/testdata/sf0.001")
    plan = _plan(df)
    # Dimension context joined through a broadcast, never a sort-merge join on a raw key.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # Dedup limited before its shuffle; the rolling frame runs as one Window over the daily grain.
    assert "WindowGroupLimit" in plan and plan.count("Window [") + plan.count("Window(") >= 1
    # Scans read only the needed columns.
    read = df._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in read and "o_totalprice" not in read


def test_broadcast_bound_shrinks_for_wide_rows(spark):
    from pyspark.sql import types as T

    from lakeshelf.operators.joins import max_broadcast_rows

    narrow = T.StructType([T.StructField("k", T.LongType())])
    wide = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(100)])
    assert max_broadcast_rows(spark, narrow) == 500_000
    assert max_broadcast_rows(spark, wide) == 64 * 1024 * 1024 // (16 + 2000)
