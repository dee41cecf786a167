"""Trailing frames by running sums equal Spark's sliding frames; densification equals the join with the list of days."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeshelf.operators import windows

DAY = dt.date(2024, 1, 1)


def series(spark, seed, dates_missing=True):
    r = random.Random(seed)
    at = {(s, DAY + dt.timedelta(r.randrange(60))) for s in ("a", "b", None) for _ in range(30)}
    rows = [(s, d, r.choice([None, 0, 5, 9]), r.choice([None, 1.25, 7.5])) for s, d in sorted(at, key=repr)]
    return spark.createDataFrame(rows + [("a", None, 3, 2.0), ("c", DAY, None, None)] * dates_missing, "s string, d date, units long, price double")


@pytest.mark.parametrize("frame", ["rows", "days"])
def test_running_sums_equal_sliding_frames(spark, frame):
    df = series(spark, 1)
    t, w = windows.Trailing(("s",), "d", 7, frame), windows.series_window(["s"], "d", 7, frame)
    got = df.select("*", t.sum("units").alias("x"), t.avg("units").alias("y"), windows.exact_avg("price", 2, t).alias("z"))
    want = df.select("*", F.sum("units").over(w).alias("x"), F.avg("units").over(w).alias("y"), windows.exact_avg("price", 2, w).alias("z"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert "specifiedwindowframe(RowFrame, -7" not in got._jdf.queryExecution().executedPlan().toString()


def test_densified_rows_are_moved_once(spark):
    df = series(spark, 2)
    twice = df.union(df.filter("units = 5"))
    out = windows.densify_days(twice, ["s"], "d", {"units": 0})
    bounds = twice.groupBy("s").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    days = bounds.select("s", F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("d"))
    want = days.join(twice, ["s", "d"], "left").fillna({"units": 0})
    assert sorted(map(repr, out.collect())) == sorted(map(repr, want.collect()))
    rolled = windows.rolling(out, ["s"], "d", {"m": ("avg", "units", 30)})
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
