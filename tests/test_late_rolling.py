"""Late days in facts with trailing frames: the patch equals a rebuild and holds nothing else."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from lakeshelf.operators import windows
from lakeshelf.plans import late
from lakeshelf.sinks.published import current, publish, read_published

DAY = dt.date(2024, 1, 1)
SCHEMA = "s string, d date, units long"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def fact(frame):
    return lambda daily: windows.rolling(daily, ["s"], "d", {"a3": ("avg", "units", 3), "s7": ("sum", "units", 7)}, frame)


@pytest.mark.parametrize("frame", ["rows", "days"])
@pytest.mark.parametrize("seed", range(4))
def test_patch_equals_a_rebuild(spark, frame, seed):
    r = random.Random(seed)
    old = {(s, DAY + dt.timedelta(r.randrange(120))): r.randrange(9) for s in "abcd" for _ in range(40)}
    old[(None, DAY)] = 4
    new = dict(old)
    touched = []
    for s, d in r.sample(sorted((k for k in old if k[0]), key=repr), 3):  # a day changes, one goes, one comes
        touched.append((s, d))
        new[s, d] += 100
    s, d = r.choice([k for k in old if k[0] == "a"])
    del new[s, d]
    touched += [(s, d), ("b", DAY + dt.timedelta(50)), ("new", DAY), (None, DAY)]
    new["b", DAY + dt.timedelta(50)] = 55
    new["new", DAY] = 1
    new[None, DAY] = 5
    before, after = (spark.createDataFrame([(*k, v) for k, v in t.items()], SCHEMA) for t in (old, new))
    patch = late.rolling_patch(after, spark.createDataFrame(touched, "s string, d date"), ["s"], "d", 7, fact(frame), frame)
    previous, want = fact(frame)(before), fact(frame)(after)
    assert rows(patch.applied(previous)) == rows(want)
    # Rows of the patch that did not change have a touched day in their frame all the same; no other row is in it.
    unchanged = set(rows(previous)) & set(rows(patch.rows))
    days = {}
    for s, d, _ in rows(after):
        days.setdefault(s, []).append(d)
    for s, d, *_ in unchanged:
        past = sorted(x for x in days[s] if x <= d)
        start = (past[-8] if len(past) > 8 else past[0]) if frame == "rows" else d - dt.timedelta(6)
        assert any(t == s and (start <= x <= d) for t, x in touched)
    assert not any(s in ("d", "c") and s not in {t for t, _ in touched} for s, *_ in rows(patch.rows))


def test_only_touched_partitions_are_written(spark, tmp_dir):
    path = os.path.join(tmp_dir, "fact")
    daily = spark.range(300).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("s"), F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("d"), F.col("id").alias("units"))
    month = F.date_format("d", "yyyy-MM").alias("m")
    build = fact("rows")
    first = publish(spark, build(daily).select("*", month), path, ["m"])
    touched = spark.createDataFrame([("a", DAY + dt.timedelta(100))], "s string, d date")  # April; seven rows of every second day reach into April only
    now = daily.withColumn("units", F.when((F.col("s") == "a") & (F.col("d") == F.lit(DAY + dt.timedelta(100))), 7000).otherwise(F.col("units")))
    patch = late.rolling_patch(now, touched, ["s"], "d", 7, build)
    assert {r.s for r in patch.rows.collect()} == {"a"} and patch.rows.count() == 8
    patch.rows = patch.rows.select("*", month)
    second = late.publish_patch(spark, path, patch, ["m"], patch.keys.select(month))
    assert {second.part(f) for f in set(second.folders) - set(first.folders)} == {"m=2024-04"}
    assert rows(read_published(spark, path)) == rows(build(now).select("*", month))
    # A month that loses its last row goes.
    last = now.filter("d >= '2024-10-01'")
    gone = late.Patch(patch.rows.limit(0), last.select("s", "d"))
    late.publish_patch(spark, path, gone, ["m"], gone.keys.select(month))
    assert "m=2024-10" not in {second.part(f) for f in current(spark, path).folders}
    assert rows(read_published(spark, path).select("s", "d")) == rows(now.filter("d < '2024-10-01'").select("s", "d"))


def test_the_rest_of_the_series_is_not_read_into_the_frames(spark):
    seen = []
    daily = spark.range(2000).select(F.lit("a").alias("s"), F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("d"), F.col("id").alias("units"))

    def build(df):
        seen.append(df.count())
        return fact("rows")(df)

    late.rolling_patch(daily, spark.createDataFrame([("a", DAY + dt.timedelta(1500))], "s string, d date"), ["s"], "d", 7, build)
    assert seen == [15]  # seven rows before the day, the day, seven after
