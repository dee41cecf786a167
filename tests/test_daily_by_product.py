"""The full inventory fact moves each sale once after deduplication, and sorts it once, as a narrow row."""

import random
import re
from decimal import Decimal

from lakeshelf.plans import facts

SALE = ("transaction_id string, store_id string, product_id string, customer_id string, transaction_ts timestamp_ntz, quantity int, "
        "unit_price decimal(10,2), total_amount decimal(10,2), payment_method string, channel string")


def sales(spark, n=600):
    import datetime as dt

    r = random.Random(7)
    some = lambda *xs: r.choice([*xs, None])
    rows = [(some(*[f"t{i}"] * 9), some("a", "b"), some("p", "q"), some("x", "y", "z"), some(*[dt.datetime(2024, 1, d, 5) for d in range(1, 15)]), some(0, 1, 30),
             some(Decimal("1.25"), Decimal("9.99")), some(Decimal("3.10"), Decimal("0.00")), some("cash", "debit_card", "cheque"), some("online", "offline"))
            for i in range(n)]
    return spark.createDataFrame(rows, SALE)


def test_daily_grain_in_place_equals_the_grouped_one(spark):
    pos = sales(spark)
    got, want = facts.pos_daily_by_product(pos), facts.pos_daily_full(pos)
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert facts.pos_daily_by_product(pos.limit(0)).collect() == []


def test_sales_are_moved_and_sorted_once(spark):
    import __spark_entry__ as entry

    df = entry.queries()["fact_inventory_full"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "snapshot_date" not in "".join(re.findall(r"Exchange hashpartitioning\(.*", plan))
    assert len(re.findall(r"Sort \[.*snapshot_date", plan)) == 1
    kpis = entry.queries()["fact_inventory_kpis"](spark, "/root/testdata/sf0.001")
    plan = kpis._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Sort \[.*snapshot_date", plan)) == 1
