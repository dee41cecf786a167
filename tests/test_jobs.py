import datetime as dt
import os

from pyspark.sql import functions as F

from lakeshelf import runlog
from lakeshelf.plans import silver
from lakeshelf.plans.jobs import incremental_job
from lakeshelf.sinks.published import read_published

CUST = "customer_id string, age_group string, gender string, zip_code string, loyalty_tier string, " \
       "first_purchase_date string, total_spend double, preferred_categories string, ingested_at timestamp"


def _rows(spark, rows):
    return spark.createDataFrame(rows, CUST)


def test_incremental_customer_job(spark, tmp_dir):
    bronze, target, log = (os.path.join(tmp_dir, n) for n in ("bronze", "silver", "runlog"))
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    _rows(spark, [("C1", "18-25", "F", "1", " GOLD ", "2020-01-01", 10.0, '["Books"]', t1),
                  ("C2", "26-40", "M", "2", "silver", "2020-02-01", 20.0, '["Food"]', t1)]).write.parquet(bronze)
    like = silver.with_audit(silver.clean_customers(_rows(spark, [])), "")

    def apply(state, inc):
        return silver.stamp(silver.apply_customers(state, inc), "job")

    def run():
        src = spark.read.parquet(bronze)
        return incremental_job(spark, "silver_customers", src, target, like, apply, log)

    r1 = run()
    assert r1["counts"] == {"insert": 2}
    # Same source again: nothing after the mark, a successful empty run.
    assert run()["rows_read"] == 0
    # New load: C1 changes tier, C3 arrives; C2 is not re-read.
    _rows(spark, [("C1", "18-25", "F", "1", "platinum", "2020-01-01", 10.0, '["Books"]', t2),
                  ("C3", "41-60", "F", "3", "bronze", "2021-01-01", 5.0, "[]", t2)]).write.mode("append").parquet(bronze)
    r3 = run()
    assert r3["rows_read"] == 2 and r3["counts"].get("update") == 1 and r3["counts"].get("insert") == 1
    final = {r["customer_id"]: r["loyalty_tier"] for r in read_published(spark, target).collect()}
    assert final == {"C1": "Platinum", "C2": "Silver", "C3": "Bronze"}
    assert runlog.watermark(spark, log, "silver_customers") == int(t2.timestamp()) * 1_000_000
    states = runlog.run_states(spark.read.parquet(log)).filter(F.col("status") == "SUCCESS").count()
    assert states == 3
