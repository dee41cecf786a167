"""What follows from another column decides no tie and is not computed for nothing; rules of one fact are counted in one pass."""

from pyspark.sql import functions as F

from lakeshelf.checks import queries
from lakeshelf.functions.columns import parse_iso_ts
from lakeshelf.operators import dedup, quality
from lakeshelf.plans import facts, silver

SF_SMALL = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _same_rows(got, want):
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_purchase_orders_parse_notes_only_when_read(spark):
    orders = queries.po_silver(spark, SF_SMALL)
    assert "from_json" not in _plan(orders.select("po_id", "status")) and "from_json" in _plan(orders)
    cleaned = silver.clean_purchase_orders(queries.fixture(spark, SF_SMALL, "fx_po"))
    by_all = dedup.furthest_state(cleaned, ["po_id"], "status", [c for c in cleaned.columns if c != "po_id"])
    _same_rows(orders, silver._project(by_all, silver.PO_COLUMNS))


def test_purchase_orders_that_differ_in_their_notes_alone(spark):
    row = ("a", "2024-01-02", "pending", None)
    schema = "po_id string, order_date string, status string, expected_delivery_date string, actual_delivery_date string, unit_cost string, quality_rating string, delivery_notes string"
    notes = ['{"carrier":"UPS","notes":"b"}', '{"carrier":"DHL","notes":"c"}', None, "~ no json"]
    raw = spark.createDataFrame([(*row, None, "1.5", None, n) for n in notes] + [(None, *row[1:], None, "1.5", None, n) for n in notes[2:]], schema)
    cleaned = silver.clean_purchase_orders(raw)
    _same_rows(silver.dedup_po_lifecycle(cleaned), silver._project(dedup.furthest_state(
        cleaned, ["po_id"], "status", [c for c in cleaned.columns if c != "po_id"]), silver.PO_COLUMNS))
    assert {r.po_id: r.carrier for r in silver.dedup_po_lifecycle(cleaned).collect()} == {"a": "DHL", None: None}


def test_frames_without_the_source_column_are_ordered_by_all(spark):
    made = spark.createDataFrame([("a", "pending", "UPS"), ("a", "pending", "DHL")], "po_id string, status string, carrier string")
    assert [r.carrier for r in silver.dedup_po_lifecycle(made).collect()] == ["DHL"]


def test_shelf_readings_are_parsed_only_when_read(spark):
    shelf = queries.shelf_silver(spark, SF_SMALL)
    assert "from_json" not in _plan(shelf.select("store_id", "current_quantity")) and "from_json" in _plan(shelf)
    cleaned = queries.shelf_clean(spark, SF_SMALL)
    _same_rows(shelf, silver._project(dedup.first_per_key(cleaned, ["store_id", "product_id"], [("seq", "desc")]), silver.STORE_INV_COLUMNS))


def test_the_size_of_a_master_is_looked_up_before_deduplication(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(silver, "strategy_for", lambda df, strategy="auto", max_rows=None: asked.append(df) or "shuffle")
    queries.product_current_load(spark, SF_SMALL)
    assert len(asked) == 1 and "Window" not in _plan(asked[0])


def test_instants_of_the_plain_form_are_cast_to_the_same(spark):
    texts = ["2023-08-19T22:26:11Z", "2023-02-30T00:00:00Z", "2023-08-19T24:00:00Z", "2023-08-19T23:59:60Z", "0000-01-01T00:00:00Z", "9999-12-31T23:59:59Z",
             "1582-10-10T01:02:03Z", "2023-08-19T22:26:11+02:00", " 023-08-19T22:26:11Z", "2023-08-19T22:26:11Z\n", "2023-8-19T22:26:11.1Z", "2023-08-19 22:26:11", "", None,
             "٢٠٢٣-08-19T22:26:11Z", "2023-08-19T22:26:11z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    by_pattern = F.try_to_timestamp("t", F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
    assert df.filter(~parse_iso_ts("t").eqNullSafe(by_pattern)).isEmpty()
    assert "cast(t" in _plan(df.select(parse_iso_ts("t")))


def test_rules_of_the_inventory_fact_and_its_kpis_are_counted_in_one_pass(spark, monkeypatch):
    passes = []
    counted = quality.rule_failures
    monkeypatch.setattr(quality, "rule_failures", lambda df, rules: passes.append(sorted(rules)) or counted(df, rules))
    rows = {r.rule for r in queries.q_quality_rules(spark, SF_SMALL).collect()}
    assert rows == {name for rules in quality.RULES.values() for name in rules}
    assert ["fact_status", "kpi_health"] in passes and sum(map(len, passes)) == len(rows)


def test_kpis_hand_on_columns_of_the_fact(spark):
    full = queries.full_fact(spark, SF_SMALL)
    kpis = facts.fact_inventory_kpis(full, keep=["status"])
    key = ["store_id", "product_id", "snapshot_date", "status"]
    _same_rows(kpis.select(*key), full.select(*key))
    assert kpis.columns == [*facts.KPI_COLUMNS, "status"]
