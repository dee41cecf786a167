"""DuckDB SQL for each registered query, written independently of the Spark
operators: deduplication as ``row_number``, merges as full outer joins with
``IS DISTINCT FROM``, windows as SQL frames. Fixtures come from the shared
fixture text, so both sides read identical rows."""

from __future__ import annotations

from lakeshelf.fixtures import FIXTURE_SQL, _DEPENDS, _resolve

NL = "NULLS LAST"

# Silver tables in SQL. Each entry: (depends-on, text).
CTE: dict[str, tuple[list[str], str]] = {
    "c_pos": (["fx_pos"], """
SELECT transaction_id, store_id, product_id, customer_id, strptime(ts_iso, '%Y-%m-%dT%H:%M:%SZ') AS transaction_ts,
 quantity, unit_price, total_amount, payment_method, channel,
 cast(cast(strptime(ts_iso, '%Y-%m-%dT%H:%M:%SZ') as date) as varchar) AS transaction_date, ingested_at,
 _source AS source_system FROM fx_pos"""),
    "s_pos": (["c_pos"], f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY ingested_at DESC {NL},
 product_id {NL}, quantity {NL}, total_amount {NL}, channel {NL}, payment_method {NL}, store_id {NL}, customer_id {NL},
 transaction_ts {NL}, source_system {NL}, unit_price {NL}) AS rn FROM c_pos) WHERE rn = 1"""),
    "c_wh": (["fx_warehouse"], """
SELECT warehouse_id, product_id, current_stock, reserved_stock, current_stock - reserved_stock AS available_stock,
 reorder_level, max_stock, strptime(last_updated, '%Y-%m-%d %H:%M:%S') AS last_updated, location_zone, seq, ingested_at,
 'warehouse_inventory_parquet' AS source_system FROM fx_warehouse"""),
    "s_wh": (["c_wh"], f"""
SELECT * EXCLUDE (rn, seq) FROM (SELECT *, row_number() OVER (PARTITION BY warehouse_id, product_id ORDER BY
 ingested_at DESC {NL}, seq DESC {NL}, reserved_stock {NL}, current_stock {NL}, reorder_level {NL}, max_stock {NL},
 location_zone {NL}, last_updated {NL}) AS rn FROM c_wh) WHERE rn = 1"""),
    "c_shelf": (["fx_shelf"], """
SELECT store_id, product_id, current_quantity, cast(last_restocked_date as date) AS last_restocked_date, shelf_location,
 cast(expiry_date as date) AS expiry_date, json_extract_string(temperature_reading, '$.sensor_id') AS sensor_id,
 cast(json_extract_string(temperature_reading, '$.temperature_celsius') as double) AS temperature_celsius,
 cast(json_extract_string(temperature_reading, '$.humidity') as double) AS humidity, seq, ingested_at,
 'store_inventory_jsonl' AS source_system FROM fx_shelf"""),
    "s_shelf": (["c_shelf"], """
SELECT * EXCLUDE (rn, seq) FROM (SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY seq DESC) AS rn
 FROM c_shelf) WHERE rn = 1"""),
    "c_po": (["fx_po"], """
SELECT po_id, supplier_id, product_id, order_date, expected_delivery_date, actual_delivery_date, quantity_ordered,
 unit_cost, status, quality_rating, delivery_notes, line_no, tie_part,
 json_extract_string(delivery_notes, '$.carrier') AS carrier,
 json_extract_string(delivery_notes, '$.tracking_number') AS tracking_number,
 json_extract_string(delivery_notes, '$.delivery_status') AS delivery_status,
 json_extract_string(delivery_notes, '$.notes') AS delivery_notes_text,
 strftime(order_date, '%Y-%m') AS order_year_month, 'purchase_orders_csv' AS source_system FROM fx_po"""),
    "c_cust": (["fx_customer"], """
SELECT customer_id, age_group, gender, zip_code,
 upper(substr(trim(loyalty_tier), 1, 1)) || lower(substr(trim(loyalty_tier), 2)) AS loyalty_tier,
 cast(first_purchase_date as date) AS first_purchase_date, cast(total_spend as decimal(10,2)) AS total_spend,
 from_json(trim(preferred_categories), '["VARCHAR"]') AS preferred_categories, 'customers_csv' AS source_system
 FROM fx_customer"""),
    "c_prod": (["fx_product"], """
SELECT product_id, product_name, category, subcategory, brand, supplier_id, cost_price, selling_price, weight,
 cast(json_extract_string(dimensions, '$.length') as double) AS length,
 cast(json_extract_string(dimensions, '$.width') as double) AS width,
 cast(json_extract_string(dimensions, '$.height') as double) AS height, status,
 'product_master_parquet' AS source_system FROM fx_product"""),
}

PO_ORDER = (
    "supplier_id, product_id, order_date, expected_delivery_date, actual_delivery_date, quantity_ordered, unit_cost, "
    "status, quality_rating, delivery_notes, line_no, tie_part, carrier, tracking_number, delivery_status, "
    "delivery_notes_text, order_year_month, source_system"
)
PO_COLS = (
    "po_id, supplier_id, product_id, order_date, expected_delivery_date, actual_delivery_date, quantity_ordered, "
    "unit_cost, status, quality_rating, order_year_month, carrier, tracking_number, delivery_status, "
    "delivery_notes_text, source_system"
)
PRIO = ("CASE status WHEN 'pending' THEN 1 WHEN 'shipped' THEN 2 WHEN 'delivered' THEN 3 WHEN 'cancelled' THEN 3 "
        "ELSE 0 END")


def po_dedup(src: str) -> str:
    order = ", ".join(f"{c} {NL}" for c in PO_ORDER.split(", "))
    return (f"SELECT {PO_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY po_id ORDER BY {PRIO} DESC, {order}) "
            f"AS rn FROM {src}) WHERE rn = 1")


CTE["s_po"] = (["c_po"], po_dedup("c_po"))


def build(body: str, uses: list[str], extra: list[tuple[str, str]] = ()) -> str:
    """``WITH`` clause for the fixtures / silver CTEs ``body`` uses, plus extra CTEs."""
    ordered: list[str] = []

    def add(n: str) -> None:
        if n in ordered:
            return
        deps = _DEPENDS.get(n, []) if n in FIXTURE_SQL else CTE[n][0]
        for dep in deps:
            add(dep)
        ordered.append(n)

    for u in uses:
        add(u)
    parts = []
    for n in ordered:
        text = _resolve(FIXTURE_SQL[n], lambda t: t) if n in FIXTURE_SQL else CTE[n][1]
        parts.append(f"{n} AS ({text})")
    parts += [f"{n} AS ({t})" for n, t in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body


def merge_sql(t: str, s: str, keys: list[str], cols: list[str], compare: list[str] | None = None,
              update: list[str] | None = None, update_all: bool = False) -> str:
    """MERGE semantics as one full outer join: insert unmatched batch rows, update
    the ``update`` columns of matched rows whose ``compare`` columns differ."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    if update_all:
        changed = "true"
        update = [c for c in cols if c not in keys]
    else:
        compare = compare or []
        update = update if update is not None else compare
        changed = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in compare) or "false"
    sel = []
    for c in cols:
        if c in update:
            sel.append(f"CASE WHEN t.__t IS NULL THEN s.{c} WHEN s.__s AND ({changed}) THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN t.__t IS NULL THEN s.{c} ELSE t.{c} END AS {c}")
    op = (f"CASE WHEN t.__t IS NULL THEN 'insert' WHEN s.__s AND ({changed}) THEN 'update' "
          f"WHEN s.__s THEN 'ignore' ELSE 'keep' END AS _op")
    return (f"SELECT {', '.join(sel)}, {op} FROM (SELECT *, true AS __t FROM {t}) t "
            f"FULL OUTER JOIN (SELECT *, true AS __s FROM {s}) s ON {on}")


POS_COLS = ["transaction_id", "store_id", "product_id", "customer_id", "transaction_ts", "quantity", "unit_price",
            "total_amount", "payment_method", "channel", "transaction_date", "ingested_at", "source_system"]
CUST_COLS = ["customer_id", "age_group", "gender", "zip_code", "loyalty_tier", "first_purchase_date", "total_spend",
             "preferred_categories", "source_system"]
WH_COLS = ["warehouse_id", "product_id", "current_stock", "reserved_stock", "available_stock", "reorder_level",
           "max_stock", "last_updated", "location_zone", "ingested_at", "source_system"]
SHELF_COLS = ["store_id", "product_id", "current_quantity", "last_restocked_date", "shelf_location", "expiry_date",
              "sensor_id", "temperature_celsius", "humidity", "ingested_at", "source_system"]
SHELF_CMP = ["current_quantity", "last_restocked_date", "shelf_location", "expiry_date", "sensor_id",
             "temperature_celsius", "humidity"]

ORACLE: dict[str, str] = {}

# --- POS ---------------------------------------------------------------------------------------

ORACLE["clean_pos"] = build("SELECT * FROM c_pos", ["c_pos"])
ORACLE["dedup_pos"] = build("SELECT * FROM s_pos", ["s_pos"])
ORACLE["source_routing"] = build(
    "SELECT * EXCLUDE (_source), 'web' AS _source FROM fx_pos WHERE channel = 'online'", ["fx_pos"])
ORACLE["incremental_read"] = build(
    "SELECT * FROM fx_pos WHERE ingested_at > (SELECT max(ingested_at) FROM fx_pos "
    "WHERE ingested_at < TIMESTAMP '2001-01-01 00:00:00')", ["fx_pos"])
ORACLE["surrogate_key"] = build(
    "SELECT store_id, product_id, snapshot_date, sha256(concat_ws('|', store_id, product_id, "
    "cast(snapshot_date as varchar))) AS inventory_snapshot_key FROM (SELECT DISTINCT store_id, product_id, "
    "cast(transaction_ts as date) AS snapshot_date FROM s_pos)", ["s_pos"])
ORACLE["channel_payment_split"] = build("""
SELECT store_id, product_id, cast(transaction_ts as date) AS snapshot_date,
 cast(sum(CASE WHEN channel = 'online' THEN quantity ELSE 0 END) as bigint) AS units_sold_online,
 cast(sum(CASE WHEN channel = 'offline' THEN quantity ELSE 0 END) as bigint) AS units_sold_offline,
 cast(sum(CASE WHEN payment_method = 'cash' THEN total_amount ELSE 0 END) as double) AS revenue_cash,
 cast(sum(CASE WHEN payment_method = 'credit_card' THEN total_amount ELSE 0 END) as double) AS revenue_credit_card,
 cast(sum(CASE WHEN payment_method = 'debit_card' THEN total_amount ELSE 0 END) as double) AS revenue_debit_card,
 cast(sum(CASE WHEN payment_method = 'mobile_payment' THEN total_amount ELSE 0 END) as double) AS revenue_mobile_payment
FROM s_pos GROUP BY 1, 2, 3""", ["s_pos"])
ORACLE["quality_nulls"] = build(
    "SELECT " + ", ".join(f"cast(count_if({c} IS NULL) as bigint) AS {c}_nulls" for c in POS_COLS) + " FROM s_pos", ["s_pos"])
ORACLE["quality_duplicates"] = build(
    "SELECT transaction_id, count(*) AS n FROM fx_pos GROUP BY transaction_id HAVING count(*) > 1", ["fx_pos"])
ORACLE["quality_freshness"] = build(
    "SELECT latest_ts, date_diff('second', latest_ts, TIMESTAMP '2002-01-01 00:00:00') / 3600.0 AS lag_hours, "
    "date_diff('second', latest_ts, TIMESTAMP '2002-01-01 00:00:00') / 3600.0 <= 8760 AS is_fresh "
    "FROM (SELECT max(ingested_at) AS latest_ts FROM s_pos)", ["s_pos"])
ORACLE["epoch_days"] = (
    "SELECT l_orderkey, l_linenumber, epoch_day, DATE '1970-01-01' + epoch_day AS ship_date FROM "
    "(SELECT l_orderkey, l_linenumber, cast(date_diff('day', DATE '1970-01-01', cast(l_shipdate as date)) as int) "
    "AS epoch_day FROM lineitem)")
ORACLE["message_decode"] = "SELECT event_id, user_id, event_type, value, 'kafka://events' AS source_file FROM events"
ORACLE["stream_messages"] = ORACLE["message_decode"]

# --- purchase orders / suppliers -----------------------------------------------------------------

ORACLE["flatten_po_json"] = build(
    "SELECT po_id, line_no, tie_part, carrier, tracking_number, delivery_status, delivery_notes_text, "
    "order_year_month FROM c_po", ["c_po"])
ORACLE["dedup_po_lifecycle"] = build("SELECT * FROM s_po", ["s_po"])
ORACLE["status_distribution"] = build(
    "SELECT status, delivery_status, count(*) AS n FROM s_po GROUP BY 1, 2", ["s_po"])
SUPPLIER_PERF = """
SELECT supplier_id, otd_pct, lead_time_variance, avg_delay_days, avg_quality_rating, total_orders, total_po_value,
 supplier_risk_score,
 CASE WHEN supplier_risk_score > 0.55 THEN 'Low' WHEN supplier_risk_score > 0.53 THEN 'Medium' ELSE 'High' END
   AS actual_risk_tier
FROM (SELECT *, round(otd_pct / 100 * 0.4 + coalesce(avg_quality_rating, 0.0) / 5.0 * 0.3
   + (CASE WHEN lead_time_variance > 0 THEN 1.0 - lead_time_variance / 10.0 ELSE 1.0 END) * 0.3, 3)
   AS supplier_risk_score
 FROM (SELECT supplier_id,
   round(sum(CASE WHEN d <= 0 THEN 1 ELSE 0 END) / count(*) * 100, 2) AS otd_pct,
   round(stddev_samp(cast(d as double)), 2) AS lead_time_variance,
   round(avg(cast(d as double)), 2) AS avg_delay_days,
   round(cast(sum(cast(quality_rating as decimal(28,2))) as double) / count(quality_rating), 2) AS avg_quality_rating,
   count(*) AS total_orders,
   round(cast(sum(cast(cast(quantity_ordered as decimal(10,0)) * unit_cost as decimal(30,2))) as double), 2)
     AS total_po_value
  FROM (SELECT *, date_diff('day', expected_delivery_date, actual_delivery_date) AS d FROM s_po)
  GROUP BY supplier_id))"""
ORACLE["fact_supplier_performance"] = build(SUPPLIER_PERF, ["s_po"])
ORACLE["top_suppliers"] = build(
    "SELECT * FROM perf ORDER BY supplier_risk_score DESC, supplier_id LIMIT 10", ["s_po"],
    [("perf", SUPPLIER_PERF)])
ORACLE["merge_purchase_orders"] = build(
    merge_sql("po_t", "s_po", ["po_id"], PO_COLS.split(", "), compare=["status"]), ["s_po"],
    [("po_t", po_dedup("(SELECT * FROM c_po WHERE line_no <= 3)"))])

# --- warehouse / shelf ----------------------------------------------------------------------------

ORACLE["latest_snapshot"] = build("SELECT * FROM s_wh", ["s_wh"])
WH_AGG = """
SELECT product_id, cast(sum(current_stock) as bigint) AS current_stock_qty,
 cast(sum(reserved_stock) as bigint) AS reserved_stock_qty, cast(sum(available_stock) as bigint) AS available_stock_qty,
 max(reorder_level) AS reorder_level, cast(sum(max_stock) as bigint) AS max_stock,
 arg_min(location_zone, warehouse_id) AS primary_location_zone, count(DISTINCT warehouse_id) AS warehouse_count,
 list_sort(list(DISTINCT warehouse_id)) AS warehouse_ids, max(last_updated) AS last_stock_updated
FROM s_wh GROUP BY product_id"""
ORACLE["warehouse_agg"] = build(WH_AGG, ["s_wh"])


def _wh_latest(where: str) -> str:
    return (f"SELECT * EXCLUDE (rn, seq) FROM (SELECT *, row_number() OVER (PARTITION BY warehouse_id, product_id "
            f"ORDER BY ingested_at DESC {NL}, seq DESC {NL}, reserved_stock {NL}, current_stock {NL}, "
            f"reorder_level {NL}, max_stock {NL}, location_zone {NL}, last_updated {NL}) AS rn FROM c_wh "
            f"WHERE {where}) WHERE rn = 1")


ORACLE["merge_warehouse"] = build(
    merge_sql("wh_t", "wh_s", ["warehouse_id", "product_id"], WH_COLS,
              compare=["current_stock", "reserved_stock", "available_stock", "reorder_level", "max_stock",
                       "location_zone"],
              update=["current_stock", "reserved_stock", "available_stock", "reorder_level", "max_stock",
                      "last_updated", "location_zone"]),
    ["c_wh"],
    [("wh_t", _wh_latest("ingested_at < TIMESTAMP '1998-01-01 00:00:00'")),
     ("wh_s", _wh_latest("ingested_at >= TIMESTAMP '1998-01-01 00:00:00'"))])
ORACLE["flatten_temperature"] = build(
    "SELECT store_id, product_id, seq, sensor_id, temperature_celsius, humidity FROM c_shelf", ["c_shelf"])


def _shelf_latest(where: str) -> str:
    return (f"SELECT * EXCLUDE (rn, seq) FROM (SELECT *, row_number() OVER (PARTITION BY store_id, product_id "
            f"ORDER BY seq DESC) AS rn FROM c_shelf WHERE {where}) WHERE rn = 1")


ORACLE["merge_store_inventory"] = build(
    merge_sql("sh_t", "sh_s", ["store_id", "product_id"], SHELF_COLS, compare=SHELF_CMP), ["c_shelf"],
    [("sh_t", _shelf_latest("ingested_at < TIMESTAMP '1998-01-01 00:00:00'")),
     ("sh_s", _shelf_latest("ingested_at >= TIMESTAMP '1998-01-01 00:00:00'"))])


def _rules(src: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, cast(count_if(NOT coalesce({expr}, true)) as bigint) AS failed_rows FROM {src}"
        for name, expr in rules.items())


def _quality_rules_sql() -> str:
    from lakeshelf.operators.quality import RULES

    body = " UNION ALL ".join([
        _rules("(SELECT *, source_system AS _source FROM s_pos)", RULES["pos"]),
        _rules("s_wh", RULES["warehouse"]),
        _rules("s_shelf", RULES["store_inventory"]),
        _rules("s_po", RULES["purchase_orders"]),
        _rules("fx_supplier", RULES["suppliers"]),
        _rules("c_cust", RULES["customers"]),
    ])
    return build(body, ["s_pos", "s_wh", "s_shelf", "s_po", "fx_supplier", "c_cust"])


ORACLE["quality_rules"] = _quality_rules_sql()

# --- customers --------------------------------------------------------------------------------------

ORACLE["clean_customers"] = build("SELECT * FROM c_cust", ["c_cust"])
ORACLE["explode_categories"] = build(
    "SELECT customer_id, unnest(preferred_categories) AS category FROM c_cust", ["c_cust"])


def _cust_clean(src: str) -> str:
    return CTE["c_cust"][1].replace("FROM fx_customer", f"FROM {src}")


CUST_MERGE = merge_sql("cust_t", "cust_s", ["customer_id"], CUST_COLS,
                       compare=["age_group", "gender", "zip_code", "loyalty_tier", "total_spend",
                                "preferred_categories"])
CUST_EXTRA = [("cust_t", _cust_clean("fx_customer_target")), ("cust_s", _cust_clean("fx_customer_source"))]
ORACLE["merge_customers"] = build(CUST_MERGE, ["fx_customer_target", "fx_customer_source"], CUST_EXTRA)
ORACLE["customer_job"] = build(f"SELECT * EXCLUDE (_op) FROM ({CUST_MERGE})",
                               ["fx_customer_target", "fx_customer_source"], CUST_EXTRA)
ORACLE["merge_metrics"] = build(
    "SELECT cast(count_if(_op = 'insert') as bigint) AS rows_inserted, cast(count_if(_op = 'update') as bigint) AS rows_updated, "
    "cast(count_if(_op = 'delete') as bigint) AS rows_deleted, cast(count_if(_op = 'ignore') as bigint) AS rows_ignored, "
    "cast(count_if(_op = 'close') as bigint) AS versions_closed, cast(count_if(_op = 'keep') as bigint) AS rows_untouched FROM merged",
    ["fx_customer_target", "fx_customer_source"], CUST_EXTRA + [("merged", CUST_MERGE)])
DIM_CUST_COLS = ["customer_id", "age_group", "gender", "zip_code", "loyalty_tier", "first_purchase_date",
                 "total_spend", "preferred_categories"]
ORACLE["dim_customer"] = build(
    merge_sql("cust_t", "cust_s", ["customer_id"], DIM_CUST_COLS, update_all=True),
    ["fx_customer_target", "fx_customer_source"], CUST_EXTRA)

# --- stream then batch ----------------------------------------------------------------------------------


def _pos_clean_from(src: str, tag: str) -> str:
    return (f"SELECT transaction_id, store_id, product_id, customer_id, strptime(ts_iso, '%Y-%m-%dT%H:%M:%SZ') "
            f"AS transaction_ts, quantity, unit_price, total_amount, payment_method, channel, "
            f"cast(cast(strptime(ts_iso, '%Y-%m-%dT%H:%M:%SZ') as date) as varchar) AS transaction_date, "
            f"ingested_at, '{tag}' AS source_system FROM {src}")


def _pos_dedup(src: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY "
            f"ingested_at DESC {NL}, product_id {NL}, quantity {NL}, total_amount {NL}, channel {NL}, "
            f"payment_method {NL}, store_id {NL}, customer_id {NL}, transaction_ts {NL}, source_system {NL}, "
            f"unit_price {NL}) AS rn FROM ({src})) WHERE rn = 1")


STREAM_EXTRA = [
    ("st_all", _pos_dedup(_pos_clean_from("fx_pos_stream", "pos_realtime_stream"))),
    ("st_first", _pos_dedup(_pos_clean_from(
        "(SELECT * FROM fx_pos_stream WHERE ingested_at < TIMESTAMP '1997-01-01 00:00:00')", "pos_realtime_stream"))),
    ("batch", _pos_dedup(_pos_clean_from("fx_pos_batch", "pos_batch_csv"))),
]
# After micro-batch 1 every row is an insert; micro-batch 2 replays it (ignore) and adds the rest (insert).
STREAM_STATE = merge_sql("st_first", "st_all", ["transaction_id"], POS_COLS)
ORACLE["merge_insert_only"] = build(STREAM_STATE, ["fx_pos_stream", "fx_pos_batch"], STREAM_EXTRA)
STREAM_LIVE = STREAM_EXTRA + [("stream_state", f"SELECT * EXCLUDE (_op) FROM ({STREAM_STATE})")]
BATCH_MERGE = merge_sql("stream_state", "batch", ["transaction_id"], POS_COLS,
                        compare=["total_amount", "quantity", "payment_method", "channel"])
ORACLE["merge_pos_batch"] = build(BATCH_MERGE, ["fx_pos_stream", "fx_pos_batch"], STREAM_LIVE)
ORACLE["batch_scope_semi"] = build(
    "SELECT transaction_id, transaction_date FROM stream_state WHERE transaction_date IN "
    "(SELECT transaction_date FROM batch)", ["fx_pos_stream", "fx_pos_batch"], STREAM_LIVE)
ORACLE["cancelled_anti"] = build(
    "SELECT transaction_id, transaction_date FROM stream_state s WHERE transaction_date IN "
    "(SELECT transaction_date FROM batch) AND NOT EXISTS (SELECT 1 FROM batch b "
    "WHERE b.transaction_id = s.transaction_id)", ["fx_pos_stream", "fx_pos_batch"], STREAM_LIVE)
ORACLE["reconcile_batch"] = build(
    "SELECT * EXCLUDE (_op), CASE WHEN transaction_date IN (SELECT transaction_date FROM batch) AND NOT EXISTS "
    "(SELECT 1 FROM batch b WHERE b.transaction_id = m.transaction_id) THEN 'delete' ELSE _op END AS _op "
    "FROM merged m", ["fx_pos_stream", "fx_pos_batch"], STREAM_LIVE + [("merged", BATCH_MERGE)])

# --- SCD2 and dimensions -----------------------------------------------------------------------------------


def _prod_clean(src: str) -> str:
    return CTE["c_prod"][1].replace("FROM fx_product", f"FROM {src}")


PROD_BIZ = ["product_id", "product_name", "category", "subcategory", "brand", "supplier_id", "cost_price",
            "selling_price", "weight", "length", "width", "height", "status", "source_system"]
PROD_TRACKED = ["product_name", "category", "subcategory", "brand", "supplier_id", "cost_price", "selling_price",
                "weight", "length", "width", "height", "status"]


def _hash_sql(cols: list[str]) -> str:
    """md5 of the tracked texts, each with its length before it and ``-`` for NULL."""
    one = "coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
    return "md5(" + " || ".join(one.format(c=c) for c in cols) + ") AS scd_hash"


def _scd2_sql(s1: str, s2: str, key: str, biz: list[str], tracked: list[str]) -> str:
    """Versions after two loads at 2024-01-01 and 2024-02-01: load 1 opens every key;
    load 2 closes and reopens keys whose tracked values differ (NULL-safe) and opens new keys."""
    cols = ", ".join(biz)
    diff = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in tracked)
    t1 = "TIMESTAMP '2024-01-01 00:00:00'"
    t2 = "TIMESTAMP '2024-02-01 00:00:00'"
    changed = f"(SELECT b.{key} FROM {s1} a JOIN {s2} b ON a.{key} = b.{key} WHERE {diff})"
    return f"""
SELECT {cols}, {t1} AS valid_from,
 CASE WHEN {key} IN {changed} THEN {t2} ELSE CAST(NULL AS TIMESTAMP) END AS valid_to,
 {key} NOT IN {changed} AS is_current,
 CASE WHEN {key} IN {changed} THEN 'close' ELSE 'keep' END AS _op FROM {s1}
UNION ALL
SELECT {cols}, {t2} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current, 'insert' AS _op
FROM {s2} WHERE {key} IN {changed} OR {key} NOT IN (SELECT {key} FROM {s1})"""


PROD_EXTRA = [("p1", _prod_clean("fx_product_t1")), ("p2", _prod_clean("fx_product_t2"))]
PROD_SCD = _scd2_sql("p1", "p2", "product_id", PROD_BIZ, PROD_TRACKED)
ORACLE["scd2_product"] = build(PROD_SCD, ["fx_product_t1", "fx_product_t2"], PROD_EXTRA)
ORACLE["scd2_classify"] = build(
    "SELECT b.product_id, b.cost_price, CASE WHEN a.product_id IS NULL THEN 'new' WHEN "
    + " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in PROD_TRACKED)
    + " THEN 'changed' ELSE 'same' END AS _action FROM p2 b LEFT JOIN p1 a ON a.product_id = b.product_id",
    ["fx_product_t1", "fx_product_t2"], PROD_EXTRA)
ORACLE["scd2_as_of"] = build("""
SELECT ts AS as_of_ts, product_id, cost_price, valid_from, valid_to FROM versions,
 (SELECT unnest([TIMESTAMP '2023-12-31 00:00:00', TIMESTAMP '2024-01-15 00:00:00', TIMESTAMP '2024-03-01 00:00:00'])
  AS ts) t
WHERE valid_from <= ts AND (valid_to IS NULL OR ts < valid_to)""",
                             ["fx_product_t1", "fx_product_t2"], PROD_EXTRA + [("versions", PROD_SCD)])
ORACLE["dim_product"] = build("""
SELECT product_id, product_name, category, subcategory, brand, supplier_id, cost_price, selling_price,
 round(CASE WHEN selling_price > 0 THEN (cast(selling_price as double) - cast(cost_price as double))
   / cast(selling_price as double) * 100 ELSE 0.0 END, 2) AS profit_margin_pct,
 CASE WHEN selling_price >= 500 THEN 'Premium' WHEN selling_price >= 100 THEN 'Mid-range' ELSE 'Budget' END
   AS price_tier, weight, length, width, height, status
FROM versions WHERE is_current""", ["fx_product_t1", "fx_product_t2"], PROD_EXTRA + [("versions", PROD_SCD)])

STORE_SNAP = ("SELECT store_id, store_name, region, city, store_type, cast(opening_date as date) AS opening_date, "
              "'store_master_csv' AS source_system FROM (SELECT *, row_number() OVER (PARTITION BY store_id "
              "ORDER BY seq DESC) AS rn FROM {src}) WHERE rn = 1")
STORE_EXTRA = [("st1", STORE_SNAP.format(src="fx_store")), ("st2", STORE_SNAP.format(src="fx_store_t2"))]
STORE_BIZ = ["store_id", "store_name", "region", "city", "store_type", "opening_date", "source_system"]
STORE_SCD = _scd2_sql("st1", "st2", "store_id", STORE_BIZ, ["store_name", "region", "city", "store_type",
                                                            "opening_date"])
ORACLE["scd2_store"] = build(f"SELECT *, {_hash_sql(['store_name', 'region', 'city', 'store_type', 'opening_date'])} FROM ({STORE_SCD})",
                             ["fx_store", "fx_store_t2"], STORE_EXTRA)
ORACLE["dim_store"] = build("""
SELECT store_id, store_name, region, city, store_type,
 CASE WHEN store_type = 'Warehouse' THEN 'Large' WHEN store_type = 'Superstore' THEN 'Medium' ELSE 'Small' END
   AS store_size_tier, opening_date,
 round(date_diff('day', opening_date, DATE '2024-06-30') / 365.25, 1) AS years_in_operation
FROM versions WHERE is_current""", ["fx_store", "fx_store_t2"], STORE_EXTRA + [("versions", STORE_SCD)])

SUP_SNAP = ("SELECT supplier_id, supplier_name, category, performance_rating, on_time_delivery_pct, "
            "'supplier_master_csv' AS source_system FROM {src}")
SUP_EXTRA = [("su1", SUP_SNAP.format(src="fx_supplier")), ("su2", SUP_SNAP.format(src="fx_supplier_t2"))]
SUP_BIZ = ["supplier_id", "supplier_name", "category", "performance_rating", "on_time_delivery_pct", "source_system"]
SUP_SCD = _scd2_sql("su1", "su2", "supplier_id", SUP_BIZ, ["supplier_name", "category", "performance_rating",
                                                           "on_time_delivery_pct"])
ORACLE["scd2_supplier"] = build(f"SELECT *, {_hash_sql(['supplier_name', 'category', 'performance_rating', 'on_time_delivery_pct'])} FROM ({SUP_SCD})",
                                ["fx_supplier", "fx_supplier_t2"], SUP_EXTRA)
ORACLE["dim_supplier"] = build("""
SELECT supplier_id, supplier_name, category, performance_rating, on_time_delivery_pct,
 CASE WHEN on_time_delivery_pct >= 90 THEN 'Low' WHEN on_time_delivery_pct >= 80 THEN 'Medium' ELSE 'High' END
   AS baseline_risk_tier,
 CASE WHEN performance_rating >= 4.5 THEN 'Excellent' WHEN performance_rating >= 3.5 THEN 'Good' ELSE 'Average' END
   AS performance_band
FROM versions WHERE is_current""", ["fx_supplier", "fx_supplier_t2"], SUP_EXTRA + [("versions", SUP_SCD)])

ORACLE["dim_date"] = """
SELECT date, cast(strftime(date, '%Y%m%d') as int) AS date_key, cast(year(date) as int) AS year, cast(quarter(date) as int) AS quarter,
 cast(month(date) as int) AS month, cast(day(date) as int) AS day, cast(dayofweek(date) + 1 as int) AS day_of_week, cast(dayofyear(date) as int) AS day_of_year,
 cast(weekofyear(date) as int) AS week_of_year, strftime(date, '%B') AS month_name, strftime(date, '%b') AS month_short,
 strftime(date, '%A') AS day_name, strftime(date, '%a') AS day_short, strftime(date, '%Y-%m') AS year_month,
 strftime(date, '%Y') || '-Q' || cast(quarter(date) as varchar) AS year_quarter,
 dayofweek(date) IN (0, 6) AS is_weekend, dayofweek(date) NOT IN (0, 6) AS is_weekday,
 CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) IN (3, 4, 5) THEN 'Spring'
  WHEN month(date) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
 cast(strftime(date, '%Y%m') as int) AS year_month_key
FROM (SELECT cast(unnest(generate_series(min(cast(l_shipdate as date)), max(cast(l_shipdate as date)),
  INTERVAL 1 DAY)) as date) AS date FROM lineitem)"""

# --- facts and windows ---------------------------------------------------------------------------------------

W = "PARTITION BY store_id, product_id ORDER BY {o} ROWS BETWEEN {n} PRECEDING AND CURRENT ROW"
DBL = "cast({} as double)"

POS_AGG = """
SELECT store_id, product_id, cast(transaction_ts as date) AS snapshot_date,
 cast(sum(quantity) as bigint) AS units_sold, cast(sum(total_amount) as double) AS total_revenue,
 avg(cast(unit_price as double)) AS avg_selling_price, count(DISTINCT transaction_id) AS transaction_count,
 count(DISTINCT customer_id) AS unique_customers,
 cast(sum(CASE WHEN channel = 'online' THEN quantity ELSE 0 END) as bigint) AS units_sold_online,
 cast(sum(CASE WHEN channel = 'offline' THEN quantity ELSE 0 END) as bigint) AS units_sold_offline,
 cast(sum(CASE WHEN payment_method = 'cash' THEN total_amount ELSE 0 END) as double) AS revenue_cash,
 cast(sum(CASE WHEN payment_method = 'credit_card' THEN total_amount ELSE 0 END) as double) AS revenue_credit_card,
 cast(sum(CASE WHEN payment_method = 'debit_card' THEN total_amount ELSE 0 END) as double) AS revenue_debit_card,
 cast(sum(CASE WHEN payment_method = 'mobile_payment' THEN total_amount ELSE 0 END) as double) AS revenue_mobile_payment
FROM s_pos GROUP BY 1, 2, 3"""
FULL = f"""
SELECT sha256(concat_ws('|', store_id, product_id, cast(snapshot_date as varchar))) AS inventory_snapshot_key,
 snapshot_date, store_id, product_id, supplier_id, product_name, category, subcategory, brand, status, cost_price,
 selling_price, units_sold, avg_daily_sales_30d, total_revenue, avg_selling_price, transaction_count, unique_customers,
 units_sold_online, units_sold_offline, revenue_cash, revenue_credit_card, revenue_debit_card, revenue_mobile_payment,
 round((avg_selling_price - cost_price) * units_sold, 2) AS gross_profit,
 round(CASE WHEN total_revenue > 0 THEN (total_revenue - cost_price * units_sold) / total_revenue * 100 ELSE 0.0 END, 2)
   AS gross_margin_pct,
 round(avg_selling_price - cost_price, 2) AS profit_per_unit,
 current_stock_qty, reserved_stock_qty, available_stock_qty, reorder_level, max_stock, warehouse_count,
 primary_location_zone, warehouse_ids, last_stock_updated,
 round(CASE WHEN avg_daily_sales_30d > 0 THEN available_stock_qty / avg_daily_sales_30d ELSE NULL END, 1)
   AS stock_cover_days,
 round(CASE WHEN units_sold + available_stock_qty > 0 THEN units_sold / (units_sold + available_stock_qty) * 100
   ELSE 0.0 END, 2) AS sell_through_rate,
 round(CASE WHEN max_stock > 0 THEN current_stock_qty / max_stock * 100 ELSE 0.0 END, 1) AS stock_utilisation_pct,
 round(CASE WHEN units_sold > 0 THEN units_sold_online / units_sold * 100 ELSE 0.0 END, 1) AS online_sales_pct,
 CASE WHEN available_stock_qty <= reorder_level THEN 1 ELSE 0 END AS reorder_flag,
 CASE WHEN available_stock_qty = 0 THEN 1 ELSE 0 END AS stockout_flag,
 CASE WHEN current_stock_qty > max_stock * cast(0.9 as double) THEN 1 ELSE 0 END AS overstock_flag
FROM (SELECT *, round(avg(units_sold) OVER ({W.format(o="snapshot_date", n=30)}), 2) AS avg_daily_sales_30d
 FROM pos_agg JOIN pm USING (product_id) JOIN wh_agg USING (product_id))"""
FULL_EXTRA = [
    ("pos_agg", POS_AGG), ("wh_agg", WH_AGG),
    ("pm", "SELECT product_id, product_name, category, subcategory, brand, supplier_id, cast(cost_price as double) "
           "AS cost_price, cast(selling_price as double) AS selling_price, status FROM c_prod"),
]
ORACLE["fact_inventory_full"] = build(FULL, ["s_pos", "s_wh", "c_prod"], FULL_EXTRA)

POS_AGG_DENSE = """
SELECT d.store_id, d.product_id, d.snapshot_date, coalesce(x.units_sold, 0) AS units_sold,
 coalesce(x.total_revenue, 0.0) AS total_revenue, x.avg_selling_price,
 coalesce(x.transaction_count, 0) AS transaction_count, coalesce(x.unique_customers, 0) AS unique_customers,
 coalesce(x.units_sold_online, 0) AS units_sold_online, coalesce(x.units_sold_offline, 0) AS units_sold_offline,
 coalesce(x.revenue_cash, 0.0) AS revenue_cash, coalesce(x.revenue_credit_card, 0.0) AS revenue_credit_card,
 coalesce(x.revenue_debit_card, 0.0) AS revenue_debit_card,
 coalesce(x.revenue_mobile_payment, 0.0) AS revenue_mobile_payment
FROM (SELECT store_id, product_id, cast(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) as date) AS snapshot_date
  FROM (SELECT store_id, product_id, min(snapshot_date) AS lo, max(snapshot_date) AS hi FROM pos_agg GROUP BY 1, 2)) d
LEFT JOIN pos_agg x ON d.store_id = x.store_id AND d.product_id = x.product_id AND d.snapshot_date = x.snapshot_date"""
FULL_DENSE = FULL.replace("FROM pos_agg JOIN pm", "FROM pos_agg_dense JOIN pm")

W30 = W.format(o="snapshot_date", n=30)
W90 = W.format(o="snapshot_date", n=90)
KPI = f"""
SELECT store_id, product_id, snapshot_date, category, subcategory, brand,
 round(CASE WHEN avg_stock_value_30d > 0 THEN cogs_30d / avg_stock_value_30d ELSE 0.0 END, 3) AS inventory_turnover_ratio,
 overstock_risk_index, avg_daily_sales_30d, avg_days_on_hand_30d, units_sold_90d, cogs_30d, avg_stock_value_30d,
 is_dead_stock, current_stock_qty, available_stock_qty, reserved_stock_qty, stock_value,
 round(CASE WHEN is_dead_stock OR overstock_risk_index > 1.5 THEN stock_value ELSE 0.0 END, 2) AS stock_value_at_risk,
 stockout_flag, reorder_flag, overstock_flag,
 CASE WHEN stockout_flag = 1 THEN 'Critical — Stockout' WHEN is_dead_stock THEN 'Critical — Dead Stock'
  WHEN overstock_risk_index > 1.5 THEN 'Warning — Overstock' WHEN reorder_flag = 1 THEN 'Warning — Low Stock'
  ELSE 'Healthy' END AS inventory_health
FROM (SELECT *,
  round(CASE WHEN avg_daily_sales_30d > 0 THEN current_stock_qty / (avg_daily_sales_30d * 30) ELSE 999.0 END, 2)
    AS overstock_risk_index,
  units_sold_90d = 0 AND current_stock_qty > 0 AS is_dead_stock
 FROM (SELECT * EXCLUDE (avg_daily_sales_30d), current_stock_qty * cost_price AS stock_value,
   cast(sum(cast(units_sold * cast(cost_price as decimal(12,2)) as decimal(30,2))) OVER ({W30}) as double) AS cogs_30d,
   round(cast(sum(cast(current_stock_qty * cast(cost_price as decimal(12,2)) as decimal(30,2))) OVER ({W30}) as double)
     / count(*) OVER ({W30}), 2) AS avg_stock_value_30d,
   round(avg(units_sold) OVER ({W30}), 2) AS avg_daily_sales_30d,
   cast(sum(units_sold) OVER ({W90}) as bigint) AS units_sold_90d,
   round(cast(sum(cast(stock_cover_days as decimal(28,1))) OVER ({W30}) as double)
     / nullif(count(stock_cover_days) OVER ({W30}), 0), 1) AS avg_days_on_hand_30d
  FROM full_fact))"""
ORACLE["fact_inventory_kpis"] = build(KPI, ["s_pos", "s_wh", "c_prod"], FULL_EXTRA + [("full_fact", FULL)])
ORACLE["fact_inventory_kpis_dense"] = build(
    KPI, ["s_pos", "s_wh", "c_prod"],
    FULL_EXTRA + [("pos_agg_dense", POS_AGG_DENSE), ("full_fact", FULL_DENSE)])

DAILY = """
SELECT store_id, product_id, cast(transaction_ts as date) AS transaction_date, cast(sum(quantity) as bigint) AS units_sold,
 cast(sum(total_amount) as double) AS revenue, count(*) AS transaction_count,
 avg(cast(unit_price as double)) AS avg_unit_price FROM s_pos GROUP BY 1, 2, 3"""
DAILY_FACT = """
SELECT d.store_id, d.product_id, d.transaction_date, units_sold, revenue, transaction_count, avg_unit_price,
 current_stock, available_stock, reorder_level, max_stock, cost_price, selling_price, category, supplier_id,
 current_quantity, expiry_date,
 round(cast(coalesce(available_stock, 0) as double) * coalesce(cost_price, 0.0), 2) AS stock_value,
 CASE WHEN units_sold > 0 THEN round(cast(coalesce(current_quantity, 0) as double) / cast(units_sold as double), 1)
   ELSE 999.0 END AS days_on_hand,
 greatest(0.0, coalesce(reorder_level, 0.0) - cast(coalesce(available_stock, 0) as double)) AS reorder_quantity,
 coalesce(current_quantity, 0) = 0 AS is_stockout,
 coalesce(current_quantity, 0) > 0 AND coalesce(current_quantity, 0) <= 20 AS is_low_stock,
 round(cast(coalesce(current_quantity, 0) as double) * coalesce(cost_price, 0.0), 2) AS stock_value_at_cost,
 greatest(0.0, coalesce(reorder_level, 0.0) - cast(coalesce(current_quantity, 0) as double)) AS reorder_needed_qty,
 CASE WHEN coalesce(current_quantity, 0) = 0 THEN 'Stockout' WHEN coalesce(current_quantity, 0) <= 20 THEN 'Low Stock'
  WHEN cast(coalesce(current_quantity, 0) as double) > coalesce(max_stock, 0.0) * cast(0.9 as double) THEN 'Overstock'
  ELSE 'Healthy' END AS inventory_health_status
FROM daily d
LEFT JOIN (SELECT product_id, cast(sum(current_stock) as bigint) AS current_stock,
  cast(sum(available_stock) as bigint) AS available_stock, avg(cast(reorder_level as double)) AS reorder_level,
  avg(cast(max_stock as double)) AS max_stock FROM s_wh GROUP BY product_id) w ON d.product_id = w.product_id
LEFT JOIN (SELECT product_id, cast(cost_price as double) AS cost_price, cast(selling_price as double) AS selling_price,
  category, supplier_id FROM c_prod) p ON d.product_id = p.product_id
LEFT JOIN (SELECT store_id, product_id, current_quantity, expiry_date FROM s_shelf) i
  ON d.store_id = i.store_id AND d.product_id = i.product_id"""
ORACLE["fact_daily_inventory"] = build(DAILY_FACT, ["s_pos", "s_wh", "c_prod", "s_shelf"], [("daily", DAILY)])

WT = {n: W.format(o="transaction_date", n=n) for n in (7, 30, 90)}
ORACLE["fact_demand_trends"] = build(f"""
SELECT store_id, product_id, cast(transaction_date as timestamp) AS inventory_date,
 cast(year(transaction_date) as int) AS year_num, cast(month(transaction_date) as int) AS month_num,
 strftime(transaction_date, '%Y-%m') AS year_month, units_sold, a7 AS avg_units_7d, a30 AS avg_units_30d,
 a90 AS avg_units_90d, avg_rev_7d, avg_rev_30d,
 round(CASE WHEN a90 > 0 THEN a7 / a90 ELSE 1.0 END, 3) AS seasonality_index,
 CASE WHEN a7 > a30 * cast(1.1 as double) THEN 'Rising' WHEN a7 < a30 * cast(0.9 as double) THEN 'Falling'
  ELSE 'Stable' END AS trend_direction
FROM (SELECT *, round(avg(units_sold) OVER ({WT[7]}), 2) AS a7, round(avg(units_sold) OVER ({WT[30]}), 2) AS a30,
  round(avg(units_sold) OVER ({WT[90]}), 2) AS a90,
  round(cast(sum(cast(revenue as decimal(28,2))) OVER ({WT[7]}) as double) / count(revenue) OVER ({WT[7]}), 2)
    AS avg_rev_7d,
  round(cast(sum(cast(revenue as decimal(28,2))) OVER ({WT[30]}) as double) / count(revenue) OVER ({WT[30]}), 2)
    AS avg_rev_30d
 FROM daily)""", ["s_pos"], [("daily", DAILY)])

ORACLE["fact_customer_sales"] = build("""
SELECT p.transaction_id, p.customer_id, p.store_id, p.product_id, p.transaction_ts, p.quantity,
 cast(p.unit_price as double) AS unit_price, cast(p.total_amount as double) AS total_amount, c.age_group, c.gender,
 c.zip_code, c.loyalty_tier, c.preferred_categories,
 cast(date_diff('day', c.first_purchase_date, DATE '2024-06-30') as int) AS customer_tenure_days, p.channel,
 p.payment_method, cast(p.transaction_ts as date) AS transaction_date
FROM s_pos p LEFT JOIN c_cust c ON p.customer_id = c.customer_id""", ["s_pos", "c_cust"])

DAILY_UNITS = ("SELECT store_id, product_id, cast(transaction_ts as date) AS transaction_date, "
               "cast(sum(quantity) as bigint) AS units_sold, cast(sum(total_amount) as double) AS revenue "
               "FROM s_pos GROUP BY 1, 2, 3")
ORACLE["rolling_avg"] = build(f"""
SELECT *, round(avg(units_sold) OVER ({WT[7]}), 2) AS avg_units_7d,
 round(avg(units_sold) OVER ({WT[30]}), 2) AS avg_units_30d, round(avg(units_sold) OVER ({WT[90]}), 2) AS avg_units_90d
FROM du""", ["s_pos"], [("du", DAILY_UNITS)])
ORACLE["rolling_sum"] = build(f"""
SELECT *, cast(sum(units_sold) OVER ({WT[30]}) as bigint) AS units_30d,
 cast(sum(units_sold) OVER ({WT[90]}) as bigint) AS units_90d,
 cast(sum(cast(revenue as decimal(28,2))) OVER ({WT[30]}) as double) AS revenue_30d
FROM du""", ["s_pos"], [("du", DAILY_UNITS)])
RANGE = ("PARTITION BY store_id, product_id ORDER BY date_diff('day', DATE '1970-01-01', transaction_date) "
         "RANGE BETWEEN {n} PRECEDING AND CURRENT ROW")
ORACLE["rolling_avg_days"] = build(f"""
SELECT *, round(avg(units_sold) OVER ({RANGE.format(n=29)}), 2) AS avg_units_30d,
 cast(sum(units_sold) OVER ({RANGE.format(n=6)}) as bigint) AS units_7d
FROM du""", ["s_pos"], [("du", DAILY_UNITS)])
ORACLE["densify_days"] = build(f"""
SELECT *, round(avg(units_sold) OVER ({WT[30]}), 2) AS avg_units_30d FROM (
 SELECT d.store_id, d.product_id, d.transaction_date, coalesce(x.units_sold, 0) AS units_sold,
  coalesce(x.revenue, 0.0) AS revenue
 FROM (SELECT store_id, product_id, cast(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) as date) AS transaction_date
   FROM (SELECT store_id, product_id, min(transaction_date) AS lo, max(transaction_date) AS hi FROM du GROUP BY 1, 2)) d
 LEFT JOIN du x ON d.store_id = x.store_id AND d.product_id = x.product_id AND d.transaction_date = x.transaction_date)
""", ["s_pos"], [("du", DAILY_UNITS)])

# Late data: the incremental recompute of the touched dates must equal a full recompute.
DAILY_SALES = ("SELECT cast(transaction_ts as date) AS transaction_date, store_id, product_id, "
               "cast(sum(quantity) as bigint) AS units_sold, cast(sum(total_amount) as double) AS revenue, "
               "count(*) AS transaction_count FROM s_pos GROUP BY 1, 2, 3")
ORACLE["late_dates"] = build(DAILY_SALES, ["s_pos"])
_ROLLED = """SELECT *, round(avg(units_sold) OVER ({a}), 2) AS avg_units_7d, round(avg(units_sold) OVER ({b}), 2) AS avg_units_90d,
 cast(sum(units_sold) OVER ({c}) as bigint) AS units_30d FROM ds"""
ORACLE["late_dates_rolling"] = build(_ROLLED.format(a=WT[7], b=WT[90], c=WT[30]), ["s_pos"], [("ds", DAILY_SALES)])
ORACLE["late_dates_rolling_days"] = build(_ROLLED.format(a=RANGE.format(n=6), b=RANGE.format(n=89), c=RANGE.format(n=29)), ["s_pos"], [("ds", DAILY_SALES)])
ORACLE["partition_overwrite"] = build(DAILY_SALES, ["s_pos"])
ORACLE["run_log_latest"] = build("""
SELECT 'pos-' || cast(load_day as varchar) AS run_id, 'silver_pos' AS pipeline_name, 'SUCCESS' AS status,
 cast(load_day as timestamp) + INTERVAL 1 HOUR AS recorded_at, rows_read, watermark
FROM (SELECT cast(ingested_at as date) AS load_day, count(*) AS rows_read, max(ingested_at) AS watermark FROM fx_pos GROUP BY 1 ORDER BY load_day DESC LIMIT 1)""", ["fx_pos"])


# Streams and tables that are written and read back: the rows themselves.
ORACLE["two_feeds"] = build("""
SELECT transaction_id, store_id, product_id, customer_id, ts_iso AS "timestamp", quantity, payment_method, channel, _source FROM fx_pos""", ["fx_pos"])
ORACLE["parquet_lineage"] = build("""
SELECT _source, 'run-0' AS pipeline_run_id, count(*) AS n, count(*) AS with_file, count(*) AS with_date FROM fx_pos GROUP BY _source""", ["fx_pos"])
ORACLE["table_stream_upsert"] = build("""
SELECT transaction_date, count(*) AS n, count(*) AS n_keys FROM (
 SELECT transaction_id, strftime(strptime(ts_iso, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%d') AS transaction_date, row_number() OVER (
  PARTITION BY transaction_id ORDER BY product_id NULLS LAST, quantity NULLS LAST, channel NULLS LAST, payment_method NULLS LAST,
  store_id NULLS LAST, customer_id NULLS LAST, ts_iso NULLS LAST) AS rn
 FROM fx_pos WHERE _source = 'pos_realtime_stream') WHERE rn = 1 GROUP BY transaction_date""", ["fx_pos"])
ORACLE["write_state_partitions"] = """
WITH t AS (SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 't:' || (c_custkey % 5) END AS tier FROM customer WHERE c_custkey % 4 <> 0),
s AS (SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, CASE WHEN c_nationkey % 7 = 0 THEN NULL ELSE 't:' || (c_nationkey % 5) END AS tier FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 4 = 0)
SELECT * FROM s UNION ALL SELECT * FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM s)"""
ORACLE["compact_table"] = "SELECT o_orderkey, o_custkey, o_orderstatus, 'p' || (o_orderkey % 3) AS part FROM orders"


_STATUS_TOTALS = "SELECT '{name}' AS reader, o_orderstatus, count(*) AS n, cast(sum({f} * cast(o_totalprice as decimal(18,2))) as double) AS total, 0 AS torn FROM orders WHERE {w} GROUP BY o_orderstatus"
ORACLE["published_swap"] = " UNION ALL ".join([
    _STATUS_TOTALS.format(name="before", f=1, w="true"),
    _STATUS_TOTALS.format(name="between", f=2, w="o_orderkey % 3 > 0"),
    _STATUS_TOTALS.format(name="after", f=2, w="o_orderkey % 3 > 0 AND o_orderstatus <> 'O'"),
    _STATUS_TOTALS.format(name="after", f=1, w="o_orderstatus = 'O'"),
])


ORACLE["crossed_commits"] = ORACLE["merge_bucketed"] = ORACLE["customer_job"]
ORACLE["stream_upsert_indexed"] = f"""
SELECT source_system, substr(transaction_date, 1, 7) AS month, count(*) AS n, count(*) AS n_keys FROM ({ORACLE["merge_insert_only"]}) GROUP BY ALL"""


ORACLE["rejected_rows"] = build("""
SELECT _source, CASE WHEN quantity % 77 = 0 THEN 'quantity: not int; transaction_id: missing' WHEN quantity % 7 = 0 THEN 'quantity: not int'
 WHEN quantity % 11 = 0 THEN 'transaction_id: missing' ELSE '' END AS reasons, count(*) AS n,
 cast(sum(CASE WHEN quantity % 7 <> 0 AND quantity % 11 <> 0 THEN quantity END) as bigint) AS units FROM fx_pos GROUP BY ALL""", ["fx_pos"])
ORACLE["raw_daily_distincts"] = build("""
SELECT store_id, product_id, cast(strptime(ts_iso, '%Y-%m-%dT%H:%M:%SZ') as date) AS snapshot_date, count(DISTINCT transaction_id) AS transaction_count,
 count(DISTINCT customer_id) AS unique_customers, cast(sum(quantity) as bigint) AS units_sold,
 cast(sum(CASE WHEN channel = 'online' THEN quantity ELSE 0 END) as bigint) AS units_sold_online FROM fx_pos GROUP BY 1, 2, 3""", ["fx_pos"])
ORACLE["ordered_output"] = """
SELECT strftime(cast(o_orderdate as date), '%Y-%m-%d') AS day, count(*) AS n, min(o_orderkey) AS first, 0 AS out_of_order FROM orders GROUP BY 1"""
ORACLE["continuous_ingest"] = """
SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS n_ids, (SELECT count(*) FROM events) AS seen FROM events GROUP BY event_type"""
ORACLE["compact_curve"] = """
SELECT strftime(cast(l_shipdate as date), '%Y-%m-%d') AS ship_date, count(*) AS n, cast(sum(l_suppkey) as bigint) AS suppliers,
 true AS ship_date_skips, true AS "l_suppkey_skips" FROM lineitem GROUP BY 1"""


ORACLE["gold_write"] = f"""
SELECT year_month, CASE WHEN year_month >= '1998-01' THEN 'run-2' ELSE 'run-1' END AS pipeline_run_id, count(*) AS n,
 cast(sum(units_sold) as bigint) AS units_sold, count(*) AS stamped FROM ({ORACLE["fact_demand_trends"]}) GROUP BY year_month"""


def _all_rules_sql() -> str:
    from lakeshelf.operators.quality import RULES

    masters = build(" UNION ALL ".join([_rules("c_prod", RULES["products"]), _rules("st1", RULES["stores"])]), ["c_prod", "fx_store"], STORE_EXTRA[:1])
    gold = [_rules(f"({ORACLE[n]})", RULES[n]) for n in (
        "dim_product", "dim_store", "dim_supplier", "dim_customer", "fact_inventory_full", "fact_inventory_kpis", "fact_demand_trends",
        "fact_customer_sales", "fact_supplier_performance")]
    return " UNION ALL ".join(f"SELECT * FROM ({q})" for q in (ORACLE["quality_rules"], masters, *gold))


ORACLE["quality_rules"] = _all_rules_sql()


# --- Spark's rounding of DOUBLE -------------------------------------------------------------------------------
# Spark rounds a double half-up on its shortest decimal text (1.005 -> 1.01);
# DuckDB's round() scales the binary value (1.005 -> 1.0). The oracle applies
# Spark's rule: text of the double, DECIMAL, round, back to DOUBLE.


def _spark_round(sql: str) -> str:
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        expr, digits = sql[j + 6:comma], sql[comma + 1:k - 1].strip()
        out.append(sql[i:j])
        out.append(f"cast(round(cast(cast(cast(({_spark_round(expr)}) as double) as varchar) as decimal(38,18)), {digits}) "
                   f"as double)")
        i = k


ORACLE = {k: _spark_round(v) for k, v in ORACLE.items()}
