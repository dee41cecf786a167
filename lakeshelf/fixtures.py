"""Retail-shaped inputs derived from the driver's TPC-H-style tables.

The same SQL text feeds Spark (tables resolved to parquet paths) and the DuckDB
oracle (tables resolved to its pre-registered views), so both engines start
from identical rows. Placeholders ``{lineitem}`` etc. name the base tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# Fixed fixture definitions (FIXTURES.md section 2 and 3). Text valid in Spark SQL and DuckDB.
FIXTURE_SQL: dict[str, str] = {
    "fx_pos": """
SELECT concat(cast(l_orderkey as string),'-',cast(l_linenumber as string)) AS transaction_id,
 concat('S',cast(o_custkey % 5 as string)) AS store_id, concat('P',cast(l_suppkey as string)) AS product_id,
 CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE concat('C',cast(o_custkey as string)) END AS customer_id,
 concat(cast(cast(l_shipdate as date) as string),'T00:00:00Z') AS ts_iso,
 cast(l_quantity as int) AS quantity, cast(500 + l_partkey % 500 as decimal(10,2)) AS unit_price,
 cast(l_extendedprice as decimal(10,2)) AS total_amount,
 CASE l_linenumber % 4 WHEN 0 THEN 'cash' WHEN 1 THEN 'credit_card' WHEN 2 THEN 'debit_card' ELSE 'mobile_payment' END AS payment_method,
 CASE WHEN l_returnflag = 'N' THEN 'online' ELSE 'offline' END AS channel,
 CASE WHEN l_linestatus = 'O' THEN 'pos_realtime_stream' ELSE 'pos_batch_csv' END AS _source,
 o_orderdate AS ingested_at
 FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "fx_warehouse": """
SELECT concat('W',cast(l_partkey % 4 as string)) AS warehouse_id, concat('P',cast(l_suppkey as string)) AS product_id,
 cast(l_quantity as bigint) * 4 AS current_stock, CASE WHEN l_suppkey % 40 = 7 THEN cast(l_quantity as bigint) * 4 ELSE cast(l_linenumber as bigint) * 20 END AS reserved_stock,
 cast(40 + l_partkey % 30 as bigint) AS reorder_level, cast(120 + l_suppkey % 80 as bigint) AS max_stock,
 concat(cast(cast(l_shipdate as date) as string),' 00:00:00') AS last_updated,
 concat('Z',l_returnflag) AS location_zone, l_orderkey AS seq, l_shipdate AS ingested_at FROM {lineitem}""",
    "fx_shelf": """
SELECT concat('S',cast(o_orderkey % 5 as string)) AS store_id, concat('P',cast(o_custkey as string)) AS product_id,
 cast(o_orderkey % 60 as int) AS current_quantity, cast(cast(o_orderdate as date) as string) AS last_restocked_date,
 concat('A',cast(o_orderkey % 9 as string)) AS shelf_location,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE cast(cast(o_orderdate as date) + 30 as string) END AS expiry_date,
 CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE concat('{{"sensor_id":"SENSOR_',cast(o_orderkey % 30 as string),'","temperature_celsius":',cast(o_orderkey % 8 as string),',"humidity":',cast(50 + o_orderkey % 20 as string),'}}') END AS temperature_reading,
 o_orderkey AS seq, o_orderdate AS ingested_at FROM {orders}""",
    "fx_product": """
SELECT concat('P',cast(p_partkey as string)) AS product_id, p_name AS product_name, p_type AS category,
 concat(p_type,'-',cast(p_size % 3 as string)) AS subcategory, p_brand AS brand, concat('V',cast(p_partkey % 10 as string)) AS supplier_id,
 cast(p_retailprice * (0.6 + (p_partkey % 5) * 0.05) as decimal(10,2)) AS cost_price,
 cast(CASE p_partkey % 3 WHEN 0 THEN p_retailprice WHEN 1 THEN p_retailprice / 4 ELSE p_retailprice / 12 END as decimal(10,2)) AS selling_price,
 cast(p_size as double) AS weight, CASE WHEN p_partkey % 11 = 0 THEN 'discontinued' ELSE 'active' END AS status,
 concat('{{"length":',cast(p_size as string),',"width":',cast(p_size % 7 as string),',"height":',cast(p_size % 5 as string),'}}') AS dimensions
 FROM {part}""",
    "fx_store": """
SELECT concat('S',cast(n_nationkey % 5 as string)) AS store_id, n_name AS store_name, r_name AS region,
 concat('City',cast(n_nationkey as string)) AS city,
 CASE n_nationkey % 4 WHEN 0 THEN 'Warehouse' WHEN 1 THEN 'Superstore' WHEN 2 THEN 'Express' ELSE 'Online' END AS store_type,
 cast(cast('2000-01-01' as date) + n_nationkey * 100 as string) AS opening_date, n_nationkey AS seq
 FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_supplier": """
SELECT concat('V',cast(s_suppkey as string)) AS supplier_id, s_name AS supplier_name, concat('cat',cast(s_nationkey % 6 as string)) AS category,
 cast((s_suppkey % 26 + 25) / 10.0 as decimal(4,2)) AS performance_rating, cast(70 + s_suppkey % 31 as decimal(5,2)) AS on_time_delivery_pct FROM {supplier}""",
    "fx_customer": """
SELECT concat('C',cast(c_custkey as string)) AS customer_id,
 CASE c_custkey % 4 WHEN 0 THEN '18-25' WHEN 1 THEN '26-40' WHEN 2 THEN '41-60' ELSE '60+' END AS age_group,
 CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, cast(10000 + c_nationkey as string) AS zip_code,
 CASE c_custkey % 4 WHEN 0 THEN ' PLATINUM ' WHEN 1 THEN 'gold' WHEN 2 THEN 'Silver' ELSE 'bronze' END AS loyalty_tier,
 cast(cast('2015-01-01' as date) + cast(c_custkey % 3000 as int) as string) AS first_purchase_date, c_acctbal AS total_spend,
 concat('["',c_mktsegment,'","Books"]') AS preferred_categories FROM {customer}""",
    "fx_po": """
SELECT concat('PO',cast(l_orderkey as string)) AS po_id, concat('V',cast(l_suppkey as string)) AS supplier_id,
 concat('P',cast(l_partkey as string)) AS product_id, cast(o_orderdate as date) AS order_date,
 cast(o_orderdate as date) + 7 AS expected_delivery_date,
 CASE WHEN o_orderstatus = 'O' THEN NULL ELSE cast(o_orderdate as date) + cast(4 + (l_partkey * 7 + l_suppkey * 3) % (3 + l_suppkey % 9) as int) END AS actual_delivery_date,
 cast(l_quantity as int) AS quantity_ordered, cast(100 + l_partkey % 500 as decimal(10,2)) AS unit_cost,
 CASE (l_linenumber + l_suppkey) % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'shipped' WHEN 2 THEN 'delivered' ELSE 'cancelled' END AS status,
 CASE WHEN l_linenumber = 1 THEN NULL ELSE cast(1 + (l_partkey % 41) / 10.0 as decimal(4,2)) END AS quality_rating,
 concat('{{"carrier":"',CASE l_linenumber % 3 WHEN 0 THEN 'UPS' WHEN 1 THEN 'DHL' ELSE 'FEDEX' END,'","tracking_number":"TRACK',cast(l_orderkey as string),'","delivery_status":"',CASE WHEN l_linestatus='O' THEN 'on_time' ELSE 'delayed' END,'","notes":"n',cast(l_linenumber as string),'"}}') AS delivery_notes,
 l_linenumber AS line_no, l_partkey AS tie_part FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    # Derived fixtures (section 3). They reference other fixtures by name.
    # Product snapshot 1 leaves out P35..P39; snapshot 2 has all, cost + 1.00 where the key number is divisible by 4.
    "fx_product_t1": """
SELECT * FROM fx_product WHERE cast(substr(product_id, 2) as int) NOT BETWEEN 35 AND 39""",
    "fx_product_t2": """
SELECT product_id, product_name, category, subcategory, brand, supplier_id,
 CASE WHEN cast(substr(product_id, 2) as int) % 4 = 0 THEN cast(cost_price + 1 as decimal(10,2)) ELSE cost_price END AS cost_price,
 selling_price, weight, status, dimensions FROM fx_product""",
    # Store master: the nation rows collapse onto 5 store ids; snapshot 2 moves the city where seq % 3 = 0.
    "fx_store_t2": """
SELECT store_id, store_name, region,
 CASE WHEN seq % 3 = 0 THEN concat(city, '-moved') ELSE city END AS city,
 store_type, opening_date, seq FROM fx_store""",
    # Supplier master snapshot 2: rating lowered by 0.5 where the key number is divisible by 7.
    "fx_supplier_t2": """
SELECT supplier_id, supplier_name, category,
 CASE WHEN cast(substr(supplier_id, 2) as int) % 7 = 0 THEN cast(performance_rating - 0.5 as decimal(4,2)) ELSE performance_rating END AS performance_rating,
 on_time_delivery_pct FROM fx_supplier""",
    # Customers already in the table (key % 5 <> 0) and an incoming batch (key % 3 = 0, spend + 1 on even keys).
    "fx_customer_target": """
SELECT * FROM fx_customer WHERE cast(substr(customer_id, 2) as bigint) % 5 <> 0""",
    "fx_customer_source": """
SELECT customer_id, age_group, gender, zip_code, loyalty_tier, first_purchase_date,
 CASE WHEN cast(substr(customer_id, 2) as bigint) % 2 = 0 THEN total_spend + 1 ELSE total_spend END AS total_spend,
 preferred_categories FROM fx_customer WHERE cast(substr(customer_id, 2) as bigint) % 3 = 0""",
    # Stream feed, then a daily batch: both tags, dates in 1997 on even days of month,
    # minus quantity 13 (cancelled), with quantity + 1 where quantity = 20 (corrected).
    "fx_pos_stream": """
SELECT * FROM fx_pos WHERE _source = 'pos_realtime_stream'""",
    "fx_pos_batch": """
SELECT transaction_id, store_id, product_id, customer_id, ts_iso,
 CASE WHEN quantity = 20 THEN 21 ELSE quantity END AS quantity,
 unit_price, total_amount, payment_method, channel, _source, ingested_at
 FROM fx_pos WHERE substr(ts_iso, 1, 4) = '1997' AND cast(substr(ts_iso, 9, 2) as int) % 2 = 0 AND quantity <> 13""",
}

_DEPENDS = {
    "fx_product_t1": ["fx_product"],
    "fx_product_t2": ["fx_product"],
    "fx_store_t2": ["fx_store"],
    "fx_supplier_t2": ["fx_supplier"],
    "fx_customer_target": ["fx_customer"],
    "fx_customer_source": ["fx_customer"],
    "fx_pos_stream": ["fx_pos"],
    "fx_pos_batch": ["fx_pos"],
}

_PLACEHOLDER = re.compile(r"\{(" + "|".join(BASE_TABLES) + r")\}")


def _resolve(sql: str, mapping) -> str:
    return _PLACEHOLDER.sub(lambda m: mapping(m.group(1)), sql).replace("{{", "{").replace("}}", "}")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a Spark DataFrame; base tables are read straight from parquet."""
    deps = _DEPENDS.get(name, [])
    sql = _resolve(FIXTURE_SQL[name], lambda t: f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`")
    if deps:
        ctes = ",\n".join(
            f"{d} AS ({_resolve(FIXTURE_SQL[d], lambda t: f'parquet.`{sf_dir.rstrip(chr(47))}/{t}.parquet`')})"
            for d in deps
        )
        sql = f"WITH {ctes}\n{sql}"
    return spark.sql(sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table of the driver's data set."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def oracle_with(*names: str) -> str:
    """``WITH`` clause defining the named fixtures (and what they depend on) for DuckDB."""
    ordered: list[str] = []
    for n in names:
        for d in _DEPENDS.get(n, []) + [n]:
            if d not in ordered:
                ordered.append(d)
    return "WITH " + ",\n".join(f"{n} AS ({_resolve(FIXTURE_SQL[n], lambda t: t)})" for n in ordered) + "\n"
