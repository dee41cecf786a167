"""Silver layer: type, flatten, deduplicate and merge each source.

``clean_*`` functions are pure projections (one pass, no shuffle). ``apply_*``
functions deduplicate a batch and merge it into the current table state,
returning the next state with ``_op`` (see ``operators.changes``). Run-time
audit columns (``processed_at``, ``pipeline_run_id``) are added by
``with_audit`` when a state is written, so plans stay deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.functions.columns import days_to_date, parse_date, parse_iso_ts, parse_ts, to_decimal
from lakeshelf.operators import changes, dedup
from lakeshelf.operators.joins import strategy_for
from lakeshelf.session import materialize

# Source-system tags and the columns each merge compares / updates.
POS_STREAM_TAG = "pos_realtime_stream"
POS_BATCH_TAG = "pos_batch_csv"
CUSTOMERS_TAG = "customers_csv"
PO_TAG = "purchase_orders_csv"
STORE_INV_TAG = "store_inventory_jsonl"
WAREHOUSE_TAG = "warehouse_inventory_parquet"
PRODUCT_TAG = "product_master_parquet"
STORE_TAG = "store_master_csv"
SUPPLIER_TAG = "supplier_master_csv"

POS_COLUMNS = [
    "transaction_id", "store_id", "product_id", "customer_id", "transaction_ts", "quantity",
    "unit_price", "total_amount", "payment_method", "channel", "transaction_date",
    "ingested_at", "source_system",
]
POS_PARSED = {"transaction_ts": ["transaction_date"]}  # as PO_PARSED
POS_BATCH_COMPARE = ["total_amount", "quantity", "payment_method", "channel"]

CUSTOMER_COLUMNS = [
    "customer_id", "age_group", "gender", "zip_code", "loyalty_tier", "first_purchase_date",
    "total_spend", "preferred_categories", "ingested_at", "source_system",
]
CUSTOMER_COMPARE = ["age_group", "gender", "zip_code", "loyalty_tier", "total_spend", "preferred_categories"]

PO_COLUMNS = [
    "po_id", "supplier_id", "product_id", "order_date", "expected_delivery_date", "actual_delivery_date",
    "quantity_ordered", "unit_cost", "status", "quality_rating", "order_year_month", "carrier",
    "tracking_number", "delivery_status", "delivery_notes_text", "ingested_at", "source_system",
]

STORE_INV_COLUMNS = [
    "store_id", "product_id", "current_quantity", "last_restocked_date", "shelf_location", "expiry_date",
    "sensor_id", "temperature_celsius", "humidity", "ingested_at", "source_system",
]
STORE_INV_COMPARE = [
    "current_quantity", "last_restocked_date", "shelf_location", "expiry_date",
    "sensor_id", "temperature_celsius", "humidity",
]

WAREHOUSE_COLUMNS = [
    "warehouse_id", "product_id", "current_stock", "reserved_stock", "available_stock", "reorder_level",
    "max_stock", "last_updated", "location_zone", "ingested_at", "source_system",
]
WAREHOUSE_COMPARE = ["current_stock", "reserved_stock", "available_stock", "reorder_level", "max_stock", "location_zone"]
WAREHOUSE_UPDATE = WAREHOUSE_COMPARE[:5] + ["last_updated", "location_zone"]

PRODUCT_COLUMNS = [
    "product_id", "product_name", "category", "subcategory", "brand", "supplier_id", "cost_price",
    "selling_price", "weight", "length", "width", "height", "status", "effective_date", "expiry_date",
    "ingested_at", "source_system",
]
PRODUCT_TRACKED = [
    "product_name", "category", "subcategory", "brand", "supplier_id", "cost_price", "selling_price",
    "weight", "length", "width", "height", "status",
]
STORE_COLUMNS = ["store_id", "store_name", "region", "city", "store_type", "opening_date", "ingested_at", "source_system"]
STORE_TRACKED = ["store_name", "region", "city", "store_type", "opening_date"]
SUPPLIER_COLUMNS = [
    "supplier_id", "supplier_name", "category", "performance_rating", "on_time_delivery_pct",
    "ingested_at", "source_system",
]
SUPPLIER_TRACKED = ["supplier_name", "category", "performance_rating", "on_time_delivery_pct"]


def _project(df: DataFrame, columns: list[str]) -> DataFrame:
    """Schema-enforcing projection: the layer's columns in order, present ones only."""
    return df.select(*[c for c in columns if c in df.columns])


def settled(df: DataFrame, parsed: dict[str, list[str]]) -> list[str]:
    """The columns of a cleaned frame that were read from another of its columns alone, which is still there."""
    return [c for source, cols in parsed.items() if source in df.columns for c in cols if c in df.columns]


def _date(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, T.DateType):
        return F.col(c)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(F.col(c))
    return parse_date(c)


def with_audit(df: DataFrame, run_id: str, now: Column | None = None) -> DataFrame:
    """Run-time audit columns added at write time."""
    return df.withColumns({"processed_at": now if now is not None else F.current_timestamp(),
                           "pipeline_run_id": F.lit(run_id)})


def stamp(state: DataFrame, run_id: str, now: Column | None = None) -> DataFrame:
    """Audit columns on the rows this run inserted, updated or closed; every other
    row keeps the values of the run that last changed it."""
    touched = F.col(changes.OP).isin("insert", "update", "close")
    new = {"processed_at": now if now is not None else F.current_timestamp(), "pipeline_run_id": F.lit(run_id)}
    types = {"processed_at": "timestamp", "pipeline_run_id": "string"}
    return state.withColumns({
        c: F.when(touched, v).otherwise(F.col(c) if c in state.columns else F.lit(None).cast(types[c]))
        for c, v in new.items()
    })


# --- POS --------------------------------------------------------------------------


def clean_pos(df: DataFrame, tag: str | Column, ts_col: str = "timestamp") -> DataFrame:
    """Typed POS rows: ISO instant parsed, money as DECIMAL(10,2), event date as text.
    ``tag`` is the feed's source-system name (or a column holding it)."""
    ts = parse_iso_ts(ts_col)
    out = df.withColumns({
        "transaction_ts": ts,
        "unit_price": to_decimal("unit_price", 10, 2),
        "total_amount": to_decimal("total_amount", 10, 2),
        "transaction_date": F.to_date(ts).cast("string"),
        "source_system": F.lit(tag) if isinstance(tag, str) else tag,
    })
    return _project(out, POS_COLUMNS)


# Total order that makes the POS dedup survivor deterministic (FIXTURES.md).
POS_TIE_BREAK = [
    ("ingested_at", "desc"), "product_id", "quantity", "total_amount", "channel", "payment_method",
    "store_id", "customer_id", "transaction_ts", "source_system", "unit_price",
]


def dedup_pos(df: DataFrame) -> DataFrame:
    """F1 on transaction_id with the deterministic POS tie break (columns the
    frame lacks, e.g. lineage on a hand-made batch, are skipped)."""
    order = [o for o in POS_TIE_BREAK if (o if isinstance(o, str) else o[0]) in df.columns]
    return dedup.first_per_key(df, ["transaction_id"], order, settled(df, POS_PARSED))


def pos_stream_rows(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("_source") == POS_STREAM_TAG)


def apply_pos_stream(state: DataFrame, bronze_batch: DataFrame, ts_col: str = "timestamp", **kw) -> DataFrame:
    """Stream-tagged rows, cleaned, deduplicated, inserted if absent (idempotent on replay). The size of the batch is looked
    up before deduplication, which would else run once more for it."""
    rows = clean_pos(pos_stream_rows(bronze_batch), POS_STREAM_TAG, ts_col)
    kw["strategy"] = strategy_for(rows, kw.get("strategy", "auto"), kw.get("max_rows"))
    return changes.upsert(state, dedup_pos(rows), ["transaction_id"], **kw)


def apply_pos_batch(state: DataFrame, bronze_batch: DataFrame, ts_col: str = "timestamp", **kw) -> DataFrame:
    """The daily batch is authoritative for its dates: insert, correct amounts,
    then delete in-scope transactions that the batch no longer lists. Event time
    and origin of existing rows stay as they were."""
    rows = clean_pos(bronze_batch, POS_BATCH_TAG, ts_col)
    batch = dedup_pos(rows)
    kw["strategy"] = strategy_for(rows, kw.get("strategy", "auto"), kw.get("max_rows"))
    merged = changes.upsert(state, batch, ["transaction_id"], compare=POS_BATCH_COMPARE, **kw)
    dates = materialize(batch.select("transaction_date").distinct())  # read twice: their number, then the dates
    return changes.delete_unmatched(merged, dates, "transaction_date", kw.get("max_rows"))


# --- customers --------------------------------------------------------------------


def clean_customers(df: DataFrame) -> DataFrame:
    out = df.withColumns({
        "first_purchase_date": _date(df, "first_purchase_date"),
        "total_spend": to_decimal("total_spend", 10, 2),
        "preferred_categories": F.from_json(F.trim("preferred_categories"), T.ArrayType(T.StringType())),
        "loyalty_tier": F.initcap(F.trim("loyalty_tier")),
        "source_system": F.lit(CUSTOMERS_TAG),
    })
    return _project(out, CUSTOMER_COLUMNS)


def apply_customers(state: DataFrame, bronze_batch: DataFrame, **kw) -> DataFrame:
    """Update the changeable attributes; first_purchase_date and source_system are immutable."""
    batch = dedup.dedup_any(clean_customers(bronze_batch), ["customer_id"])
    return changes.upsert(state, batch, ["customer_id"], compare=CUSTOMER_COMPARE, **kw)


# --- purchase orders ----------------------------------------------------------------


NOTES_SCHEMA = "carrier string, tracking_number string, delivery_status string, notes string"
TEMPERATURE_SCHEMA = "sensor_id string, temperature_celsius string, humidity string"
# What the cleaning reads from one column alone: rows that agree in that column agree in these.
PO_PARSED = {
    "delivery_notes": ["carrier", "tracking_number", "delivery_status", "delivery_notes_text"], "order_date": ["order_year_month"],
}
STORE_INV_PARSED = {"temperature_reading": ["sensor_id", "temperature_celsius", "humidity"]}


def clean_purchase_orders(df: DataFrame) -> DataFrame:
    """Typed PO rows; the delivery-notes JSON is parsed once per row into its
    four fields (malformed JSON gives NULL fields)."""
    order_date = _date(df, "order_date")
    notes = F.from_json("delivery_notes", NOTES_SCHEMA)
    out = df.withColumn("__notes", notes).withColumns({
        "order_date": order_date,
        "expected_delivery_date": _date(df, "expected_delivery_date"),
        "actual_delivery_date": _date(df, "actual_delivery_date"),
        "unit_cost": to_decimal("unit_cost", 10, 2),
        "quality_rating": to_decimal("quality_rating", 4, 2),
        "carrier": F.col("__notes.carrier"),
        "tracking_number": F.col("__notes.tracking_number"),
        "delivery_status": F.col("__notes.delivery_status"),
        "delivery_notes_text": F.col("__notes.notes"),
        "order_year_month": F.date_format(order_date, "yyyy-MM"),
        "source_system": F.lit(PO_TAG),
    })
    return out.drop("__notes")


def dedup_po_lifecycle(cleaned: DataFrame, tie_break: list | None = None) -> DataFrame:
    """one row per PO in its furthest lifecycle state; remaining ties broken
    by every other column ascending (those parsed from another decide none)."""
    parsed = settled(cleaned, PO_PARSED)
    tb = tie_break or [c for c in cleaned.columns if c != "po_id" and c not in parsed]
    return _project(dedup.furthest_state(cleaned, ["po_id"], "status", tb, settled=parsed), PO_COLUMNS)


def apply_purchase_orders(state: DataFrame, bronze_batch: DataFrame, **kw) -> DataFrame:
    """Status-only change-data update; every other column is immutable."""
    batch = dedup_po_lifecycle(clean_purchase_orders(bronze_batch))
    return changes.upsert(state, batch, ["po_id"], compare=["status"], **kw)


# --- store (shelf) inventory --------------------------------------------------------


def clean_store_inventory(df: DataFrame) -> DataFrame:
    """Typed shelf rows; the sensor JSON is parsed once per row (numbers read as
    text, then cast ANSI-safely, so a malformed reading gives NULL)."""
    reading = F.from_json("temperature_reading", TEMPERATURE_SCHEMA)
    return df.withColumn("__t", reading).withColumns({
        "last_restocked_date": _date(df, "last_restocked_date"),
        "expiry_date": _date(df, "expiry_date"),
        "sensor_id": F.col("__t.sensor_id"),
        "temperature_celsius": F.col("__t.temperature_celsius").try_cast("double"),
        "humidity": F.col("__t.humidity").try_cast("double"),
        "source_system": F.lit(STORE_INV_TAG),
    }).drop("__t")


def latest_store_inventory(cleaned: DataFrame, order) -> DataFrame:
    """one row per (store, product), the first under ``order``. Products come first in the sort: most rows differ there."""
    parsed = settled(cleaned, STORE_INV_PARSED)
    return _project(dedup.first_per_key(cleaned, ["product_id", "store_id"], order, parsed), STORE_INV_COLUMNS)


def apply_store_inventory(state: DataFrame, cleaned_batch: DataFrame, order, **kw) -> DataFrame:
    """E2 with NULL-safe comparison of every changeable column."""
    batch = latest_store_inventory(cleaned_batch, order)
    return changes.upsert(state, batch, ["store_id", "product_id"], compare=STORE_INV_COMPARE, **kw)


# --- warehouse inventory -------------------------------------------------------------


def clean_warehouse(df: DataFrame) -> DataFrame:
    """Typed warehouse rows; available = current - reserved (may be negative)."""
    return df.withColumns({
        "last_updated": parse_ts("last_updated"),
        "available_stock": F.col("current_stock") - F.col("reserved_stock"),
        "source_system": F.lit(WAREHOUSE_TAG),
    })


# Deterministic survivor for warehouse snapshots (FIXTURES.md).
WAREHOUSE_TIE_BREAK = [
    ("ingested_at", "desc"), ("seq", "desc"), "reserved_stock", "current_stock", "reorder_level", "max_stock",
    "location_zone", "last_updated",
]


def latest_warehouse(cleaned: DataFrame, tie_break=None) -> DataFrame:
    """latest snapshot per (warehouse, product). Products come first in the sort: most rows differ there."""
    tb = tie_break or WAREHOUSE_TIE_BREAK
    return _project(dedup.first_per_key(cleaned, ["product_id", "warehouse_id"], tb), WAREHOUSE_COLUMNS)


def apply_warehouse(state: DataFrame, cleaned_batch: DataFrame, **kw) -> DataFrame:
    batch = latest_warehouse(cleaned_batch)
    return changes.upsert(
        state, batch, ["warehouse_id", "product_id"], compare=WAREHOUSE_COMPARE, update=WAREHOUSE_UPDATE, **kw
    )


# --- masters (SCD2) ---------------------------------------------------------------------


def _dimension(df: DataFrame, axis: str) -> Column:
    """One axis of ``dimensions``: JSON ``{"length":..}`` or text ``LxWxH``."""
    c = F.col("dimensions")
    from_json = F.get_json_object(c, f"$.{axis}")
    idx = {"length": 1, "width": 2, "height": 3}[axis]
    from_text = F.regexp_extract(c, r"^\s*([0-9.]+)\s*[xX]\s*([0-9.]+)\s*[xX]\s*([0-9.]+)\s*$", idx)
    return F.coalesce(from_json.try_cast("double"), F.nullif(from_text, F.lit("")).try_cast("double"))


def clean_products(df: DataFrame) -> DataFrame:
    cols = {
        "cost_price": to_decimal("cost_price", 10, 2),
        "selling_price": to_decimal("selling_price", 10, 2),
        "weight": F.col("weight").cast("double"),
        "length": _dimension(df, "length"),
        "width": _dimension(df, "width"),
        "height": _dimension(df, "height"),
        "source_system": F.lit(PRODUCT_TAG),
    }
    if "effective_date" in df.columns:
        cols["effective_date"] = _date(df, "effective_date")
    if "expiry_date" in df.columns:
        cols["expiry_date"] = days_to_date("expiry_date")
    return _project(df.withColumns(cols), PRODUCT_COLUMNS)


def clean_stores(df: DataFrame) -> DataFrame:
    return _project(df.withColumns({"opening_date": _date(df, "opening_date"), "source_system": F.lit(STORE_TAG)}),
                    STORE_COLUMNS)


def clean_suppliers(df: DataFrame) -> DataFrame:
    return _project(
        df.withColumns({
            "performance_rating": to_decimal("performance_rating", 4, 2),
            "on_time_delivery_pct": to_decimal("on_time_delivery_pct", 5, 2),
            "source_system": F.lit(SUPPLIER_TAG),
        }),
        SUPPLIER_COLUMNS,
    )


def apply_scd2(state: DataFrame | None, snapshot: DataFrame, key: str, tracked: list[str], now, **kw) -> DataFrame:
    """E6 for a master table: the latest row per key by load time (F2, ties broken
    by every other column), then close / open versions. ``state=None`` starts an
    empty versioned table. The size of the snapshot is looked up before deduplication, which would else run once more for it."""
    kw["strategy"] = strategy_for(snapshot, kw.get("strategy", "auto"), kw.get("max_rows"))
    if "ingested_at" in snapshot.columns:
        latest = dedup.latest_per_key(snapshot, [key], "ingested_at")
    else:
        latest = dedup.dedup_any(snapshot, [key])
    base = state if state is not None else changes.empty_scd_table(latest)
    return changes.scd2_apply(base, latest, [key], tracked, now, **kw)
