"""Explicit schemas of the raw records (never inferred) and the C1 projection.

Fixed values: field names and types of each landing format, as the sources
deliver them; the audit columns (source_file, ingested_at, pipeline_run_id,
ingested_date) are added by ingest and are not part of the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


BRONZE = {
    "customers": _schema(
        ("customer_id", S), ("age_group", S), ("gender", S), ("zip_code", S), ("loyalty_tier", S),
        ("first_purchase_date", S), ("total_spend", D), ("preferred_categories", S)),
    "product_master": _schema(
        ("product_id", S), ("product_name", S), ("category", S), ("subcategory", S), ("brand", S),
        ("supplier_id", S), ("cost_price", D), ("selling_price", D), ("weight", D), ("dimensions", S),
        ("status", S), ("effective_date", S), ("expiry_date", I)),
    "store_master": _schema(
        ("store_id", S), ("store_name", S), ("region", S), ("city", S), ("store_type", S), ("opening_date", S)),
    "supplier_master": _schema(
        ("supplier_id", S), ("supplier_name", S), ("category", S), ("performance_rating", D),
        ("on_time_delivery_pct", D)),
    "purchase_orders": _schema(
        ("po_id", S), ("supplier_id", S), ("product_id", S), ("order_date", S), ("expected_delivery_date", S),
        ("actual_delivery_date", S), ("quantity_ordered", I), ("unit_cost", D), ("status", S),
        ("quality_rating", D), ("delivery_notes", S)),
    "store_inventory": _schema(
        ("store_id", S), ("product_id", S), ("current_quantity", I), ("last_restocked_date", S),
        ("shelf_location", S), ("expiry_date", S), ("temperature_reading", S)),
    "pos_transactions": _schema(
        ("transaction_id", S), ("store_id", S), ("product_id", S), ("customer_id", S), ("timestamp", S),
        ("quantity", I), ("unit_price", D), ("total_amount", D), ("payment_method", S), ("channel", S)),
    "warehouse_inventory": _schema(
        ("warehouse_id", S), ("product_id", S), ("current_stock", L), ("reserved_stock", L),
        ("available_stock", L), ("reorder_level", L), ("max_stock", L), ("last_updated", S), ("location_zone", S)),
}

# Formats the sources land in (a caller option; the schema does not depend on it).
LANDING_FORMAT = {
    "customers": "csv", "product_master": "parquet", "store_master": "csv", "supplier_master": "csv",
    "purchase_orders": "csv", "store_inventory": "json", "pos_transactions": "json",
    "warehouse_inventory": "parquet",
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's fields, in its order and types. Extra columns are
    dropped, missing ones are NULL, values that do not fit the type become NULL
    (ANSI-safe ``try_cast``) instead of failing the job."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name)
            cols.append((c if df.schema[f.name].dataType == f.dataType else c.try_cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def misfits(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: how many values of each field ``conform`` would turn into NULL (present, but not of
    the field's type), and the fields that are absent altogether (counted as all rows)."""
    counts = []
    for f in schema.fields:
        if f.name not in df.columns:
            counts.append(F.count("*").alias(f.name))
        else:
            counts.append(F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name))
    return df.agg(*counts)


CORRUPT = "_corrupt_record"


def as_text(schema: T.StructType) -> T.StructType:
    """The fields of a landing file before any of them is typed, and the whole record where its form is broken."""
    return T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema.fields], T.StructField(CORRUPT, T.StringType())])


def rejection_reasons(df: DataFrame, schema: T.StructType, required: Sequence[str] = ()) -> Column:
    """Why a record read ``as_text`` may not enter a table (empty: it may): its form is broken, a value is not of its
    field's type, or a required field has none."""
    found = [F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed record"))] if CORRUPT in df.columns else []
    for f in schema.fields:
        misfit = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        found.append(F.when(misfit, F.lit(f"{f.name}: not {f.dataType.simpleString()}")))
    found += [F.when(F.col(c).isNull(), F.lit(f"{c}: missing")) for c in required]
    return F.array_compact(F.array(*found))


# The columns that may not be NULL in each silver and gold table, besides the audit columns.
REQUIRED = {
    "silver.customers": ["customer_id"],
    "silver.product_master": ["product_id", "scd_hash", "valid_from", "is_current"],
    "silver.store_master": ["store_id", "scd_hash", "valid_from", "is_current"],
    "silver.supplier_master": ["supplier_id", "scd_hash", "valid_from", "is_current"],
    "silver.purchase_orders": ["po_id", "supplier_id", "product_id"],
    "silver.store_inventory": ["store_id", "product_id", "current_quantity"],
    "silver.pos_transactions": ["transaction_id", "store_id", "product_id", "transaction_ts", "quantity", "unit_price", "total_amount"],
    "silver.warehouse_inventory": ["warehouse_id", "product_id", "current_stock", "reserved_stock", "available_stock"],
    "gold.dim_product": ["product_id"],
    "gold.dim_store": ["store_id"],
    "gold.dim_supplier": ["supplier_id"],
    "gold.dim_customer": ["customer_id"],
    "gold.fact_inventory_full": ["inventory_snapshot_key", "snapshot_date", "store_id", "product_id"],
    "gold.fact_daily_inventory": ["transaction_date"],
    "gold.fact_inventory_kpis": ["store_id", "product_id", "snapshot_date"],
    "gold.fact_demand_trends": ["store_id", "product_id", "inventory_date"],
    "gold.fact_customer_sales": ["transaction_id", "store_id", "product_id", "transaction_ts", "quantity", "unit_price", "total_amount",
                                 "transaction_date"],
    "gold.fact_supplier_performance": ["supplier_id"],
}


def audit_columns(table: str) -> list[str]:
    """Columns that a write adds: load, processing time, run and source in silver; processing time and run in gold."""
    if table.startswith("silver."):
        return ["ingested_at", "processed_at", "pipeline_run_id", "source_system"]
    return ["_fact_processed_at" if table == "gold.fact_customer_sales" else "_gold_processed_at", "pipeline_run_id"]


def split_required(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows that may be stored, and those with a NULL in a required column (with ``null_columns``, their names)."""
    missing = [c for c in REQUIRED[table] if c not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks the required columns {missing}")
    nulls = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED[table]]))
    marked = df.withColumn("null_columns", nulls)
    return marked.filter(F.size("null_columns") == 0).drop("null_columns"), marked.filter(F.size("null_columns") > 0)
