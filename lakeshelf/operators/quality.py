"""Quality gates (K1-K7). Each check is one aggregation pass over the frame; no
check collects rows to the driver (only the small result row of a gate)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(AssertionError):
    pass


def assert_not_empty(df: DataFrame, name: str = "frame") -> None:
    """K1."""
    if df.isEmpty():
        raise QualityError(f"{name} is empty")


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """K2 / K7: one row, ``<col>_nulls`` per column, all counted in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K3: keys occurring more than once, with their count (partial aggregation
    first, so a hot key is pre-counted on the map side)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def freshness(df: DataFrame, ts_col: str, as_of, max_hours: float) -> DataFrame:
    """K4: latest time, its age in hours at ``as_of``, and whether it is within ``max_hours``."""
    as_of_c = F.lit(str(as_of)).cast("timestamp_ntz")
    latest = F.max(F.col(ts_col).cast("timestamp_ntz"))
    lag = F.timestamp_diff("SECOND", latest, as_of_c) / 3600.0
    return df.agg(latest.alias("latest_ts"), lag.alias("lag_hours")).withColumn(
        "is_fresh", F.col("lag_hours") <= max_hours
    )


def rule_failures(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """K5: failures per named SQL rule, all rules in one pass, long format
    (``rule``, ``failed_rows``). As with SQL CHECK constraints a NULL result passes."""
    agg = df.agg(*[F.count_if(~F.coalesce(F.expr(r), F.lit(True))).alias(f"r{i}") for i, r in enumerate(rules.values())])
    pairs = ", ".join(f"'{name}', r{i}" for i, name in enumerate(rules))
    return agg.selectExpr(f"stack({len(rules)}, {pairs}) AS (rule, failed_rows)")


def failing_rows(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """K5: rows breaking at least one rule, with the names of the rules they break."""
    names = F.array_compact(
        F.array(*[F.when(~F.coalesce(F.expr(r), F.lit(True)), F.lit(n)) for n, r in rules.items()])
    )
    return df.withColumn("failed_rules", names).filter(F.size("failed_rules") > 0)


def enforce(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Raise if any rule fails (the CHECK-constraint behaviour), else return ``df``."""
    bad = rule_failures(df, rules).filter(F.col("failed_rows") > 0).collect()
    if bad:
        raise QualityError("rule violations: " + ", ".join(f"{r['rule']}={r['failed_rows']}" for r in bad))
    return df


# Row rules of the silver and gold tables (the source's CHECK constraints).
RULES = {
    "pos": {
        "pos_source_tag": "_source IN ('pos_realtime_stream', 'pos_batch_csv')",
        "pos_channel": "channel IN ('online', 'offline')",
        "pos_amount_non_negative": "total_amount >= 0",
        "pos_quantity_positive": "quantity > 0",
    },
    "customers": {"customer_loyalty_tier": "loyalty_tier IN ('Bronze', 'Silver', 'Gold', 'Platinum')"},
    "products": {"product_status": "status IN ('active', 'discontinued')"},
    "stores": {"store_type": "store_type IN ('Warehouse', 'Superstore', 'Express', 'Online')"},
    "suppliers": {
        "supplier_rating_range": "performance_rating BETWEEN 0 AND 5",
        "supplier_delivery_pct_range": "on_time_delivery_pct BETWEEN 0 AND 100",
    },
    "purchase_orders": {
        "po_status": "status IN ('pending', 'shipped', 'delivered', 'cancelled')",
        "po_quantity_positive": "quantity_ordered > 0",
    },
    "store_inventory": {"shelf_quantity_non_negative": "current_quantity >= 0"},
    "warehouse": {
        "warehouse_current_non_negative": "current_stock >= 0",
        "warehouse_reserved_non_negative": "reserved_stock >= 0",
        "warehouse_available_consistent": "available_stock = current_stock - reserved_stock",
    },
    "dim_product": {
        "dim_product_status": "status IN ('active', 'discontinued')",
        "dim_product_price_tier": "price_tier IN ('Premium', 'Mid-range', 'Budget')",
    },
    "dim_store": {"dim_store_size_tier": "store_size_tier IN ('Large', 'Medium', 'Small')"},
    "dim_supplier": {
        "dim_supplier_risk_tier": "baseline_risk_tier IN ('Low', 'Medium', 'High')",
        "dim_supplier_band": "performance_band IN ('Excellent', 'Good', 'Average')",
    },
    "dim_customer": {"dim_customer_loyalty_tier": "loyalty_tier IN ('Bronze', 'Silver', 'Gold', 'Platinum')"},
    "fact_inventory_full": {"fact_status": "status IN ('active', 'discontinued')"},
    "fact_inventory_kpis": {
        "kpi_health": "inventory_health IN ('Critical — Stockout', 'Critical — Dead Stock', "
        "'Warning — Overstock', 'Warning — Low Stock', 'Healthy')",
    },
    "fact_demand_trends": {"trend_direction": "trend_direction IN ('Rising', 'Falling', 'Stable')"},
    "fact_customer_sales": {
        "sales_channel": "channel IN ('online', 'offline')",
        "sales_amount_non_negative": "total_amount >= 0",
        "sales_quantity_positive": "quantity > 0",
    },
    "fact_supplier_performance": {"actual_risk_tier": "actual_risk_tier IN ('Low', 'Medium', 'High')"},
}
