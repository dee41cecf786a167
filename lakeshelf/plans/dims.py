"""Gold dimensions and the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshelf.functions.columns import tier
from lakeshelf.operators import changes

DIM_PRODUCT_COLUMNS = [
    "product_id", "product_name", "category", "subcategory", "brand", "supplier_id", "cost_price",
    "selling_price", "profit_margin_pct", "price_tier", "weight", "length", "width", "height", "status",
    "effective_date", "expiry_date",
]
DIM_STORE_COLUMNS = [
    "store_id", "store_name", "region", "city", "store_type", "store_size_tier", "opening_date", "years_in_operation",
]
DIM_SUPPLIER_COLUMNS = [
    "supplier_id", "supplier_name", "category", "performance_rating", "on_time_delivery_pct",
    "baseline_risk_tier", "performance_band",
]
DIM_CUSTOMER_COLUMNS = [
    "customer_id", "age_group", "gender", "zip_code", "loyalty_tier", "first_purchase_date", "total_spend",
    "preferred_categories",
]


def _present(df: DataFrame, cols: list[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def _date(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def dim_product(products: DataFrame) -> DataFrame:
    """Current product versions with margin and price tier."""
    cur = products.filter(F.col("is_current"))
    sell, cost = F.col("selling_price").cast("double"), F.col("cost_price").cast("double")
    out = cur.withColumns({
        "profit_margin_pct": F.round(F.when(sell > 0, (sell - cost) / sell * 100).otherwise(0.0), 2),
        "price_tier": tier("selling_price", [(500, "Premium"), (100, "Mid-range")], "Budget"),
    })
    return out.select(*_present(out, DIM_PRODUCT_COLUMNS))


def dim_store(stores: DataFrame, as_of) -> DataFrame:
    """Current stores with age in years at ``as_of`` and a size tier from the format."""
    cur = stores.filter(F.col("is_current"))
    st = F.col("store_type")
    out = cur.withColumns({
        "years_in_operation": F.round(F.datediff(_date(as_of), F.col("opening_date")) / 365.25, 1),
        "store_size_tier": F.when(st == "Warehouse", "Large").when(st == "Superstore", "Medium").otherwise("Small"),
    })
    return out.select(*DIM_STORE_COLUMNS)


def dim_supplier(suppliers: DataFrame) -> DataFrame:
    """Current suppliers with a baseline risk tier and a performance band."""
    cur = suppliers.filter(F.col("is_current"))
    out = cur.withColumns({
        "baseline_risk_tier": tier("on_time_delivery_pct", [(90, "Low"), (80, "Medium")], "High"),
        "performance_band": tier("performance_rating", [(4.5, "Excellent"), (3.5, "Good")], "Average"),
    })
    return out.select(*DIM_SUPPLIER_COLUMNS)


def dim_customer(existing: DataFrame, customers: DataFrame, **kw) -> DataFrame:
    """Changed and new customers replace / extend the dimension (update all, insert all)."""
    src = customers.select(*DIM_CUSTOMER_COLUMNS)
    return changes.upsert(existing.select(*DIM_CUSTOMER_COLUMNS), src, ["customer_id"], update="*", **kw)


# --- calendar -----------------------------------------------------------------------------

DIM_DATE_COLUMNS = [
    "date", "date_key", "year", "quarter", "month", "day", "day_of_week", "day_of_year", "week_of_year",
    "month_name", "month_short", "day_name", "day_short", "year_month", "year_quarter", "is_weekend",
    "is_weekday", "season", "year_month_key",
]


def calendar_days(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per day for each (start, end) row of ``bounds``."""
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))).alias("date"))


def fixed_calendar(spark, start: str = "2020-01-01", end: str = "2030-12-31") -> DataFrame:
    """The calendar over a fixed span (one row per day; 4,018 rows for the default span)."""
    bounds = spark.createDataFrame([(start, end)], "start string, end string").select(
        F.to_date("start").alias("start"), F.to_date("end").alias("end"))
    return dim_date(calendar_days(bounds)).orderBy("date")  # I3: the table is written in date order


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar attributes for a frame of dates (column ``date``). Sunday = 1 and
    Saturday = 7; the quarter label is ``yyyy-'Q'q`` (e.g. 2024-Q1)."""
    d = F.col("date")
    dow = F.dayofweek(d)
    m = F.month(d)
    weekend = dow.isin(1, 7)
    return days.select(
        d.alias("date"),
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        m.alias("month"),
        F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_short"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.date_format(d, "yyyy-'Q'q").alias("year_quarter"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        F.when(m.isin(12, 1, 2), "Winter").when(m.isin(3, 4, 5), "Spring").when(m.isin(6, 7, 8), "Summer")
        .otherwise("Autumn").alias("season"),
        F.date_format(d, "yyyyMM").cast("int").alias("year_month_key"),
    )
