"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame
built from the driver's tables through the fixtures and the library's
operators. ``oracle.py`` holds the DuckDB text for the same results."""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf import runlog
from lakeshelf.fixtures import fixture, table
from lakeshelf.operators import changes, dedup, quality, windows
from lakeshelf.operators.joins import fits, maybe_broadcast, strategy_for
from lakeshelf.plans import dims, facts, late, silver
from lakeshelf.sinks import writers
from lakeshelf.session import materialize, scratch_path
from lakeshelf.sinks.published import publish, read_published
from lakeshelf.sources import files, messages

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the checks: snapshot times of the two master loads, the
# date used in place of "today", the cut between existing and incoming data.
NOW_1 = "2024-01-01 00:00:00"
NOW_2 = "2024-02-01 00:00:00"
AS_OF_DATE = "2024-06-30"
FRESHNESS_AS_OF = "2002-01-01 00:00:00"
INCREMENT_FROM = "2001-01-01"
SPLIT_DATE = "1998-01-01"


def comparable(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock (TIMESTAMP_NTZ), the form DuckDB returns."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


# --- silver inputs shared by many checks ---------------------------------------------------


def pos_silver(spark, d) -> DataFrame:
    return silver.dedup_pos(silver.clean_pos(fixture(spark, d, "fx_pos"), F.col("_source"), "ts_iso"))


def warehouse_silver(spark, d) -> DataFrame:
    return silver.latest_warehouse(silver.clean_warehouse(fixture(spark, d, "fx_warehouse")))


def shelf_clean(spark, d) -> DataFrame:
    return silver.clean_store_inventory(fixture(spark, d, "fx_shelf"))


def shelf_silver(spark, d, df: DataFrame | None = None) -> DataFrame:
    cleaned = df if df is not None else shelf_clean(spark, d)
    return silver.latest_store_inventory(cleaned, [("seq", "desc")])


def po_silver(spark, d, df: DataFrame | None = None) -> DataFrame:
    src = df if df is not None else fixture(spark, d, "fx_po")
    return silver.dedup_po_lifecycle(silver.clean_purchase_orders(src))


def customers_silver(spark, d, name: str = "fx_customer") -> DataFrame:
    return silver.clean_customers(fixture(spark, d, name))


def product_versions(spark, d) -> DataFrame:
    """Product master after two weekly loads (t1 at NOW_1, t2 at NOW_2)."""
    s1 = silver.apply_scd2(None, silver.clean_products(fixture(spark, d, "fx_product_t1")), "product_id",
                           silver.PRODUCT_TRACKED, NOW_1)
    return silver.apply_scd2(materialize(changes.live(s1)), silver.clean_products(fixture(spark, d, "fx_product_t2")),
                             "product_id", silver.PRODUCT_TRACKED, NOW_2)


def product_current_load(spark, d) -> DataFrame:
    """Product master after one load of the full product fixture."""
    return changes.live(silver.apply_scd2(None, silver.clean_products(fixture(spark, d, "fx_product")),
                                          "product_id", silver.PRODUCT_TRACKED, NOW_1))


def _store_snapshot(spark, d, name) -> DataFrame:
    return silver.clean_stores(dedup.first_per_key(fixture(spark, d, name), ["store_id"], [("seq", "desc")]).drop("seq"))


def store_versions(spark, d) -> DataFrame:
    s1 = silver.apply_scd2(None, _store_snapshot(spark, d, "fx_store"), "store_id", silver.STORE_TRACKED, NOW_1)
    return silver.apply_scd2(materialize(changes.live(s1)), _store_snapshot(spark, d, "fx_store_t2"), "store_id",
                             silver.STORE_TRACKED, NOW_2)


def supplier_versions(spark, d) -> DataFrame:
    s1 = silver.apply_scd2(None, silver.clean_suppliers(fixture(spark, d, "fx_supplier")), "supplier_id",
                           silver.SUPPLIER_TRACKED, NOW_1)
    return silver.apply_scd2(materialize(changes.live(s1)), silver.clean_suppliers(fixture(spark, d, "fx_supplier_t2")),
                             "supplier_id", silver.SUPPLIER_TRACKED, NOW_2)


def _no_hash(df: DataFrame) -> DataFrame:
    """Product hashes hold texts of doubles, which the engines print differently; stores and suppliers keep theirs."""
    return df.drop("scd_hash")


# --- stream then batch ---------------------------------------------------------------------


def _bronze_pos(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("ts_iso", "timestamp")


def pos_after_stream(spark, d) -> DataFrame:
    """Silver POS after the stream feed, delivered as two overlapping micro-batches
    (the second replays the first, as an at-least-once source may)."""
    stream = _bronze_pos(fixture(spark, d, "fx_pos_stream"))
    empty = silver.clean_pos(stream, silver.POS_STREAM_TAG).limit(0)
    first = silver.apply_pos_stream(empty, stream.filter(F.col("ingested_at") < F.lit("1997-01-01").cast("timestamp_ntz")))
    # The silver table between micro-batches is stored data: materialise it.
    return silver.apply_pos_stream(materialize(changes.live(first)), stream)


def silver_after_stream(spark, d) -> DataFrame:
    """The stored silver POS table after the stream feed."""
    return materialize(changes.live(pos_after_stream(spark, d)))


def pos_batch_rows(spark, d) -> DataFrame:
    return silver.clean_pos(_bronze_pos(fixture(spark, d, "fx_pos_batch")), silver.POS_BATCH_TAG)


def pos_batch_clean(spark, d) -> DataFrame:
    return silver.dedup_pos(pos_batch_rows(spark, d))


def batch_dates(batch: DataFrame) -> DataFrame:
    """The event dates of a batch, broadcast if they are few."""
    dates = materialize(dedup.distinct_keys(batch, ["transaction_date"]))
    return maybe_broadcast(dates, fits(dates))


# --- queries ------------------------------------------------------------------------------------


def q_clean_pos(spark, d):
    return comparable(silver.clean_pos(fixture(spark, d, "fx_pos"), F.col("_source"), "ts_iso"))


def q_dedup_pos(spark, d):
    return comparable(pos_silver(spark, d))


def q_source_routing(spark, d):
    tagged = files.with_source(fixture(spark, d, "fx_pos").drop("_source"),
                               F.when(F.col("channel") == "online", "web").otherwise("store"))
    return files.route(tagged, "web")


def q_incremental_read(spark, d):
    pos = fixture(spark, d, "fx_pos")
    first_run = pos.filter(F.col("ingested_at") < F.lit(INCREMENT_FROM).cast("timestamp_ntz"))
    mark = files.high_water_mark(first_run, "ingested_at")
    return files.read_since(pos, "ingested_at", mark)


def q_surrogate_key(spark, d):
    daily = facts.pos_daily_full(pos_silver(spark, d)).select("store_id", "product_id", "snapshot_date")
    from lakeshelf.functions.columns import surrogate_key
    return daily.withColumn("inventory_snapshot_key", surrogate_key(["store_id", "product_id", "snapshot_date"]))


def q_channel_payment_split(spark, d):
    return facts.channel_payment_split(pos_silver(spark, d))


def q_quality_nulls(spark, d):
    return quality.null_counts(pos_silver(spark, d), silver.POS_COLUMNS)


def q_quality_duplicates(spark, d):
    return quality.duplicate_keys(fixture(spark, d, "fx_pos"), ["transaction_id"])


def q_quality_freshness(spark, d):
    return quality.freshness(pos_silver(spark, d), "ingested_at", FRESHNESS_AS_OF, max_hours=24 * 365)


def q_epoch_days(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.unix_date(F.to_date("l_shipdate")).alias("epoch_day")
    )
    from lakeshelf.functions.columns import days_to_date
    return li.withColumn("ship_date", days_to_date("epoch_day"))


EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def q_message_decode(spark, d):
    msgs = messages.encode_messages(table(spark, d, "events"), ["event_id", "user_id", "event_type", "value"], "events")
    return messages.decode_messages(msgs, EVENT_SCHEMA, "events")


def q_stream_messages(spark, d):
    """A4 + B1 + J1 + J3 through Structured Streaming: the events table is landed
    as message files, ingested by the checkpointed bronze stream (run to
    completion), and the bronze table is read back. Run-time lineage columns
    are left out of the result."""
    from lakeshelf.streaming.ingest import bronze_messages

    landing, bronze, ckpt = (scratch_path(spark, n) for n in ("msg_landing", "msg_bronze", "msg_ckpt"))
    messages.encode_messages(table(spark, d, "events"), ["event_id", "user_id", "event_type", "value"],
                             "events").write.parquet(landing)
    stream = spark.readStream.schema("topic string, value binary").parquet(landing)
    bronze_messages(stream, EVENT_SCHEMA, "events", bronze, ckpt, "registry").awaitTermination()
    return spark.read.parquet(bronze).select("event_id", "user_id", "event_type", "value", "source_file")


RAW_POS = T.StructType([T.StructField(c, T.StringType()) for c in ("transaction_id", "store_id", "product_id", "customer_id", "timestamp")]
                       + [T.StructField("quantity", T.IntegerType())]
                       + [T.StructField(c, T.StringType()) for c in ("payment_method", "channel")])


def _land_pos(spark, d, tag: str, fmt: str) -> str:
    """One feed's sales as landing files (A1 CSV, A2 JSON lines, A3 Parquet)."""
    path = scratch_path(spark, f"landing_{fmt}")
    rows = _bronze_pos(fixture(spark, d, "fx_pos")).filter(F.col("_source") == tag).select(*RAW_POS.fieldNames())
    w = rows.write.format(fmt)
    (w.option("header", "true").option("escape", '"') if fmt == "csv" else w).save(path)
    return path


def _ingest_two_feeds(spark, d, first: str = "json", second: str = "csv") -> str:
    """Both POS feeds through two checkpoints into one raw table (A10, B1); the second run of each finds nothing new."""
    from lakeshelf.streaming.ingest import bronze_files

    bronze = scratch_path(spark, "pos_bronze")
    for tag, fmt in (("pos_realtime_stream", first), ("pos_batch_csv", second)):
        landing, ckpt = _land_pos(spark, d, tag, fmt), scratch_path(spark, "pos_ckpt")
        for run in range(2):
            bronze_files(spark, landing, fmt, RAW_POS, bronze, ckpt, f"run-{run}", tag=tag, feed=tag).awaitTermination()
    return bronze


def q_two_feeds(spark, d):
    """A1 + A2 + A10 + B1: a CSV feed and a JSON feed share a raw table; all rows of both are read back."""
    return spark.read.parquet(_ingest_two_feeds(spark, d)).select(*RAW_POS.fieldNames(), "_source")


def q_parquet_lineage(spark, d):
    """A3 + A9: Parquet landing files; each row names its file, load date and run."""
    bronze = spark.read.parquet(_ingest_two_feeds(spark, d, "parquet", "parquet"))
    return bronze.groupBy("_source", "pipeline_run_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("source_file").endswith(".parquet")).alias("with_file"),
        F.count_if(F.col("ingested_date") == F.to_date("ingested_at").cast("string")).alias("with_date"))


def q_table_stream_upsert(spark, d):
    """A7 + B2 + J4 + C11: the raw table read as a stream, each micro-batch inserted if absent through foreachBatch; a
    second query with a fresh checkpoint replays everything and adds nothing."""
    from lakeshelf.streaming.ingest import bronze_files, silver_pos_stream

    landing, bronze, target = _land_pos(spark, d, "pos_realtime_stream", "json"), scratch_path(spark, "s_bronze"), scratch_path(spark, "s_silver")
    schema = T.StructType([*RAW_POS.fields, T.StructField("unit_price", T.DoubleType()), T.StructField("total_amount", T.DoubleType())])
    bronze_files(spark, landing, "json", schema, bronze, scratch_path(spark, "s_ckpt"), "run", partition_by=(), tag="pos_realtime_stream").awaitTermination()
    table_schema = spark.read.parquet(bronze).schema
    for _ in range(2):
        silver_pos_stream(spark, bronze, table_schema, target, scratch_path(spark, "u_ckpt"), partition_by=()).awaitTermination()
    return spark.read.parquet(target).groupBy("transaction_date").agg(
        F.count("*").alias("n"), F.count_distinct("transaction_id").alias("n_keys"))


def q_compact_curve(spark, d):
    """B7 on several columns: a published table clustered along a Z-curve. Its rows, and whether a look-up on either column
    has to open less than half of the files (by their least and greatest values)."""
    path = scratch_path(spark, "lines_curve")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.to_date("l_shipdate").cast("string").alias("ship_date"))
    n = publish(spark, li.repartition(8), path).number + li.count()
    writers.compact(spark, path, [], ["ship_date", "l_suppkey"], max(1, n // 32))
    rows = read_published(spark, path)
    middle = {c: rows.agg(F.median(c).cast("long")).first()[0] if c == "l_suppkey" else rows.agg(F.min(c)).first()[0] for c in ("ship_date", "l_suppkey")}
    span = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(*[f(c).alias(f"{f.__name__}_{c}") for c in middle for f in (F.min, F.max)])
    opened = span.agg(*[F.avg(F.lit(v).between(F.col(f"min_{c}"), F.col(f"max_{c}")).cast("int")).alias(c) for c, v in middle.items()]).first()
    return rows.groupBy("ship_date").agg(F.count("*").alias("n"), F.sum("l_suppkey").alias("suppliers")).withColumns(
        {f"{c}_skips": F.lit(opened[c] < 0.5) for c in middle})


def q_write_state_partitions(spark, d):
    """B4 + E2 through a real table partitioned by a column with NULLs: customers change their tier (and so
    their partition), lose it, or arrive; the table read back equals the merged state."""
    from lakeshelf.sinks.tables import write_state

    path = scratch_path(spark, "by_tier")
    tier = lambda df, key: df.withColumn("tier", F.when(F.col(key) % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("t:"), F.col(key) % 5)))
    base = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    writers.overwrite(tier(base.filter(F.col("c_custkey") % 4 != 0), "c_custkey"), path, ["tier"])
    batch = tier(base.filter((F.col("c_custkey") % 3 == 0) | (F.col("c_custkey") % 4 == 0)).withColumn("c_name", F.upper("c_name")), "c_nationkey")
    stored = spark.read.schema(batch.schema).parquet(path)
    write_state(spark, changes.upsert(stored, batch, ["c_custkey"], update="*"), path, ["tier"])
    return spark.read.schema(batch.schema).parquet(path)


def q_stream_upsert_indexed(spark, d):
    """E1 + J4 through the key index: a part of the raw table as a stream, then all of it, that part included, from a fresh
    checkpoint. Rows and keys by source and month."""
    from lakeshelf.streaming.ingest import silver_pos_batch, silver_pos_stream

    bronze, target, index = (scratch_path(spark, n) for n in ("i_bronze", "i_silver", "i_keys"))
    stream = _bronze_pos(fixture(spark, d, "fx_pos_stream"))
    early = stream.filter(F.col("ingested_at") < F.lit("1997-01-01").cast("timestamp_ntz"))
    early.write.parquet(bronze)

    def run() -> None:
        silver_pos_stream(spark, bronze, stream.schema, target, scratch_path(spark, "i_ckpt"), partition_by=(), index_path=index, buckets=16).awaitTermination()

    run()
    stream.write.mode("append").parquet(bronze)  # the early rows once more, and all others
    run()
    return spark.read.parquet(target).groupBy("source_system", F.substring("transaction_date", 1, 7).alias("month")).agg(
        F.count("*").alias("n"), F.count_distinct("transaction_id").alias("n_keys"))


def q_rejected_rows(spark, d):
    """C1 + K5 at ingest: both feeds land with values that are no numbers and sales without an id; those rows come to rest beside the
    table with their reasons, all others in it. Rows by feed and reasons (none: they were taken), and the units taken."""
    from lakeshelf.streaming.ingest import bronze_checked

    bronze, found = scratch_path(spark, "checked"), []
    bad = {"quantity": F.when(F.col("quantity") % 7 == 0, F.lit("n/a")).otherwise(F.col("quantity").cast("string")),
           "transaction_id": F.when(F.col("quantity") % 11 == 0, F.lit(None)).otherwise(F.col("transaction_id"))}
    for tag, fmt in (("pos_realtime_stream", "json"), ("pos_batch_csv", "csv")):
        rows = _bronze_pos(fixture(spark, d, "fx_pos")).filter(F.col("_source") == tag).select(*RAW_POS.fieldNames()).withColumns(bad)
        landing = scratch_path(spark, f"landing_bad_{fmt}")
        w = rows.write.format(fmt)
        (w.option("header", "true").option("escape", '"') if fmt == "csv" else w).save(landing)
        bronze_checked(spark, landing, fmt, RAW_POS, bronze, scratch_path(spark, "checked_ckpt"), "run", ["transaction_id"], tag, tag).awaitTermination()
    taken = spark.read.parquet(bronze).select("_source", F.lit("").alias("reasons"), F.col("quantity").cast("long").alias("units"))
    set_aside = spark.read.parquet(bronze + "__rejected").select("_source", F.array_join("reasons", "; ").alias("reasons"), F.lit(None).cast("long").alias("units"))
    return taken.unionByName(set_aside).groupBy("_source", "reasons").agg(F.count("*").alias("n"), F.sum("units").alias("units"))


def q_raw_daily_distincts(spark, d):
    """Distinct transactions and customers of raw sales, in which both feeds repeat ids, beside sums over the same rows."""
    raw = silver.clean_pos(fixture(spark, d, "fx_pos"), F.col("_source"), "ts_iso")
    return facts.pos_daily_full(raw, unique=False).select("store_id", "product_id", "snapshot_date", "transaction_count", "unique_customers", "units_sold", "units_sold_online")


def q_ordered_output(spark, d):
    """Orders stored in order of day and key; what is read back by day, and how many rows or files are out of order."""
    path = scratch_path(spark, "orders_in_order")
    orders = table(spark, d, "orders").select(F.to_date("o_orderdate").cast("string").alias("day"), "o_orderkey", "o_totalprice")
    writers.overwrite_ordered(orders, path, ["day", "o_orderkey"], 16)
    wrong = writers.out_of_order(spark, path, ["day", "o_orderkey"]).count()
    return spark.read.parquet(path).groupBy("day").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"), F.lit(wrong).alias("out_of_order"))


def q_continuous_ingest(spark, d):
    """The events table lands in three portions while a query on the default trigger runs, is stopped and goes on twice from its
    checkpoint. Events by type, and how many rows the listener saw the query read in all."""
    from lakeshelf.streaming.continuous import Progress, drained
    from lakeshelf.streaming.ingest import bronze_messages

    landing, bronze, ckpt = (scratch_path(spark, n) for n in ("cont_landing", "cont_bronze", "cont_ckpt"))
    events = messages.encode_messages(table(spark, d, "events"), ["event_id", "user_id", "event_type", "value"], "events")
    portion = F.pmod(F.xxhash64("value"), F.lit(3))
    with Progress(spark) as progress:
        runs = []
        for n in range(3):
            events.filter(portion == n).write.mode("append").parquet(landing)
            stream = spark.readStream.schema("topic string, value binary").parquet(landing)
            runs.append(drained(bronze_messages(stream, EVENT_SCHEMA, "events", bronze, ckpt, "registry", available_now=False), progress))
    seen = sum(progress.rows.get(r, 0) for r in runs)
    return spark.read.parquet(bronze).groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("n_ids"), F.lit(seen).cast("long").alias("seen"))


def q_published_swap(spark, d):
    """B3 + B5: a table partitioned by status is replaced as a whole and then in one partition, while readers go on. Rows and
    totals by status as seen by a reader that opened it before, by one between, and by one after; ``torn`` counts reads taken
    during the writes that were none of the three states."""
    path = scratch_path(spark, "orders_published")
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderstatus")
    total = lambda df: df.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("price").cast("double").alias("total"))
    seen = lambda df: {tuple(r) for r in total(df).collect()}  # noqa: E731  a row per status
    publish(spark, orders, path, ["o_orderstatus"])
    readers = {"before": read_published(spark, path)}
    states, reads, ended = [seen(readers["before"])], [], threading.Event()

    def keep_reading() -> None:
        while not ended.is_set():
            reads.append(seen(read_published(spark, path)))

    reader = threading.Thread(target=keep_reading)
    reader.start()
    try:
        publish(spark, orders.filter("o_orderkey % 3 > 0").withColumn("price", (F.col("price") * 2).cast("decimal(18,2)")), path, ["o_orderstatus"])
        readers["between"] = read_published(spark, path)
        publish(spark, orders.filter("o_orderstatus = 'O'"), path, ["o_orderstatus"], "partitions")
        readers["after"] = read_published(spark, path)
    finally:
        ended.set()
        reader.join()
    states += [seen(readers["between"]), seen(readers["after"])]
    torn = sum(r not in states for r in reads)
    return reduce(DataFrame.unionByName, [total(df).select(F.lit(name).alias("reader"), "*", F.lit(torn).alias("torn")) for name, df in readers.items()])


def q_compact_table(spark, d):
    """Two partitions of a table are compacted in place, clustered on a column of few values; all rows stay."""
    path = scratch_path(spark, "orders")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.concat(F.lit("p"), F.col("o_orderkey") % 3).alias("part"))
    orders.repartition(8).write.partitionBy("part").parquet(path)
    some = spark.createDataFrame([("p0",), ("p2",)], "part string")
    writers.compact(spark, path, ["part"], ["o_orderstatus"], 100_000, partitions=some)
    return spark.read.parquet(path).select(*orders.columns)


# purchase orders / suppliers


def q_flatten_po_json(spark, d):
    return silver.clean_purchase_orders(fixture(spark, d, "fx_po")).select(
        "po_id", "line_no", "tie_part", "carrier", "tracking_number", "delivery_status", "delivery_notes_text",
        "order_year_month",
    )


def q_dedup_po_lifecycle(spark, d):
    return po_silver(spark, d)


def q_status_distribution(spark, d):
    return po_silver(spark, d).groupBy("status", "delivery_status").agg(F.count("*").alias("n"))


def q_fact_supplier_performance(spark, d):
    return facts.fact_supplier_performance(po_silver(spark, d))


def q_top_suppliers(spark, d):
    return facts.top_suppliers(facts.fact_supplier_performance(po_silver(spark, d)), 10)


def q_merge_purchase_orders(spark, d):
    po = fixture(spark, d, "fx_po")
    state = po_silver(spark, d, po.filter(F.col("line_no") <= 3))
    batch = po_silver(spark, d, po)
    return changes.upsert(state, batch, ["po_id"], compare=["status"])


# warehouse / shelf


def q_latest_snapshot(spark, d):
    return comparable(warehouse_silver(spark, d))


def q_warehouse_agg(spark, d):
    return comparable(facts.warehouse_by_product(warehouse_silver(spark, d)))


def q_merge_warehouse(spark, d):
    cleaned = silver.clean_warehouse(fixture(spark, d, "fx_warehouse"))
    cut = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    state = silver.latest_warehouse(cleaned.filter(F.col("ingested_at") < cut))
    return comparable(silver.apply_warehouse(state, cleaned.filter(F.col("ingested_at") >= cut)))


def q_flatten_temperature(spark, d):
    return shelf_clean(spark, d).select("store_id", "product_id", "seq", "sensor_id", "temperature_celsius", "humidity")


def q_merge_store_inventory(spark, d):
    cleaned = shelf_clean(spark, d)
    cut = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    state = shelf_silver(spark, d, cleaned.filter(F.col("ingested_at") < cut))
    return silver.apply_store_inventory(state, cleaned.filter(F.col("ingested_at") >= cut), [("seq", "desc")])


def q_quality_rules(spark, d):
    """All 28 rules of the catalogue, each table in one pass. The silver tables that several tables read are stored once, without
    the texts that neither a rule nor a fact looks at; the KPIs hold the inventory fact row for row, so that one pass counts
    the rules of both."""
    pos = materialize(pos_silver(spark, d).drop("transaction_date", "ingested_at"))
    wh, products = (materialize(f(spark, d)) for f in (warehouse_silver, product_current_load))
    po = materialize(po_silver(spark, d).drop("order_year_month", *silver.PO_PARSED["delivery_notes"]))
    shelf = materialize(shelf_silver(spark, d).select("store_id", "product_id", "current_quantity", "expiry_date"))
    customers = customers_silver(spark, d)
    full = facts.fact_inventory_full(pos, wh, products)
    daily = facts.fact_daily_inventory(pos, wh, products, shelf)
    tables = {
        "pos": pos.withColumn("_source", F.col("source_system")), "warehouse": wh, "store_inventory": shelf, "purchase_orders": po,
        "suppliers": silver.clean_suppliers(fixture(spark, d, "fx_supplier")), "customers": customers,
        "products": silver.clean_products(fixture(spark, d, "fx_product")), "stores": _store_snapshot(spark, d, "fx_store"),
        **{name: QUERIES[name](spark, d) for name in ("dim_product", "dim_store", "dim_supplier", "dim_customer")},
        "fact_inventory_kpis": facts.fact_inventory_kpis(full, keep=["status"]),
        "fact_demand_trends": facts.fact_demand_trends(daily), "fact_customer_sales": facts.fact_customer_sales(pos, customers, AS_OF_DATE),
        "fact_supplier_performance": facts.fact_supplier_performance(po),
    }
    rules = {**quality.RULES, "fact_inventory_kpis": {**quality.RULES["fact_inventory_full"], **quality.RULES["fact_inventory_kpis"]}}
    return reduce(DataFrame.unionByName, [quality.rule_failures(df, rules[name]) for name, df in tables.items()])


# customers


def q_clean_customers(spark, d):
    return customers_silver(spark, d)


def q_explode_categories(spark, d):
    return customers_silver(spark, d).select("customer_id", F.explode("preferred_categories").alias("category"))


def merged_customers(spark, d):
    state = customers_silver(spark, d, "fx_customer_target")
    return silver.apply_customers(state, fixture(spark, d, "fx_customer_source"))


def q_merge_customers(spark, d):
    return merged_customers(spark, d)


def q_customer_job(spark, d):
    """The generic incremental job on real tables: two customer loads land in a
    bronze folder (the existing customers, then the incoming batch); after each
    load the job reads only rows past the run log's mark and merges them into
    the silver table. The result is the silver table after both runs."""
    from lakeshelf.plans.jobs import incremental_job

    bronze, target, log = (scratch_path(spark, n) for n in ("cust_bronze", "cust_silver", "cust_runlog"))
    like = silver.clean_customers(fixture(spark, d, "fx_customer").limit(0).withColumn(
        "ingested_at", F.lit(None).cast("timestamp")))
    for n, (name, loaded) in enumerate([("fx_customer_target", NOW_1), ("fx_customer_source", NOW_2)]):
        load = fixture(spark, d, name).withColumn("ingested_at", F.lit(loaded).cast("timestamp"))
        load.write.mode("append").parquet(bronze)
        incremental_job(spark, "silver_customers", spark.read.parquet(bronze), target, like,
                        lambda state, inc: silver.apply_customers(state, inc), log)
    return read_published(spark, target).select(*[c for c in silver.CUSTOMER_COLUMNS if c != "ingested_at"])


def q_merge_bucketed(spark, d):
    """E2 for a large batch: the customer table lies in buckets of its key, the batch is dealt out to them, and the merged
    table is published in the same buckets; then the batch once more, which changes nothing."""
    path = scratch_path(spark, "customers_bucketed")
    publish(spark, customers_silver(spark, d, "fx_customer_target"), path, keys=["customer_id"], buckets=8)
    batch = materialize(customers_silver(spark, d, "fx_customer_source"))
    for _ in range(2):
        state = changes.merge_bucketed(read_published(spark, path), batch, ["customer_id"], compare=silver.CUSTOMER_COMPARE)
        publish(spark, changes.live(state), path, keys=["customer_id"], buckets=8, laid_out=True)
    return read_published(spark, path)


def q_crossed_commits(spark, d):
    """A6 + B6 by files seen: the second load is stamped a month before the first but committed after the first run; it is
    merged all the same, and a third run finds nothing."""
    from lakeshelf.plans.jobs import file_progress_job

    bronze, target, log, ckpt = (scratch_path(spark, n) for n in ("cross_bronze", "cross_silver", "cross_runlog", "cross_ckpt"))
    like = silver.clean_customers(fixture(spark, d, "fx_customer").limit(0).withColumn("ingested_at", F.lit(None).cast("timestamp")))
    for name, stamped in (("fx_customer_target", NOW_2), ("fx_customer_source", NOW_1), (None, None)):
        if name:
            load = fixture(spark, d, name).withColumn("ingested_at", F.lit(stamped).cast("timestamp"))
            load.write.mode("append").parquet(bronze)
        ran = file_progress_job(spark, "silver_customers", bronze, load.schema, target, like, silver.apply_customers, log, ckpt)
        if bool(name) != bool(ran):
            raise AssertionError(f"{name}: {ran}")
    return read_published(spark, target).select(*[c for c in silver.CUSTOMER_COLUMNS if c != "ingested_at"])


def q_merge_metrics(spark, d):
    return changes.change_metrics(merged_customers(spark, d))


def q_dim_customer(spark, d):
    existing = customers_silver(spark, d, "fx_customer_target")
    incoming = customers_silver(spark, d, "fx_customer_source")
    return dims.dim_customer(existing, incoming)


# stream then batch


def q_merge_insert_only(spark, d):
    return comparable(pos_after_stream(spark, d))


def q_merge_pos_batch(spark, d):
    state = silver_after_stream(spark, d)
    return comparable(changes.upsert(state, pos_batch_clean(spark, d), ["transaction_id"], compare=silver.POS_BATCH_COMPARE,
                                     strategy=strategy_for(pos_batch_rows(spark, d))))


def q_batch_scope_semi(spark, d):
    state = silver_after_stream(spark, d)
    return state.join(batch_dates(pos_batch_clean(spark, d)), "transaction_date", "left_semi").select("transaction_id", "transaction_date")


def q_cancelled_anti(spark, d):
    state = silver_after_stream(spark, d)
    batch = pos_batch_clean(spark, d)
    in_scope = state.join(batch_dates(batch), "transaction_date", "left_semi")
    return in_scope.join(batch.select("transaction_id"), "transaction_id", "left_anti").select(
        "transaction_id", "transaction_date"
    )


def q_reconcile_batch(spark, d):
    state = silver_after_stream(spark, d)
    bronze = _bronze_pos(fixture(spark, d, "fx_pos_batch"))
    return comparable(silver.apply_pos_batch(state, bronze))


# SCD2 and dimensions


def q_scd2_classify(spark, d):
    s1 = silver.apply_scd2(None, silver.clean_products(fixture(spark, d, "fx_product_t1")), "product_id",
                           silver.PRODUCT_TRACKED, NOW_1)
    cls = changes.scd2_classify(changes.live(s1), silver.clean_products(fixture(spark, d, "fx_product_t2")),
                                ["product_id"], silver.PRODUCT_TRACKED)
    return cls.select("product_id", "cost_price", "_action")


def q_scd2_product(spark, d):
    return comparable(_no_hash(product_versions(spark, d)))


def q_scd2_store(spark, d):
    return comparable(store_versions(spark, d))


def q_scd2_supplier(spark, d):
    return comparable(supplier_versions(spark, d))


def q_scd2_as_of(spark, d):
    versions = changes.live(product_versions(spark, d))
    parts = []
    for ts in ("2023-12-31 00:00:00", "2024-01-15 00:00:00", "2024-03-01 00:00:00"):
        parts.append(changes.as_of(versions, ts).select(
            F.lit(ts).cast("timestamp_ntz").alias("as_of_ts"), "product_id", "cost_price", "valid_from", "valid_to"
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return comparable(out)


def q_dim_product(spark, d):
    return dims.dim_product(changes.live(product_versions(spark, d)))


def q_dim_store(spark, d):
    return dims.dim_store(changes.live(store_versions(spark, d)), AS_OF_DATE)


def q_dim_supplier(spark, d):
    return dims.dim_supplier(changes.live(supplier_versions(spark, d)))


def q_dim_date(spark, d):
    li = table(spark, d, "lineitem")
    bounds = li.agg(F.min(F.to_date("l_shipdate")).alias("start"), F.max(F.to_date("l_shipdate")).alias("end"))
    return dims.dim_date(dims.calendar_days(bounds))


# facts and windows


def full_fact(spark, d, frame="rows", densify=False):
    return facts.fact_inventory_full(pos_silver(spark, d), warehouse_silver(spark, d),
                                     product_current_load(spark, d), frame=frame, densify=densify)


def daily_fact(spark, d):
    return facts.fact_daily_inventory(pos_silver(spark, d), warehouse_silver(spark, d),
                                      product_current_load(spark, d), shelf_silver(spark, d))


def q_fact_inventory_full(spark, d):
    return comparable(full_fact(spark, d))


def q_fact_inventory_kpis(spark, d):
    return facts.fact_inventory_kpis(full_fact(spark, d))


def q_fact_inventory_kpis_dense(spark, d):
    """KPIs over the densified snapshot (one row per day per series): dead stock
    can be detected."""
    return facts.fact_inventory_kpis(full_fact(spark, d, densify=True))


def q_fact_daily_inventory(spark, d):
    return daily_fact(spark, d)


def q_fact_demand_trends(spark, d):
    return comparable(facts.fact_demand_trends(daily_fact(spark, d)))


def q_gold_write(spark, d):
    """B5 + C1: the demand fact stored by month with its audit columns, one month replaced by a second run, read back;
    rows and runs by month."""
    from lakeshelf.sinks.gold import write_gold

    path = scratch_path(spark, "gold_demand")
    fact = materialize(facts.fact_demand_trends(daily_fact(spark, d)))
    write_gold(spark, fact, "gold.fact_demand_trends", path, "run-1", ["year_month"])
    write_gold(spark, fact.filter(F.col("year_month") >= "1998-01"), "gold.fact_demand_trends", path, "run-2", ["year_month"], only_partitions=True)
    return read_published(spark, path).groupBy("year_month", "pipeline_run_id").agg(
        F.count("*").alias("n"), F.sum("units_sold").alias("units_sold"), F.count("_gold_processed_at").alias("stamped"))


def q_fact_customer_sales(spark, d):
    return comparable(facts.fact_customer_sales(pos_silver(spark, d), customers_silver(spark, d), AS_OF_DATE))


def _daily_units(spark, d):
    return facts.pos_daily(pos_silver(spark, d)).select("store_id", "product_id", "transaction_date", "units_sold",
                                                         "revenue")


def q_rolling_avg(spark, d):
    return windows.rolling(_daily_units(spark, d), facts.SERIES, "transaction_date", {
        "avg_units_7d": ("avg", "units_sold", 7), "avg_units_30d": ("avg", "units_sold", 30),
        "avg_units_90d": ("avg", "units_sold", 90),
    })


def q_rolling_sum(spark, d):
    daily = _daily_units(spark, d)
    out = windows.rolling(daily, facts.SERIES, "transaction_date", {
        "units_30d": ("sum", "units_sold", 30), "units_90d": ("sum", "units_sold", 90),
    })
    return windows.rolling(out, facts.SERIES, "transaction_date", {"revenue_30d": ("sum", "revenue", 30)},
                           money_scale=2)


def q_rolling_avg_days(spark, d):
    return windows.rolling(_daily_units(spark, d), facts.SERIES, "transaction_date", {
        "avg_units_30d": ("avg", "units_sold", 30), "units_7d": ("sum", "units_sold", 7),
    }, frame="days")


def q_densify_days(spark, d):
    daily = windows.densify_days(_daily_units(spark, d), facts.SERIES, "transaction_date",
                                 {"units_sold": 0, "revenue": 0.0})
    return windows.rolling(daily, facts.SERIES, "transaction_date", {"avg_units_30d": ("avg", "units_sold", 30)})


# late data and partition overwrite


def _daily_sales(pos: DataFrame) -> DataFrame:
    return facts.pos_daily(pos).select("transaction_date", "store_id", "product_id", "units_sold", "revenue",
                                       "transaction_count")


def late_inputs(spark, d):
    """Silver POS before the late increment, after it, and the increment itself
    (event date as a DATE column, the fact's partition column).

    The raw rows are deduplicated once, by key and side of the cut; each side is read from that, and what holds
    after the increment is the survivor of both."""
    cut = F.lit(INCREMENT_FROM).cast("timestamp_ntz")
    raw = silver.clean_pos(fixture(spark, d, "fx_pos"), F.col("_source"), "ts_iso").withColumn("__late", F.col("ingested_at") >= cut)
    sides = materialize(dedup.first_per_key(raw, ["transaction_id", "__late"], silver.POS_TIE_BREAK))
    dated = lambda df: df.drop("__late").withColumn("transaction_date", F.to_date("transaction_ts"))
    now = materialize(dated(silver.dedup_pos(sides.drop("__late"))))
    return dated(sides.filter(~F.col("__late"))), now, dated(sides.filter("__late"))


def q_late_dates(spark, d):
    """Recompute exactly the event dates the late increment touches (its own dates
    and those its keys moved away from) and keep every other date."""
    before, now, increment = late_inputs(spark, d)
    touched = materialize(late.touched_partitions(before, increment, ["transaction_id"], "transaction_date"))
    return late.recompute_partitions(_daily_sales(before), now, touched, "transaction_date", _daily_sales)


ROLLED = {"avg_units_7d": ("avg", "units_sold", 7), "avg_units_90d": ("avg", "units_sold", 90), "units_30d": ("sum", "units_sold", 30)}


def _late_rolling(spark, d, frame: str):
    """A published fact with trailing frames, built before the late increment and patched by it."""
    before, now, increment = late_inputs(spark, d)
    build = lambda daily: windows.rolling(daily, facts.SERIES, "transaction_date", ROLLED, frame)
    month = F.date_format("transaction_date", "yyyy-MM").alias("year_month")
    path = scratch_path(spark, "rolling_fact")
    daily = materialize(_daily_sales(before))
    publish(spark, build(daily).select("*", month), path, ["year_month"])
    touched = materialize(late.touched_days(before, increment, ["transaction_id"], facts.SERIES, "transaction_date"))
    daily = materialize(late.recompute_groups(daily, now, touched, [*facts.SERIES, "transaction_date"], _daily_sales))
    patch = late.rolling_patch(daily, touched, facts.SERIES, "transaction_date", 90, build, frame)
    patch.rows = patch.rows.select("*", month)
    late.publish_patch(spark, path, patch, ["year_month"], patch.keys.select(month))
    return read_published(spark, path).drop("year_month")


def q_late_dates_rolling(spark, d):
    """J5 for trailing frames of rows: late rows change the next 7, 30 and 90 observed rows of their series, and only the
    months that hold those are written; the result equals a full rebuild."""
    return _late_rolling(spark, d, "rows")


def q_late_dates_rolling_days(spark, d):
    """The same for frames of calendar days."""
    return _late_rolling(spark, d, "days")


def q_partition_overwrite(spark, d):
    """B4 through a real table: write the first result partitioned by month,
    overwrite only the months holding touched dates, read the table back.
    (Month partitions because this data set has ~20 rows per day; the operator
    is the same for daily partitions of a large table.)"""
    before, now, increment = late_inputs(spark, d)

    def monthly(df):
        return _daily_sales(df).withColumn("year_month", F.date_format("transaction_date", "yyyy-MM"))

    path = scratch_path(spark, "daily_sales")
    writers.overwrite(monthly(before), path, ["year_month"])
    touched = late.touched_partitions(before, increment, ["transaction_id"], "transaction_date")
    months = materialize(touched.select(F.date_format("transaction_date", "yyyy-MM").alias("year_month")).distinct())
    current = now.withColumn("year_month", F.date_format("transaction_date", "yyyy-MM"))
    redo = monthly(current.join(maybe_broadcast(months, fits(months)), "year_month", "left_semi").drop("year_month"))
    writers.overwrite_partitions(redo, path, ["year_month"])
    return spark.read.parquet(path).drop("year_month")


def q_run_log_latest(spark, d):
    """Run records derived from the POS loads: one run per load day, a RUNNING and a SUCCESS record each; the latest success
    carries the mark (max load time read)."""
    pos = fixture(spark, d, "fx_pos")
    per_day = pos.groupBy(F.to_date("ingested_at").alias("load_day")).agg(
        F.count("*").alias("rows_read"), F.max("ingested_at").alias("watermark"))
    run_id = F.concat(F.lit("pos-"), F.col("load_day").cast("string"))
    started = per_day.select(
        run_id.alias("run_id"), F.lit("silver_pos").alias("pipeline_name"), F.lit("RUNNING").alias("status"),
        F.col("load_day").cast("timestamp_ntz").alias("recorded_at"), F.lit(None).cast("long").alias("rows_read"),
        F.lit(None).cast("timestamp_ntz").alias("watermark"))
    ended = per_day.select(
        run_id.alias("run_id"), F.lit("silver_pos").alias("pipeline_name"), F.lit("SUCCESS").alias("status"),
        (F.col("load_day").cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")).alias("recorded_at"),
        F.col("rows_read"), F.col("watermark"))
    return runlog.last_success(started.unionByName(ended), "silver_pos")


def _in_utc(fn: Query) -> Query:
    """Dates and instants are defined in UTC (event dates, partition days): pin
    the session time zone before building the plan."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Query] = {
    name[2:]: _in_utc(fn) for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
