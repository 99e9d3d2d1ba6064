"""One callable per operator: ``(spark, sf_dir) -> DataFrame``.

Each one reads whole tables.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.config import Layers, RawDataset, RunConfig, raw_datasets
from orderloom.functions import event_json, exact_total, parse_event, rounded_amount, utc_text
from orderloom.operators.quality import (
    Between,
    InReference,
    NotNull,
    Suite,
    Unique,
    evaluate,
    failing_rows,
    overall,
    repeated_keys,
    unknown_keys,
)
from orderloom.plans import bronze, gold, quality_gate, silver
from orderloom.plans.staged_run import run_stages
from orderloom.session import apply_settings, scratch_path
from orderloom.sinks import (
    append_table,
    cluster_table,
    compact_table,
    create_database,
    publish,
    refresh_table,
)
from orderloom.sizing import restore_shuffles
from orderloom.sources import (
    Topic,
    list_columns,
    preview,
    read_landing,
    read_table,
    stream_topic,
)
from orderloom.streaming import (
    StreamCounts,
    compact_printed_landing,
    drain,
    land_and_print,
    land_orders,
    landed_totals,
    read_batches,
    read_printed,
)
from orderloom.workload import mapping as src

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

log = logging.getLogger(__name__)


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        restore_shuffles(spark)
        return fn(apply_settings(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.order_lines(
        orders=src.orders(spark, sf_dir),
        customers=src.customers(spark, sf_dir),
        order_items=src.order_items(spark, sf_dir),
        payments=src.order_payments(spark, sf_dir),
        products=src.products(spark, sf_dir),
        translation=src.translation(spark, sf_dir),
    )


def orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, without a look at products."""
    known = silver.known_orders(
        orders=src.orders(spark, sf_dir),
        customers=src.customers(spark, sf_dir),
        payments=src.order_payments(spark, sf_dir),
    )
    return gold.order_grain(silver.ordered(known, src.order_items(spark, sf_dir)))


# ---- raw files and tables


def write_raw(spark: SparkSession, sf_dir: str, *tables: str) -> str:
    """The given tables as raw CSV folders, written by all tasks."""
    root = scratch_path(spark, "raw")
    for name in tables:
        src.RAW[name](spark, sf_dir).write.option("header", True).csv(f"{root}/{name}.csv")
    return root


def fresh_layers(spark: SparkSession) -> Layers:
    return Layers.with_suffix(uuid.uuid4().hex, scratch_path(spark, "layers"))


@query
def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, layers = write_raw(spark, sf_dir, "orders"), fresh_layers(spark)
    datasets = tuple(d for d in raw_datasets() if d.table == "orders")
    bronze.ingest_all(spark, root, datasets, layers)
    return read_table(spark, layers.bronze, "orders").select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        "order_status",
        F.to_date("order_purchase_timestamp").alias("order_date"),
        F.col("ingestion_timestamp").isNotNull().alias("has_time"),
        F.col("source_file").contains("/orders.csv/").alias("has_source"),
    )


@query
def bronze_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, layers = write_raw(spark, sf_dir, *src.RAW), fresh_layers(spark)
    counts = bronze.ingest_all(spark, root, raw_datasets(multi_line=("order_reviews",)), layers)
    return bronze.counts_frame(spark, counts)


@query
def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, layers = write_raw(spark, sf_dir, *src.RAW), fresh_layers(spark)
    datasets = raw_datasets(schemas=src.RAW_SCHEMAS, multi_line=("order_reviews",))
    bronze.ingest_all(spark, root, datasets, layers)
    return list_columns(spark, layers.bronze)


@query
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write replaces rows and schema of the first."""
    layers = fresh_layers(spark)
    create_database(spark, layers.silver, layers.database_path(layers.silver))
    refresh_table(src.customers(spark, sf_dir), layers.silver, "orders")
    refresh_table(silver.clean_orders(src.orders(spark, sf_dir)), layers.silver, "orders")
    return read_table(spark, layers.silver, "orders")


@query
def table_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = fresh_layers(spark)
    create_database(spark, layers.gold, layers.database_path(layers.gold))
    orders = silver.clean_orders(src.orders(spark, sf_dir))
    refresh_table(orders, layers.gold, "orders", cluster_by=("order_date",))
    return read_table(spark, layers.gold, "orders")


@query
def bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged lines of orders: what became a row, and what was set aside as it came."""
    root, layers = scratch_path(spark, "raw"), fresh_layers(spark)
    src.damaged_order_lines(spark, sf_dir).write.text(f"{root}/orders.csv")
    dataset = RawDataset("orders", "orders.csv", src.RAW_SCHEMAS["orders"], options={"header": "false"})
    counts = bronze.ingest_all(spark, root, (dataset,), layers, rejects=True)
    kept = read_table(spark, layers.bronze, "orders").select(
        "order_id", "customer_id", "order_status", F.to_date("order_purchase_timestamp").alias("order_date"),
        F.lit(None).cast("string").alias("rejected_line"),
    )
    rejected = read_table(spark, layers.bronze, "orders_rejects").select(
        F.substring_index("rejected_line", ",", 1).cast("bigint").alias("order_id"),
        F.lit(None).cast("bigint").alias("customer_id"),
        F.lit(None).cast("string").alias("order_status"),
        F.lit(None).cast("date").alias("order_date"),
        "rejected_line",
    )
    return kept.unionByName(rejected).withColumns(
        {name: F.lit(counts[table]).cast("long") for name, table in (("kept", "orders"), ("rejected", "orders_rejects"))}
    )


@query
def table_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that grew by seven appends and was put together on the way."""
    layers = fresh_layers(spark)
    create_database(spark, layers.gold, layers.database_path(layers.gold))
    orders = silver.clean_orders(src.orders(spark, sf_dir))
    refresh_table(orders.limit(0), layers.gold, "orders")
    for piece in range(7):
        day = orders.where(F.pmod(F.dayofyear("order_date"), F.lit(7)) == piece)
        append_table(day, layers.gold, "orders", most_parts=4)
    compact_table(spark, layers.gold, "orders")
    table = read_table(spark, layers.gold, "orders")
    return table.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.countDistinct("order_id").alias("distinct_orders"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )


@query
def table_reclustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clustered table, to which late orders are added and which is then clustered again."""
    layers = fresh_layers(spark)
    create_database(spark, layers.gold, layers.database_path(layers.gold))
    orders = silver.clean_orders(src.orders(spark, sf_dir))
    late = F.col("order_id") % 100 == 0
    refresh_table(orders.where(~late), layers.gold, "orders", cluster_by=("order_date",))
    append_table(orders.where(late), layers.gold, "orders")
    cluster_table(spark, layers.gold, "orders", "order_date")
    again = cluster_table(spark, layers.gold, "orders", "order_date")
    return read_table(spark, layers.gold, "orders").withColumn("rewritten_again", F.lit(again).cast("long"))


# ---- order lines


@query
def orders_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_orders(src.damaged_orders(spark, sf_dir))


@query
def order_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.order_amounts(src.order_payments(spark, sf_dir))


@query
def order_amount_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of seven decimals, of which a total must lose none."""
    payments = src.order_payments(spark, sf_dir).withColumn("payment_value", F.col("payment_value") / 1000)
    return silver.order_amounts(payments)


@query
def products_translated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.translate_categories(src.products(spark, sf_dir), src.translation(spark, sf_dir))


@query
def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir)


@query
def silver_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(lines(spark, sf_dir), ["order_id", "product_id", "price", "freight_value"])


# ---- business aggregates


@query
def orders_order_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_with_lines(spark, sf_dir)


@query
def daily_revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_revenue_by_category(lines(spark, sf_dir))


@query
def top10_customers_ltv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_customers(orders_with_lines(spark, sf_dir))


@query
def rolling_7day_order_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.rolling_order_volume(orders_with_lines(spark, sf_dir))


# ---- quality


def written_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines as a table, for queries that read them more than once."""
    layers = fresh_layers(spark)
    create_database(spark, layers.silver, layers.database_path(layers.silver))
    refresh_table(lines(spark, sf_dir), layers.silver, "orders")
    return read_table(spark, layers.silver, "orders")


# These bounds cut through the given order dates; the wide ones contain them all.
NARROW = (date(1996, 1, 1), date(1998, 12, 31))
WIDE = (date(1995, 1, 1), date(2001, 12, 31))


@query
def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(
        lines(spark, sf_dir),
        quality_gate.order_line_suite(*NARROW),
        "silver_orders",
        {"customers": src.customers(spark, sf_dir)},
    )


@query
def dq_results_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key rules on the uncleaned orders, where they can fail."""
    suite = Suite(
        "raw_orders_suite",
        (
            NotNull("order_id"),
            NotNull("customer_id"),
            InReference("customer_id", "customers", "customer_id"),
        ),
    )
    references = {"customers": src.customers_with_gaps(spark, sf_dir)}
    return evaluate(src.damaged_orders(spark, sf_dir), suite, "bronze_orders", references)


@query
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = written_lines(spark, sf_dir)
    references = {"customers": src.customers(spark, sf_dir)}
    outcomes = [
        overall(
            evaluate(table, quality_gate.order_line_suite(*bounds), "silver_orders", references)
        ).select(F.lit(name).alias("bounds"), "success")
        for name, bounds in (("narrow", NARROW), ("wide", WIDE))
    ]
    return outcomes[0].unionByName(outcomes[1])


@query
def dq_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two recorded runs; the list grows by one row each."""
    layers = fresh_layers(spark)
    orders = silver.clean_orders(src.damaged_orders(spark, sf_dir))
    for bounds in (NARROW, WIDE):
        suite = Suite("order_dates", (NotNull("customer_id"), Between("order_date", *bounds)))
        verdict = quality_gate.run_suite(orders, suite, "orders", run_name=f"until {bounds[1]}")
        quality_gate.record_run(spark, verdict, layers)
    return read_table(spark, layers.quality, "runs").select("run_name", "asset", "suite", "success")


@query
def dq_orphan_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unknown_keys(
        silver.clean_orders(src.damaged_orders(spark, sf_dir)),
        InReference("customer_id", "customers", "customer_id"),
        {"customers": src.customers_with_gaps(spark, sf_dir)},
    )


@query
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    suite = quality_gate.order_line_suite(*NARROW, min_amount=5000)
    failing = failing_rows(
        written_lines(spark, sf_dir), suite, {"customers": src.customers_with_gaps(spark, sf_dir)}
    )
    return failing.withColumn("broken_rules", F.array_join("broken_rules", ","))


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on single and compound keys, of which some are repeated."""
    people = Suite("customers_suite", (NotNull("customer_id"), Unique("customer_id")))
    lines = Suite(
        "items_suite",
        (Unique("order_id", "order_item_id"), Unique("order_id", "order_item_id", "product_id", "price"), NotNull("price")),
    )
    results = evaluate(src.doubled_customers(spark, sf_dir), people, "bronze_customers")
    return results.unionByName(evaluate(src.order_items(spark, sf_dir), lines, "bronze_order_items"))


@query
def dq_unique_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers that are there twice, with all their rows."""
    suite = quality_gate.reference_suite("customers")
    failing = failing_rows(src.doubled_customers(spark, sf_dir), suite)
    return failing.withColumn("broken_rules", F.array_join("broken_rules", ","))


@query
def dq_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compound keys that several lines share, each with their number."""
    return repeated_keys(src.order_items(spark, sf_dir), Unique("order_id", "order_item_id"))


@query
def dq_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three references and a uniqueness rule, in one pass over the lines. One reference
    lists its keys as text."""
    suite = Suite(
        "lines_suite",
        (
            InReference("customer_id", "customers", "customer_id"),
            Between("order_date", *NARROW),
            InReference("product_id", "products", "product_id"),
            InReference("order_id", "paid", "paid_order"),
            Unique("order_id", "product_id"),
        ),
    )
    references = {
        "customers": src.customers_with_gaps(spark, sf_dir),
        "products": src.products_with_gaps(spark, sf_dir),
        "paid": src.paid_orders(spark, sf_dir),
    }
    return evaluate(lines(spark, sf_dir), suite, "silver_orders", references)


# ---- event stream


def event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.order_events(spark, sf_dir).select(
        event_json(
            "customer_id",
            "product_id",
            rounded_amount(F.col("order_amount")).alias("order_amount"),
            utc_text(F.col("event_time")).alias("timestamp"),
        ).alias("value")
    )


def damaged_event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event; some are cut short and some lack an amount."""
    number = F.substring_index("product_id", "_", -1).cast("bigint")
    return src.order_events(spark, sf_dir).select(
        F.when(number % 50 == 0, F.concat(F.lit('{"product_id": "'), "product_id"))
        .when(number % 51 == 0, event_json("product_id"))
        .otherwise(
            event_json("customer_id", "product_id", "order_amount", utc_text(F.col("event_time")).alias("timestamp"))
        )
        .alias("value")
    )


def published(spark: SparkSession, values: DataFrame, **settings) -> Topic:
    topic = Topic(scratch_path(spark, "new_orders"), **settings)
    publish(values, topic)
    return topic


@query
def order_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_text(spark, sf_dir).select(parse_event(F.col("value")).alias("event")).select(
        "event.customer_id", "event.product_id", "event.order_amount", "event.timestamp"
    )


@query
def stream_high_value_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = published(spark, event_text(spark, sf_dir))
    out = scratch_path(spark, "landing")
    drain(land_orders(stream_topic(spark, topic), out, f"{out}-checkpoint"))
    return read_landing(spark, out)


@query
def stream_landing_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed lines summed up per customer."""
    topic = published(spark, event_text(spark, sf_dir))
    out = scratch_path(spark, "landing")
    drain(land_orders(stream_topic(spark, topic), out, f"{out}-checkpoint"))
    return read_landing(spark, out).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        exact_total(F.col("order_amount")).alias("total_amount"),
    )


@query
def stream_two_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both sinks, and what the stream itself counted."""
    topic = published(spark, event_text(spark, sf_dir))
    out, counts = scratch_path(spark, "landing"), StreamCounts()
    drain(land_and_print(stream_topic(spark, topic), out, f"{out}-checkpoint", counts=counts))
    printed = read_printed(spark, out).select(parse_event(F.col("value")).alias("event")).select("event.*")
    fields = ("customer_id", "product_id", "order_amount", "timestamp")
    sinks = [
        rows.select(*fields, F.lit(name).alias("sink"))
        for name, rows in (("landing", read_batches(spark, out)), ("console", printed))
    ]
    return sinks[0].unionByName(sinks[1]).withColumns(
        {"matched": F.lit(counts.matched).cast("long"), "rejected": F.lit(counts.rejected).cast("long")}
    )


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one checkpoint, new events in between; none lands twice."""
    events = event_text(spark, sf_dir)
    amount = F.get_json_object("value", "$.order_amount").cast("double")
    topic = published(spark, events.where(amount <= 100))
    out = scratch_path(spark, "landing")
    drain(land_orders(stream_topic(spark, topic), out, f"{out}-checkpoint"))
    publish(events.where(amount > 100), topic)
    drain(land_orders(stream_topic(spark, topic), out, f"{out}-checkpoint"))
    drain(land_orders(stream_topic(spark, topic), out, f"{out}-checkpoint"))
    return read_landing(spark, out)


@query
def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over one checkpoint, and what their batches have counted in all."""
    events = damaged_event_text(spark, sf_dir)
    topic = Topic(scratch_path(spark, "new_orders"))
    out = scratch_path(spark, "landing")
    for piece in range(3):
        publish(events.where(F.pmod(F.xxhash64("value"), F.lit(3)) == piece), topic)
        drain(land_and_print(stream_topic(spark, topic), out, f"{out}-checkpoint"))
    total = landed_totals(spark, out)
    return read_batches(spark, out).groupBy("customer_id").agg(F.count(F.lit(1)).alias("landed")).withColumns(
        {"matched": F.lit(total.matched).cast("long"), "rejected": F.lit(total.rejected).cast("long")}
    )


@query
def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small batches, put together in place: all their outputs, as they were."""
    topic = published(spark, damaged_event_text(spark, sf_dir).repartition(4), batch_limit=1)
    out = scratch_path(spark, "landing")
    drain(land_and_print(stream_topic(spark, topic), out, f"{out}-checkpoint"))
    compact_printed_landing(spark, out)
    product = F.regexp_extract("value", r"prod_\d+", 0).alias("product_id")
    outputs = {
        "landing": read_batches(spark, out).select("product_id"),
        "console": read_printed(spark, out).select(product),
        "dead": read_batches(spark, out, "dead_letter").select(product),
    }
    rows = [frame.select("product_id", F.lit(name).alias("output")) for name, frame in outputs.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def stream_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = published(spark, damaged_event_text(spark, sf_dir))
    out = scratch_path(spark, "landing")
    drain(land_orders(stream_topic(spark, topic), out, f"{out}-checkpoint"))
    rejected = read_landing(spark, out, "dead_letter", "value string, reason string")
    kept = read_landing(spark, out)
    return rejected.select(
        F.regexp_extract("value", r"prod_\d+", 0).alias("product_id"), "reason"
    ).unionByName(kept.select("product_id", F.lit("kept").alias("reason")))


# ---- all stages


def run_config(spark: SparkSession, sf_dir: str, bounds: tuple[date, date], **settings) -> RunConfig:
    return RunConfig(
        raw_root=write_raw(spark, sf_dir, *src.RAW),
        datasets=raw_datasets(schemas=src.RAW_SCHEMAS, multi_line=("order_reviews",)),
        layers=fresh_layers(spark),
        first_order_date=bounds[0],
        last_order_date=bounds[1],
        **settings,
    )


@query
def staged_run_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_stages(spark, run_config(spark, sf_dir, WIDE)).summary(spark)


@query
def staged_run_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_stages(spark, run_config(spark, sf_dir, NARROW)).summary(spark)


@query
def staged_gold_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all gold tables of a whole run, as one list."""
    cfg = run_config(spark, sf_dir, WIDE)
    run_stages(spark, cfg)

    def gold_table(name: str, day, label, value) -> DataFrame:
        table = read_table(spark, cfg.layers.gold, name)
        return table.select(
            F.lit(name).alias("table_name"), day.alias("order_date"), label.alias("label"), value.cast("double").alias("value")
        )

    no_day, no_label = F.lit(None).cast("date"), F.lit(None).cast("string")
    return (
        gold_table("daily_revenue_by_category", F.col("order_date"), F.col("product_category_name_english"), F.col("revenue"))
        .unionByName(gold_table("top10_customers_ltv", no_day, F.col("customer_unique_id"), F.col("lifetime_value")))
        .unionByName(
            gold_table("rolling_7day_order_volume", F.col("order_date"), no_label, F.col("rolling_7day_avg_order_volume"))
        )
    )


@query
def staged_quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that a whole run has set aside, and why."""
    cfg = run_config(spark, sf_dir, NARROW)
    run_stages(spark, cfg)
    table = read_table(spark, cfg.layers.quarantine, "orders")
    return table.withColumn("broken_rules", F.array_join("broken_rules", ","))


@query
def staged_run_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run over repeated customers, which is stopped before they fan out."""
    cfg = run_config(spark, sf_dir, WIDE, unique_references=True)
    path = f"{cfg.raw_root}/customers.csv"
    src.doubled_customers(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    return run_stages(spark, cfg).summary(spark)
