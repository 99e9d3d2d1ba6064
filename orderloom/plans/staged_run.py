"""Raw files to gold tables, with the quality gate in between.

Each stage reads the tables of the stage before, so it can also be run alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from orderloom.config import RunConfig
from orderloom.operators.quality import failing_rows
from orderloom.plans import bronze, gold, silver
from orderloom.plans.quality_gate import (
    REFERENCE_KEYS,
    Verdict,
    order_line_suite,
    record_run,
    reference_suite,
    run_suite,
)
from orderloom.sinks.tables import create_database, refresh_table
from orderloom.sizing import size_shuffles
from orderloom.sources.tables import read_table


@dataclass(frozen=True)
class StagedRun:
    branch: str
    verdict: Verdict
    rows: dict[str, int]

    def summary(self, spark: SparkSession) -> DataFrame:
        """One row per written table, with the branch the run took."""
        rows = [(table, count, self.branch, self.verdict.success) for table, count in self.rows.items()]
        return spark.createDataFrame(
            rows, "table_name string, row_count long, branch string, success boolean"
        )


def ingest_bronze(spark: SparkSession, cfg: RunConfig) -> dict[str, int]:
    counts = bronze.ingest_all(
        spark, cfg.raw_root, cfg.datasets, cfg.layers, cfg.table_format, rejects=cfg.rejects
    )
    return {f"bronze.{table}": n for table, n in counts.items()}


def transform_silver(spark: SparkSession, cfg: RunConfig) -> dict[str, int]:
    def raw(table: str) -> DataFrame:
        return read_table(spark, cfg.layers.bronze, table)

    create_database(spark, cfg.layers.silver, cfg.layers.database_path(cfg.layers.silver))
    size_shuffles(spark, raw("order_items"), raw("orders"), raw("order_payments"))
    lines = silver.order_lines(
        orders=raw("orders"),
        customers=raw("customers"),
        order_items=raw("order_items"),
        payments=raw("order_payments"),
        products=raw("products"),
        translation=raw("product_category_translation"),
    )
    n = refresh_table(lines, cfg.layers.silver, "orders", table_format=cfg.table_format)
    return {"silver.orders": n}


def check_references(spark: SparkSession, cfg: RunConfig) -> dict[str, Verdict]:
    """Whether each table that lines are joined to has its key once; recorded as runs are."""
    verdicts = {}
    for table in REFERENCE_KEYS:
        raw = read_table(spark, cfg.layers.bronze, table)
        size_shuffles(spark, raw)
        verdicts[table] = run_suite(raw, reference_suite(table), f"bronze_{table}", run_name=cfg.run_name)
        record_run(spark, verdicts[table], cfg.layers, cfg.table_format)
    return verdicts


def quarantine_references(spark: SparkSession, cfg: RunConfig, verdicts: dict[str, Verdict]) -> dict[str, int]:
    """Set the rows of repeated keys aside. Silver and gold stay as they are."""
    database, rows = cfg.layers.quarantine, {}
    create_database(spark, database, cfg.layers.database_path(database))
    for table, verdict in verdicts.items():
        if not verdict.success:
            failing = failing_rows(read_table(spark, cfg.layers.bronze, table), reference_suite(table))
            rows[f"quarantine.{table}"] = refresh_table(failing, database, table, table_format=cfg.table_format)
    return rows


def check_quality(spark: SparkSession, cfg: RunConfig) -> Verdict:
    suite = order_line_suite(cfg.first_order_date, cfg.last_order_date, cfg.min_order_amount)
    lines = read_table(spark, cfg.layers.silver, "orders")
    size_shuffles(spark, lines)
    verdict = run_suite(
        lines,
        suite,
        "silver_orders",
        {"customers": read_table(spark, cfg.layers.bronze, "customers")},
        cfg.run_name,
    )
    record_run(spark, verdict, cfg.layers, cfg.table_format)
    return verdict


def build_gold(spark: SparkSession, cfg: RunConfig) -> dict[str, int]:
    lines = read_table(spark, cfg.layers.silver, "orders")
    size_shuffles(spark, lines)
    database = cfg.layers.gold
    create_database(spark, database, cfg.layers.database_path(database))
    rows = {
        "gold.daily_revenue_by_category": refresh_table(
            gold.daily_revenue_by_category(lines, ordered=False),
            database,
            "daily_revenue_by_category",
            table_format=cfg.table_format,
            cluster_by=("order_date", "product_category_name_english"),
        )
    }
    # Two tables are made from the order grain; blocks lost with an executor are
    # computed again from the silver table.
    orders = gold.order_grain(lines).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows["gold.top10_customers_ltv"] = refresh_table(
            gold.top_customers(orders, cfg.top_customers),
            database,
            "top10_customers_ltv",
            table_format=cfg.table_format,
            compact=True,
        )
        rows["gold.rolling_7day_order_volume"] = refresh_table(
            gold.rolling_order_volume(orders),
            database,
            "rolling_7day_order_volume",
            table_format=cfg.table_format,
            cluster_by=("order_date",),
        )
    finally:
        orders.unpersist()
    return rows


def quarantine(spark: SparkSession, cfg: RunConfig) -> dict[str, int]:
    """Set the failing order lines aside. Silver and the gold tables stay as they are."""
    suite = order_line_suite(cfg.first_order_date, cfg.last_order_date, cfg.min_order_amount)
    database = cfg.layers.quarantine
    create_database(spark, database, cfg.layers.database_path(database))
    lines = read_table(spark, cfg.layers.silver, "orders")
    size_shuffles(spark, lines)
    failing = failing_rows(
        lines,
        suite,
        {"customers": read_table(spark, cfg.layers.bronze, "customers")},
    )
    return {
        "quarantine.orders": refresh_table(failing, database, "orders", table_format=cfg.table_format)
    }


def run_stages(spark: SparkSession, cfg: RunConfig) -> StagedRun:
    """All stages. Gold is built only on an explicit success; either branch ends
    in the same summary. With ``unique_references`` a repeated key of a joined table ends
    the run in quarantine before anything is joined to it."""
    rows = ingest_bronze(spark, cfg)
    if cfg.unique_references:
        verdicts = check_references(spark, cfg)
        broken = [v for v in verdicts.values() if not v.success]
        if broken:
            rows.update(quarantine_references(spark, cfg, verdicts))
            return StagedRun("quarantine", broken[0], rows)
    rows.update(transform_silver(spark, cfg))
    verdict = check_quality(spark, cfg)
    branch = "gold" if verdict.success is True else "quarantine"
    rows.update(build_gold(spark, cfg) if branch == "gold" else quarantine(spark, cfg))
    return StagedRun(branch, verdict, rows)
