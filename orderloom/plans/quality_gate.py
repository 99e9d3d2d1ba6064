"""The quality suite of the order lines, its run record and its verdict."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession

from orderloom.config import FIRST_ORDER_DATE, LAST_ORDER_DATE, Layers
from orderloom.operators.quality import Between, InReference, NotNull, References, Suite, Unique, evaluate
from orderloom.sinks.tables import append_table, create_database

RUN_SCHEMA = (
    "run_time timestamp, run_name string, asset string, batch_id string, suite string, success boolean"
)


def order_line_suite(
    first: date = FIRST_ORDER_DATE,
    last: date = LAST_ORDER_DATE,
    min_amount: float = 0,
) -> Suite:
    return Suite(
        "silver_orders_suite",
        (
            NotNull("order_id"),
            NotNull("customer_id"),
            Between("order_amount", low=min_amount, strict_low=True),
            Between("order_date", low=first, high=last),
            InReference("customer_id", "customers", "customer_id"),
        ),
    )


# The keys by which orders and lines meet other raw tables.
REFERENCE_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "product_category_translation": "product_category_name",
}


def reference_suite(table: str) -> Suite:
    """The key of a raw table that others are joined to occurs once."""
    return Suite(f"{table}_suite", (Unique(REFERENCE_KEYS[table]),))


@dataclass(frozen=True)
class Verdict:
    """Outcome of one suite run. ``results`` holds one row per rule."""

    success: bool
    results: tuple[Row, ...]
    run_time: datetime
    run_name: str
    asset: str
    batch_id: str
    suite: str

    def results_frame(self, spark: SparkSession) -> DataFrame:
        schema = (
            "suite string, asset string, rule_no int, rule string, column string, detail string, "
            "element_count long, unexpected_count long, success boolean"
        )
        return spark.createDataFrame(list(self.results), schema)

    def run_frame(self, spark: SparkSession) -> DataFrame:
        row = (self.run_time, self.run_name, self.asset, self.batch_id, self.suite, self.success)
        return spark.createDataFrame([row], RUN_SCHEMA)

    def to_json(self) -> str:
        return json.dumps({"success": self.success})


def run_suite(
    df: DataFrame,
    suite: Suite,
    asset: str,
    references: References | None = None,
    run_name: str = "order_run",
) -> Verdict:
    """Evaluate a suite. Only its rule rows come to the driver, never table rows.
    A suite that yields no result has not succeeded."""
    rows = tuple(evaluate(df, suite, asset, references).collect())
    return Verdict(
        success=bool(rows) and all(row["success"] for row in rows),
        results=rows,
        run_time=datetime.now(timezone.utc),
        run_name=run_name,
        asset=asset,
        batch_id=uuid.uuid4().hex,
        suite=suite.name,
    )


def record_run(spark: SparkSession, verdict: Verdict, layers: Layers, table_format: str = "parquet") -> None:
    """Append the run to the list of runs, and its rule results to theirs."""
    create_database(spark, layers.quality, layers.database_path(layers.quality))
    append_table(verdict.run_frame(spark).coalesce(1), layers.quality, "runs", table_format)
    append_table(verdict.results_frame(spark).coalesce(1), layers.quality, "results", table_format)
