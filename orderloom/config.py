"""Names and limits that callers may change. Nothing here touches Spark."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# The nine raw datasets, by the table each one becomes.
RAW_TABLES = (
    "orders",
    "customers",
    "products",
    "order_items",
    "order_payments",
    "order_reviews",
    "sellers",
    "geolocation",
    "product_category_translation",
)

# Quality limits of the order-line table and the stream threshold.
FIRST_ORDER_DATE = date(2016, 1, 1)
LAST_ORDER_DATE = date(2018, 12, 31)
HIGH_VALUE_THRESHOLD = 50
IDLE_SECONDS = 15.0
TOP_CUSTOMERS = 10
ROLLING_ROWS = 7


@dataclass(frozen=True)
class RawDataset:
    """One raw CSV input.

    Without ``schema`` Spark infers the types, which reads the input twice; give
    one for large inputs. ``multi_line`` keeps quoted line breaks together but
    makes a file unsplittable, so set it only where text needs it.
    """

    table: str
    file_name: str
    schema: str | None = None
    multi_line: bool = False
    options: dict[str, str] = field(default_factory=dict)


def raw_datasets(
    pattern: str = "{table}.csv",
    *,
    files: dict[str, str] | None = None,
    schemas: dict[str, str] | None = None,
    multi_line: tuple[str, ...] = (),
) -> tuple[RawDataset, ...]:
    """The nine datasets, with file names made from ``pattern`` unless ``files``
    names one for a table."""
    files, schemas = files or {}, schemas or {}
    return tuple(
        RawDataset(
            table=table,
            file_name=files.get(table, pattern.format(table=table)),
            schema=schemas.get(table),
            multi_line=table in multi_line,
        )
        for table in RAW_TABLES
    )


@dataclass(frozen=True)
class Layers:
    """Database names. ``location`` is a shared folder under which each database
    gets its own directory; without it the session's warehouse is used."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    quality: str = "quality"
    quarantine: str = "quarantine"
    location: str | None = None

    @classmethod
    def with_suffix(cls, suffix: str, location: str | None = None) -> "Layers":
        return cls(
            *(f"{n}_{suffix}" for n in ("bronze", "silver", "gold", "quality", "quarantine")),
            location=location,
        )

    def database_path(self, database: str) -> str | None:
        return None if self.location is None else f"{self.location}/{database}"


@dataclass(frozen=True)
class RunConfig:
    """One run. ``rejects`` and ``unique_references`` are off by default: then spoiled fields
    become NULL and repeated references fan out, as plain scans and joins do."""

    raw_root: str
    datasets: tuple[RawDataset, ...] = field(default_factory=raw_datasets)
    layers: Layers = field(default_factory=Layers)
    table_format: str = "parquet"
    first_order_date: date = FIRST_ORDER_DATE
    last_order_date: date = LAST_ORDER_DATE
    min_order_amount: float = 0
    top_customers: int = TOP_CUSTOMERS
    run_name: str = "order_run"
    rejects: bool = False
    unique_references: bool = False
