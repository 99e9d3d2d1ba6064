import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from orderloom.config import Layers, RAW_TABLES, RawDataset, RunConfig, raw_datasets
from orderloom.plans import bronze
from orderloom.plans.staged_run import run_stages
from orderloom.session import scratch_path
from orderloom.sinks import append_table, create_database, refresh_table
from orderloom.sources import list_columns, preview, read_raw_csv, read_table


@pytest.fixture
def layers(spark, request):
    name = "".join(c if c.isalnum() else "_" for c in request.node.name)
    made = Layers.with_suffix(name.lower(), scratch_path(spark, "layers"))
    create_database(spark, made.gold, made.database_path(made.gold))
    return made


def test_refresh_replaces_rows_and_schema(spark, layers):
    assert refresh_table(spark.range(5), layers.gold, "t") == 5
    assert refresh_table(spark.range(3).selectExpr("id AS n", "'x' AS name"), layers.gold, "t") == 3
    assert refresh_table(spark.range(3).selectExpr("id AS n", "'x' AS name"), layers.gold, "t") == 3
    table = read_table(spark, layers.gold, "t")
    assert table.columns == ["n", "name"] and table.count() == 3


def test_refresh_counts_an_empty_table(spark, layers):
    assert refresh_table(spark.range(0), layers.gold, "t") == 0
    assert refresh_table(spark.range(0), layers.gold, "t", cluster_by=("id",)) == 0


def test_other_formats_are_counted_too(spark, layers):
    assert refresh_table(spark.range(5), layers.gold, "t", table_format="orc") == 5
    assert refresh_table(spark.range(4).selectExpr("id AS n"), layers.gold, "t", table_format="orc", compact=True) == 4
    assert read_table(spark, layers.gold, "t").columns == ["n"]


def test_append(spark, layers):
    append_table(spark.range(2), layers.gold, "t")
    append_table(spark.range(3), layers.gold, "t")
    assert read_table(spark, layers.gold, "t").count() == 5


def file_ranges(spark, layers, table, column):
    ranges = []
    for path in read_table(spark, layers.gold, table).inputFiles():
        column_data = pq.read_table(path.removeprefix("file://").removeprefix("file:"), columns=[column])[column]
        values = column_data.to_pylist()
        if values:
            ranges.append((min(values), max(values), len(values)))
    return sorted(ranges)


def test_clustered_files_have_ordered_ranges(spark, layers):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        days = spark.range(4000).selectExpr("date_add(DATE '2018-01-01', CAST(id % 365 AS INT)) AS order_date", "id")
        refresh_table(days.repartition(7), layers.gold, "t", cluster_by=("order_date",))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ranges = file_ranges(spark, layers, "t", "order_date")
    assert len(ranges) > 1
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_clustering_splits_one_hot_day_even_among_equal_rows(spark, layers):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(20000, numPartitions=16).selectExpr(
            "CASE WHEN id % 3 > 0 THEN DATE '2018-06-01' ELSE date_add(DATE '2018-01-01', CAST(id % 300 AS INT)) END"
            " AS order_date"
        )
        refresh_table(rows, layers.gold, "t", cluster_by=("order_date",))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ranges = file_ranges(spark, layers, "t", "order_date")
    hot = datetime.date(2018, 6, 1)
    assert sum(1 for low, high, _ in ranges if low <= hot <= high) > 1
    assert max(n for *_, n in ranges) < 20000 * 0.6


def test_small_clustered_table_is_one_file(spark, layers):
    refresh_table(spark.range(100).repartition(8), layers.gold, "t", cluster_by=("id",))
    assert len(file_ranges(spark, layers, "t", "id")) == 1
    refresh_table(spark.range(100).repartition(8), layers.gold, "u", compact=True)
    assert len(file_ranges(spark, layers, "u", "id")) == 1


def test_preview_is_ordered(spark):
    df = spark.range(1000).selectExpr("1000 - id AS n").repartition(5)
    assert [r.n for r in preview(df, ["n"], 3).collect()] == [1, 2, 3]


# ---- raw files


def write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_types_are_inferred_or_declared(spark, tmp_path):
    root = write(tmp_path, "geo.csv", "zip,when,price\n01310,2018-01-02 03:04:05,1.5\n")
    inferred = dict(read_raw_csv(spark, root, RawDataset("geolocation", "geo.csv")).dtypes)
    assert inferred == {"zip": "int", "when": "timestamp", "price": "double"}
    declared = RawDataset("geolocation", "geo.csv", "zip string, when timestamp, price decimal(12,2)")
    assert read_raw_csv(spark, root, declared).collect()[0].zip == "01310"


def test_line_breaks_in_quotes_need_multi_line(spark, tmp_path):
    root = write(tmp_path, "reviews.csv", 'id,text\n1,"two\nlines"\n2,plain\n')
    assert read_raw_csv(spark, root, RawDataset("order_reviews", "reviews.csv")).count() == 3
    whole = read_raw_csv(spark, root, RawDataset("order_reviews", "reviews.csv", multi_line=True))
    assert [r.text for r in whole.collect()] == ["two\nlines", "plain"]


def test_ingestion_adds_audit_columns_and_lists_the_table(spark, tmp_path, layers):
    root = write(tmp_path, "orders.csv", "order_id,customer_id\na,b\nc,d\n")
    counts = bronze.ingest_all(spark, root, (RawDataset("orders", "orders.csv"),), layers)
    assert counts == {"orders": 2}
    table = read_table(spark, layers.bronze, "orders")
    assert table.columns == ["order_id", "customer_id", "ingestion_timestamp", "source_file"]
    assert table.select("ingestion_timestamp").distinct().count() == 1
    assert table.collect()[0].source_file.endswith("/orders.csv")
    listed = [tuple(r) for r in list_columns(spark, layers.bronze).collect()]
    assert ("orders", "ingestion_timestamp", "timestamp") in listed and len(listed) == 4


def test_dataset_names():
    made = raw_datasets("shop_{table}_dataset.csv", files={"product_category_translation": "names.csv"})
    assert [d.table for d in made] == list(RAW_TABLES) and len(made) == 9
    assert made[0].file_name == "shop_orders_dataset.csv" and made[-1].file_name == "names.csv"


# ---- all stages


def raw_folder(tmp_path, amount="5.00"):
    files = {
        "orders": "order_id,customer_id,order_status,order_purchase_timestamp\no1,c1,delivered,2017-02-03 04:05:06\n",
        "customers": "customer_id,customer_unique_id\nc1,u1\n",
        "products": "product_id,product_category_name\np1,jogos\n",
        "order_items": "order_id,product_id,price,freight_value\no1,p1,3.00,1.00\no1,p1,3.00,1.00\n",
        "order_payments": f"order_id,payment_value\no1,{amount}\n",
        "order_reviews": "review_id\nr1\n",
        "sellers": "seller_id\ns1\n",
        "geolocation": "zip\n1\n",
        "product_category_translation": "product_category_name,product_category_name_english\njogos,games\n",
    }
    for name, text in files.items():
        write(tmp_path, f"{name}.csv", text)
    return str(tmp_path)


def test_stages_build_gold_then_quarantine_leaves_it(spark, tmp_path, layers):
    done = run_stages(spark, RunConfig(raw_folder(tmp_path), layers=layers))
    assert done.branch == "gold" and done.rows["silver.orders"] == 2
    top = read_table(spark, layers.gold, "top10_customers_ltv").collect()
    assert [(r.customer_unique_id, float(r.lifetime_value)) for r in top] == [("u1", 5.0)]

    done = run_stages(spark, RunConfig(raw_folder(tmp_path, "-2.00"), layers=layers))
    assert done.branch == "quarantine" and done.rows["quarantine.orders"] == 2
    assert read_table(spark, layers.gold, "top10_customers_ltv").collect() == top
    failing = read_table(spark, layers.quarantine, "orders").select(F.explode("broken_rules").alias("rule"))
    assert {r.rule for r in failing.collect()} == {"between:order_amount"}
    assert read_table(spark, layers.quality, "runs").count() == 2
    assert {r.branch for r in done.summary(spark).collect()} == {"quarantine"}


def test_a_failed_refresh_keeps_the_old_table(spark, layers):
    refresh_table(spark.range(5), layers.gold, "t")
    broken = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("n"))
    with pytest.raises(Exception, match="lost"):
        refresh_table(broken, layers.gold, "t")
    assert sorted(r.id for r in read_table(spark, layers.gold, "t").collect()) == [0, 1, 2, 3, 4]
