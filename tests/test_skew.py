"""The registered queries where a third of the rows share one key."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import connect, duck_table, spark_table

SKEWED = {
    # A third of the lines on one order, another third on one product.
    "lineitem": "SELECT * EXCLUDE (n) REPLACE (CASE WHEN n % 3 = 0 THEN 42 ELSE l_orderkey END AS l_orderkey,"
    " CASE WHEN n % 3 = 1 THEN 11 ELSE l_partkey END AS l_partkey)"
    " FROM (SELECT *, row_number() OVER () AS n FROM lineitem)",
    # A third of the orders by one customer, and copies of one order.
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)"
    " FROM orders UNION ALL SELECT o.* FROM orders o, range(700) WHERE o_orderkey = 43",
    # Copies of one customer and of one product: their lines fan out.
    "customer": "SELECT * FROM customer UNION ALL SELECT c.* FROM customer c, range(60) WHERE c_custkey = 100",
    "part": "SELECT * FROM part UNION ALL SELECT p.* FROM part p, range(60) WHERE p_partkey = 12",
}


@pytest.fixture(scope="module")
def skewed_dir(sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    source = connect(sf_dir)
    for name in ("lineitem", "orders", "customer", "part", "supplier", "nation", "conversations", "events"):
        sql = SKEWED.get(name, f"SELECT * FROM {name}")
        source.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 2048)")
    return str(folder)


@pytest.mark.parametrize(
    "name",
    [
        "orders_clean",
        "order_amount",
        "products_translated",
        "silver_orders",
        "orders_order_grain",
        "daily_revenue_by_category",
        "top10_customers_ltv",
        "rolling_7day_order_volume",
        "dq_results",
        "dq_results_raw_orders",
        "dq_orphan_customers",
        "quarantine_rows",
    ],
)
def test_results_are_whole(shuffled_joins, skewed_dir, name):
    result = spark_table(contract.queries()[name](shuffled_joins, skewed_dir))
    assert result == duck_table(connect(skewed_dir), contract.oracle_sql()[name])


def test_lines_are_spread_evenly(shuffled_joins, skewed_dir):
    spark = shuffled_joins
    changed = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.files.maxPartitionBytes": "32k",
        "spark.sql.files.openCostInBytes": "0",
    }
    before = {key: spark.conf.get(key) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        lines = contract.queries()["silver_orders"](spark, skewed_dir)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sizes = [r["count"] for r in lines.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2.5 * sum(sizes) / 8
