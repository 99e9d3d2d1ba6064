"""The given tables, seen as the raw order datasets.

Money is double here, as raw files give it. A product is taken over whole cents
and whole percents, so its four decimals are exact; the SQL in ``oracle.py`` gets
the same values from decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.sizing import size_shuffles


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; shuffles are sized for it, whatever query reads it."""
    given = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    size_shuffles(spark, given)
    return given


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "o_orderstatus AS order_status",
        "o_orderdate AS order_purchase_timestamp",
    )


def damaged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, plus exact copies of some and copies of others that lost their
    customer."""
    whole = orders(spark, sf_dir)
    copies = whole.where("order_id % 10 = 0")
    without_customer = whole.where("order_id % 97 = 0").withColumn(
        "customer_id", F.lit(None).cast("bigint")
    )
    return whole.unionByName(copies).unionByName(without_customer)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_id",
        "concat(c_nationkey, '-', c_mktsegment) AS customer_unique_id",
    )


def customers_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer list that lost some customers, so that orders refer to unknown ones."""
    return customers(spark, sf_dir).where("customer_id % 50 <> 0")


def doubled_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer list in which some customers occur twice, and one has lost its key twice."""
    whole = customers(spark, sf_dir)
    twice = whole.where("customer_id % 25 = 0").withColumn("customer_unique_id", F.lit("moved"))
    keyless = whole.where("customer_id % 60 = 1").withColumn("customer_id", F.lit(None).cast("bigint"))
    return whole.unionByName(twice).unionByName(keyless)


def products_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(spark, sf_dir).where("product_id % 40 <> 0")


def paid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order numbers as text, as another system might list them."""
    return order_payments(spark, sf_dir).selectExpr("CAST(order_id AS STRING) AS paid_order")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_extendedprice AS price",
        "rint(l_extendedprice * 100) * rint(l_tax * 100) / 10000 AS freight_value",
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines were not paid, so some orders have no payment at all."""
    return (
        table(spark, sf_dir, "lineitem")
        .where("l_returnflag <> 'R'")
        .selectExpr(
            "l_orderkey AS order_id",
            "l_linenumber AS payment_sequential",
            "rint(l_extendedprice * 100) * (100 - rint(l_discount * 100)) / 10000 AS payment_value",
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id", "p_type AS product_category_name"
    )


def translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name per category that occurs; PROMO is left out, so some products have none."""
    return (
        table(spark, sf_dir, "part")
        .where("p_type <> 'PROMO'")
        .select(F.col("p_type").alias("product_category_name"))
        .distinct()
        .withColumn("product_category_name_english", F.initcap("product_category_name"))
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier")


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation")


RAW = {
    "orders": orders,
    "customers": customers,
    "products": products,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": reviews,
    "sellers": sellers,
    "geolocation": geolocation,
    "product_category_translation": translation,
}

RAW_SCHEMAS = {
    "orders": "order_id bigint, customer_id bigint, order_status string, order_purchase_timestamp timestamp",
    "customers": "customer_id bigint, customer_unique_id string",
    "products": "product_id bigint, product_category_name string",
    "order_items": "order_id bigint, order_item_id int, product_id bigint,"
    " price double, freight_value double",
    "order_payments": "order_id bigint, payment_sequential int, payment_value double",
    "order_reviews": "conv_id bigint, turn bigint, role string, text string",
    "sellers": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "geolocation": "n_nationkey int, n_name string, n_regionkey int",
    "product_category_translation": "product_category_name string, product_category_name_english string",
}


def damaged_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as lines of CSV text without a header; some lack fields, some have one
    too many, and some have text where a number belongs."""
    fields = ("order_id", "customer_id", "order_status", F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss"))
    whole = F.concat_ws(",", *fields)
    return orders(spark, sf_dir).select(
        F.when(F.col("order_id") % 50 == 0, F.concat_ws(",", *fields[:2]))
        .when(F.col("order_id") % 51 == 0, F.concat(whole, F.lit(",more")))
        .when(F.col("order_id") % 53 == 0, F.concat_ws(",", "order_id", F.lit("nobody"), *fields[2:]))
        .otherwise(whole)
        .alias("value")
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table with the fields of an order event; times are UTC."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('cust_', user_id) AS customer_id",
        "concat('prod_', event_id) AS product_id",
        "value AS order_amount",
        "ts AS event_time",
    )
