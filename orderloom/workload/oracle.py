"""SQL counterpart of each registered query, over the same tables."""

from __future__ import annotations

_CTES = {
    "src_orders": (
        "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,"
        " o_orderdate AS order_purchase_timestamp FROM orders"
    ),
    "src_dirty": (
        "SELECT * FROM src_orders"
        " UNION ALL SELECT * FROM src_orders WHERE order_id % 10 = 0"
        " UNION ALL SELECT order_id, CAST(NULL AS BIGINT), order_status, order_purchase_timestamp"
        " FROM src_orders WHERE order_id % 97 = 0"
    ),
    "src_customers": (
        "SELECT c_custkey AS customer_id, concat(c_nationkey, '-', c_mktsegment) AS customer_unique_id"
        " FROM customer"
    ),
    "src_doubled": (
        "SELECT * FROM src_customers UNION ALL SELECT customer_id, 'moved' FROM src_customers WHERE customer_id % 25 = 0"
        " UNION ALL SELECT NULL, customer_unique_id FROM src_customers WHERE customer_id % 60 = 1"
    ),
    "src_gapped": "SELECT * FROM src_customers WHERE customer_id % 50 <> 0",
    "src_items": (
        "SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,"
        " CAST(l_extendedprice AS DECIMAL(12,2)) AS price,"
        " CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))"
        " AS DECIMAL(18,4)) AS freight_value FROM lineitem"
    ),
    "src_payments": (
        "SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) *"
        " (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))"
        " AS payment_value FROM lineitem WHERE l_returnflag <> 'R'"
    ),
    "src_products": "SELECT p_partkey AS product_id, p_type AS product_category_name FROM part",
    "src_translation": (
        "SELECT DISTINCT p_type AS product_category_name,"
        " concat(upper(substr(p_type, 1, 1)), lower(substr(p_type, 2))) AS product_category_name_english"
        " FROM part WHERE p_type <> 'PROMO'"
    ),
    "clean": (
        "SELECT DISTINCT order_id, customer_id, order_status,"
        " CAST(order_purchase_timestamp AS DATE) AS order_date FROM src_dirty"
        " WHERE order_id IS NOT NULL AND customer_id IS NOT NULL"
    ),
    "amounts": "SELECT order_id, sum(payment_value) AS order_amount FROM src_payments GROUP BY order_id",
    "translated": (
        "SELECT p.product_id, p.product_category_name, t.product_category_name_english"
        " FROM src_products p LEFT JOIN src_translation t"
        " ON p.product_category_name = t.product_category_name"
    ),
    "silver": (
        "SELECT i.order_id, i.product_id, o.customer_id, i.price, i.freight_value, o.order_status,"
        " o.order_date, c.customer_unique_id, p.product_category_name, p.product_category_name_english,"
        " a.order_amount FROM src_items i"
        " JOIN clean o ON i.order_id = o.order_id"
        " JOIN src_customers c ON o.customer_id = c.customer_id"
        " LEFT JOIN translated p ON i.product_id = p.product_id"
        " JOIN amounts a ON i.order_id = a.order_id"
    ),
    "grain": (
        "SELECT DISTINCT order_id, customer_unique_id, order_date, order_amount FROM silver"
    ),
    "daily": "SELECT order_date, count(*) AS order_count FROM grain GROUP BY order_date",
    "revenue": (
        "SELECT order_date, product_category_name_english, sum(price + freight_value) AS revenue"
        " FROM silver GROUP BY order_date, product_category_name_english"
    ),
    "src_events": (
        "SELECT concat('cust_', user_id) AS customer_id, concat('prod_', event_id) AS product_id,"
        " round(value, 2) AS order_amount, event_id,"
        " concat(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '+00:00') AS \"timestamp\" FROM events"
    ),
}

_SILVER_OUT = (
    "order_id, product_id, customer_id, CAST(price AS DOUBLE) AS price,"
    " CAST(freight_value AS DOUBLE) AS freight_value, order_status, order_date, customer_unique_id,"
    " product_category_name, product_category_name_english, CAST(order_amount AS DOUBLE) AS order_amount"
)
_EVENT_OUT = 'customer_id, product_id, order_amount, "timestamp"'
_NARROW = "order_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"
_WIDE = "order_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'"


def _sql(body: str) -> str:
    ctes = ", ".join(f"{name} AS ({text})" for name, text in _CTES.items())
    return f"WITH {ctes} {body}"


def _rule(suite: str, asset: str, no: int, rule: str, column: str, detail: str, frame: str, broken: str) -> str:
    return (
        f"SELECT '{suite}' AS suite, '{asset}' AS asset, {no} AS rule_no, '{rule}' AS rule,"
        f" '{column}' AS \"column\", '{detail}' AS detail, count(*) AS element_count,"
        f" count(*) FILTER (WHERE {broken}) AS unexpected_count,"
        f" count(*) FILTER (WHERE {broken}) = 0 AS success FROM {frame}"
    )


def _not_in(customers: str) -> str:
    return f"customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM {customers})"


def _fails(inside: str) -> str:
    """Whether a line breaks a rule of the suite."""
    return (
        f"(order_id IS NULL OR customer_id IS NULL OR order_amount <= 0 OR NOT ({inside})"
        f" OR {_not_in('src_customers')})"
    )


def _repeated(keys: str, frame: str) -> str:
    """Keys without NULL that several rows share."""
    present = " AND ".join(f"{key} IS NOT NULL" for key in keys.split(", "))
    return f"SELECT {keys} FROM {frame} WHERE {present} GROUP BY {keys} HAVING count(*) > 1"


def _counts(pairs: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {frame}" for name, frame in pairs)


_RAW_FRAMES = [
    ("orders", "src_orders"),
    ("customers", "src_customers"),
    ("products", "src_products"),
    ("order_items", "src_items"),
    ("order_payments", "src_payments"),
    ("order_reviews", "conversations"),
    ("sellers", "supplier"),
    ("geolocation", "nation"),
    ("product_category_translation", "src_translation"),
]

# The columns each ingested table has.
_CATALOG = {
    "orders": "order_id, customer_id, order_status, order_purchase_timestamp",
    "customers": "customer_id, customer_unique_id",
    "products": "product_id, product_category_name",
    "order_items": "order_id, order_item_id, product_id, price, freight_value",
    "order_payments": "order_id, payment_sequential, payment_value",
    "order_reviews": "conv_id, turn, role, text",
    "sellers": "s_suppkey, s_name, s_nationkey, s_acctbal",
    "geolocation": "n_nationkey, n_name, n_regionkey",
    "product_category_translation": "product_category_name, product_category_name_english",
}


def _catalog() -> str:
    """Each column with the type that the given tables have for it, in Spark's words. Money is
    exact in the SQL and double in the raw files."""
    frames = dict(_RAW_FRAMES)
    rows = []
    for table, columns in _CATALOG.items():
        names = columns.split(", ")
        listed = ", ".join(f"any_value(typeof({name}))" for name in names)
        quoted = ", ".join(f"'{name}'" for name in names)
        rows.append(
            f"SELECT '{table}' AS table_name, unnest([{quoted}]) AS column_name, unnest([{listed}]) AS kind"
            f" FROM {frames[table]}"
        )
        for name, kind in (("ingestion_timestamp", "TIMESTAMP"), ("source_file", "VARCHAR")):
            rows.append(f"SELECT '{table}', '{name}', '{kind}'")
    return (
        "SELECT table_name, column_name, CASE WHEN kind LIKE 'DECIMAL%' THEN 'double' WHEN kind = 'VARCHAR' THEN 'string'"
        " WHEN kind = 'INTEGER' THEN 'int' ELSE lower(kind) END AS data_type"
        " FROM (" + " UNION ALL ".join(rows) + ") t"
    )


def _staged(inside: str) -> str:
    """The tables of a whole run. Whether it succeeds, which branch it takes and so which
    tables it writes follow from the rules on the lines."""
    always = [(f"bronze.{name}", frame) for name, frame in _RAW_FRAMES] + [("silver.orders", "silver")]
    in_gold = [
        ("gold.daily_revenue_by_category", "revenue"),
        ("gold.top10_customers_ltv", f"({_TOP}) top"),
        ("gold.rolling_7day_order_volume", "daily"),
    ]
    in_quarantine = [("quarantine.orders", f"(SELECT * FROM silver WHERE {_fails(inside)}) bad")]
    return (
        f"SELECT table_name, row_count, CASE WHEN success THEN 'gold' ELSE 'quarantine' END AS branch, success FROM"
        f" (SELECT count(*) FILTER (WHERE {_fails(inside)}) = 0 AS success FROM silver) v,"
        f" (SELECT *, NULL AS needed FROM ({_counts(always)}) a UNION ALL SELECT *, true FROM ({_counts(in_gold)}) g"
        f" UNION ALL SELECT *, false FROM ({_counts(in_quarantine)}) q) t WHERE needed IS NULL OR needed = success"
    )


_BROKEN = (
    "CASE WHEN order_amount <= 5000 THEN 'between:order_amount' END",
    f"CASE WHEN NOT ({_NARROW}) THEN 'between:order_date' END",
    f"CASE WHEN {_not_in('src_gapped')} THEN 'in_reference:customer_id' END",
)
_TOP = (
    "SELECT customer_unique_id, CAST(sum(order_amount) AS DOUBLE) AS lifetime_value FROM grain"
    " GROUP BY customer_unique_id ORDER BY sum(order_amount) DESC, customer_unique_id LIMIT 10"
)
_LANDED = f"SELECT {_EVENT_OUT} FROM src_events WHERE order_amount > 50"

_SUITE = ("silver_orders_suite", "silver_orders")
_RAW_SUITE = ("raw_orders_suite", "bronze_orders")

_BODIES = {
    "bronze_orders": (
        "SELECT order_id, customer_id, order_status, CAST(order_purchase_timestamp AS DATE) AS order_date,"
        " true AS has_time, true AS has_source FROM src_orders"
    ),
    "bronze_row_counts": _counts(_RAW_FRAMES),
    "catalog_columns": _catalog(),
    "table_roundtrip": (
        "SELECT order_id, customer_id, order_status, CAST(order_purchase_timestamp AS DATE) AS order_date"
        " FROM src_orders"
    ),
    "table_clustered": (
        "SELECT order_id, customer_id, order_status, CAST(order_purchase_timestamp AS DATE) AS order_date"
        " FROM src_orders"
    ),
    "orders_clean": "SELECT order_id, customer_id, order_status, order_date FROM clean",
    "order_amount": "SELECT order_id, CAST(order_amount AS DOUBLE) AS order_amount FROM amounts",
    "order_amount_fine": (
        "SELECT order_id, CAST(order_amount * CAST(0.001 AS DECIMAL(4,3)) AS DOUBLE) AS order_amount FROM amounts"
    ),
    "products_translated": (
        "SELECT product_id, product_category_name, product_category_name_english FROM translated"
    ),
    "silver_orders": f"SELECT {_SILVER_OUT} FROM silver",
    "silver_preview": (
        f"SELECT {_SILVER_OUT} FROM silver s"
        " ORDER BY s.order_id, s.product_id, s.price, s.freight_value LIMIT 10"
    ),
    "orders_order_grain": (
        "SELECT order_id, customer_unique_id, order_date, CAST(order_amount AS DOUBLE) AS order_amount FROM grain"
    ),
    "daily_revenue_by_category": (
        "SELECT order_date, product_category_name_english, CAST(revenue AS DOUBLE) AS revenue FROM revenue"
    ),
    "top10_customers_ltv": _TOP,
    "rolling_7day_order_volume": (
        "SELECT order_date, order_count, avg(order_count) OVER"
        " (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
        " AS rolling_7day_avg_order_volume FROM daily"
    ),
    "dq_results": " UNION ALL ".join(
        (
            _rule(*_SUITE, 1, "not_null", "order_id", "", "silver", "order_id IS NULL"),
            _rule(*_SUITE, 2, "not_null", "customer_id", "", "silver", "customer_id IS NULL"),
            _rule(*_SUITE, 3, "between", "order_amount", "> 0", "silver", "order_amount <= 0"),
            _rule(
                *_SUITE, 4, "between", "order_date", ">= 1996-01-01 and <= 1998-12-31", "silver", f"NOT ({_NARROW})"
            ),
            _rule(
                *_SUITE, 5, "in_reference", "customer_id", "customers.customer_id", "silver", _not_in("src_customers")
            ),
        )
    ),
    "dq_results_raw_orders": " UNION ALL ".join(
        (
            _rule(*_RAW_SUITE, 1, "not_null", "order_id", "", "src_dirty", "order_id IS NULL"),
            _rule(*_RAW_SUITE, 2, "not_null", "customer_id", "", "src_dirty", "customer_id IS NULL"),
            _rule(
                *_RAW_SUITE, 3, "in_reference", "customer_id", "customers.customer_id", "src_dirty", _not_in("src_gapped")
            ),
        )
    ),
    "dq_gate": " UNION ALL ".join(
        f"SELECT '{name}' AS bounds, count(*) FILTER (WHERE order_amount <= 0 OR NOT ({inside})"
        f" OR {_not_in('src_customers')}) = 0 AS success FROM silver"
        for name, inside in (("narrow", _NARROW), ("wide", _WIDE))
    ),
    "dq_runs": " UNION ALL ".join(
        f"SELECT 'until {last}' AS run_name, 'orders' AS asset, 'order_dates' AS suite,"
        f" count(*) FILTER (WHERE NOT ({inside})) = 0 AS success FROM clean"
        for last, inside in (("1998-12-31", _NARROW), ("2001-12-31", _WIDE))
    ),
    "dq_orphan_customers": (
        "SELECT customer_id, count(*) AS row_count FROM clean o WHERE NOT EXISTS"
        " (SELECT 1 FROM src_gapped c WHERE c.customer_id = o.customer_id) GROUP BY customer_id"
    ),
    "quarantine_rows": (
        f"SELECT * FROM (SELECT {_SILVER_OUT}, concat_ws(',', {', '.join(_BROKEN)}) AS broken_rules"
        " FROM silver) t WHERE broken_rules <> ''"
    ),
    "order_events_json": f"SELECT {_EVENT_OUT} FROM src_events",
    "stream_high_value_orders": _LANDED,
    "stream_landing_readback": (
        "SELECT customer_id, count(*) AS order_count,"
        " CAST(sum(CAST(order_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount"
        " FROM src_events WHERE order_amount > 50 GROUP BY customer_id"
    ),
    "stream_two_sinks": (
        f"SELECT l.*, s.sink, count(*) OVER () // 2 AS matched, CAST(0 AS BIGINT) AS rejected FROM ({_LANDED}) l"
        " CROSS JOIN (VALUES ('landing'), ('console')) s(sink)"
    ),
    "stream_restart": _LANDED,
    "stream_bad_records": (
        "SELECT product_id, CASE WHEN event_id % 50 = 0 THEN 'malformed'"
        " WHEN event_id % 51 = 0 THEN 'no amount' ELSE 'kept' END AS reason FROM src_events"
        " WHERE event_id % 50 = 0 OR event_id % 51 = 0 OR order_amount > 50"
    ),
    "staged_run_gold": _staged(_WIDE),
    "staged_run_quarantine": _staged(_NARROW),
    "staged_gold_tables": (
        "SELECT 'daily_revenue_by_category' AS table_name, order_date, product_category_name_english AS label,"
        " CAST(revenue AS DOUBLE) AS value FROM revenue"
        f" UNION ALL SELECT 'top10_customers_ltv', NULL, customer_unique_id, lifetime_value FROM ({_TOP}) top"
        " UNION ALL SELECT 'rolling_7day_order_volume', order_date, NULL, avg(order_count) OVER"
        " (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) FROM daily"
    ),
    "staged_quarantined_lines": (
        f"SELECT {_SILVER_OUT}, 'between:order_date' AS broken_rules FROM silver WHERE NOT ({_NARROW})"
    ),
    "staged_run_fanout": (
        "SELECT table_name, row_count, CASE WHEN success THEN 'gold' ELSE 'quarantine' END AS branch, success FROM"
        f" (SELECT count(*) = 0 AS success FROM ({_repeated('customer_id', 'src_doubled')})) v,"
        f" ({_counts([(f'bronze.{n}', 'src_doubled' if n == 'customers' else f) for n, f in _RAW_FRAMES])}"
        " UNION ALL SELECT 'quarantine.customers', count(*) FROM src_doubled"
        f" WHERE customer_id IN ({_repeated('customer_id', 'src_doubled')})) t"
    ),
    "bronze_rejects": (
        "SELECT order_id, CASE WHEN line IS NULL THEN customer_id END AS customer_id,"
        " CASE WHEN line IS NULL THEN order_status END AS order_status,"
        " CASE WHEN line IS NULL THEN CAST(order_purchase_timestamp AS DATE) END AS order_date, line AS rejected_line,"
        " count(*) FILTER (WHERE line IS NULL) OVER () AS kept, count(line) OVER () AS rejected FROM"
        " (SELECT *, CASE WHEN order_id % 50 = 0 THEN concat(order_id, ',', customer_id)"
        " WHEN order_id % 51 = 0 THEN concat(order_id, ',', customer_id, ',', order_status, ',', day, ',more')"
        " WHEN order_id % 53 = 0 THEN concat(order_id, ',nobody,', order_status, ',', day) END AS line FROM"
        " (SELECT *, strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') AS day FROM src_orders))"
    ),
    "table_appended": (
        "SELECT order_status, count(*) AS order_count, count(DISTINCT order_id) AS distinct_orders,"
        " min(CAST(order_purchase_timestamp AS DATE)) AS first_date, max(CAST(order_purchase_timestamp AS DATE)) AS last_date"
        " FROM src_orders GROUP BY order_status"
    ),
    "table_reclustered": (
        "SELECT order_id, customer_id, order_status, CAST(order_purchase_timestamp AS DATE) AS order_date,"
        " CAST(0 AS BIGINT) AS rewritten_again FROM src_orders"
    ),
    "dq_unique": " UNION ALL ".join(
        (
            _rule("customers_suite", "bronze_customers", 1, "not_null", "customer_id", "", "src_doubled", "customer_id IS NULL"),
            _rule(
                "customers_suite", "bronze_customers", 2, "unique", "customer_id", "", "src_doubled",
                f"customer_id IN ({_repeated('customer_id', 'src_doubled')})",
            ),
            _rule(
                "items_suite", "bronze_order_items", 1, "unique", "order_id,order_item_id", "", "src_items",
                f"(order_id, order_item_id) IN ({_repeated('order_id, order_item_id', 'src_items')})",
            ),
            _rule(
                "items_suite", "bronze_order_items", 2, "unique", "order_id,order_item_id,product_id,price", "", "src_items",
                f"(order_id, order_item_id, product_id, price) IN"
                f" ({_repeated('order_id, order_item_id, product_id, price', 'src_items')})",
            ),
            _rule("items_suite", "bronze_order_items", 3, "not_null", "price", "", "src_items", "price IS NULL"),
        )
    ),
    "dq_unique_failing": (
        "SELECT customer_id, customer_unique_id, 'unique:customer_id' AS broken_rules FROM src_doubled"
        f" WHERE customer_id IN ({_repeated('customer_id', 'src_doubled')})"
    ),
    "dq_repeated_lines": (
        "SELECT order_id, order_item_id, count(*) AS row_count FROM src_items GROUP BY ALL HAVING count(*) > 1"
    ),
    "dq_references": " UNION ALL ".join(
        _rule("lines_suite", "silver_orders", nr, rule, column, detail, "silver", broken)
        for nr, (rule, column, detail, broken) in enumerate(
            (
                ("in_reference", "customer_id", "customers.customer_id", _not_in("src_gapped")),
                ("between", "order_date", ">= 1996-01-01 and <= 1998-12-31", f"NOT ({_NARROW})"),
                ("in_reference", "product_id", "products.product_id",
                 "product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM src_products WHERE product_id % 40 <> 0)"),
                ("in_reference", "order_id", "paid.paid_order", "order_id NOT IN (SELECT order_id FROM src_payments)"),
                ("unique", "order_id,product_id", "", f"(order_id, product_id) IN ({_repeated('order_id, product_id', 'silver')})"),
            ),
            1,
        )
    ),
    "stream_totals": (
        "SELECT customer_id, count(*) AS landed, any_value(matched) AS matched, any_value(rejected) AS rejected FROM"
        " (SELECT *, count(*) FILTER (WHERE good) OVER () AS matched, count(*) FILTER (WHERE bad) OVER () AS rejected FROM"
        " (SELECT *, event_id % 50 = 0 OR event_id % 51 = 0 AS bad, NOT bad AND order_amount > 50 AS good FROM src_events))"
        " WHERE good GROUP BY customer_id"
    ),
    "stream_compacted": (
        "SELECT product_id, output FROM (SELECT *, event_id % 50 = 0 OR event_id % 51 = 0 AS bad FROM src_events),"
        " (VALUES ('landing'), ('console'), ('dead')) o(output)"
        " WHERE CASE WHEN output = 'dead' THEN bad ELSE NOT bad AND order_amount > 50 END"
    ),
}

ORACLE_SQL = {name: _sql(body) for name, body in _BODIES.items()}
