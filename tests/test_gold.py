from datetime import date, timedelta

from orderloom.plans import gold

LINE = (
    "order_id string, customer_unique_id string, order_date date, order_amount double,"
    " product_category_name_english string, price double, freight_value double"
)
D = date(2018, 1, 1)


def line(order, customer="u1", day=D, amount=10.0, category="toys", price=4.0, freight=1.0):
    return (order, customer, day, amount, category, price, freight)


def frame(spark, rows):
    return spark.createDataFrame(rows, LINE)


def daily(spark, counts):
    rows = [line(f"o{d}-{i}", day=D + timedelta(days=d)) for d, n in counts.items() for i in range(n)]
    return frame(spark, rows)


def test_revenue_keeps_the_null_category_and_skips_half_known_lines(spark):
    rows = [
        line("o1"),
        line("o2", category=None),
        line("o3", category=None, price=None),
        line("o4", category="food", freight=None),
    ]
    result = [tuple(r) for r in gold.daily_revenue_by_category(frame(spark, rows)).collect()]
    assert result == [(D, None, 5.0), (D, "food", None), (D, "toys", 5.0)]


def test_order_amount_counts_once_per_order(spark):
    orders = gold.order_grain(frame(spark, [line("o1"), line("o1"), line("o2", amount=5.0)]))
    assert orders.count() == 2
    assert [tuple(r) for r in gold.top_customers(orders).collect()] == [("u1", 15.0)]


def test_top_customers_breaks_ties_by_key_and_puts_null_last(spark):
    rows = [line(f"o{i}", customer=f"u{i:02d}", amount=7.0) for i in range(14)]
    rows += [line("x", customer="u99", amount=8.0), line("y", customer="u00x", amount=None)]
    top = gold.top_customers(gold.order_grain(frame(spark, rows))).collect()
    assert [r.customer_unique_id for r in top] == ["u99"] + [f"u{i:02d}" for i in range(9)]
    few = gold.top_customers(gold.order_grain(frame(spark, rows[-2:]))).collect()
    assert [r.customer_unique_id for r in few] == ["u99", "u00x"]


def test_rolling_average_counts_rows_across_date_gaps(spark):
    counts = {0: 7, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 20: 2, 21: 9}
    rows = gold.rolling_order_volume(gold.order_grain(daily(spark, counts))).collect()
    assert [r.order_count for r in rows] == [7, 1, 1, 1, 1, 1, 2, 9]
    averages = [r.rolling_7day_avg_order_volume for r in rows]
    assert averages[0] == 7.0 and averages[1] == 4.0
    assert averages[6] == 14 / 7 and averages[7] == 16 / 7


def test_rolling_average_by_calendar_days_is_opt_in(spark):
    orders = gold.order_grain(daily(spark, {0: 7, 1: 1, 20: 2}))
    rows = gold.rolling_order_volume(orders, calendar_days=True).collect()
    assert [r.rolling_7day_avg_order_volume for r in rows] == [7.0, 4.0, 2.0]


def test_top_customers_plan_has_no_full_sort(spark):
    plan = gold.top_customers(gold.order_grain(frame(spark, [line("o1")])))._jdf.queryExecution().executedPlan()
    assert "TakeOrderedAndProject" in plan.toString()


def test_a_null_date_is_a_day_of_its_own_and_sorts_first(spark):
    rows = [line("o1", day=None), line("o2"), line("o3"), line("o4", day=None)]
    result = gold.rolling_order_volume(gold.order_grain(frame(spark, rows))).collect()
    assert [tuple(r) for r in result] == [(None, 2, 2.0), (D, 2, 2.0)]
    assert gold.daily_revenue_by_category(frame(spark, rows)).collect()[0].order_date is None


def test_fewer_days_than_the_frame(spark):
    rows = gold.rolling_order_volume(gold.order_grain(daily(spark, {0: 3, 1: 4}))).collect()
    assert [r.rolling_7day_avg_order_volume for r in rows] == [3.0, 3.5]
