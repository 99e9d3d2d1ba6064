import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import spark_table
from orderloom.operators.joins import SKETCH_GROUPS, hot_keys, spread_join


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def left_frame(spark, hot="k7", n=3000):
    """A third of the rows on one key, a third without key, the rest spread."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        key = (hot, None, f"k{rng.randrange(400)}")[i % 3]
        rows.append((key, i % 11))
    return spark.createDataFrame(rows, "key string, amount int").repartition(6)


def right_frame(spark):
    """Most keys once, some twice, every fifth missing, one without key."""
    rows = [(f"k{i}", f"name {i}") for i in range(400) if i % 5]
    rows += [(f"k{i}", f"other {i}") for i in range(0, 400, 7) if i % 5] + [(None, "none")]
    return spark.createDataFrame(rows, "key string, name string")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(shuffled_joins, how):
    left, right = left_frame(shuffled_joins), right_frame(shuffled_joins)
    spread = spread_join(left, right, "key", how, buckets=5)
    plain = left.join(right, "key", how)
    assert spread.columns == plain.columns
    assert spark_table(spread) == spark_table(plain)


def copied_right_frame(spark, n=600):
    """A third of the rows on one key that is cold on the left, a third on the key
    that is hot there, the rest spread."""
    rows = [(("k3", "k7", f"k{i % 400}")[i % 3], f"name {i}") for i in range(n)]
    return spark.createDataFrame(rows, "key string, name string").repartition(3)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("buckets", [3, 20])
def test_both_sides_may_repeat_a_key(shuffled_joins, how, buckets):
    left, right = left_frame(shuffled_joins), copied_right_frame(shuffled_joins)
    spread = spread_join(left, right, "key", how, right_keys=right, buckets=buckets)
    plain = left.join(right, "key", how)
    assert hot_keys(right, "key", min_rows=20 * 8).collect()[0]["hot"]["key"]
    assert spread.columns == plain.columns
    assert spark_table(spread) == spark_table(plain)


def test_copies_of_a_right_key_reach_several_partitions(shuffled_joins):
    spark = shuffled_joins
    left = spark.createDataFrame([(f"k{i}",) for i in range(50)], "key string")
    right = copied_right_frame(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = spread_join(left, right, "key", "left", right_keys=right, buckets=8)
        parts = joined.where("key = 'k3'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) > 1 and sum(p["count"] for p in parts) == right.where("key = 'k3'").count()


def test_few_keys_on_a_small_side_cause_no_copies(spark):
    few = spark.createDataFrame([(f"k{i}",) for i in range(5)], "key string")
    assert hot_keys(few, "key", min_rows=100).collect()[0]["hot"]["key"] == []


def test_hot_rows_reach_several_partitions(shuffled_joins):
    spark = shuffled_joins
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = spread_join(left_frame(spark), right_frame(spark), "key", buckets=8)
        places = joined.where("key = 'k7'").select(F.spark_partition_id().alias("p")).distinct().count()
        loose = spread_join(left_frame(spark), right_frame(spark), "key", "left", buckets=8)
        null_places = loose.where("key IS NULL").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert places > 1 and null_places > 1


def test_cold_keys_are_not_copied(shuffled_joins):
    left = shuffled_joins.range(10_000).selectExpr("id AS key", "id AS amount")
    right = shuffled_joins.range(10_000).selectExpr("id AS key", "id AS other")
    assert hot_keys(left, "key").collect()[0]["hot"]["key"] == []
    assert spread_join(left, right, "key").count() == 10_000


def test_hot_keys_finds_the_large_keys_only(spark):
    assert hot_keys(left_frame(spark), "key").collect()[0]["hot"]["key"] == ["k7"]
    assert not hot_keys(left_frame(spark).where("false"), "key").collect()[0]["hot"]


def test_left_keys_only_routes(shuffled_joins):
    left, right = left_frame(shuffled_joins), right_frame(shuffled_joins)
    other = shuffled_joins.createDataFrame([("k1",)] * 50, "key string")
    assert spark_table(spread_join(left, right, "key", "left", left_keys=other)) == spark_table(
        left.join(right, "key", "left")
    )


def test_small_side_is_joined_without_salt(spark):
    large = spark.range(100_000_000).selectExpr("id % 100 AS key", "id")
    small = spark.range(100).selectExpr("id AS key", "id * 2 AS name")
    for joined in (spread_join(large, small, "key", "left"), spread_join(small, large, "key")):
        plan = plan_of(joined)
        assert "_left_bucket" not in plan and "approx_top_k" not in plan and "BroadcastHashJoin" in plan
    assert "_left_bucket" in plan_of(spread_join(small, large, "key", "left"))


def test_other_join_types_are_refused(spark):
    with pytest.raises(ValueError):
        spread_join(spark.range(1), spark.range(1), "id", "full")


KEYS = st.sampled_from(["a", "b", "c", "d", None])
COPIES = st.lists(st.tuples(KEYS, st.integers(0, 3), st.integers(1, 40)), max_size=8)


def copies(spark, groups, name):
    rows = [(key, value) for key, value, times in groups for _ in range(times)]
    return spark.createDataFrame(rows, f"key string, {name} int").repartition(3), rows


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=COPIES, right=COPIES, how=st.sampled_from(["inner", "left"]))
def test_any_copies_on_either_side(shuffled_joins, left, right, how):
    left_df, left_rows = copies(shuffled_joins, left, "l")
    right_df, right_rows = copies(shuffled_joins, right, "r")
    joined = spread_join(left_df, right_df, "key", how, right_keys=right_df, deal_by=["l"], buckets=2)
    expected = Counter()
    for key, value in left_rows:
        matches = [r for k, r in right_rows if key is not None and k == key]
        if how == "left" and not matches:
            matches = [None]
        expected.update((key, value, match) for match in matches)
    counts = {(r.key, r.l, r.r): r["count"] for r in joined.groupBy("key", "l", "r").count().collect()}
    assert counts == dict(expected)


def test_the_limit_follows_the_partition_count(shuffled_joins):
    rows = shuffled_joins.range(20_000).selectExpr("IF(id % 200 = 0, -1, id) AS key")
    assert hot_keys(rows, "key", share=64).collect()[0]["hot"]["key"] == []
    assert hot_keys(rows, "key", share=1000).collect()[0]["hot"]["key"] == [-1]
    before = shuffled_joins.conf.get("spark.sql.shuffle.partitions")
    shuffled_joins.conf.set("spark.sql.shuffle.partitions", "1000")
    assert hot_keys(rows, "key").collect()[0]["hot"]["key"] == [-1]
    shuffled_joins.conf.set("spark.sql.shuffle.partitions", before)


def test_the_last_task_merges_a_fixed_number_of_sketches(spark):
    keys = spark.range(0, 30_000, 1, 300).selectExpr("id % 7 AS key")
    plan = plan_of(hot_keys(keys, "key"))
    merged, _, grouped = plan.partition("approx_top_k_accumulate")
    assert "approx_top_k_combine" in merged and "hashpartitioning(part" in plan
    assert grouped and SKETCH_GROUPS == 64
