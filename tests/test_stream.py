import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from orderloom.functions import event_json, one_line, utc_text
from orderloom.session import scratch_path
from orderloom.sinks import publish
from orderloom.sources import Topic, read_landing, read_topic, stream_topic
from orderloom.streaming import (
    StreamCounts,
    compact_landing,
    drain,
    land_and_print,
    land_orders,
    read_batches,
    read_printed,
    route_events,
)


def event(n, amount, **more):
    return json.dumps(
        {
            "customer_id": f"cust_{n}",
            "product_id": f"prod_{n}",
            "order_amount": amount,
            "timestamp": "2024-03-05T01:02:03.456789+00:00",
            **more,
        }
    )


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


@pytest.fixture
def topic(spark):
    return Topic(scratch_path(spark, "topic"))


@pytest.fixture
def out(spark):
    return scratch_path(spark, "landing")


def land(spark, topic, out):
    return drain(land_orders(stream_topic(spark, topic), out, f"{out}-checkpoint"))


def test_only_amounts_above_the_threshold(spark, topic, out):
    publish(values(spark, event(1, 50), event(2, 50.01), event(3, 49.99), event(4, 200)), topic)
    counts = land(spark, topic, out)
    rows = read_landing(spark, out).orderBy("customer_id").collect()
    assert [(r.customer_id, r.order_amount) for r in rows] == [("cust_2", 50.01), ("cust_4", 200.0)]
    assert rows[0].timestamp == "2024-03-05T01:02:03.456789+00:00"
    assert (counts.matched, counts.rejected) == (2, 0)


def test_bad_records_go_to_the_dead_letters_and_the_rest_goes_on(spark, topic, out):
    bad = ['{"order_amount": 60', "plain text", "", '{"customer_id": "cust_1"}', '{"order_amount": "much"}', "[]", "null"]
    publish(values(spark, *bad, event(1, 60)), topic)
    counts = land(spark, topic, out)
    dead = read_landing(spark, out, "dead_letter", "value string, reason string").collect()
    assert {r.value for r in dead} == set(bad)
    assert {r.value: r.reason for r in dead}['{"customer_id": "cust_1"}'] == "no amount"
    assert {r.value: r.reason for r in dead}["plain text"] == "malformed"
    assert read_landing(spark, out).count() == 1
    assert (counts.matched, counts.rejected) == (1, len(bad))


def test_unknown_fields_and_line_breaks_survive(spark):
    text = json.dumps({"order_amount": 60, "gift": True}, indent=1)
    routed = route_events(values(spark, text)).select(one_line(F.col("value")).alias("value")).collect()
    assert "\n" not in routed[0].value and json.loads(routed[0].value) == {"order_amount": 60, "gift": True}


def test_a_record_without_value_is_a_dead_letter(spark):
    routed = route_events(spark.createDataFrame([(None,)], "value string")).collect()
    assert [tuple(r) for r in routed] == [(None, "dead_letter", "malformed")]


def test_restart_lands_nothing_twice(spark, topic, out):
    publish(values(spark, event(1, 60)), topic)
    land(spark, topic, out)
    assert land(spark, topic, out).matched == 0
    publish(values(spark, event(2, 70)), topic)
    assert land(spark, topic, out).matched == 1
    assert sorted(r.customer_id for r in read_landing(spark, out).collect()) == ["cust_1", "cust_2"]


def test_nothing_matched_reads_as_empty(spark, topic, out):
    publish(values(spark, event(1, 1)), topic)
    assert land(spark, topic, out).matched == 0
    assert read_landing(spark, out).count() == 0


def test_both_sinks_get_every_match(spark, topic, out):
    publish(values(spark, *(event(n, n) for n in range(40, 170)), "broken"), topic)
    shown, counts = [], StreamCounts()
    query = land_and_print(
        stream_topic(spark, topic), out, f"{out}-checkpoint", counts=counts, preview=shown.append, preview_rows=5
    )
    drain(query)
    printed = [json.loads(r.value)["customer_id"] for r in read_printed(spark, out).collect()]
    landed = [r.customer_id for r in read_batches(spark, out).collect()]
    assert sorted(printed) == sorted(landed) == sorted(f"cust_{n}" for n in range(51, 170))
    assert (counts.matched, counts.rejected) == (119, 1)
    assert [tuple(r) for r in read_batches(spark, out, "dead_letter").collect()] == [("broken", "malformed")]
    assert len(shown) == 5 and shown[0].startswith("above threshold: {")


def test_landed_files_are_put_together(spark, out):
    topic = Topic(scratch_path(spark, "topic"), batch_limit=1)
    publish(values(spark, *(event(n, 100) for n in range(12)), "broken").repartition(4), topic)
    land(spark, topic, out)
    compact_landing(spark, out, f"{out}-compact")
    before, after = read_landing(spark, out), read_landing(spark, f"{out}-compact")
    assert sorted(before.collect()) == sorted(after.collect()) and after.count() == 12
    assert len(after.inputFiles()) < len(before.inputFiles())


def test_batches_are_bounded_by_files(spark, out):
    topic = Topic(scratch_path(spark, "topic"), batch_limit=1)
    publish(values(spark, *(event(n, 100) for n in range(12))).repartition(3), topic)
    query = land_orders(stream_topic(spark, topic), out, f"{out}-checkpoint")
    assert drain(query).matched == 12
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3


def test_continuous_query_stops_when_idle(spark, topic, out):
    publish(values(spark, event(1, 60)), topic)
    late = threading.Timer(2.0, lambda: publish(values(spark, event(2, 70)), topic))
    late.start()
    started = time.monotonic()
    query = land_orders(stream_topic(spark, topic), out, f"{out}-checkpoint", continuous=True)
    counts = drain(query, idle_seconds=5, poll_seconds=0.5)
    late.join()
    assert not query.isActive and counts.matched == 2
    assert time.monotonic() - started >= 5
    assert read_landing(spark, out).count() == 2


def test_a_long_batch_is_not_idle(spark, topic, out):
    publish(values(spark, event(1, 60), event(2, 70)), topic)
    counts = StreamCounts()
    query = land_and_print(
        stream_topic(spark, topic),
        out,
        f"{out}-checkpoint",
        counts=counts,
        preview=lambda _: time.sleep(3),
        continuous=True,
    )
    drain(query, idle_seconds=2, poll_seconds=0.5)
    assert counts.matched == 2 and read_batches(spark, out).count() == 2
    assert land(spark, Topic(topic.name), f"{out}-again").matched == 2


def test_published_text(spark, topic):
    source = spark.sql("SELECT 'cust_1' AS customer_id, 53.5D AS order_amount, TIMESTAMP '2024-03-05 01:02:03.456789' AS t")
    publish(source.select(event_json("customer_id", "order_amount", utc_text(F.col("t")).alias("timestamp")).alias("value")), topic)
    assert json.loads(read_topic(spark, topic).collect()[0].value) == {
        "customer_id": "cust_1",
        "order_amount": 53.5,
        "timestamp": "2024-03-05T01:02:03.456789+00:00",
    }


def test_kafka_settings():
    with pytest.raises(ValueError):
        Topic("new_orders", "kafka")
    with pytest.raises(ValueError):
        Topic("new_orders", "carrier pigeon")
    topic = Topic("new_orders", "kafka", "broker:9092", batch_limit=1000, min_partitions=64)
    assert topic.read_options(streaming=True) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "new_orders",
        "startingOffsets": "earliest",
        "minPartitions": "64",
        "maxOffsetsPerTrigger": "1000",
    }
    assert "maxOffsetsPerTrigger" not in topic.read_options(streaming=False)
