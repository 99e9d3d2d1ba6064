import pytest

from compare import spark_table
from orderloom.__main__ import parse, run_config, run_stage, run_stream
from orderloom.session import scratch_path
from orderloom.sinks import publish
from orderloom.sources import Topic, read_landing
from orderloom.streaming import read_batches
from test_stream import event, values
from test_tables import raw_folder


def test_stages_one_by_one(spark, tmp_path, capsys):
    location = scratch_path(spark, "cli")
    common = ["--location", location, "--raw-root", raw_folder(tmp_path)]
    for what in ("bronze", "silver", "quality", "gold"):
        run_stage(spark, parse([what, *common]))
    out = capsys.readouterr().out
    assert "bronze.orders: 1 rows" in out and "silver.orders: 2 rows" in out
    assert '{"success": true}' in out and "gold.top10_customers_ltv: 1 rows" in out
    run_stage(spark, parse(["quality", *common, "--last-date", "2016-12-31"]))
    run_stage(spark, parse(["quarantine", *common, "--last-date", "2016-12-31"]))
    out = capsys.readouterr().out
    assert '{"success": false}' in out and "quarantine.orders: 2 rows" in out
    run_stage(spark, parse(["all", *common]))
    assert "gold.rolling_7day_order_volume" in capsys.readouterr().out


def test_file_names_from_options():
    args = parse(["bronze", "--file-pattern", "x_{table}.csv", "--translation-file", "t.csv", "--multi-line", "order_reviews"])
    datasets = {d.table: d for d in run_config(args).datasets}
    assert datasets["orders"].file_name == "x_orders.csv" and datasets["order_reviews"].multi_line
    assert datasets["product_category_translation"].file_name == "t.csv"


def test_settings_from_options(tmp_path):
    schemas = tmp_path / "schemas.json"
    schemas.write_text('{"orders": "order_id string, customer_id string"}')
    given = ["--schemas", str(schemas), "--min-amount", "5", "--top", "3", "--run-name", "r", "--database", "gold=best"]
    cfg = run_config(parse(["all", *given]))
    assert {d.table: d.schema for d in cfg.datasets}["orders"] == "order_id string, customer_id string"
    assert (cfg.min_order_amount, cfg.top_customers, cfg.run_name, cfg.layers.gold) == (5, 3, "r", "best")
    stream = parse(["stream", "--topic", "t", "--landing", "l", "--checkpoint", "c", "--option", "kafka.group.id=g"])
    assert dict(stream.option) == {"kafka.group.id": "g"}


@pytest.mark.parametrize("extra", [[], ["--print-matches"], ["--idle-seconds", "3"]])
def test_stream(spark, capsys, extra):
    topic, landing = scratch_path(spark, "topic"), scratch_path(spark, "landing")
    publish(values(spark, event(1, 60), event(2, 20)), Topic(topic))
    run_stream(spark, parse(["stream", "--topic", topic, "--landing", landing, "--checkpoint", f"{landing}-c", *extra]))
    out = capsys.readouterr().out
    assert f"landed 1, rejected 0: {landing}" in out
    assert ("above threshold: {" in out) == ("--print-matches" in extra)
    landed = (read_batches if "--print-matches" in extra else read_landing)(spark, landing)
    assert spark_table(landed.select("customer_id"))[1] == [("'cust_1'",)]
