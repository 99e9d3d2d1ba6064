import os

from orderloom.session import SESSION_SETTINGS, apply_settings, clear_scratch, scratch_path, scratch_root
from orderloom.workload.queries import QUERIES


class Session:
    """Just the settings a path depends on."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = {key.replace("_", "."): value for key, value in settings.items()}

    def get(self, key, default=None):
        return self.settings.get(key, default)


class Named(Session):
    sparkContext = type("Context", (), {"applicationId": "app-1"})


def test_scratch_is_below_the_named_folder():
    named = Named(spark_checkpoint_dir="hdfs://shared/scratch/")
    first, second = scratch_path(named, "x"), scratch_path(named, "x")
    assert first.startswith("hdfs://shared/scratch/orderloom-app-1/") and first.endswith("/x")
    assert first != second


def test_scratch_without_a_named_folder_is_below_the_warehouse():
    assert scratch_root(Named(spark_sql_warehouse_dir="s3://w")) == "s3://w/orderloom-app-1"


def test_scratch_can_be_cleared(spark, sf_dir):
    assert QUERIES["table_roundtrip"](spark, sf_dir).count() > 0
    assert os.path.exists(scratch_root(spark).removeprefix("file:"))
    clear_scratch(spark)
    assert not os.path.exists(scratch_root(spark).removeprefix("file:"))
    assert not [d.name for d in spark.catalog.listDatabases() if d.name.count("_") and len(d.name) > 32]


def test_settings_reach_a_foreign_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    apply_settings(spark)
    assert all(spark.conf.get(key) == value for key, value in SESSION_SETTINGS.items())
