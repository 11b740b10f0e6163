import time

import pytest
from pyspark.sql import functions as F

from stratamart import staging
from tests.conftest import rows


def test_staged_tables_live_in_the_named_folder_until_cleared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(staging, "shared_folder", lambda _: f"file:{tmp_path}/app")
    stored = staging.materialize(spark.range(3), "t")
    assert rows(stored) == [(0,), (1,), (2,)]
    assert stored.inputFiles()[0].startswith(f"file://{tmp_path}/app/staged/t-")
    staging.clear(spark)
    assert not (tmp_path / "app").exists()


def test_the_session_names_the_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert staging.shared_folder(spark) == f"{base}/stratamart/{spark.sparkContext.applicationId}"


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def test_a_load_leaves_neither_staged_tables_nor_shuffle_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(staging, "shared_folder", lambda _: f"file:{tmp_path}/app")
    kept = staging.materialize(spark.range(3), "kept")
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(name), shuffle_files(spark)
    with staging.passing(spark):
        staged = staging.materialize(spark.range(1000).repartition(4, "id"), "passed")
        with staging.passing(spark):  # a load within a load
            staging.materialize(spark.range(2), "inner")
        dealt = staged.repartition(4, F.col("id") % 7)  # still referred to, so no garbage collection could delete its shuffle
        dealt.write.parquet(str(tmp_path / "table"))
    until = time.time() + 20  # executors delete them in their own time
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert {p.name.split("-")[0] for p in (tmp_path / "app/staged").iterdir()} == {"kept"}
    assert rows(kept) == [(0,), (1,), (2,)] and spark.read.parquet(str(tmp_path / "table")).count() == 1000
    assert spark.conf.get(name) == setting


def test_a_load_that_dies_leaves_nothing_staged(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(staging, "shared_folder", lambda _: f"file:{tmp_path}/app")
    with pytest.raises(ZeroDivisionError), staging.passing(spark):
        staging.materialize(spark.range(3), "t")
        1 / 0
    assert not any((tmp_path / "app/staged").iterdir())
    assert staging.materialize(spark.range(3), "t").count() == 3
