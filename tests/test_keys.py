from pyspark.sql import functions as F

from stratamart.operators.keys import dense_key, file_counts, file_key
from tests.conftest import rows


def test_ranked_keys_follow_the_order_nulls_first(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), ("a", None)], "x string, y int").repartition(3)
    assert rows(dense_key(df, "k", ["x", "y"])) == [(1, None, 2), (2, "a", None), (3, "a", 3), (4, "b", 1)]


def test_keys_of_repeated_rows_are_dense_and_distinct(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("x")).repartition(7)
    keyed = dense_key(df, "k")
    assert sorted(r.k for r in keyed.collect()) == list(range(1, 1001))
    assert keyed.groupBy("x").count().count() == 3


def test_empty_input_has_no_keys(spark):
    df = spark.createDataFrame([], "x int")
    assert dense_key(df, "k", ["x"]).collect() == []


def test_stored_tables_are_numbered_by_file_and_row(spark, tmp_path):
    spark.range(500).repartition(6).write.parquet(f"{tmp_path}/t")
    keyed = file_key(spark.read.parquet(f"{tmp_path}/t"), "k")
    assert keyed.columns == ["k", "id"]
    assert sorted(r.k for r in keyed.collect()) == list(range(1, 501))
    assert keyed.select("id").distinct().count() == 500


def test_files_are_counted_without_sorting_their_rows(spark, tmp_path):
    spark.range(500).repartition(6).write.parquet(f"{tmp_path}/t")
    counts = file_counts(spark.read.parquet(f"{tmp_path}/t").select("id", F.col("_metadata.file_path").alias("_file")))
    assert sum(r["_rows"] for r in counts.collect()) == 500 and counts.count() == 6
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
