"""A third of all rows on one key: same results, balanced tasks."""

import pytest
from pyspark.sql import functions as F

from stratamart.operators.skew import skew_join, sum_through
from stratamart.staging import materialize
from tests.conftest import rows

N = 60_000


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 97 == 0, None).otherwise(F.col("id") % 20_000)
    fact = spark.range(0, N, 1, 16).select(key.cast("int").alias("k"), F.lit("same").alias("v"), F.lit(1.5).alias("price"))
    return materialize(fact, "skewed")


@pytest.fixture(scope="module")
def side(spark):
    # Keys from 15,000 on are missing; the frequent key is there.
    ids = spark.range(15_000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("attribute"))
    return materialize(ids.unionByName(spark.createDataFrame([(None, 99)], "k bigint, attribute bigint")), "side")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [True, False])
def test_same_rows_as_a_plain_join(spark, no_broadcast, skewed, side, how, null_safe):
    got = skew_join(skewed, side, ["k"], how, null_safe)
    assert "frequent_keys" in str(got.inputFiles())
    renamed = side.withColumnRenamed("k", "other")
    same = skewed["k"].eqNullSafe(renamed["other"]) if null_safe else skewed["k"] == renamed["other"]
    want = skewed.join(renamed, same, how).drop("other")
    assert rows(got.groupBy(*got.columns).count()) == rows(want.groupBy(*want.columns).count())


def test_frequent_keys_missing_from_the_side(spark, no_broadcast, skewed, side):
    rest = materialize(side.where("k <> 7"), "rest")
    assert skew_join(skewed, rest, ["k"]).where("k = 7").count() == 0
    left = skew_join(skewed, rest, ["k"], "left")
    assert left.count() == N and left.where("k = 7 AND attribute IS NULL").count() == skewed.where("k = 7").count()


def test_frequent_rows_are_spread_over_tasks(spark, no_broadcast, skewed, side):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    varied = materialize(skewed.withColumn("n", F.monotonically_increasing_id()), "varied")
    try:
        def largest(df):
            return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        plain = largest(varied.join(side, "k", "left"))
        spread = largest(skew_join(varied, side, ["k"], "left"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert plain > N / 3
    assert spread < N / 4


def test_zero_and_minus_zero_are_one_key(spark, no_broadcast):
    fact = spark.range(30_000).select(F.when(F.col("id") % 2 == 0, -0.0).otherwise(0.0).alias("k"))
    side = spark.createDataFrame([(0.0, "zero")], "k double, name string")
    assert rows(skew_join(materialize(fact, "zeros"), materialize(side, "zero"), ["k"], "left")
                .groupBy("name").count()) == [("zero", 30_000)]


def test_sums_are_the_same_either_way(spark, skewed, side):
    def sums():
        return rows(sum_through(skewed, side, "k", ["attribute"], {"n": F.lit(1), "total": F.col("price")},
                                {"low": F.col("price")}, {"high": F.col("k")}))
    direct = sums()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert sums() == direct
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(r[1] for r in direct) == skewed.where("k < 15000").count()


def test_columns_of_a_large_table_are_not_broadcast(spark):
    """A few columns of it seem to fit a broadcast."""
    wide = materialize(spark.range(3000).select("id", *[F.sha2(F.concat(F.lit(str(i)), F.col("id")), 256).alias(f"t{i}") for i in range(20)]), "wide")
    fact = materialize(spark.range(9000).select((F.col("id") % 3000).alias("id")), "fact")
    few = wide.select("id", (F.col("id") % 5).alias("a"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "300000")
    try:
        plan = {"sized": skew_join(fact, few, ["id"], sized_on=wide), "summed": sum_through(fact, wide.withColumn("a", F.col("id") % 5), "id", ["a"], {"n": F.lit(1)})}
        for df in plan.values():
            assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
        assert rows(plan["summed"]) == [(i, 1800) for i in range(5)]
        assert plan["sized"].count() == 9000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
