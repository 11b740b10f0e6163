"""The listing schema over the order-management tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart.operators.skew import skew_join
from stratamart.schemas import LISTING_COLUMNS
from stratamart.staging import materialize


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sold_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item in the listing schema, all columns but the brand popularity.

    Orders meet customers first, so that the line items, by far the largest side, are shuffled for
    their order and their part only.
    """
    lineitem = read_table(spark, sf_dir, "lineitem")
    orders = skew_join(
        read_table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"),
        read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), [("o_custkey", "c_custkey")])
    parts = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size", "p_type")
    items = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
                            "l_discount", "l_returnflag", "l_linestatus")
    joined = skew_join(items, orders.drop("o_custkey"), [("l_orderkey", "o_orderkey")])
    joined = skew_join(joined, parts, [("l_partkey", "p_partkey")], measured_on=lineitem)
    year = F.year("o_orderdate")
    mileage = F.col("l_quantity").cast("int") * 2000
    age = F.lit(2002) - year
    return joined.select(
        F.col("p_brand").alias("make"),
        F.col("p_name").alias("model"),
        year.alias("year"),
        mileage.alias("mileage"),
        (F.col("p_size") * 10).cast("double").alias("engine_hp"),
        F.col("l_linestatus").alias("transmission"),
        F.col("o_orderstatus").alias("fuel_type"),
        F.col("l_returnflag").alias("drivetrain"),
        F.col("p_type").alias("body_type"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("exterior_color"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("interior_color"),
        F.col("l_linenumber").cast("int").alias("owner_count"),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("accident_history"),
        F.col("c_mktsegment").alias("seller_type"),
        F.when(F.col("l_discount") < 0.03, "Fair").when(F.col("l_discount") < 0.07, "Good")
        .otherwise("Excellent").alias("condition"),
        F.concat(F.lit("T"), (F.col("p_size") % 5).cast("string")).alias("trim"),
        age.alias("vehicle_age"),
        (mileage / age.cast("double")).alias("mileage_per_year"),
        F.col("l_extendedprice").alias("price"),
    )


def with_brand_popularity(items: DataFrame) -> DataFrame:
    """Add the share of all rows that the make has (our definition of the column).

    The items are scanned twice, so hand in a stored table. The shares are staged: their file size
    then decides whether they are broadcast.
    """
    total = items.agg(F.count("*")).scalar()
    share = items.groupBy("make").agg(F.count("*").alias("_n")).select(
        F.col("make").alias("_make"), (F.col("_n").cast("double") / total).alias("brand_popularity"))
    shares = materialize(share, "brand_popularity")
    joined = skew_join(items, shares, [("make", "_make")], "left", null_safe=True)
    return joined.select(*LISTING_COLUMNS)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_brand_popularity(materialize(sold_items(spark, sf_dir), "sold_items"))
