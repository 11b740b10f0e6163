"""Sales measures over the order-management tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratamart.functions.columns import round_money


def average_ticket(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Average order value per market segment.

    Orders are summed per customer before the join: both sides then meet on the customer key with
    one shuffle, and a customer with very many orders is a single row by then.
    """
    spent = orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("_spent"), F.count("o_totalprice").alias("_n"))
    joined = spent.join(customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    totals = joined.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.sum("_spent").alias("_spent"), F.sum("_n").alias("orders"))
    average = F.col("_spent").cast("double") / F.col("orders")
    return totals.select("segment", round_money(average).alias("average_ticket"), "orders")


def active_customers(orders: DataFrame) -> DataFrame:
    """Customers with an order in the year (our definition of active)."""
    return orders.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.countDistinct("o_custkey").alias("active_customers")).orderBy("year")


def sales_by_region(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame,
                    region: DataFrame) -> DataFrame:
    """Discounted revenue per region, summed exactly as decimals.

    Revenue shrinks to one row per order, then per customer, before each join.
    """
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    paid = price * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))
    by_order = lineitem.groupBy("l_orderkey").agg(F.sum(paid).alias("_paid"))
    by_customer = (
        by_order.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey").agg(F.sum("_paid").alias("_paid"))
    )
    by_nation = (
        by_customer.join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey").agg(F.sum("_paid").alias("_paid"))
    )
    placed = by_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey"))
    return placed.groupBy(F.col("r_name").alias("region")).agg(
        F.sum("_paid").cast("decimal(28,2)").cast("double").alias("revenue")).orderBy("region")
