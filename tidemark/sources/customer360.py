"""One row per customer, read from an order history.

Features use orders up to the cut date, one year before the newest order; the
label says whether the customer ordered nothing after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import table

_SERVICES = {
    "svc_urgent": "1-URGENT",
    "svc_high": "2-HIGH",
    "svc_medium": "3-MEDIUM",
    "svc_unspecified": "4-NOT SPECIFIED",
    "svc_low": "5-LOW",
}


def customer360(spark: SparkSession, folder: str) -> DataFrame:
    dated = table(spark, folder, "orders")
    cut = dated.agg(F.max("o_orderdate")).scalar() - F.expr("interval 365 days")
    orders = dated.select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        "o_orderpriority",
        (F.col("o_orderdate") <= cut).alias("past"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        "o_orderstatus",
    )
    returned = (
        table(spark, folder, "lineitem")
        .where("l_returnflag = 'R'")
        .select(F.col("l_orderkey").alias("o_orderkey"))
        .distinct()
        .withColumn("returned", F.lit(1))
    )
    past = F.col("past")

    def yes(condition):
        return F.when(F.max(F.when(past & condition, 1).otherwise(0)) == 1, "Yes").otherwise("No")

    amount = F.when(past, F.col("price"))
    history = (
        orders.join(returned, "o_orderkey", "left")
        .groupBy("o_custkey")
        .agg(
            (1 - F.max(F.when(past, 0).otherwise(1))).alias("target"),
            F.min(F.when(past, F.col("o_orderdate"))).alias("first"),
            F.max(F.when(past, F.col("o_orderdate"))).alias("last"),
            F.count(amount).alias("n"),
            F.sum(amount).alias("amount"),
            F.max_by("o_orderstatus", F.when(past, F.struct("o_orderdate", "o_orderkey"))).alias("payment"),
            yes(F.col("returned") == 1).alias("paperless"),
            *[yes(F.col("o_orderpriority") == v).alias(c) for c, v in _SERVICES.items()],
        )
        .where("n > 0")
    )
    place = (
        table(spark, folder, "nation")
        .join(
            table(spark, folder, "region"),
            F.col("n_regionkey") == F.col("r_regionkey"),
        )
        .select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("internet"))
    )
    customer = table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    months = lambda c: F.floor(F.datediff(cut, F.col(c)) / 30).cast("int")
    return (
        history.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(place, "c_nationkey", "left")
        .select(
            F.col("c_custkey").alias("customer_key"),
            F.col("target"),
            months("first").alias("tenure"),
            months("last").alias("recency"),
            (F.col("amount").cast("double") / F.col("n")).alias("monthly"),
            F.col("amount").cast("double").alias("total"),
            F.when(F.col("c_acctbal") < 0, F.lit(" "))
            .otherwise(F.col("amount").cast("string"))
            .alias("total_text"),
            F.col("c_acctbal").alias("balance"),
            F.col("c_mktsegment").alias("contract"),
            "internet",
            "payment",
            "paperless",
            F.when(F.col("c_nationkey") % 2 == 1, "Yes").otherwise("No").alias("partner"),
            F.when(F.col("c_acctbal") > 0, "Yes").otherwise("No").alias("dependents"),
            F.when(F.col("c_nationkey") >= 20, 1).otherwise(0).alias("senior"),
            *_SERVICES,
        )
    )
