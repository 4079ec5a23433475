"""Structured sales and stock questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def revenue() -> Column:
    return money("l_extendedprice") * (F.lit(1).cast("decimal(18,2)") - money("l_discount"))


def store_count(stores: DataFrame, key: str) -> DataFrame:
    return stores.agg(F.count_distinct(key).alias("total_stores"))


def sales_aggregated(sales: DataFrame, store: str, timestamp: str) -> DataFrame:
    """Exact revenue per store and month."""
    return sales.groupBy(F.col(store).alias("store_id"), F.date_format(timestamp, "yyyy-MM").alias("month")).agg(
        F.sum(revenue()).cast("decimal(18,2)").alias("total_revenue")
    )


def in_month(timestamp: str, month: str) -> Column:
    """Half-open range on the bare column, so it reaches the scan."""
    first = F.to_date(F.lit(f"{month}-01"))
    return (F.col(timestamp) >= first) & (F.col(timestamp) < F.add_months(first, 1))


def top_stores(monthly: DataFrame, k: int = 3) -> DataFrame:
    return monthly.orderBy(F.desc("total_revenue"), "store_id").limit(k)


def top_products_by_region(sales: DataFrame, k: int = 3) -> DataFrame:
    """Best sellers per region; the product is aggregated before the window sees it."""
    sold = sales.groupBy("region", "product_id").agg(F.sum("units").alias("units"))
    order = W.partitionBy("region").orderBy(F.desc("units"), "product_id")
    return sold.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def stores_over(sales: DataFrame, threshold: float) -> DataFrame:
    """Per state, how many stores sold more than `threshold` units."""
    per_store = sales.groupBy("state", "store_id").agg(F.sum("units").alias("units")).filter(F.col("units") > threshold)
    return per_store.groupBy("state").agg(F.count("store_id").alias("stores"))


def month_over_month(monthly: DataFrame, drop: float = 0.4) -> DataFrame:
    """Change of revenue against the month before (yyyy-MM); large drops are flagged.

    A month whose predecessor is not listed, or sold nothing, has no change.
    """
    order = W.partitionBy("store_id").orderBy("month")
    before = F.date_format(F.add_months(F.to_date(F.concat("month", F.lit("-01"))), -1), "yyyy-MM")
    previous = F.when(F.lag("month").over(order) == before, F.lag("total_revenue").over(order))
    change = F.try_divide(
        F.col("total_revenue").cast("double") - F.col("previous").cast("double"), F.col("previous").cast("double")
    )
    return (
        monthly.withColumn("previous", previous)
        .withColumn("pct_change", F.round(change, 6))
        .withColumn("dropped", F.coalesce(F.col("pct_change") <= -drop, F.lit(False)))
    )


def stock_decision(requests: DataFrame, parts: DataFrame, lead: DataFrame, max_days: float = 7.0) -> DataFrame:
    """Sell, wait or substitute for each requested SKU.

    The substitute is the best-stocked part of the same type, found per type and not per request.
    """
    order = W.partitionBy("type").orderBy(F.desc("stock"), "sku")
    substitute = (
        parts.filter("stock > 0")
        .withColumn("r", F.row_number().over(order))
        .filter("r = 1")
        .select("type", F.col("sku").alias("substitute"))
    )
    known = requests.join(parts, "sku", "left").join(lead, "sku", "left").join(substitute, "type", "left")
    decision = (
        F.when(F.col("stock").isNull(), "unknown")
        .when(F.col("stock") > 0, "none")
        .when(F.col("lead_days") > max_days, "substitute")
        .otherwise("wait")
    )
    return known.withColumn("decision", decision).withColumn(
        "substitute", F.when(F.col("decision") == "substitute", F.col("substitute"))
    )
