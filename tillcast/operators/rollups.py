"""Coarser views of the marts that keep ratios and distinct counts right."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions import money

HOURS_PER_DAY = 24


def average_check(mart: DataFrame, by: list[str]) -> DataFrame:
    """Overall average check: revenue over receipts, never a mean of means."""
    totals = mart.groupBy(*by).agg(
        F.sum("sales_count").alias("sales_count"),
        F.sum("total_revenue_rub").cast(money.TOTAL).alias("total_revenue_rub"),
    )
    return totals.withColumn(
        "average_check_rub", money.ratio_2dp(F.col("total_revenue_rub"), F.col("sales_count"))
    )


def revenue_share(product_mart: DataFrame, by: list[str], item: str = "product_key") -> DataFrame:
    """Share of each item in the revenue of a coarser period, recomputed."""
    parts = product_mart.groupBy(*by, item).agg(
        F.sum("product_revenue_rub").cast(money.TOTAL).alias("product_revenue_rub")
    )
    whole = F.sum("product_revenue_rub").over(Window.partitionBy(*by)).cast(money.TOTAL)
    known = F.lit(True)
    for column in by:
        known = known & F.col(column).isNotNull()
    return parts.withColumn("revenue_share_pct", F.when(known, money.share_pct(F.col("product_revenue_rub"), whole)))


def complete_days(daily_mart: DataFrame, hours: int = HOURS_PER_DAY) -> DataFrame:
    """Days whose temperature is known for every hour, fit for weather comparisons."""
    return daily_mart.filter(F.col("temperature_hours_count") == hours)


def receipts(sold_items: DataFrame, by: list[str]) -> DataFrame:
    """Receipts at a coarser grain. They do not add up across products, so they
    are counted anew from the lines."""
    return sold_items.groupBy(*by).agg(F.count_distinct("sale_key").alias("receipts_count"))
