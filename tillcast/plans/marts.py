"""Mart models: sales and weather at the grain reports read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions import money
from tillcast.operators.intervals import interval_join
from tillcast.operators.parts import spread

DAY = ["city_key", "date_key"]
HOUR = ["city_key", "date_key", "hour"]


def _city_names(cities: DataFrame) -> DataFrame:
    return cities.select("city_key", "city_slug", "city_name")


def _sales_dates(dates: DataFrame, *more: str) -> DataFrame:
    return dates.select("date_key", F.col("date").alias("sales_date"), *more)


def items_with_sales(items: DataFrame, sales: DataFrame, n_items: int = 0) -> DataFrame:
    """Receipt lines with the city and day of their receipt; lines without a
    receipt keep nulls.

    With the number of lines known, many are joined in more parts than a shuffle
    has, so that what a task sorts and counts doesn't grow with them.
    """
    lines = items.select("sale_key", "product_key", "quantity", "line_amount_rub")
    return spread(lines, n_items, "sale_key").join(sales.select("sale_key", *DAY), "sale_key", "left")


def product_days(sold: DataFrame) -> DataFrame:
    """Units, receipts and revenue per city, day and product."""
    return sold.groupBy(*DAY, "product_key").agg(
        F.sum("quantity").alias("units_sold"),
        F.count_distinct("sale_key").alias("receipts_count"),
        F.sum("line_amount_rub").cast(money.TOTAL).alias("product_revenue_rub"),
    )


def with_day_share(product_day: DataFrame) -> DataFrame:
    """Add the product's share in its city-day.

    A city-day has at most a row per product; a window adds the totals in the
    one pass over the receipts and lines, and spills where they outgrow memory.
    """
    revenue = F.col("product_revenue_rub")
    total = F.sum(revenue).over(Window.partitionBy(*DAY)).cast(money.TOTAL)
    known = F.col("city_key").isNotNull() & F.col("date_key").isNotNull()
    return product_day.withColumn("revenue_share_pct", F.when(known, money.share_pct(revenue, total)))


def mart_product_sales_daily(
    items: DataFrame, sales: DataFrame, cities: DataFrame, products: DataFrame, dates: DataFrame, n_items: int = 0
) -> DataFrame:
    """Product sales per city and local day."""
    shared = with_day_share(product_days(items_with_sales(items, sales, n_items)))
    unit_price = money.ratio_2dp(F.col("product_revenue_rub"), F.col("units_sold"))
    named = (
        shared.join(_city_names(cities), "city_key", "left")
        .join(products.select("product_key", "product_name"), "product_key", "left")
        .join(_sales_dates(dates), "date_key", "left")
    )
    return named.select(
        "city_key",
        "city_slug",
        "city_name",
        "date_key",
        "sales_date",
        "product_key",
        "product_name",
        "units_sold",
        "receipts_count",
        "product_revenue_rub",
        unit_price.alias("average_unit_price_rub"),
        "revenue_share_pct",
    )


def sales_days(sales: DataFrame) -> DataFrame:
    return sales.groupBy(*DAY).agg(
        F.count("*").alias("sales_count"),
        F.sum("total_amount_rub").cast(money.TOTAL).alias("total_revenue_rub"),
    )


def weather_days(weather: DataFrame) -> DataFrame:
    """Daily weather with the number of hours each figure rests on."""
    temperature, rain = F.col("temperature_c"), F.col("precipitation_mm")
    return weather.groupBy(*DAY).agg(
        # Summed exactly; a decimal average would keep six digits only.
        (F.sum(temperature).cast("double") / F.nullif(F.count(temperature), F.lit(0))).alias("avg_temperature_c"),
        F.min(temperature).alias("min_temperature_c"),
        F.max(temperature).alias("max_temperature_c"),
        F.sum(rain).cast("decimal(20,5)").alias("total_precipitation_mm"),
        F.count(temperature).cast("int").alias("temperature_hours_count"),
        F.count(rain).cast("int").alias("precipitation_hours_count"),
    )


def mart_sales_weather_daily(
    sales: DataFrame, weather: DataFrame, cities: DataFrame, dates: DataFrame
) -> DataFrame:
    """Sales per city and local day with that day's weather, where known.

    Both sides are aggregated first, so the join neither multiplies nor loses
    sales, and both already have the partitioning it needs.
    """
    joined = sales_days(sales).join(weather_days(weather), DAY, "left")
    named = joined.join(_city_names(cities), "city_key", "left").join(
        _sales_dates(dates, "weekday", "is_weekend"), "date_key", "left"
    )
    hours = [
        F.coalesce(c, F.lit(0)).alias(c)
        for c in ("temperature_hours_count", "precipitation_hours_count")
    ]
    average = money.ratio_2dp(F.col("total_revenue_rub"), F.col("sales_count"))
    return named.select(
        "city_key",
        "city_slug",
        "city_name",
        "date_key",
        "sales_date",
        "weekday",
        "is_weekend",
        "sales_count",
        "total_revenue_rub",
        average.alias("average_check_rub"),
        "avg_temperature_c",
        "min_temperature_c",
        "max_temperature_c",
        "total_precipitation_mm",
        *hours,
    )


def sales_hours(sales: DataFrame) -> DataFrame:
    hours = sales.groupBy(*HOUR).agg(
        F.count("*").alias("sales_count"),
        F.sum("total_amount_rub").cast(money.TOTAL).alias("total_revenue_rub"),
        F.count("total_amount_rub").alias("_priced"),
    )
    average = money.mean_16dp(F.col("total_revenue_rub"), F.col("_priced"))
    return hours.withColumn("average_check_rub", average).drop("_priced")


def sales_period(hours: DataFrame) -> DataFrame:
    """First and last day with sales of each city, from its sales hours."""
    return hours.groupBy("city_key").agg(
        F.min("date_key").alias("first_date_key"), F.max("date_key").alias("last_date_key")
    )


def within_period(weather: DataFrame, period: DataFrame) -> DataFrame:
    """Weather hours inside the sales period of their city."""
    return interval_join(weather, period, ["city_key"], "date_key", "first_date_key", "last_date_key")


def mart_sales_weather_hourly(
    sales: DataFrame, weather: DataFrame, cities: DataFrame, dates: DataFrame
) -> DataFrame:
    """Every weather hour of a city's sales period, with that hour's sales.

    Hours without sales count zero and have no average check.
    """
    return hourly_from_hours(sales_hours(sales), weather, cities, dates)


def hourly_from_hours(hours: DataFrame, weather: DataFrame, cities: DataFrame, dates: DataFrame) -> DataFrame:
    """The hourly mart from sales hours, which are read twice: for the period and for the hour's own sales.

    Hand in written hours where sales are costly, as Spark would compute them once for each use.
    """
    grid = within_period(weather.drop("loaded_at"), sales_period(hours))
    named = (
        grid.join(hours, HOUR, "left")
        .join(_city_names(cities), "city_key", "left")
        .join(_sales_dates(dates), "date_key", "left")
    )
    return named.select(
        "city_key",
        "date_key",
        "hour",
        "measured_at",
        "temperature_c",
        "apparent_temperature_c",
        "precipitation_mm",
        "surface_pressure_hpa",
        F.coalesce("sales_count", F.lit(0)).alias("sales_count"),
        F.coalesce("total_revenue_rub", F.lit(0)).cast(money.TOTAL).alias("total_revenue_rub"),
        "average_check_rub",
        "city_slug",
        "city_name",
        "sales_date",
    )
