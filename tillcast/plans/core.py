"""Core models: dimensions and facts of the star schema.

Unmatched dimension rows leave null keys in the facts; the not-null checks
report them instead of the joins dropping rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions import clock, keys, money
from tillcast.operators.latest import latest

# Fixed value: first day of the calendar.
FIRST_DAY = date(2024, 1, 1)
YEARS_AHEAD = 3
NEWEST_LOAD = ["loaded_at", "period_end", "period_start"]


# --- dimensions ----------------------------------------------------------------------------


def dim_city(cities: DataFrame, sales: DataFrame) -> DataFrame:
    """Cities with the zone their sales carry. A city with two zones appears
    twice and is reported by the uniqueness check."""
    zones = sales.select("city_slug", "timezone").distinct()
    return cities.join(zones, "city_slug", "left").select(
        keys.md5_key(F.col("city_slug")).alias("city_key"),
        "city_slug",
        "city_name",
        "timezone",
        "latitude",
        "longitude",
    )


def calendar(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row per day, both ends included; ``bounds`` is a one-row frame."""
    day = F.col("date")
    days = bounds.select(F.explode(F.sequence(start, end)).alias("date"))
    return days.select(
        clock.date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        clock.weekday_name(day).alias("weekday"),
        clock.is_weekend(day).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, today: date) -> DataFrame:
    """Calendar from the first day to three years after ``today``, in date order."""
    end = F.add_months(F.lit(today), 12 * YEARS_AHEAD)
    return calendar(spark.range(1), F.lit(FIRST_DAY), end).orderBy("date")


def dim_product(sales: DataFrame) -> DataFrame:
    """Distinct product names without surrounding spaces; case matters."""
    names = sales.filter(F.col("product_name").isNotNull()).select(F.trim("product_name").alias("product_name"))
    return names.distinct().select(keys.md5_key(F.col("product_name")).alias("product_key"), "product_name")


# --- facts ---------------------------------------------------------------------------------


def _with_city(df: DataFrame, cities: DataFrame) -> DataFrame:
    return df.join(cities.select("city_slug", "city_key", "timezone"), "city_slug", "left")


def _with_date_key(df: DataFrame, day: str, dates: DataFrame) -> DataFrame:
    return df.join(dates.select("date_key", F.col("date").alias(day)), day, "left")


def fct_sales(sales: DataFrame, cities: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per receipt, dated by its local day.

    The hour uses the zone of the city dimension, not the one on the sale.
    """
    joined = _with_date_key(_with_city(sales.drop("timezone"), cities), "sold_local_date", dates)
    return joined.select(
        F.col("synthetic_sale_id").alias("sale_key"),
        clock.local_hour(F.col("sold_at"), F.col("timezone")).alias("hour"),
        F.col("amount_rub").alias("total_amount_rub"),
        "source_sale_id",
        "city_key",
        "sold_at",
        "date_key",
        "payment_type",
        "is_synthetic",
    )


def fct_sales_item(sales: DataFrame, products: DataFrame) -> DataFrame:
    """One row per receipt line, with the price of one unit."""
    named = products.select("product_key", F.col("product_name").alias("_name"))
    unit_price = F.round(money.safe_div(F.col("amount_rub"), F.col("quantity").cast("decimal(12,2)")), 2)
    joined = sales.withColumn("_name", F.trim("product_name")).join(named, "_name", "left")
    return joined.select(
        F.col("synthetic_sale_item_id").alias("sale_item_key"),
        F.col("synthetic_sale_id").alias("sale_key"),
        "line_number",
        "product_key",
        "quantity",
        unit_price.cast(money.TOTAL).alias("unit_price_rub"),
        F.col("amount_rub").alias("line_amount_rub"),
    )


def fct_weather_hour(weather: DataFrame, cities: DataFrame, dates: DataFrame) -> DataFrame:
    """Measured weather, newest load per city and hour, in local date and hour."""
    loads = weather.select(
        "city_slug", "measured_at", *NEWEST_LOAD, "temperature_c", "apparent_temperature_c",
        "precipitation_mm", "surface_pressure_hpa",
    )
    newest = latest(loads, ["city_slug", "measured_at"], NEWEST_LOAD)
    local = _with_city(newest, cities).withColumn(
        "_local", clock.to_local(F.col("measured_at"), F.col("timezone"))
    )
    dated = _with_date_key(local.withColumn("_day", F.to_date("_local")), "_day", dates)
    return dated.select(
        "city_key",
        "measured_at",
        "date_key",
        F.hour("_local").alias("hour"),
        "temperature_c",
        "apparent_temperature_c",
        "precipitation_mm",
        "surface_pressure_hpa",
        "loaded_at",
    )


def fct_weather_forecast_hour(forecast: DataFrame, cities: DataFrame, dates: DataFrame) -> DataFrame:
    """Forecast weather; every issue of an hour is kept."""
    local = _with_city(forecast, cities).withColumn(
        "_local", clock.to_local(F.col("forecast_for"), F.col("timezone"))
    )
    dated = _with_date_key(local.withColumn("_day", F.to_date("_local")), "_day", dates)
    return dated.select(
        "city_key",
        "issued_at",
        "forecast_for",
        "forecast_days",
        F.col("date_key").alias("forecast_date_key"),
        F.hour("_local").alias("forecast_hour"),
        "temperature_c",
        "apparent_temperature_c",
        "precipitation_mm",
        "surface_pressure_hpa",
        "precipitation_probability_pct",
        "loaded_at",
    )
