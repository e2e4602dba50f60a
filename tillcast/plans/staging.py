"""Staging models: renamed, typed views of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions import clock, money, payload
from tillcast.sources.readers import with_document


def stg_sales_log(raw: DataFrame) -> DataFrame:
    """Base sales log. Its wall clock is read as UTC here, unlike in the fan-out."""
    return raw.select(
        clock.wall_clock(F.col("date"), F.col("time")).alias("ordered_at"),
        F.col("coffee_name").alias("product_name"),
        F.col("money").cast("decimal(10,2)").alias("transaction_amount"),
        F.col("cash_type").alias("payment_type"),
        F.col("hour_of_day").alias("order_hour"),
        F.col("time_of_day").alias("day_period"),
        F.col("weekday").alias("weekday_name"),
        F.col("weekdaysort").alias("weekday_number"),
        "month_name",
        F.col("monthsort").alias("month_number"),
    )


def stg_cities(raw: DataFrame) -> DataFrame:
    return raw.select(
        "city_slug",
        "city_name",
        F.col("latitude").cast(payload.COORDINATE).alias("latitude"),
        F.col("longitude").cast(payload.COORDINATE).alias("longitude"),
        "updated_at",
    )


def stg_synthetic_sales(raw: DataFrame) -> DataFrame:
    return raw.select(
        "source_sale_id",
        "synthetic_sale_id",
        "synthetic_sale_item_id",
        "city_slug",
        "timezone",
        F.col("date").alias("sold_local_date"),
        "sold_at",
        "product_name",
        "payment_type",
        F.col("amount_money").alias("source_amount"),
        "price_multiplier",
        F.col("amount_rub").cast(money.AMOUNT).alias("amount_rub"),
        "quantity",
        "line_number",
        "is_synthetic",
    )


def stg_weather_hourly(raw: DataFrame) -> DataFrame:
    """One row per archive load and hour."""
    head = ["city_slug", "period_start", "period_end", "loaded_at"]
    return _hours(raw, head, "measured_at", payload.MEASURES)


def stg_weather_forecast(raw: DataFrame) -> DataFrame:
    """One row per forecast issue and hour."""
    head = ["city_slug", "issued_at", "forecast_days", "loaded_at"]
    return _hours(raw, head, "forecast_for", payload.FORECAST_MEASURES)


def _hours(raw: DataFrame, head: list[str], instant: str, measures: dict[str, tuple[str, str]]) -> DataFrame:
    parsed = with_document(raw).select(
        *head, payload.parse_document(F.col("payload"), measures).alias("doc")
    )
    coordinates = [F.col(f"doc.{c}").cast(payload.COORDINATE).alias(c) for c in ("latitude", "longitude")]
    arrays = {name: F.col(f"doc.hourly.{name}") for name in ("time", *measures)}
    hours = payload.unnest_parallel(parsed, arrays, [*[F.col(c) for c in head], *coordinates])
    return hours.filter(F.col("time").isNotNull()).select(
        *head,
        F.col("time").cast("timestamp_ntz").alias(instant),
        *[F.col(name).cast(type_).alias(column) for name, (column, type_) in measures.items()],
        "latitude",
        "longitude",
    )
