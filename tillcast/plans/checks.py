"""Checks declared per model, and the cross-model checks."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillcast.operators import quality
from tillcast.operators.stored_checks import StoredChecks
from tillcast.sources.days import DayTable


@dataclass(frozen=True)
class Declared:
    """Column checks of one model; ``parents`` maps a column to (model, its key)."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    combination: tuple[str, ...] = ()
    parents: tuple[tuple[str, str, str], ...] = ()


TO_CITY = ("city_key", "core_dim_city", "city_key")

# The checks each model declares.
DECLARED = {
    "core_dim_date": Declared(
        not_null=("date_key", "year", "month", "weekday", "is_weekend"),
        unique=("date_key", "date"),
    ),
    "core_dim_city": Declared(
        not_null=("city_key", "city_name", "timezone", "latitude", "longitude"),
        unique=("city_key", "city_slug"),
        combination=("city_slug", "timezone"),
    ),
    "core_dim_product": Declared(
        not_null=("product_key",),
        unique=("product_key", "product_name"),
    ),
    "core_fct_sales": Declared(
        not_null=(
            "sale_key", "source_sale_id", "city_key", "sold_at", "date_key", "hour",
            "total_amount_rub", "payment_type", "is_synthetic",
        ),
        unique=("sale_key",),
        parents=(TO_CITY, ("date_key", "core_dim_date", "date_key")),
    ),
    "core_fct_sales_item": Declared(
        not_null=(
            "sale_item_key", "sale_key", "line_number", "product_key", "quantity",
            "unit_price_rub", "line_amount_rub",
        ),
        unique=("sale_item_key",),
        combination=("sale_key", "line_number"),
        parents=(("sale_key", "core_fct_sales", "sale_key"), ("product_key", "core_dim_product", "product_key")),
    ),
    "core_fct_weather_hour": Declared(
        not_null=("city_key", "measured_at", "date_key", "hour", "loaded_at"),
        combination=("city_key", "measured_at"),
        parents=(TO_CITY, ("date_key", "core_dim_date", "date_key")),
    ),
    "core_fct_weather_forecast_hour": Declared(
        not_null=(
            "city_key", "issued_at", "forecast_for", "forecast_days", "forecast_date_key",
            "forecast_hour", "loaded_at",
        ),
        combination=("city_key", "issued_at", "forecast_for"),
        parents=(TO_CITY, ("forecast_date_key", "core_dim_date", "date_key")),
    ),
    "mart_sales_weather_hourly": Declared(
        not_null=(
            "city_key", "city_slug", "city_name", "date_key", "sales_date", "hour", "measured_at",
            "sales_count", "total_revenue_rub",
        ),
        combination=("city_key", "date_key", "hour"),
    ),
    "mart_product_sales_daily": Declared(
        not_null=(
            "city_key", "city_slug", "city_name", "date_key", "sales_date", "product_key",
            "product_name", "units_sold", "receipts_count", "product_revenue_rub",
        ),
        combination=("city_key", "date_key", "product_key"),
    ),
    "mart_sales_weather_daily": Declared(
        not_null=(
            "city_key", "city_slug", "city_name", "date_key", "sales_date", "weekday", "is_weekend",
            "sales_count", "total_revenue_rub", "temperature_hours_count", "precipitation_hours_count",
        ),
        combination=("city_key", "date_key"),
    ),
}


def declared_checks(models: dict[str, DataFrame], name: str) -> dict[str, DataFrame]:
    """Offending rows of every check one model declares."""
    rules, df = DECLARED[name], models[name]
    checks = {f"{name}: not null": quality.not_null(df, rules.not_null)}
    for column in rules.unique:
        checks[f"{name}: unique {column}"] = quality.unique(df, column)
    if rules.combination:
        label = ", ".join(rules.combination)
        checks[f"{name}: unique ({label})"] = quality.unique_combination(df, rules.combination)
    for column, parent, key in rules.parents:
        checks[f"{name}: {column} in {parent}"] = quality.relationships(df, column, models[parent], key)
    return checks


def stored_checks(table: DayTable, name: str) -> StoredChecks:
    """The checks that a model kept by day declares, with their results kept by day too."""
    rules = DECLARED[name]
    keys = {f"{name}: unique {column}": (column,) for column in rules.unique}
    if rules.combination:
        keys[f"{name}: unique ({', '.join(rules.combination)})"] = rules.combination
    parents = {f"{name}: {column} in {parent}": column for column, parent, _ in rules.parents}
    return StoredChecks(table, {f"{name}: not null": rules.not_null}, keys, parents)


def stored_failures(stored: StoredChecks, name: str, models: dict[str, DataFrame], days: Iterable[int] | None = None) -> DataFrame:
    """(check, n_rows) of the failed checks of a whole model, from what is kept; see StoredChecks.failures."""
    parents = {f"{name}: {column} in {parent}": models[parent].select(key) for column, parent, key in DECLARED[name].parents}
    return stored.failures(parents, days)


def core_checks(models: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Cross-model checks of the core layer."""
    sales, items = models["core_fct_sales"], models["core_fct_sales_item"]
    return {
        "local sales date is consistent": quality.local_date_mismatch(
            sales, models["core_dim_city"], models["core_dim_date"]
        ),
        "items match receipts": quality.items_vs_receipts(sales, items),
        "sales values are valid": quality.sales_out_of_range(sales, items),
        "weather values are valid": quality.weather_out_of_range(
            models["core_fct_weather_hour"], models["core_fct_weather_forecast_hour"]
        ),
    }


def mart_checks(models: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Cross-model checks of the mart layer."""
    sales = models["core_fct_sales"]
    return {
        "marts match daily sales": quality.marts_vs_sales(
            sales, models["mart_sales_weather_hourly"], models["mart_sales_weather_daily"]
        ),
        "product revenue matches sales": quality.product_revenue_vs_sales(
            models["mart_product_sales_daily"], sales
        ),
    }
