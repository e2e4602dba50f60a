"""City reference rows and their sales profiles."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions.keys import slug
from tillcast.operators.upsert import upsert

# City name, latitude, longitude.
CITIES = [
    ("Moscow", "55.76", "37.62"),
    ("Saint Petersburg", "59.94", "30.31"),
    ("Novosibirsk", "55.03", "82.92"),
    ("Yekaterinburg", "56.84", "60.60"),
    ("Kazan", "55.79", "49.11"),
    ("Nizhny Novgorod", "56.33", "44.01"),
    ("Chelyabinsk", "55.15", "61.40"),
    ("Samara", "53.18", "50.12"),
    ("Omsk", "54.97", "73.38"),
    ("Rostov-on-Don", "47.22", "39.71"),
    ("Ufa", "54.73", "55.96"),
    ("Krasnoyarsk", "56.01", "92.87"),
    ("Perm", "58.00", "56.24"),
    ("Voronezh", "51.66", "39.20"),
    ("Volgograd", "48.71", "44.51"),
    ("Krasnodar", "45.02", "38.97"),
    ("Saratov", "51.53", "46.04"),
    ("Tyumen", "57.15", "65.53"),
    ("Tolyatti", "53.51", "49.42"),
    ("Izhevsk", "56.85", "53.22"),
]

# City slug, IANA zone, price multiplier.
PROFILES = [
    ("moscow", "Europe/Moscow", "1.20"),
    ("saint_petersburg", "Europe/Moscow", "1.15"),
    ("novosibirsk", "Asia/Novosibirsk", "1.45"),
    ("yekaterinburg", "Asia/Yekaterinburg", "1.35"),
    ("kazan", "Europe/Moscow", "1.25"),
    ("nizhny_novgorod", "Europe/Moscow", "1.22"),
    ("chelyabinsk", "Asia/Yekaterinburg", "1.38"),
    ("samara", "Europe/Samara", "1.30"),
    ("omsk", "Asia/Omsk", "1.40"),
    ("rostov_on_don", "Europe/Moscow", "1.23"),
    ("ufa", "Asia/Yekaterinburg", "1.36"),
    ("krasnoyarsk", "Asia/Krasnoyarsk", "1.50"),
    ("perm", "Asia/Yekaterinburg", "1.37"),
    ("voronezh", "Europe/Moscow", "1.24"),
    ("volgograd", "Europe/Volgograd", "1.28"),
    ("krasnodar", "Europe/Moscow", "1.21"),
    ("saratov", "Europe/Saratov", "1.29"),
    ("tyumen", "Asia/Yekaterinburg", "1.39"),
    ("tolyatti", "Europe/Samara", "1.31"),
    ("izhevsk", "Europe/Samara", "1.26"),
]


def seed_rows(spark: SparkSession, now: datetime) -> DataFrame:
    """The reference cities, stamped with ``now`` (UTC)."""
    rows = [(name, Decimal(lat), Decimal(lon), now) for name, lat, lon in CITIES]
    named = spark.createDataFrame(
        rows,
        "city_name string, latitude decimal(9,5), longitude decimal(9,5), updated_at timestamp_ntz",
    )
    return named.select(slug(F.col("city_name")).alias("city_slug"), *named.columns)


def seed_cities(spark: SparkSession, existing: DataFrame, now: datetime) -> DataFrame:
    """City table after seeding: reference rows replace rows with the same slug."""
    return upsert(existing, seed_rows(spark, now), ["city_slug"])


def profile_rows(spark: SparkSession) -> DataFrame:
    rows = [(city, zone, Decimal(multiplier)) for city, zone, multiplier in PROFILES]
    return spark.createDataFrame(
        rows, "city_slug string, timezone string, price_multiplier decimal(5,2)"
    )
