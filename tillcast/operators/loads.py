"""Summary of a load of weather documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.payload import hours_in

# Fixed value: a forecast covers three days.
FORECAST_DAYS = 3


def with_hours(documents: DataFrame) -> DataFrame:
    return documents.withColumn("hours", hours_in(F.col("payload")))


def reject_empty(documents: DataFrame) -> DataFrame:
    """Pass documents through; one without any hour fails the job that reads it."""
    counted = with_hours(documents)
    refused = F.raise_error(F.concat(F.lit("no hours in the document of "), F.col("city_slug")))
    return counted.withColumn(
        "hours", F.when(F.col("hours") == 0, refused.cast("int")).otherwise(F.col("hours"))
    )


def incomplete(documents: DataFrame, expected_hours: int = FORECAST_DAYS * 24) -> DataFrame:
    """Documents with fewer hours than expected."""
    return with_hours(documents).filter(F.col("hours") < expected_hours)


def load_summary(documents: DataFrame, expected_hours: int = FORECAST_DAYS * 24) -> DataFrame:
    """One row: documents, hours in total, documents that are short."""
    return with_hours(documents).agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum("hours"), F.lit(0)).alias("total_hours"),
        F.count_if(F.col("hours") < expected_hours).alias("incomplete"),
    )
