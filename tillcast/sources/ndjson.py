"""Newline-delimited JSON export that keeps decimals and instants exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, StructField, TimestampNTZType, TimestampType

from tillcast.functions import clock


def json_value(field: StructField) -> Column:
    """Decimals and instants as text, other values as they are; NaN is an error."""
    value = F.col(field.name)
    if isinstance(field.dataType, DecimalType):
        value = value.cast("string")
    elif isinstance(field.dataType, TimestampNTZType):
        value = clock.iso_utc(value)
    elif isinstance(field.dataType, TimestampType):
        value = clock.iso_utc(clock.utc_wall(value))
    elif isinstance(field.dataType, (DoubleType, FloatType)):
        infinite = F.abs(value) == F.lit(float("inf"))
        refused = F.raise_error(F.lit(f"{field.name} is not a finite number"))
        value = F.when(F.isnan(value) | infinite, refused.cast(field.dataType)).otherwise(value)
    return value.alias(field.name)


def json_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.select([json_value(df.schema[name]) for name in columns or df.columns])


def json_lines(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One text column ``line`` per row; null fields keep their key."""
    rows = json_rows(df, columns)
    line = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return rows.select(line.alias("line"))


def write_ndjson(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    json_rows(df, columns).write.mode("errorifexists").option("ignoreNullFields", False).json(path)
