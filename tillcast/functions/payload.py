"""Weather documents: one JSON object holding parallel hourly arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the hourly arrays in a document, the published column
# for each, and its type.
MEASURES = {
    "precipitation": ("precipitation_mm", "decimal(12,5)"),
    "temperature_2m": ("temperature_c", "decimal(6,2)"),
    "surface_pressure": ("surface_pressure_hpa", "decimal(8,2)"),
    "apparent_temperature": ("apparent_temperature_c", "decimal(6,2)"),
}
FORECAST_MEASURES = {
    **MEASURES,
    "precipitation_probability": ("precipitation_probability_pct", "decimal(6,2)"),
}
COORDINATE = "decimal(9,5)"


def document_schema(measures: dict[str, tuple[str, str]]) -> str:
    # Elements stay text: with decimal elements one overflow would turn the
    # whole array into null instead of failing on that element.
    arrays = ", ".join(f"{name}: array<string>" for name in ["time", *measures])
    return f"latitude string, longitude string, hourly struct<{arrays}>"


def parse_document(payload: Column, measures: dict[str, tuple[str, str]] = MEASURES) -> Column:
    """Typed record of a document; a malformed one fails the job."""
    return F.from_json(payload, document_schema(measures), {"mode": "FAILFAST"})


def json_number(payload: Column, path: str, type_: str = COORDINATE) -> Column:
    return F.get_json_object(payload, path).cast(type_)


def hours_in(payload: Column) -> Column:
    """Length of ``hourly.time``; 0 when the array is absent."""
    times = F.from_json(payload, "hourly struct<time: array<string>>", {"mode": "FAILFAST"})
    return F.coalesce(F.size(times["hourly"]["time"]), F.lit(0))


def unnest_parallel(df: DataFrame, arrays: dict[str, Column], keep: list[Column]) -> DataFrame:
    """One row per position of arrays walked in lock-step.

    Shorter arrays are padded with null and an absent array counts as empty;
    without the ``coalesce`` a null array would remove all rows of its document.
    """
    empty = F.array().cast("array<string>")
    zipped = F.arrays_zip(*[F.coalesce(array, empty) for array in arrays.values()])
    rows = df.select(*keep, F.explode(zipped).alias("_h"))
    fields = [F.col("_h")[str(i)].alias(name) for i, name in enumerate(arrays)]
    return rows.select(*[c for c in rows.columns if c != "_h"], *fields)
