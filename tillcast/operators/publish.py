"""Publish a mart: write a copy, verify it, then show it to readers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

from tillcast.contracts import MartSpec
from tillcast.functions import clock
from tillcast.sources import tables
from tillcast.sources.days import DayTable



class PublishError(ValueError):
    """The mart does not meet its contract or the copy differs from it."""


def _typed(df: DataFrame, name: str, target: DataType) -> Column:
    value = F.col(name)
    if isinstance(target, TimestampType) and isinstance(df.schema[name].dataType, TimestampNTZType):
        return clock.as_instant(value).alias(name)
    return value.cast(target).alias(name)


def to_contract(df: DataFrame, spec: MartSpec) -> DataFrame:
    """Columns of the contract, in its order and types; other columns are left out."""
    missing = [c for c in spec.columns if c not in df.columns]
    if missing:
        raise PublishError(f"{spec.model} lacks columns {missing}")
    return df.select([_typed(df, field.name, field.dataType) for field in spec.schema.fields])


def statistics(df: DataFrame, spec: MartSpec) -> DataFrame:
    """One row: row count and control sums."""
    sums = [F.sum(c).alias(c) for c in spec.sum_columns]
    return df.agg(F.count("*").alias("row_count"), *sums)


def verification(df: DataFrame, spec: MartSpec) -> DataFrame:
    """One row: statistics, distinct keys, and rows that break the contract.

    The key is counted as one struct, so a null part still counts.
    """
    nulls = F.count_if(_any(F.col(c).isNull() for c in spec.required)).alias("null_rows")
    negatives = F.count_if(_any(F.col(c) < 0 for c in spec.unsigned)).alias("negative_rows")
    return df.agg(
        F.count("*").alias("row_count"),
        *[F.sum(c).alias(c) for c in spec.sum_columns],
        F.count_distinct(F.struct(*spec.unique_key)).alias("distinct_keys"),
        nulls,
        negatives,
    )


def _any(tests) -> Column:
    result = F.lit(False)
    for test in tests:
        result = result | test
    return result


def compare(expected: dict, actual: dict, spec: MartSpec) -> None:
    """Raise unless the copy has the same counts and sums, whole keys and valid rows."""
    for name in ("row_count", *spec.sum_columns):
        if _exact(expected[name]) != _exact(actual[name]):
            raise PublishError(f"{name} of {spec.model} changed: {expected[name]} became {actual[name]}")
    if actual["distinct_keys"] != actual["row_count"]:
        raise PublishError(f"{spec.model} has duplicate keys")
    if actual["null_rows"] or actual["negative_rows"]:
        raise PublishError(
            f"{spec.model} has {actual['null_rows']} rows with a missing value "
            f"and {actual['negative_rows']} with a negative count"
        )


def _exact(value) -> Decimal | None:
    return None if value is None else Decimal(str(value))


def clustered(df: DataFrame, spec: MartSpec) -> DataFrame:
    """Range-partitioned and sorted by the mart's sort key, so that files carry
    narrow min/max ranges. The key is unique, so no range can grow hot."""
    return df.repartitionByRange(*spec.sort_key).sortWithinPartitions(*spec.sort_key)


@contextmanager
def claimed(spark: SparkSession, spec: MartSpec, root: str, run_id: str) -> Iterator[None]:
    """Hold the mart for one publisher."""
    try:
        with tables.claimed(spark, root, spec.layer, spec.table, run_id):
            yield
    except tables.ClaimedError as error:
        raise PublishError(f"{spec.model} is being published by another run: {error}") from error


def publish_mart(source: DataFrame, spec: MartSpec, root: str, run_id: str) -> dict[str, str]:
    """Publish a materialised mart and return its verified statistics as text.

    ``source`` must read a written table: its statistics and its rows are then
    those of one version. Readers keep the former version until the last step,
    and a copy that fails is dropped. A second publisher is refused.
    """
    spark = source.sparkSession
    expected = statistics(source, spec).first().asDict()
    if expected["row_count"] == 0:
        raise PublishError(f"{spec.model} is empty and will not be published")
    with claimed(spark, spec, root, run_id):
        copy = clustered(to_contract(source, spec), spec)
        version = tables.write_version(copy, root, spec.layer, spec.table, run_id)
        try:
            actual = verification(spark.table(version), spec).first().asDict()
            compare(expected, actual, spec)
        except Exception:
            tables.refuse(spark, version)
            raise
        tables.point_to(spark, spec.layer, spec.table, version)
    shown = {name: str(actual[name]) for name in ("row_count", *spec.sum_columns)}
    return {"table": f"{spec.layer}.{spec.table}", **shown}


def publish_days(
    source: DataFrame, spec: MartSpec, root: str, run_id: str, days: Iterable[int] | None = None, day: str = "date_key"
) -> dict[str, str]:
    """Publish the rows of some days of a materialised mart, or, without ``days``, all of it.

    The days' rows are written beside what readers see and compared with the source; then all days change at once. The
    key holds the day, so rows of other days can't repeat it. Days without rows any more are empty afterwards.
    """
    spark = source.sparkSession
    if day not in spec.unique_key:
        raise PublishError(f"the key of {spec.model} doesn't hold its day {day}")
    expected = statistics(source, spec).first().asDict()
    if expected["row_count"] == 0 and days is None:
        raise PublishError(f"{spec.model} is empty and will not be published")
    table = DayTable(spark, root, spec.layer, spec.table, day)
    with claimed(spark, spec, root, run_id):
        staged = table.stage(to_contract(source, spec), run_id, [c for c in spec.sort_key if c != day])
        actual = verification(staged, spec).first().asDict()
        compare(expected, actual, spec)
        table.show(run_id, days)
    shown = {name: str(actual[name]) for name in ("row_count", *spec.sum_columns)}
    return {"table": f"{spec.layer}.{spec.table}", **shown}
