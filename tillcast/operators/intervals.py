"""Join points in time with the periods that hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days of a bucket.
BUCKET_DAYS = 7


def day_number(date_key: str) -> Column:
    """Days since 1970 of a date key such as 20240131."""
    return F.unix_date(F.to_date(F.col(date_key).cast("string"), "yyyyMMdd"))


def interval_join(
    points: DataFrame, periods: DataFrame, key: list[str], point: str, first: str, last: str, bucket_days: int = BUCKET_DAYS
) -> DataFrame:
    """The points inside a period of their key, both ends included; period columns follow, but for its bounds.

    ``point``, ``first`` and ``last`` name date keys. Periods are cut into buckets of days and the join is an equi-join
    on key and bucket, so points spread by time as well: a few keys holding all rows make no hot task. A period has a
    row for each bucket it touches; a point lies in one bucket, so it meets a period once. A null bound or point
    meets nothing, and neither does a period that ends before it starts.
    """
    number = lambda column: F.floor(day_number(column) / bucket_days).cast("int")
    cut = periods.filter(F.col(first) <= F.col(last)).withColumn("_bucket", F.explode(F.sequence(number(first), number(last))))
    found = points.withColumn("_bucket", number(point)).join(cut, [*key, "_bucket"])
    return found.filter(F.col(point).between(F.col(first), F.col(last))).drop("_bucket", first, last)
