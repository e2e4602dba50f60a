"""JDBC scan and sink.

Connection details are passed in by the caller (``user``, ``password``,
``driver`` as properties); this module only shapes the parallelism.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """Range split of a scan over a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def scan_options(url: str, table: str, split: Split, fetch_size: int = 10_000) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    return {**options, **split.options()}


def read_table(spark: SparkSession, url: str, table: str, split: Split, **properties: str) -> DataFrame:
    """Table scan; each task reads one range of the split over its own connection."""
    return spark.read.format("jdbc").options(**scan_options(url, table, split), **properties).load()


def write_table(df: DataFrame, url: str, table: str, connections: int = 2, **properties: str) -> None:
    """Create the table and fill it; an existing table is an error.

    ``connections`` bounds the load on the database, not Spark's parallelism.
    """
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, numPartitions=str(connections), **properties)
        .mode("errorifexists")
        .save()
    )
