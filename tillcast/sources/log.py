"""Append-only log of keyed rows, laid out by key.

Every batch is a partition of its own, bucketed and sorted by the key, so the batches of one key lie in the same bucket.
Reading the newest row of each key groups rows where they lie: no part of the history is exchanged, however many
batches there are. A batch costs no more than its own rows; the same batch again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators.latest import latest
from tillcast.sources import tables

BATCH = "batch_id"
#: Buckets of a new log; they bound the tasks that read it, and are kept for good.
BUCKETS = 64


class Log:
    """``layer.name``: rows by batch, newest row of each key on read."""

    def __init__(self, spark: SparkSession, layer: str, name: str, key: list[str], root: str | None = None, buckets: int = BUCKETS):
        self.spark, self.layer, self.name, self.key, self.root, self.buckets = spark, layer, name, key, root, buckets

    @property
    def table(self) -> str:
        return f"{self.layer}.{self.name}"

    def exists(self) -> bool:
        return self.name in tables.table_names(self.spark, self.layer)

    def append(self, batch: DataFrame, batch_id: str) -> None:
        """Write a batch as its own partition."""
        if self.root:
            tables.ensure_layer(self.spark, self.layer, self.root)
        if not self.exists():
            empty = self.spark.createDataFrame([], batch.schema).withColumn(BATCH, F.lit(""))
            empty.write.partitionBy(BATCH).bucketBy(self.buckets, *self.key).sortBy(*self.key).format("parquet").saveAsTable(self.table)
        # Dealt out as buckets are, each task writes the one file of a bucket. The partition is named in the statement,
        # so no other can be overwritten.
        self._insert(batch.repartition(self.bucket_count(), *self.key), batch_id, "OVERWRITE TABLE")

    def _insert(self, rows: DataFrame, batch_id: str, how: str) -> None:
        # A stream's batches belong to a session of their own, and so does the view.
        view, spark = f"{self.name}_batch", rows.sparkSession
        rows.createOrReplaceTempView(view)
        columns = ", ".join(f"`{c}`" for c in rows.columns)
        spark.sql(f"INSERT {how} `{self.layer}`.`{self.name}` PARTITION ({BATCH} = '{batch_id}') SELECT {columns} FROM {view}")
        spark.catalog.dropTempView(view)
        spark.catalog.refreshTable(self.table)
        self.spark.catalog.refreshTable(self.table)

    def bucket_count(self) -> int:
        """Buckets the stored log has."""
        described = {r[0]: r[1] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED `{self.layer}`.`{self.name}`").collect()}
        return int(described["Num Buckets"])

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def current(self, newest_by: str = "loaded_at") -> DataFrame:
        """Newest row of each key; equal load times are decided by the later batch."""
        return latest(self.rows(), self.key, [newest_by, BATCH]).drop(BATCH)

    def batches(self) -> list[str]:
        found = self.spark.sql(f"SHOW PARTITIONS `{self.layer}`.`{self.name}`").collect()
        return sorted(row[0].split("=", 1)[1] for row in found)

    def versions_of(self, batches: list[str]) -> DataFrame:
        """All rows, of any batch, whose key one of the batches holds."""
        keys = self.rows().where(F.col(BATCH).isin(batches)).select(*self.key).distinct()
        return self.rows().join(keys, self.key, "left_semi")

    def compact(self, batch_id: str) -> list[str]:
        """Replace all batches by one of the rows that count; returns the former batches.

        The new batch is written before the old ones go. Readers in between see the same rows, since a row and its
        copy resolve to one; so they do when a compaction that died is done again. Rows stay in their buckets.
        """
        old = [b for b in self.batches() if b != batch_id]
        self._insert(self.current(), batch_id, "INTO TABLE")
        for batch in old:
            self.spark.sql(f"ALTER TABLE `{self.layer}`.`{self.name}` DROP IF EXISTS PARTITION ({BATCH} = '{batch}')")
        self.spark.catalog.refreshTable(self.table)
        return old
