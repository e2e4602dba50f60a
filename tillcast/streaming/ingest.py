"""Idempotent ingest of landed files with Structured Streaming.

Each micro-batch becomes one batch of a keyed log, named by its batch id. A batch that runs twice replaces itself, so a
failure between the write and the stream's commit repeats no row, and a batch costs no more than its own rows however
long the history is. Readers resolve the log to one row per key, newest load first, so late and corrected rows
supersede old ones without a state store. Batch ids only mean something together with the stream's checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

#: Begins the name of a batch that a stream appended; sorts behind run ids, which are numbers.
STREAMED = "stream-"


def landed(spark: SparkSession, path: str, schema: StructType, fmt: str = "json", glob: str | None = None,
           files_per_batch: int | None = None) -> DataFrame:
    """Stream of the files that land in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def start_ingest(stream: DataFrame, append: Callable[[DataFrame, str], None], checkpoint: str) -> StreamingQuery:
    """Hand all files that have landed since the last run to ``append``, batch by batch, then stop."""

    def take(batch: DataFrame, batch_id: int) -> None:
        append(batch, f"{STREAMED}{batch_id:010d}")

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest(stream: DataFrame, append: Callable[[DataFrame, str], None], checkpoint: str) -> None:
    start_ingest(stream, append, checkpoint).awaitTermination()
