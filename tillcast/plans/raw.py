"""Load jobs of the raw layer: sales log, cities, weather documents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillcast import schemas
from tillcast.operators import loads
from tillcast.operators.upsert import upsert
from tillcast.sources import cities, readers, tables
from tillcast.sources.log import BATCH, Log
from tillcast.streaming import ingest

RAW = "raw"
# Document tables are append-only logs, a partition for each batch.
LOG_MARK = "__log"
DOCUMENTS = ["weather_archive", "weather_forecast"]


def existing(spark: SparkSession, name: str) -> DataFrame:
    """A raw table, or an empty one with its schema before the first load."""
    if name in tables.table_names(spark, RAW):
        return spark.table(f"{RAW}.{name}")
    return spark.createDataFrame([], schemas.RAW_TABLES[name])


def load_sales_log(spark: SparkSession, path: str, root: str, run_id: str) -> bool:
    """Load the base sales log once; False when it is there already."""
    return tables.create_if_absent(readers.read_sales_log(spark, path), root, RAW, "kaggle_coffee", run_id)


def seed_cities(spark: SparkSession, root: str, run_id: str, now: datetime) -> DataFrame:
    """Write the reference cities over those with the same slug; others stay."""
    seeded = cities.seed_cities(spark, existing(spark, "cities"), now)
    return tables.replace_table(seeded, root, RAW, "cities", run_id)


def document_log(spark: SparkSession, name: str, root: str | None = None) -> Log:
    """The log of a document table, laid out by its key."""
    return Log(spark, RAW, f"{name}{LOG_MARK}", schemas.RAW_KEYS[name], root)


def load_documents(landed: DataFrame, name: str, root: str, run_id: str) -> dict[str, int]:
    """Append landed weather documents to the log of their table; returns a summary.

    The cost is the batch's: nothing of the history is read or rewritten. The
    table itself is the log resolved by key, as ``read_documents`` gives it.
    A document without any hour fails the load and leaves the log as it was.
    """
    spark = landed.sparkSession
    fields: StructType = schemas.RAW_TABLES[name]
    batch = loads.reject_empty(readers.with_document(landed)).filter("hours > 0").select(*fields.names)
    log = document_log(spark, name, root)
    log.append(batch, run_id)
    return loads.load_summary(log.rows().filter(F.col(BATCH) == run_id)).first().asDict()


def stream_documents(spark: SparkSession, path: str, name: str, root: str, files_per_batch: int | None = None) -> dict[str, dict[str, int]]:
    """Load all documents that landed in a folder since the last call; returns a summary of each new batch.

    A file is loaded once. A run that fails after a batch was written and before the stream noted it writes the same
    batch again under the same name.
    """
    summaries: dict[str, dict[str, int]] = {}

    def append(batch: DataFrame, batch_id: str) -> None:
        summaries[batch_id] = load_documents(batch, name, root, batch_id)

    stream = ingest.landed(spark, path, schemas.RAW_TABLES[name], files_per_batch=files_per_batch)
    ingest.ingest(stream, append, f"{root}/checkpoints/{name}")
    return summaries


def batches(spark: SparkSession, name: str) -> list[str]:
    return document_log(spark, name).batches()


def compact(spark: SparkSession, name: str, run_id: str) -> int:
    """Replace all batches of a log by one of the rows that count; returns its former number of batches."""
    return len(document_log(spark, name).compact(run_id))


def read_documents(spark: SparkSession, name: str) -> DataFrame:
    """A document table: its resolved log, over what a snapshot restored, if any."""
    names = tables.table_names(spark, RAW)
    log, fields = document_log(spark, name), schemas.RAW_TABLES[name].names
    if not log.exists():
        return spark.table(f"{RAW}.{name}")
    if name not in names:
        return log.current().select(*fields)
    return upsert(spark.table(f"{RAW}.{name}"), log.current().select(*fields), schemas.RAW_KEYS[name])
