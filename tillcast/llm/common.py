"""Helpers the operators share: tables, folds, slices of texts, words and shared storage."""

from __future__ import annotations

import sys
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Task code travels with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules["tillcast.llm"])

#: Text bytes that a task handles at once; a longer document is a slice of its own.
SLICE_BYTES = 4 << 20

MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; where that is unset, under the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends at files that outlive executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def labelled_sample(labels: DataFrame, value: str, rows: int, where: Column | None = None) -> DataFrame:
    """At most ``rows`` labelled ids in hash order (id, value), one row per id; a repeated id takes its largest value."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(value).isNotNull())
    if where is not None:
        known = known.where(where)
    single = known.groupBy("doc_id").agg(F.max(value).alias(value))
    return single.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of at most ``limit`` text bytes, one row at least."""
    if not batch.num_rows:
        return
    if not text:
        yield batch
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        base = ends[at] - sizes[at]
        stop = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def map_slices(df: DataFrame, make: Callable, schema: str | StructType, text: str = "text") -> DataFrame:
    """Run ``make()`` once per task and apply it to slices of rows, columns as lists in and out.

    Without a ``text`` column to measure, slices are Spark's own batches.
    What ``make`` returns may have a ``finish`` method, called after the last slice for rows gathered over a task.
    """
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(batches):
        step = make()
        for batch in batches:
            for part in slices(batch, text):
                out = step(part.to_pydict())
                if out is not None:
                    yield pa.RecordBatch.from_pydict(out, schema=arrow)
        if hasattr(step, "finish"):
            out = step.finish()
            if out is not None:
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(run, kind)


def filter_slices(df: DataFrame, make: Callable, text: str = "text") -> DataFrame:
    """The rows that ``make()``, run once per task, marks as kept from the texts of a slice; nothing is shuffled."""

    def run(batches):
        keep = make()
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(pa.array(np.asarray(keep(part.column(text).to_pylist()), bool)))

    return df.mapInArrow(run, df.schema)


def encode(texts: list, lower: bool = False) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word ids, words per text and the distinct words of texts; words are runs of bytes outside ``[\\x20\\x09-\\x0D]``."""
    seen: dict = defaultdict()
    seen.default_factory = seen.__len__
    ids: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        if text:
            raw = text.encode("utf-8", "surrogatepass")
            words = (raw.lower() if lower else raw).split()
            ids.extend(map(seen.__getitem__, words))
            counts[k] = len(words)
    # The dict holds a method of its own: a cycle that would keep all words until Python collects garbage.
    seen.default_factory = None
    return np.array(ids, np.int64), counts, list(seen)


def owners(counts: np.ndarray) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(counts)), counts)


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well-spread bits of 64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def windows(values: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``n`` values that lies in one text, and the index of its first value."""
    if len(values) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(len(values) - n + 1, np.uint64)
    for k in range(n):
        h = h * MIX + values[k : len(values) - n + 1 + k]
    ends = np.repeat(np.cumsum(counts), counts)
    first = np.flatnonzero(np.arange(len(h)) + n <= ends[: len(h)])
    return mixed(h[first]), first
