"""Operator 6, line dedup: a line that several documents hold stays in the document with the smallest id.

One scan hashes the lines. A task forwards a hash once, for its smallest document, and notes the lines it already knows
to be lost, so a line common to all documents sends one row per task. The rows are range-partitioned by hash and
sorted by document and position; a stream over each partition keeps the first document of a hash and gives the places
of the others. What comes out is a compressed bitmap of kept lines per document; texts are cut by it afterwards.

A null or empty text is one empty line, too short to be a repeat. A null id stands after all ids, as one document.
Rows of the same id are one document: they never lose lines to each other, also if repeated. Lines whose key is
shorter than LEAST code points stay. Keys are compared by 128-bit hash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import map_slices, table, written

#: Least code points of a key that can be a repeat.
LEAST = 10
#: A task hands over its rows at this many distinct lines.
FLUSH = 200_000

PLACES = "h1 long, h2 long, doc_id long, text_key long, place int, n_lines int"


def line_keys(text: str | None) -> list[bytes | None]:
    """The key of each line, None for one too short."""
    keys = [x.strip().lower() for x in (text or "").encode("utf-8", "surrogatepass").split(b"\n")]
    # Four bytes a code point at most: only short keys need counting.
    return [k if len(k) >= 4 * LEAST or len(k) >= LEAST and len(k.decode("utf-8", "replace")) >= LEAST else None for k in keys]


class Scan:
    """Rows of a task: one per document, one per place known to be lost, and one per distinct line."""

    def __init__(self):
        self.first: dict[bytes, tuple] = {}

    def __call__(self, rows):
        out = ([], [], [], [], [], [])
        for doc, key, text in zip(rows["doc_id"], rows["text_key"], rows["text"], strict=True):
            keys = line_keys(text)
            self.add(out, None, doc, key, None, len(keys))
            rank = (doc is None, doc or 0)
            for place, line in enumerate(keys):
                if line is None:
                    continue
                digest = hashlib.md5(line).digest()
                held = self.first.get(digest)
                if held is None or rank < held[0]:
                    if held is not None:
                        for lost in held[1]:
                            self.add(out, None, *lost, None)
                    self.first[digest] = (rank, [(doc, key, place)])
                elif rank == held[0]:
                    held[1].append((doc, key, place))
                else:
                    self.add(out, None, doc, key, place, None)
        if len(self.first) >= FLUSH:
            self.flush(out)
        return self.rows(out)

    def add(self, out, digest, *rest) -> None:
        h1, h2 = (None, None) if digest is None else (int.from_bytes(digest[k : k + 8], "big", signed=True) for k in (0, 8))
        for column, x in zip(out, (h1, h2, *rest), strict=True):
            column.append(x)

    def flush(self, out) -> None:
        for digest, (_, places) in self.first.items():
            for place in places:
                self.add(out, digest, *place, None)
        self.first = {}

    def rows(self, out) -> dict:
        return dict(zip(("h1", "h2", "doc_id", "text_key", "place", "n_lines"), out, strict=True))

    def finish(self):
        out = ([], [], [], [], [], [])
        self.flush(out)
        return self.rows(out)


def later_places(sorted_lines: DataFrame) -> DataFrame:
    """Rows, sorted by hash and document, whose document isn't the first of their hash."""
    schema = sorted_lines.select("doc_id", "text_key", "place").schema

    def run(batches):
        last = None  # hash and first document that the stream is in
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            h1, h2 = (batch.column(k).to_numpy() for k in ("h1", "h2"))
            doc = batch.column("doc_id").fill_null(0).to_numpy()
            none = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            head = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            group = np.cumsum(head) - 1
            firsts = np.flatnonzero(head)
            first_doc, first_none = doc[firsts], none[firsts]
            if last is not None and last[:2] == (h1[0], h2[0]):
                first_doc, first_none = first_doc.copy(), first_none.copy()
                first_doc[0], first_none[0] = last[2:]
            lost = (doc != first_doc[group]) | (none != first_none[group])
            last = (h1[-1], h2[-1], first_doc[-1], first_none[-1])
            yield batch.select(["doc_id", "text_key", "place"]).filter(pa.array(lost))

    return sorted_lines.mapInArrow(run, schema)


def bitmaps(rows: dict) -> dict:
    """Places lost to a compressed bitmap of lines kept, eight a byte."""
    keep = []
    for n, places in zip(rows["n_lines"], rows["places"], strict=True):
        bits = np.ones(n, bool)
        bits[np.array(places, np.int64)] = False
        keep.append(zlib.compress(np.packbits(bits).tobytes(), 1))
    return {"doc_id": rows["doc_id"], "text_key": rows["text_key"], "n_lines": rows["n_lines"], "keep": keep}


def keyed(documents: DataFrame) -> DataFrame:
    return documents.withColumn("text_key", F.xxhash64("text"))


def keep_bitmaps(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_lines, keep): a bitmap for each document that loses a line; one row for rows alike."""
    texts = keyed(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    scanned = written(map_slices(texts, Scan, PLACES))
    lines = scanned.where("h1 is not null").select("h1", "h2", "doc_id", "text_key", "place")
    ordered = lines.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", F.asc_nulls_last("doc_id"), "place")
    lost = later_places(ordered).withColumn("n_lines", F.lit(None).cast("int"))
    known = scanned.where("h1 is null").select("doc_id", "text_key", "place", "n_lines")
    per_text = lost.unionByName(known).groupBy("doc_id", "text_key").agg(F.max("n_lines").alias("n_lines"), F.collect_set("place").alias("places"))
    some = per_text.where(F.size("places") > 0)
    return map_slices(some, lambda: bitmaps, "doc_id long, text_key long, n_lines int, keep binary", text="")


def kept_text(text: str | None, keep: bytes | None) -> str | None:
    if keep is None:
        return text
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    return "\n".join([x for x, k in zip(lines, bits, strict=True) if k])


def with_bitmaps(documents: DataFrame) -> DataFrame:
    maps = keep_bitmaps(documents).select(F.col("doc_id").alias("_tillcast_id"), F.col("text_key").alias("_tillcast_key"), F.col("keep").alias("_tillcast_keep"))
    return documents.join(maps, F.col("doc_id").cast("long").eqNullSafe(F.col("_tillcast_id")) & (F.xxhash64("text") == F.col("_tillcast_key")), "left").drop("_tillcast_id", "_tillcast_key")


def dedup_lines(documents: DataFrame, least_words: int = 0) -> DataFrame:
    """The documents with repeated lines cut from their texts; other columns as they are.

    A document that loses a line and has fewer than ``least_words`` words left goes as well.
    """
    names = documents.columns

    def make():
        def step(rows):
            keeps = rows["_tillcast_keep"]
            texts = [kept_text(t, k) for t, k in zip(rows["text"], keeps, strict=True)]
            stays = [k is None or not least_words or len(t.encode("utf-8", "surrogatepass").split()) >= least_words for t, k in zip(texts, keeps, strict=True)]
            rows["text"] = texts
            return {n: [x for x, stay in zip(rows[n], stays, strict=True) if stay] for n in names}

        return step

    return map_slices(with_bitmaps(documents), make, documents.schema)


def digests(rows: dict) -> dict:
    before = [(t or "").count("\n") + 1 for t in rows["text"]]
    after = [kept_text(t, k) for t, k in zip(rows["text"], rows["_tillcast_keep"], strict=True)]
    bits = [n if k is None else int(np.unpackbits(np.frombuffer(zlib.decompress(k), np.uint8), count=n).sum()) for n, k in zip(before, rows["_tillcast_keep"], strict=True)]
    return {
        "doc_id": rows["doc_id"],
        "n_lines": before,
        "n_dropped": [n - k for n, k in zip(before, bits, strict=True)],
        "kept_sha256": [hashlib.sha256((t or "").encode("utf-8", "surrogatepass")).hexdigest() for t in after],
    }


def op6_line_dedup(spark, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return map_slices(with_bitmaps(documents), lambda: digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
