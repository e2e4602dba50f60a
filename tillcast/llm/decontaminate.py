"""Operator 7, benchmark decontamination: test suffixes looked up in suffix arrays of the training documents.

Each task cuts its documents into shards, sorts the suffixes of a shard and binary-searches every suffix of the test
items in it. A range of equal suffixes gives the places where a test window occurs; neighbouring windows merge to the
longest verbatim matches. No text is shuffled. The test set is the query set: it is sent to the tasks in blocks of
bounded size, one pass over the documents for each block.

A suffix of training words can only hold a test window if it starts in a run of words of the test vocabulary at least
as long as the shortest window, so only those runs enter the suffix array.

Null and empty texts have no words and are clean. An empty test set or one without words leaves all documents clean.
Repeated rows give repeated rows; repeated items and items that share a window each count. A null item id marks words
as hit but isn't listed. Null document ids are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import filter_slices, map_slices, table, written

#: Words of a test window; a shorter item is one window.
WINDOW = 10
#: Most bytes of test text in a block, which is what a task holds of the test set.
BLOCK_BYTES = 16 << 20
#: Cells of items that a block is made of.
CELLS = 64

#: Bytes that are no part of a word become spaces; A-Z become a-z.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

FOUND = "doc_id long, text_key string, n_words long, matches array<struct<item_id:string,start:long,item_start:long,n_words:long>>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


class Items:
    """A block of test items as word numbers, and the windows in it."""

    def __init__(self, rows: list[tuple], width: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.words, self.starts, self.widths, self.of = [], [], [], [], []
        for item_id, text in rows:
            own = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            if not own:
                continue
            w = min(width, len(own))
            n = len(own) - w + 1
            self.starts.extend(range(len(self.words), len(self.words) + n))
            self.widths.extend([w] * n)
            self.of.extend([len(self.ids)] * n)
            self.ids.append((None if item_id is None else str(item_id), len(self.words)))
            self.words.extend([*own, 0])
        self.words = np.array(self.words + [0] * width, np.int64)
        self.starts, self.widths, self.of = (np.array(x, np.int64) for x in (self.starts, self.widths, self.of))


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of non-zero numbers, sorted by the next ``depth`` numbers (prefix doubling)."""
    rank, k = text.astype(np.int64), 1
    while k < depth:
        after = np.zeros_like(rank)
        after[:-k] = rank[k:]
        rank = np.unique(rank * (after.max(initial=0) + 1) + after, return_inverse=True)[1].astype(np.int64)
        k *= 2
    order = np.argsort(rank, kind="stable")
    return order[text[order] > 0]


def compared(text: np.ndarray, at: np.ndarray, items: Items, which: np.ndarray) -> np.ndarray:
    """Sign of the suffix of ``text`` at each place against a test window."""
    sign, live, d = np.zeros(len(at), np.int8), np.arange(len(at)), 0
    starts, widths = items.starts[which], items.widths[which]
    while len(live):
        a, b = text[at[live] + d], items.words[starts[live] + d]
        sign[live] = np.sign(a - b)
        d += 1
        live = live[(a == b) & (d < widths[live])]
    return sign


def bound(text: np.ndarray, order: np.ndarray, items: Items, right: bool) -> np.ndarray:
    """Where each test window would be inserted in the suffix array, before or after equal suffixes."""
    lo, hi = np.zeros(len(items.starts), np.int64), np.full(len(items.starts), len(order), np.int64)
    while len(live := np.flatnonzero(lo < hi)):
        mid = (lo[live] + hi[live]) // 2
        sign = compared(text, order[mid], items, live)
        below = sign < (1 if right else 0)
        lo[live[below]] = mid[below] + 1
        hi[live[~below]] = mid[~below]
    return lo


def long_runs(text: np.ndarray, least: int) -> np.ndarray:
    """Which places lie in a run of at least ``least`` non-zero numbers."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (text > 0).view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    keep = ends - starts >= least
    cover = np.zeros(len(text) + 1, np.int64)
    cover[starts[keep]] += 1
    cover[ends[keep]] -= 1
    return np.cumsum(cover[:-1]) > 0


def shard_matches(texts: list[list[bytes]], items: Items) -> list[list[tuple]]:
    """For each document the longest verbatim matches: (item id, first word, first word in the item, words)."""
    found: list[list[tuple]] = [[] for _ in texts]
    if not len(items.starts):
        return found
    pieces = [np.fromiter(map(items.vocabulary.get, t, repeat(0)), np.int64, len(t)) for t in texts]
    firsts = np.cumsum([0] + [len(p) + 1 for p in pieces])
    text = np.zeros(int(firsts[-1]) + 1, np.int64)
    for p, at in zip(pieces, firsts, strict=False):
        text[at : at + len(p)] = p
    keep = long_runs(text, int(items.widths.min()))
    if not keep.any():
        return found
    # Runs stay apart: the place after each run holds 0.
    places = np.flatnonzero(keep | np.concatenate([[False], keep[:-1]]))
    runs = np.concatenate([text[places] * keep[places], np.zeros(int(items.widths.max()), np.int64)])
    order = suffix_array(runs, int(items.widths.max()))
    lo, hi = bound(runs, order, items, False), bound(runs, order, items, True)
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    at = places[order[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]]
    # Windows that follow each other in both texts lie on one diagonal.
    start = items.starts[which]
    by = np.lexsort((at, start - at, items.of[which]))
    at, start, which = at[by], start[by], which[by]
    same = (np.diff(at) == 1) & (np.diff(start) == 1) & (np.diff(items.of[which]) == 0)
    head = np.flatnonzero(np.concatenate([[True], ~same])) if len(at) else np.zeros(0, np.int64)
    tail = np.concatenate([head[1:], [len(at)]]) - 1 if len(head) else head
    for h, t in zip(head, tail, strict=True):
        doc = int(np.searchsorted(firsts, at[h], "right")) - 1
        item_id, first = items.ids[items.of[which[h]]]
        found[doc].append((item_id, int(at[h] - firsts[doc]), int(start[h] - first), int(at[t] - at[h] + items.widths[which[t]])))
    return found


def passed(documents: DataFrame, rows: list[tuple]) -> DataFrame:
    """One pass: the matches of every document with a block of test items."""
    held = documents.sparkSession.sparkContext.broadcast(rows)

    def make():
        items = Items(held.value)

        def step(rows):
            texts = [words(t) for t in rows["text"]]
            matches = shard_matches(texts, items)
            return {
                "doc_id": rows["doc_id"],
                "text_key": [hashlib.md5((t or "").encode("utf-8", "surrogatepass")).hexdigest() if m else None for t, m in zip(rows["text"], matches, strict=True)],
                "n_words": [len(t) for t in texts],
                "matches": [[dict(zip(("item_id", "start", "item_start", "n_words"), x, strict=True)) for x in m] for m in matches],
            }

        return step

    return map_slices(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, FOUND)


def packed(sizes: list[tuple[int, int]], most: int) -> Iterator[tuple[int, int]]:
    """Ranges (first, last) of cells, given in order with their bytes, of at most ``most`` bytes or of one cell."""
    first = last = None
    held = 0
    for cell, size in sizes:
        if first is not None and held + size > most:
            yield first, last
            first, held = None, 0
        first = cell if first is None else first
        last, held = cell, held + size
    if first is not None:
        yield first, last


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """Distinct rows of the test set in blocks of whole items, read one after another.

    Items are hashed to CELLS cells a block; neighbouring cells make a block as long as their bytes fit. Only an item
    that is larger than a block, or shares its cell with such, makes a larger one.
    """
    items = benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    bytes_of = F.octet_length("text") + 64
    total = items.agg(F.sum(bytes_of)).first()[0] or 0
    cell = F.pmod(F.xxhash64("item_id", "text"), F.lit(CELLS * max(1, -(-total // block_bytes))))
    sizes = sorted(tuple(r) for r in items.groupBy(cell.alias("cell")).agg(F.sum(bytes_of)).collect())
    ranges = list(packed(sizes, block_bytes)) if total > block_bytes else [(0, CELLS)]
    for first, last in ranges:
        yield [tuple(r) for r in items.where(cell.between(first, last)).collect()]


def find_matches(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document its words and its longest verbatim matches with test items, of a window at least."""
    passes = [passed(documents, block) for block in item_blocks(benchmark, block_bytes)]
    if len(passes) == 1:
        return passes[0].drop("text_key")
    # Rows alike in id and text have the same matches, so each pass needs one of them.
    hits = passes[0].where(F.size("matches") > 0)
    for more in passes[1:]:
        hits = hits.unionByName(more.where(F.size("matches") > 0))
    hits = written(hits).distinct().groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("matches")).alias("matches"))
    every = documents.select(F.col("doc_id").cast("long").alias("id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key"), "text")
    counted = map_slices(every, lambda: lambda rows: {"id": rows["id"], "key": rows["key"], "n_words": [len(words(t)) for t in rows["text"]]}, "id long, key string, n_words long")
    none = F.array().cast("array<struct<item_id:string,start:long,item_start:long,n_words:long>>")
    return counted.join(hits, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")), "left").select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("matches", none).alias("matches")
    )


def covered(matches) -> F.Column:
    """Words that lie in any of the matches, from matches sorted by start."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("a"), (m["start"] + m["n_words"]).alias("z"))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    add = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0).cast("long"), s["z"] - F.greatest(s["a"], acc["end"]))).alias("n"),
        F.greatest(acc["end"], s["z"]).alias("end"),
    )
    return F.aggregate(spans, zero, add, lambda acc: acc["n"])


def digest(found: DataFrame) -> DataFrame:
    """Counts and item list of each document's matches."""
    ids = F.array_sort(F.array_distinct(F.transform(F.filter("matches", lambda m: m["item_id"].isNotNull()), lambda m: m["item_id"])))
    hit = covered(F.col("matches"))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("matches") > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["n_words"])), F.lit(0).cast("long")).alias("longest"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without a test window, with all their columns."""
    for block in item_blocks(benchmark, block_bytes):
        held = documents.sparkSession.sparkContext.broadcast(block)

        def make(held=held):
            items = Items(held.value)
            return lambda texts: [not m for m in shard_matches([words(t) for t in texts], items)]

        documents = filter_slices(documents, make)
    return documents


def op7_decontaminate(spark, folder: str) -> DataFrame:
    return digest(find_matches(table(spark, folder, "documents"), table(spark, folder, "benchmark")))
