"""Operator 8, quality rules: how much likelier a document's n-grams are in trusted text than in the corpus.

Words and word pairs are hashed to buckets. Two multinomials over the buckets, one of trusted documents and one of
the whole corpus, give each bucket a log-likelihood ratio; a document's score is the mean over its n-grams. Both count
each distinct text once, and so does the threshold, so no score depends on how many copies a text has. The least
score of a kept document follows from the scores of the trusted documents, so it fits a corpus whose languages or
sizes differ from theirs. Plain counts of words, symbols, repeated lines and repeated windows come with it.

Null and empty texts have no words: score null, not kept. Repeated rows give repeated rows. An empty corpus gives no
rows. Without trusted documents both multinomials are flat and uninformative: only the base rules decide.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import encode, filter_slices, map_slices, mixed, owners, table, windows, written

#: Hash buckets; both multinomials have this size whatever the corpus.
BUCKETS = 1 << 16
#: Added to each count.
SMOOTHING = 1.0
#: The least score of a kept document lies this far under a low quantile of the trusted documents' own scores.
LOW, MARGIN = 0.005, 0.12
#: Steps to one unit of score in the histogram that the quantile is read from.
STEPS = 1024
#: Base rules: least words, and most percent of words in repeated windows.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8

SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

SCORED = (
    "doc_id long, text_key string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_grams long, score double"
)


def buckets(ids: np.ndarray, counts: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word and each pair of neighbours, and the document of each."""
    hashes = np.array([zlib.crc32(w) | len(w) << 32 for w in words], np.uint64)[ids] if len(ids) else np.zeros(0, np.uint64)
    pairs, first = windows(hashes, counts, 2)
    of = owners(counts)
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    return (np.concatenate([mixed(hashes), pairs]) >> shift).astype(np.int64), np.concatenate([of, of[first]])


class Counter:
    """Adds up n-gram counts of a task; hands them over once."""

    def __init__(self):
        self.counts = np.zeros((2, BUCKETS), np.int64)

    def __call__(self, rows):
        ids, counts, words = encode(rows["text"])
        at, of = buckets(ids, counts, words)
        trusted = np.array(rows["trusted"], bool)[of] if len(of) else np.zeros(0, bool)
        self.counts[0] += np.bincount(at, minlength=BUCKETS)
        self.counts[1] += np.bincount(at[trusted], minlength=BUCKETS)

    def finish(self):
        some = np.flatnonzero(self.counts[0])
        return {"bucket": some, "corpus": self.counts[0][some], "target": self.counts[1][some]}


def keyed(documents: DataFrame) -> DataFrame:
    """(doc_id, text, text_key) of the documents that have a text."""
    return documents.where("text is not null").select("doc_id", "text", F.md5(F.col("text").cast("binary")).alias("text_key"))


def distinct_texts(documents: DataFrame, trusted: DataFrame) -> DataFrame:
    """(text, trusted) of each distinct text; it is trusted if one of its copies is."""
    texts = keyed(documents)
    own = texts.select("doc_id", "text_key").join(trusted, "doc_id").select("text_key").distinct().withColumn("trusted", F.lit(True))
    once = texts.groupBy("text_key").agg(F.first("text").alias("text"))
    return once.join(own, "text_key", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))


def fit(documents: DataFrame, trusted: DataFrame) -> np.ndarray:
    """The log-likelihood ratio of each bucket, from every distinct text; ``trusted`` holds the ids of the target."""
    counted = map_slices(distinct_texts(documents, trusted), Counter, "bucket long, corpus long, target long")
    sums = counted.groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("target").alias("target"))
    both = np.zeros((2, BUCKETS))
    for row in sums.collect():  # BUCKETS rows at most
        both[:, row["bucket"]] = row["corpus"], row["target"]
    if not both[1].any():
        return np.zeros(BUCKETS)
    chances = (both + SMOOTHING) / (both.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return np.log(chances[1]) - np.log(chances[0])


def repeated_words(ids: np.ndarray, counts: np.ndarray, n: int = WINDOW) -> np.ndarray:
    """Words per document that lie in a window of ``n`` words which the document holds twice or more."""
    hashes, first = windows(ids.astype(np.uint64), counts, n)
    of = owners(counts)
    key = hashes + mixed(of[first].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, first[twice], 1)
    np.add.at(edges, first[twice] + n, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(of[covered], minlength=len(counts))


def repeated_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def scores(texts: list, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean log-likelihood ratio of each text, and its n-grams."""
    ids, counts, words = encode(texts)
    at, of = buckets(ids, counts, words)
    grams = np.bincount(of, minlength=len(texts))
    return np.bincount(of, weights[at], minlength=len(texts)) / np.maximum(grams, 1), grams


def least_score(scored: DataFrame, trusted: DataFrame) -> float:
    """The threshold: LOW quantile of the scores of all distinct trusted texts, less MARGIN.

    ``scored`` has (doc_id, text_key, n_grams, score) of every document. Scores are counted in steps, so the quantile is
    the lower end of its step; a score is a mean of bounded ratios, so there are some ten thousand steps at any size.
    """
    known = scored.where((F.col("n_grams") >= LEAST_WORDS) & F.col("score").isNotNull())
    own = known.join(trusted, "doc_id").select("text_key", F.floor(F.col("score") * STEPS).alias("step")).distinct()
    counts = sorted(own.groupBy("step").agg(F.count("*").alias("n")).collect())
    wanted = LOW * sum(n for _, n in counts)
    for step, n in counts:
        wanted -= n
        if wanted <= 0:
            return step / STEPS - MARGIN
    return -np.inf


def with_scores(documents: DataFrame, weights) -> DataFrame:
    """(doc_id, text_key, n_grams, score) of the documents that have a text."""

    def make():
        def step(rows):
            score, grams = scores(rows["text"], weights.value)
            return {"doc_id": rows["doc_id"], "text_key": rows["text_key"], "n_grams": grams, "score": score}

        return step

    texts = keyed(documents).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_slices(texts, make, "doc_id long, text_key string, n_grams long, score double")


def measures(texts: list, weights: np.ndarray) -> dict:
    ids, counts, _ = encode(texts)
    score, grams = scores(texts, weights)
    repeats = repeated_words(ids, counts)
    failed = (counts < LEAST_WORDS) | (100 * repeats > MOST_REPEATED * counts)
    texts = [t or "" for t in texts]
    return {
        "n_words": counts,
        "word_chars": [len(t) - sum(map(t.count, SPACES)) for t in texts],
        "n_symbols": [len(b) - len(b.translate(None, SYMBOLS)) for b in (t.encode("utf-8", "surrogatepass") for t in texts)],
        "n_dup_lines": [repeated_lines(t) for t in texts],
        "n_repeat_words": repeats,
        "base_failed": failed,
        "n_grams": grams,
        "score": score,
    }


def good_ids(labels: DataFrame) -> DataFrame:
    """Ids of the trusted documents: those that a label calls good."""
    return written(labels.where("doc_id is not null and quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct())


def quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, score and verdict of every document."""
    trusted = good_ids(labels)
    held = documents.sparkSession.sparkContext.broadcast(fit(documents, trusted))

    def make():
        return lambda rows: {"doc_id": rows["doc_id"], "text_key": rows["text_key"], **measures(rows["text"], held.value)}

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.md5(F.col("text").cast("binary")).alias("text_key"))
    found = written(map_slices(texts, make, SCORED))
    least = least_score(found, trusted)
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("score") >= F.lit(least))).alias("kept"),
        F.when(F.col("n_grams") > 0, F.col("score")).alias("score"),
    )


def kept_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    trusted, context = good_ids(labels), documents.sparkSession.sparkContext
    held = context.broadcast(fit(documents, trusted))
    least = least_score(with_scores(documents, held), trusted)

    def keep(texts):
        found = measures(texts, held.value)
        return ~found["base_failed"] & (found["score"] >= least)

    return filter_slices(documents, lambda: keep)


def op8_quality_rules(spark, folder: str) -> DataFrame:
    return quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
