"""Operator 9, language ID: rank-order profiles of character n-grams compared by out-of-place distance.

A profile is the list of a language's most frequent n-grams of 1 to 3 letters, words bounded by blanks, counted over
all training texts. A document's own most frequent n-grams are ranked alike; the distance to a language is the sum of
rank differences, an n-gram that the profile lacks counting as the longest profile. The nearest language wins, the
first by name among equals. The score is 1 minus the distance over the greatest possible distance.

A null text, or one without a letter, is ``und`` with score 0; so is every text if nothing could be learned. Training
rows need a text and a language. A null id learns. Repeated rows give repeated rows; an empty table gives no rows.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import MIX, fold, map_slices, table

#: N-grams in a profile, and the longest n-gram.
RANKS, LONGEST = 300, 3
#: A task hands over its counts at this many distinct n-grams.
FLUSH = 1 << 20

#: Bits of an n-gram's hash; the document's number in its slice stands above them.
GRAM_BITS = np.uint64(44)
UNKNOWN = "und"


def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_counts(texts: list, is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, n-gram and count of each n-gram of each text."""
    points, sizes = [], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        own = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        own = np.where(is_letter[own], own, 0)
        own = own[np.concatenate([[True], (own[1:] != 0) | (own[:-1] != 0)])]
        points.append(own)
        sizes[k] = len(own)
    text = np.concatenate(points).astype(np.uint64) if points else np.zeros(0, np.uint64)
    of = np.repeat(np.arange(len(texts), dtype=np.uint64), sizes)
    keys = []
    gram = np.zeros(len(text), np.uint64)
    for n in range(1, LONGEST + 1):
        # A blank may stand first or last in an n-gram but not within, and not alone.
        gram = (gram[: len(text) - n + 1] << np.uint64(21)) | text[n - 1 :]
        first, last = text[: len(gram)], text[n - 1 :]
        good = (of[: len(gram)] == of[n - 1 :]) & ((first != 0) | (last != 0))
        for k in range(1, n - 1):
            good &= text[k : k + len(gram)] != 0
        keys.append((of[: len(gram)][good] << GRAM_BITS) | ((gram[good] + np.uint64(n)) * MIX >> (np.uint64(64) - GRAM_BITS)))
    both, counts = np.unique(np.concatenate(keys), return_counts=True)
    return (both >> GRAM_BITS).astype(np.int64), (both & ((np.uint64(1) << GRAM_BITS) - np.uint64(1))).astype(np.int64), counts


def summed(langs: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((grams, langs))
    langs, grams, counts = langs[order], grams[order], counts[order]
    head = np.flatnonzero(np.concatenate([[True], (np.diff(grams) != 0) | (np.diff(langs) != 0)])) if len(grams) else np.zeros(0, np.int64)
    return langs[head], grams[head], np.add.reduceat(counts, head) if len(head) else counts


class Tally:
    """Counts n-grams by language over a task."""

    def __init__(self):
        self.names: dict[str, int] = {}
        self.letters = letters()
        self.held = [np.zeros(0, np.int64)] * 3

    def __call__(self, rows):
        docs, grams, counts = gram_counts(rows["text"], self.letters)
        lang = np.array([self.names.setdefault(x, len(self.names)) for x in rows["lang"]], np.int64)
        more = summed(lang[docs], grams, counts)
        self.held = summed(*(np.concatenate(x) for x in zip(self.held, more, strict=True)))
        if len(self.held[0]) >= FLUSH:
            return self.finish()
        return None

    def finish(self):
        (langs, grams, counts), self.held = self.held, [np.zeros(0, np.int64)] * 3
        names = np.array(list(self.names), object)
        return {"lang": names[langs] if len(langs) else [], "gram": grams, "n": counts}


def fit(training: DataFrame, ranks: int = RANKS) -> dict[str, np.ndarray]:
    """Each language's n-grams by falling count, ties by n-gram; ``training`` has ``text`` and ``lang``."""
    known = training.where("text is not null and lang is not null").select("text", "lang")
    counts = map_slices(known, Tally, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place).where(F.col("place") <= ranks)
    profiles: dict[str, np.ndarray] = {}
    for lang, part in top.select("lang", "gram", "place").toPandas().groupby("lang"):
        profiles[lang] = part.sort_values("place")["gram"].to_numpy(np.int64)
    return profiles


class Profiles:
    """Ranks of all profiles in one table by n-gram."""

    def __init__(self, profiles: dict[str, np.ndarray], ranks: int = RANKS):
        self.names, self.ranks, self.letters = sorted(profiles), ranks, letters()
        self.grams = np.unique(np.concatenate([*profiles.values(), np.zeros(0, np.int64)]))
        self.place = np.full((len(self.grams) + 1, len(self.names)), -1, np.int64)
        for k, name in enumerate(self.names):
            self.place[np.searchsorted(self.grams, profiles[name]), k] = np.arange(len(profiles[name]))

    def predict(self, texts: list) -> tuple[list[str], np.ndarray]:
        docs, grams, counts = gram_counts(texts, self.letters)
        order = np.lexsort((grams, -counts, docs))
        docs, grams = docs[order], grams[order]
        starts = np.searchsorted(docs, np.arange(len(texts)))
        rank = np.arange(len(docs)) - starts[docs]
        top = rank < self.ranks
        docs, grams, rank = docs[top], grams[top], rank[top]
        at = np.searchsorted(self.grams, grams)
        found = np.append(self.grams, -1)[at] == grams
        place = self.place[np.where(found, at, len(self.grams))]
        out = np.where(place < 0, self.ranks, np.abs(place - rank[:, None]))
        sums = np.stack([np.bincount(docs, out[:, k], minlength=len(texts)) for k in range(len(self.names))], axis=1) if self.names else np.zeros((len(texts), 0))
        n = np.bincount(docs, minlength=len(texts))
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = sums.argmin(axis=1)
        score = np.where(n > 0, 1 - sums[np.arange(len(texts)), best] / np.maximum(n * self.ranks, 1), 0.0)
        return [self.names[b] if k else UNKNOWN for b, k in zip(best, n, strict=True)], score


def predict(documents: DataFrame, profiles: dict[str, np.ndarray], ranks: int = RANKS) -> DataFrame:
    """Language and score of every document; columns ``doc_id``, ``held_out`` and ``text`` go in."""
    held = documents.sparkSession.sparkContext.broadcast(profiles)

    def make():
        table = Profiles(held.value, ranks)

        def step(rows):
            langs, score = table.predict(rows["text"])
            return {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "lang_pred": langs, "score": score}

        return step

    return map_slices(documents.select("doc_id", "held_out", "text"), make, "doc_id long, held_out boolean, lang_pred string, score double")


def op9_language_id(spark, folder: str) -> DataFrame:
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    return predict(documents, fit(documents.where("not held_out")))
