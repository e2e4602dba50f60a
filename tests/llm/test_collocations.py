"""Phrase collocations against a plain count, with tries that burst and spill at once."""

import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import tables as T  # noqa: E402
from tillcast.llm import collocations as M  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=10, top=2000):
    counts = defaultdict(Counter)
    for r in rows:
        own = counts["und" if r["lang"] is None else r["lang"]]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r["text"] or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                own.update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    out = []
    for lang, own in counts.items():
        total = sum(f for w, f in own.items() if len(w) == 1)
        some = {w: f for w, f in own.items() if len(w) > 1 and f >= least}
        scored = []
        for w, a in some.items():
            if any(len(x) > len(w) and 100 * f >= 50 * a and any(x[k : k + len(w)] == w for k in range(len(x))) for x, f in some.items()):
                continue
            score, k = min((1_000_000 * a * a // (own[w[:k]] * own[w[k:]]), k) for k in range(1, len(w)))
            scored.append((-score, -a, " ".join(w).encode(), own[w[:k]], own[w[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(out)


def found(frame):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in frame.collect())


@pytest.fixture(scope="module")
def edges(tmp_path_factory):
    return T.folder(tmp_path_factory.mktemp("edges"))


def test_edge_rows(spark, edges):
    expected = plain(T.documents())
    assert found(M.op12_collocations(spark, edges)) == expected and len(expected) > 3


def test_lower_bounds_and_ties(spark):
    texts = [("a b c. A\tB  c! x", "en")] * 4 + [("b c", None), ("", "en"), (None, None), ("z z z z", "de"), ("x. y", "en")]
    rows = [{"text": t, "lang": g} for t, g in texts]
    docs = spark.createDataFrame(texts, "text string, lang string")
    for least in (1, 2, 8):
        assert found(M.collocations(docs, least, 3)) == plain(rows, least, 3)


def test_small_tries_burst_and_spill(spark, edges, monkeypatch):
    for name, size in (("BURST", 8), ("HELD", 64), ("NUMBERED", 100), ("PIECE", 7), ("MERGED", 16)):
        monkeypatch.setattr(M, name, size)
    assert found(M.op12_collocations(spark, edges)) == plain(T.documents())


def test_words_of_one_hash_are_told_apart(spark, monkeypatch):
    hashed = M.xxhash.xxh64_intdigest

    def narrow(word, salt):
        return hashed(word, salt) if salt else hashed(word, 0) % 3 + 1

    rows = [{"text": "red house. blue house. red sky", "lang": "en"}] * 5
    docs = spark.createDataFrame([("red house. blue house. red sky", "en")] * 5, "text string, lang string")
    own = {"salt": 0}
    counter = M.Counter

    def make(buckets, salt):
        made = counter(buckets, salt)
        made.hashes = lambda: np.concatenate([[0], np.array([narrow(w, salt) for w in made.numbers], np.uint64).view(np.int64)]).astype(np.int64)
        own["salt"] = salt
        return made

    monkeypatch.setattr(M, "Counter", make)
    assert found(M.collocations(docs, 2, 10)) == plain(rows, 2, 10)


def test_scores_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    rows = [(10**11 + k, 10**11 + 7 * k + 3, 10**12 - k) for k in range(50)]
    frame = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", M.score(F.col("a"), F.col("l"), F.col("r")).alias("score"))
    for a, left, right, score in frame.collect():
        assert score == 1_000_000 * a * a // (left * right)


def test_trie_counts_and_spills_whole_subtrees(monkeypatch):
    monkeypatch.setattr(M, "BURST", 4)
    draw = np.random.default_rng(12)
    trie, expected = M.Trie(), Counter()
    for _ in range(20):
        codes = np.unique(draw.integers(1, 300, 50) << (2 * M.BITS) | draw.integers(1, 9, 50) << M.BITS)
        counts = draw.integers(1, 5, len(codes))
        trie.add(codes, counts)
        expected.update(dict(zip(codes.tolist(), counts.tolist(), strict=True)))
    assert trie.size == len(expected) and isinstance(trie.root, list)
    out = Counter()
    for keep in (trie.size // 2, 0):
        for codes, counts in trie.spill(keep):
            assert (np.diff(codes) > 0).all()
            out.update(dict(zip(codes.tolist(), counts.tolist(), strict=True)))
        assert trie.size <= keep
    assert out == expected
