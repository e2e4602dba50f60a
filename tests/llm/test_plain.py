"""Fitted and searched results held against plain versions: sums written out, gradients by differences, paths tried one by one."""

import itertools
import math
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import tables as T  # noqa: E402
from tillcast.llm import language_id, lattice_lm, near_duplicates, personal_data, quality_classifier, quality_rules  # noqa: E402

ALL = (1 << 64) - 1
FACTOR = 0x9E3779B97F4A7C15


def spread(x: int) -> int:
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD & ALL
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 & ALL
    return x ^ x >> 33


def polynomial(values) -> int:
    h = 0
    for v in values:
        h = (h * FACTOR + v) & ALL
    return h


TEXTS = ["the the river runs", "", None, "ñç é river", "one", "a" * 300, "Stone stone, stone stone"]


# --- op1: mean of vectors, softmax, a step of descent ------------------------------------------


def plain_rows(word: str) -> list[int]:
    points = [ord(c) for c in f"<{word}>"]
    keys = [spread(sum(spread(c + (k << 21)) for k, c in enumerate(points)) & ALL)]
    for n in (3, 4):
        keys += [spread((polynomial(points[k : k + n]) + n) & ALL) for k in range(len(points) - n + 1)]
    return [k >> 48 for k in keys]


def test_means_of_subword_vectors():
    model = quality_classifier.Model()
    found = quality_classifier.averages(TEXTS, model.vectors)
    for text, mean in zip(TEXTS, found, strict=True):
        words = (text or "").split()
        words = [quality_classifier.REPEAT.decode() if k and words[k - 1] == w else w for k, w in enumerate(words)]
        rows = [r for w in words for r in plain_rows(w)]
        expected = sum((model.vectors[r].astype(float) for r in rows), np.zeros(quality_classifier.LENGTH)) / max(1, len(rows))
        assert np.allclose(mean, expected, atol=1e-6)


def test_a_step_follows_the_gradient_of_the_loss():
    draw = np.random.default_rng(5)
    vectors, layer, bias = draw.normal(size=(6, quality_classifier.LENGTH)), draw.normal(size=(quality_classifier.LENGTH, 2)), draw.normal(size=2)
    rows, weights = np.array([1, 3, 4]), np.array([0.5, 0.2, 0.3])

    def loss(vectors, layer, bias):
        z = (weights[:, None] * vectors[rows]).sum(axis=0) @ layer + bias
        return -(z[1] - math.log(sum(math.exp(x) for x in z)))

    parts = {"vectors": vectors, "layer": layer, "bias": bias}
    gradients = {}
    for name, value in parts.items():
        gradients[name] = np.zeros(value.shape)
        for at in np.ndindex(value.shape):
            near = {k: v.copy() for k, v in parts.items()}
            near[name][at] += 1e-6
            far = {k: v.copy() for k, v in parts.items()}
            far[name][at] -= 1e-6
            gradients[name][at] = (loss(**near) - loss(**far)) / 2e-6
    model = quality_classifier.Model(vectors.copy(), layer.copy(), bias.copy()).train([(rows, weights, 1)], epochs=1, step=0.25)
    assert np.allclose(model.vectors, vectors - 0.25 * gradients["vectors"], atol=1e-7)
    assert np.allclose(model.layer, layer - 0.25 * gradients["layer"], atol=1e-7)
    assert np.allclose(model.bias, bias - 0.025 * gradients["bias"], atol=1e-7)


# --- op9: profiles and out-of-place distance ---------------------------------------------------


def plain_grams(text) -> Counter:
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    marked = " " + " ".join(words) + " " if words else " "
    grams = Counter()
    for n in (1, 2, 3):
        for k in range(len(marked) - n + 1):
            gram = marked[k : k + n]
            if " " not in gram[1:-1] and not (gram[0] == " " and gram[-1] == " "):
                packed = 0
                for c in gram:
                    packed = (packed << 21 | (0 if c == " " else ord(c))) & ALL
                grams[((packed + n) * FACTOR & ALL) >> 20] += 1
    return grams


def ranked(grams: Counter, n: int) -> list[int]:
    return [g for g, _ in sorted(grams.items(), key=lambda x: (-x[1], x[0]))[:n]]


@pytest.mark.parametrize("ranks", [300, 12])
def test_language_profiles_and_distances(spark, ranks):
    training = [(T.prose(k), "aa") for k in range(8)] + [(T.prose(k)[::-1], "bb") for k in range(8)] + [("ñç été naïve", "cc"), (None, "dd"), ("abc", None)]
    profiles = language_id.fit(spark.createDataFrame(training, "text string, lang string"), ranks)
    plain = {}
    for lang in ("aa", "bb", "cc"):
        plain[lang] = ranked(sum((plain_grams(t) for t, own in training if own == lang and t), Counter()), ranks)
    assert {k: v.tolist() for k, v in profiles.items()} == plain
    texts = [*TEXTS, T.prose(50), T.prose(51)[::-1], "12 34", "퟿ été"]
    langs, scores = language_id.Profiles(profiles, ranks).predict(texts)
    for text, lang, score in zip(texts, langs, scores, strict=True):
        own = ranked(plain_grams(text), ranks)
        far = {k: sum(abs(p.index(g) - r) if g in p else ranks for r, g in enumerate(own)) for k, p in plain.items()}
        best = min(sorted(far), key=far.get)
        assert (lang, score) == ((best, pytest.approx(1 - far[best] / (len(own) * ranks))) if own else ("und", 0))


# --- op8: ratio and threshold ------------------------------------------------------------------


def plain_buckets(text) -> list[int]:
    hashes = [zlib.crc32(w.encode()) | len(w.encode()) << 32 for w in (text or "").split()]
    return [spread(h) >> 48 for h in hashes] + [spread(polynomial(p)) >> 48 for p in itertools.pairwise(hashes)]


def test_ratio_and_threshold_of_the_rules(spark):
    texts = {k: T.prose(k) for k in range(60)} | {100 + k: T.junk(k) for k in range(20)} | {200: T.prose(3), 201: None, 202: "", 203: "short text", 204: T.prose(3)}
    good = [*range(0, 30), 203, 999]
    labels = [(k, 1) for k in good] + [(0, 0), (100, 0), (None, 1), (40, None)]
    documents = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r for r in quality_rules.quality_rules(documents, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}

    distinct = {t for t in texts.values() if t is not None}
    trusted = {texts[k] for k in good if k in texts}
    corpus = Counter(b for t in distinct for b in plain_buckets(t))
    target = Counter(b for t in trusted for b in plain_buckets(t))
    n, m = sum(corpus.values()) + 65536, sum(target.values()) + 65536
    ratio = lambda b: math.log((target[b] + 1) / m) - math.log((corpus[b] + 1) / n)
    score = lambda t: sum(map(ratio, plain_buckets(t))) / max(1, len(plain_buckets(t)))
    own = sorted(math.floor(score(t) * 1024) for t in trusted if len(plain_buckets(t)) >= 20)
    least = own[max(0, math.ceil(0.005 * len(own)) - 1)] / 1024 - 0.12
    for k, text in texts.items():
        assert found[k]["score"] == (pytest.approx(score(text), abs=1e-9) if plain_buckets(text) else None), k
        assert found[k]["kept"] == (not found[k]["base_failed"] and score(text) >= least), k
    assert {k for k in texts if found[k]["kept"]} >= {3, 200, 204} and not any(found[100 + k]["kept"] for k in range(20))


def test_the_threshold_counts_all_trusted_texts(spark):
    scored = spark.range(50_000).select(F.col("id").alias("doc_id"), F.md5(F.col("id").cast("string")).alias("text_key"), F.lit(30).alias("n_grams"), (F.col("id") / 50_000).alias("score"))
    found = quality_rules.least_score(scored, spark.range(50_000).select(F.col("id").alias("doc_id")))
    assert found == math.floor(0.005 * 1024) / 1024 - 0.12
    assert quality_rules.least_score(scored, spark.range(0).select(F.col("id").alias("doc_id"))) == -np.inf


# --- op4: best path over tags ------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_viterbi_finds_the_best_of_all_paths(seed):
    draw = np.random.default_rng(seed)
    tags, none = personal_data.TAGS, personal_data.NONE
    weights = {k: draw.normal(size=(personal_data.FEATURES, tags)) * 0.6 for k in ("here", "left", "right")} | {"move": draw.normal(size=(tags, tags))}
    for k in ("here", "left", "right"):
        weights[k][:, none] += (0, 0.4)[seed % 2]  # with a lead of "none" chains are cut
    field = personal_data.Field(weights)
    texts = ["ann.b@mail.org is here", "+1 (743) 555-3824", "", "word", "host 10.0.0.3 and fe80::1 x9"]
    ids, counts = field.numbered(texts)
    found, at = field.tags(ids, counts), 0
    for text in texts:
        shapes = [personal_data.shape_features(s) for s in personal_data.shapes(text)]

        def total(path, shapes=shapes):
            score = 0.0
            for k, tag in enumerate(path):
                score += weights["here"][shapes[k], tag].sum()
                if k:
                    score += weights["left"][shapes[k - 1], tag].sum()
                if k + 1 < len(shapes):
                    score += weights["right"][shapes[k + 1], tag].sum()
            return score + sum(weights["move"][a, b] for a, b in itertools.pairwise([none, *path, none]))

        best = max(itertools.product(range(tags), repeat=len(shapes)), key=total)
        assert tuple(found[at : at + len(shapes)]) == best
        at += len(shapes)


def test_features_see_whole_shapes():
    one, two = b"ad" * 20 + b"a", b"ad" * 20 + b"a-d"
    assert personal_data.shape_features(one) != personal_data.shape_features(two)


# --- op3: sums over segmentations --------------------------------------------------------------


def cuts(word: bytes, names: set[bytes]):
    if not word:
        yield ()
    for n in range(1, len(word) + 1):
        if word[:n] in names:
            for rest in cuts(word[n:], names):
                yield (word[:n], *rest)


@pytest.mark.parametrize("long", [48, 2])
def test_lattice_sums_all_segmentations(monkeypatch, long):
    monkeypatch.setattr(lattice_lm, "LONG", long)
    names = [bytes([b]) for b in range(256)] + [b" r", b" riv", b"ver", b"iv", b"er", b" the", b"the", b"he", "é".encode()]
    logs = np.log(np.random.default_rng(1).dirichlet(np.ones(len(names))))
    chance = dict(zip(names, np.exp(logs), strict=True))
    words, counts = [b"river", b"the", b"x", "été".encode(), b"thethe"], np.array([3, 1, 2, 5, 1])
    lattice = lattice_lm.Lattice(names, logs)
    uses = Counter()
    for word, score, n in zip(words, lattice.scores(words), counts, strict=True):
        paths = {p: math.prod(chance[x] for x in p) for p in cuts(b" " + word, set(names))}
        total = sum(paths.values())
        assert len(paths) >= 2 and score == pytest.approx(math.log(total)) or word == b"x"
        for path, p in paths.items():
            for piece in path:
                uses[piece] += n * p / total
    found = lattice.expected(words, counts)
    assert np.allclose(found, [uses[x] for x in names])


# --- op10: the forest --------------------------------------------------------------------------


def test_depths_of_the_forest_are_those_of_all_pairs(spark):
    draw = np.random.default_rng(3)
    base = draw.integers(0, 1 << 16, (5, near_duplicates.TREES * near_duplicates.OWN), dtype=np.uint16)
    rows = []
    for k in range(60):
        own = base[k % 5].copy()
        other = draw.random(len(own)) < (k % 4) * 0.15
        own[other] = draw.integers(0, 1 << 16, other.sum(), dtype=np.uint16)
        rows.append((k, own))
    frame = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in rows], "rep long, signature binary").repartition(3)
    found = {(r["tree"], r["node"]): r["depth"] for r in near_duplicates.forest(frame).collect()}
    places = near_duplicates.label_places()
    assert all(len(set(p)) == near_duplicates.LABEL for p in places.tolist())
    deeper = 0
    for tree, place in enumerate(places):
        labels = {k: (s[place] & 255).tolist() for k, s in rows}
        shared = lambda a, b: next((n for n, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), len(a))
        for k, own in labels.items():
            depth = max(shared(own, other) for j, other in labels.items() if j != k)
            # The outermost rows of a partition count as deep.
            deeper += found.get((tree, k), 0) != (depth if depth >= near_duplicates.SHORTEST else 0)
            assert found.get((tree, k), 0) >= (depth if depth >= near_duplicates.SHORTEST else 0)
    assert deeper <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_prefixes_are_shortened_until_the_recall_is_met():
    few = near_duplicates.recall(16, 10, 8, 8, 6)
    assert few == (near_duplicates.found_share(0.8, 16), 0.8) and few[0] < 0.8
    assert near_duplicates.shorter(16, 0.8) == 8 and near_duplicates.shorter(8, 0.8) == 7 and near_duplicates.shorter(5, 0.1) == 4
    # Pairs of one similarity that two halves of the trees find by chance: the estimate is near the true share.
    draw = np.random.default_rng(2)
    for size in (12, 9, 8):
        hits = draw.random((200_000, 2)) < near_duplicates.found_share(0.81, size, near_duplicates.TREES // 2)
        pairs, first, second, both = hits.any(axis=1).sum(), hits[:, 0].sum(), hits[:, 1].sum(), hits.all(axis=1).sum()
        share, similar = near_duplicates.recall(size, pairs, first, second, both)
        assert share == pytest.approx(near_duplicates.found_share(0.81, size), abs=2e-3) and similar == pytest.approx(0.81, abs=2e-3)
        assert (share >= near_duplicates.RECALL) == (size == 8)
    assert near_duplicates.shorter(12, 0.81) == 8


# --- what is held out has no effect ------------------------------------------------------------


def folder_with(spark, tmp_path, source: str, name: str, **changes) -> str:
    """A folder whose tables are those of ``source``, with some columns of some tables changed."""
    for table in ("documents", "labels"):
        df = spark.read.parquet(f"{source}/{table}.parquet")
        for column, value in changes.get(table, {}).items():
            df = df.withColumn(column, value)
        df.write.parquet(f"{tmp_path}/{name}/{table}.parquet")
    return f"{tmp_path}/{name}"


def remainder(parts: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts))


def test_labels_and_languages_of_held_out_rows_have_no_effect(spark, tmp_path):
    (tmp_path / "edges").mkdir()
    edges = T.folder(tmp_path / "edges")
    other = folder_with(
        spark, tmp_path, edges, "other",
        labels={"quality": F.when(remainder(5) == 0, 1 - F.col("quality")).otherwise(F.col("quality"))},
        documents={"lang": F.when(remainder(3) == 1, F.lit("zz")).otherwise(F.col("lang")), "source": F.lit("elsewhere")},
    )
    for query in (quality_classifier.op1_quality_classifier, language_id.op9_language_id):
        rows = [sorted(map(repr, query(spark, folder).collect())) for folder in (edges, other)]
        assert rows[0] == rows[1]


def test_held_out_texts_teach_the_model_nothing(spark, tmp_path):
    (tmp_path / "edges").mkdir()
    edges = T.folder(tmp_path / "edges")
    other = folder_with(spark, tmp_path, edges, "other", documents={"text": F.when(remainder(10) == 0, F.lit("qqq zzz qqq")).otherwise(F.col("text"))})
    # Sums over tasks may differ in their last bits.
    rows = [sorted(repr(r.asDict() | {"score": round(r["score"], 6)}) for r in lattice_lm.op3_lattice_lm(spark, folder).collect() if not r["held_out"]) for folder in (edges, other)]
    assert rows[0] == rows[1] and rows[0]
