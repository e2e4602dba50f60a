"""Places where an operator once did less than its whole job."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
import tables as T  # noqa: E402
from tillcast.llm import lattice_lm, mixing, personal_data, quality_rules, secrets  # noqa: E402


@pytest.fixture(scope="module")
def edges(tmp_path_factory):
    return T.folder(tmp_path_factory.mktemp("edges"))


def labelled_texts(spark, copies: int):
    """Good and poor labelled texts, and a clean text without a label that has so many copies."""
    draw = random.Random(3)
    common = sorted(set(T.prose(1).split()))[:30]
    prose = lambda: " ".join(draw.choices(common, k=60))
    good = [(k, prose(), 1) for k in range(200)]
    poor = [(1000 + k, T.junk(k), 0) for k in range(40)]
    clean = prose()
    many = [(10_000 + k, clean, None) for k in range(copies)]
    data = spark.createDataFrame(good + poor + many, "doc_id long, text string, quality int")
    return data.select("doc_id", "text"), data.select("doc_id", "quality").where("quality is not null")


def test_quality_rules_keep_texts_of_many_copies(spark):
    kept = {}
    for copies in (1, 3000):
        found = quality_rules.quality_rules(*labelled_texts(spark, copies)).collect()
        assert all(r["kept"] for r in found if r["doc_id"] >= 10_000)
        assert not any(r["kept"] for r in found if 1000 <= r["doc_id"] < 2000)
        kept[copies] = {r["doc_id"]: (r["kept"], r["score"]) for r in found if r["doc_id"] <= 10_000}
    assert kept[1] == kept[3000]


def test_copied_documents_pass_the_rules(spark, edges):
    verdicts = {r["doc_id"]: r["kept"] for r in quality_rules.op8_quality_rules(spark, edges).collect()}
    assert verdicts[38] and verdicts[138]
    docs = spark.read.parquet(f"{edges}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, edges))
        if name == "quality_rules":
            assert {38, 138} <= {r["doc_id"] for r in docs.collect()}
        if name == "near_duplicates":
            break
    assert [r["doc_id"] for r in docs.collect() if r["text"] == T.prose(38)] == [38]


def test_secrets_of_many_repositories_are_examples(spark):
    copied, live, mixed = "token=Abcdefgh12345678copy", "token=Abcdefgh12345678live", "zZ9" * 10
    data = [(k, f"{copied} and {mixed}", "hot") for k in range(50)] + [(100 + k, live, "hot") for k in range(3)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    found = {r["doc_id"]: r for r in secrets.scan_secrets(docs, F.col("doc_id"), F.col("source")).collect()}
    assert all((found[k]["n_live"], found[k]["n_example"]) == (0, 1) for k in range(50))
    assert all(found[k]["spans"] == f"assign:0:{len(copied)}" for k in range(50))
    assert all((found[100 + k]["n_live"], found[100 + k]["n_example"]) == (1, 0) for k in range(3))


def test_long_words_give_expected_counts(monkeypatch):
    names = [b" ", b"a", b"b", b"ab", b"ba", b" a"]
    lattice = lattice_lm.Lattice(names, np.log(np.array([0.2, 0.2, 0.2, 0.15, 0.15, 0.1])))
    words, counts = [b"abba" * 15, b"ab"], np.array([3, 2])
    long = lattice.expected(words, counts), lattice.scores(words)
    monkeypatch.setattr(lattice_lm, "LONG", 100)
    assert long[0] == pytest.approx(lattice.expected(words, counts), rel=1e-9) and long[1] == pytest.approx(lattice.scores(words), rel=1e-9)


def test_shape_features_read_whole_words():
    features = lambda word: personal_data.shape_features(personal_data.shapes(word)[0])
    assert features("a" * 80 + "@examplehost") == features("ab@examplehost") != features("a" * 80)


def test_mixing_meets_targets_far_above_a_share(spark):
    text = lambda k, name: " ".join(f"{name}{(k + j) % 20}" for j in range(200))
    data = [(k, text(k, "calm"), "good") for k in range(400)] + [(1000 + k, text(k, "rude"), "toxic") for k in range(10)]
    docs = spark.createDataFrame(data, "doc_id long, text string, domain string")
    found = mixing.mix(docs.select("doc_id", "text"), docs.select("doc_id", "domain"), {"good": 0.4, "toxic": 0.6}).collect()
    tokens = sum(r["n_tokens"] for r in found)
    assert sum(r["rate"] * r["n_tokens"] * r["p_toxic"] for r in found) / tokens == pytest.approx(0.6, rel=1e-4)
    assert max(r["rate"] for r in found) > 20 and min(r["rate"] for r in found) >= 0


def test_mixing_with_most_rates_at_zero_takes_few_passes(spark, monkeypatch):
    text = lambda k, name: " ".join(f"{name}{(k + j) % 20}" for j in range(200))
    both = lambda k: text(k, "calm")[: 40 * (k % 30)] + " " + text(k, "rude")[: 40 * (30 - k % 30)]
    data = [(k, both(k), "good" if k % 30 > 20 else "toxic" if k % 30 < 5 else None) for k in range(900)]
    docs = spark.createDataFrame(data, "doc_id long, text string, domain string")
    passes, look = [], mixing.look
    monkeypatch.setattr(mixing, "look", lambda *args: passes.append(1) or look(*args))
    found = mixing.mix(docs.select("doc_id", "text"), docs.select("doc_id", "domain").where("domain is not null"), {"good": 0.03, "toxic": 0.97}).collect()
    tokens = sum(r["n_tokens"] for r in found)
    assert sum(r["rate"] == 0 for r in found) > 450 and len(passes) <= 20
    for domain, part in (("good", 0.03), ("toxic", 0.97)):
        assert sum(r["rate"] * r["n_tokens"] * r[f"p_{domain}"] for r in found) / tokens == pytest.approx(part, abs=1e-6)


def test_mixing_ends_near_targets_out_of_reach(spark):
    data = [(k, f"calm day {k % 7} rude" if k % 2 else "calm day here", "good" if k % 2 else "toxic") for k in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, text string, domain string")
    found = mixing.mix(docs.select("doc_id", "text"), docs.select("doc_id", "domain"), {"good": 0.0, "toxic": 1.0}).collect()
    assert len(found) == 60 and all(0 <= r["rate"] < 1e6 for r in found)


def test_near_copies_that_lose_lines_are_one_document(spark, tmp_path):
    lines = [T.prose(900 + k, 12) for k in range(40)]
    copies = {k: "\n".join([*lines, f"{T.prose(950 + k, 30)}"]) for k in range(300, 306)}
    rows = [r for r in T.documents() if r["doc_id"] is not None and r["doc_id"] < 60]
    rows += [{"doc_id": k, "text": t, "lang": "en", "source": "s", "n_chars": len(t)} for k, t in copies.items()]
    folder = T.folder(tmp_path, rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:3]:
        docs = corpus_pipeline.written(stage(spark, docs, folder))
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert [k for k in kept if k >= 300] == [300] and kept[300] == copies[300]
    assert set(range(60)) - {38} <= set(kept) | {38}


def near_copies_in_unlike_frames() -> list[dict]:
    """Documents 400 to 403 differ by a word in a long line each; other lines, which earlier documents hold, are most of a text."""
    frames = [[T.prose(2000 + 10 * k + j, 30) for j in range(6)] for k in range(4)]
    article = T.prose(3000, 90).split()
    texts = {300 + k: "\n".join([*frame, T.prose(3100 + k, 40)]) for k, frame in enumerate(frames)}
    texts |= {400 + k: "\n".join([*frame, " ".join([*article[:-1], f"last{k}"])]) for k, frame in enumerate(frames)}
    return [{"doc_id": k, "text": t, "lang": "en", "source": "s", "n_chars": len(t)} for k, t in texts.items()]


@pytest.mark.parametrize("others", [[], [500, 500]])
def test_texts_that_are_alike_once_lines_are_cut_are_one_document(spark, tmp_path, others):
    rows = [r for r in T.documents() if r["doc_id"] is not None and r["doc_id"] < 38] + near_copies_in_unlike_frames()
    rows += [{"doc_id": k, "text": T.prose(4000, 50), "lang": "en", "source": "s", "n_chars": 9} for k in others]
    folder = T.folder(tmp_path, rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    lines = corpus_pipeline.written(corpus_pipeline.line_stage(spark, docs, folder))
    kept = corpus_pipeline.near_duplicate_stage(spark, lines, folder)
    assert kept.columns == lines.columns
    came, stay = (sorted((r["doc_id"], r["text"]) for r in df.collect()) for df in (lines, kept))
    assert {400, 401, 402, 403} <= {k for k, _ in came}
    assert [k for k, _ in stay] == [*range(38), 300, 301, 302, 303, 400, *others[:1]] and set(stay) <= set(came)


def test_groups_by_either_text_are_one(spark, tmp_path):
    """Of 400 to 403 the last is also a near copy, by its uncut text, of 350: all are one group, of which 350 stays."""
    rows = near_copies_in_unlike_frames()
    words = rows[-1]["text"].split(" ")
    near = " ".join([*words[:-1], "other"])
    rows.append({"doc_id": 350, "text": near, "lang": "en", "source": "s", "n_chars": len(near)})
    folder = T.folder(tmp_path, rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    lines = corpus_pipeline.written(corpus_pipeline.line_stage(spark, docs, folder))
    kept = corpus_pipeline.near_duplicate_stage(spark, lines, folder)
    assert sorted(r["doc_id"] for r in kept.collect()) == [300, 301, 302, 303, 350]


def test_blocks_of_test_items_are_bounded(spark):
    from tillcast.llm import decontaminate

    same = [(1, "alpha beta gamma " * 10)] * 2000
    others = [(k, T.prose(k, 40)) for k in range(2, 300)]
    large = [(999, T.prose(7, 4000))]
    items = spark.createDataFrame(same + others + large, "item_id long, text string")
    blocks = list(decontaminate.item_blocks(items, 8000))
    assert sorted(x for b in blocks for x in b) == sorted((str(k), t) for k, t in set(same + others + large))
    sizes = [sum(len(t.encode()) + 64 for _, t in b) for b in blocks]
    assert sum(s > 8000 for s in sizes) == 1 and len(blocks) < 20
