"""Operator 1, quality classifier: supervised subword embeddings.

Each word and each of its character n-grams is hashed to a row of a table of learned vectors. A document is the mean of
the vectors of all its words and n-grams; a softmax layer over it gives the labels' probabilities. Table and layer are
trained together by stochastic gradient descent in numpy, one document a step, on a bounded sample of labelled
documents whose n-grams are counted by Spark. Scoring covers every document whole.

A null or empty text has the zero vector and gets the layer's bias alone. Without a labelled document every score is
0.5. Repeated rows give repeated rows; an id labelled twice counts as good if any label is. A null id isn't held out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import MIX, encode, fold, labelled_sample, map_slices, mixed, owners, table, written

#: Labelled documents that the model is fitted on at most, in hash order of their ids.
TRAIN_ROWS = 4_000
#: Rows of the vector table, their length, and the lengths of character n-grams.
ROWS, LENGTH, GRAMS = 1 << 16, 8, (3, 4)
#: Passes over the sample, and the first step size, which falls to zero in equal steps.
EPOCHS, STEP = 6, 4.0
#: Stands for a word that repeats its predecessor; no word of a text holds a blank.
REPEAT = b"same again"
#: Least score of a document predicted to be good.
CUT = 0.3


def marked(texts: list) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words as ``encode`` gives them, but a word that repeats the one before it becomes the mark of a repeat."""
    ids, counts, words = encode(texts)
    of = owners(counts)
    again = np.flatnonzero((ids[1:] == ids[:-1]) & (of[1:] == of[:-1])) + 1
    ids[again] = len(words)
    return ids, counts, [*words, REPEAT]


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of each distinct word: the word itself and its n-grams with word bounds; and how many each has."""
    points = [np.frombuffer(f"<{w.decode('utf-8', 'replace')}>".encode("utf-32-le"), np.uint32) for w in words]
    sizes = np.array([len(p) for p in points], np.int64)
    text = np.concatenate(points).astype(np.uint64) if points else np.zeros(0, np.uint64)
    ends = np.cumsum(sizes)
    of = owners(sizes)
    # A whole word is the sum of its spread-out characters by place.
    place = (np.arange(len(text)) - (ends - sizes)[of]).astype(np.uint64)
    whole = np.zeros(len(words), np.uint64)
    np.add.at(whole, of, mixed(text + (place << np.uint64(21))))
    keys, at = [mixed(whole)], [np.arange(len(words))]
    for n in GRAMS:
        if len(text) < n:
            continue
        h = np.zeros(len(text) - n + 1, np.uint64)
        for k in range(n):
            h = h * MIX + text[k : len(text) - n + 1 + k]
        good = np.flatnonzero(np.arange(len(h)) + n <= ends[of[: len(h)]])
        keys.append(mixed(h[good] + np.uint64(n)))
        at.append(of[good])
    rows, at = np.concatenate(keys), np.concatenate(at)
    order = np.argsort(at, kind="stable")
    return (rows[order] >> np.uint64(64 - (ROWS.bit_length() - 1))).astype(np.int64), np.bincount(at, minlength=len(words))


def word_sums(words: list[bytes], vectors: np.ndarray, chunk: int = 50_000) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the vectors of each distinct word, and how many they are."""
    sums, sizes = [np.zeros((0, vectors.shape[1]))], [np.zeros(0, np.int64)]
    for k in range(0, len(words), chunk):
        rows, n = features(words[k : k + chunk])
        sums.append(np.add.reduceat(vectors[rows], np.cumsum(n) - n, axis=0))
        sizes.append(n)
    return np.concatenate(sums), np.concatenate(sizes)


def averages(texts: list, vectors: np.ndarray) -> np.ndarray:
    """Mean vector of each text."""
    ids, counts, words = marked(texts)
    sums, sizes = word_sums(words, vectors)
    of = owners(counts)
    total = np.stack([np.bincount(of, sums[ids, k], minlength=len(texts)) for k in range(vectors.shape[1])], axis=1)
    return total / np.maximum(np.bincount(of, sizes[ids], minlength=len(texts)), 1)[:, None]


def bags(rows: dict) -> dict:
    """Each document's table rows and their weights, which sum to 1, as bytes."""
    out: dict = {"quality": rows["quality"], "rows": [], "weights": []}
    for text in rows["text"]:
        ids, _, words = marked([text])
        at, n = features(words)
        weight = np.repeat(np.bincount(ids, minlength=len(words)), n)
        total = np.bincount(at, weight, minlength=ROWS)
        some = np.flatnonzero(total)
        out["rows"].append(some.astype(np.uint32).tobytes())
        out["weights"].append((total[some] / max(total.sum(), 1)).astype(np.float32).tobytes())
    return out


class Model:
    """Vector table and softmax layer."""

    def __init__(self, vectors: np.ndarray | None = None, layer: np.ndarray | None = None, bias: np.ndarray | None = None):
        draw = np.random.default_rng(1)
        self.vectors = draw.uniform(-1 / LENGTH, 1 / LENGTH, (ROWS, LENGTH)).astype(np.float32) if vectors is None else vectors
        self.layer = np.zeros((LENGTH, 2), np.float32) if layer is None else layer
        self.bias = np.zeros(2, np.float32) if bias is None else bias

    def chances(self, means: np.ndarray) -> np.ndarray:
        z = means @ self.layer + self.bias
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    def train(self, docs: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, step: float = STEP, seed: int = 2) -> Model:
        draw, done, total = np.random.default_rng(seed), 0, max(1, epochs * len(docs))
        for _ in range(epochs):
            for k in draw.permutation(len(docs)):
                rows, weights, label = docs[k]
                rate = step * (1 - done / total)
                done += 1
                mean = weights @ self.vectors[rows]
                error = self.chances(mean)
                error[label] -= 1
                back = self.layer @ error
                self.layer -= rate * np.outer(mean, error)
                self.bias -= rate * 0.1 * error
                self.vectors[rows] -= rate * weights[:, None] * back
        return self


def fit(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model of ``labels.quality`` from the labelled ones of ``documents``."""
    sample = written(labelled_sample(labels, "quality", rows))
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")
    bagged = map_slices(texts, lambda: lambda r: {"doc_id": r["doc_id"], **bags(r)}, "doc_id long, quality int, rows binary, weights binary")
    held = bagged.orderBy("doc_id", "rows").collect()  # a sample's bags: at most ``rows`` times the table's size
    return Model().train([(np.frombuffer(r["rows"], np.uint32), np.frombuffer(r["weights"], np.float32), int(r["quality"] > 0)) for r in held])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Probability of the good label for every document; columns ``doc_id``, ``held_out`` and ``text`` go in."""
    held = documents.sparkSession.sparkContext.broadcast(vars(model))

    def make():
        model = Model(**held.value)

        def step(rows):
            chance = model.chances(averages(rows["text"], model.vectors))[:, 1].astype(float)
            return {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "score": chance, "predicted": (chance >= CUT).astype(np.int32)}

        return step

    return map_slices(documents.select("doc_id", "held_out", "text"), make, "doc_id long, held_out boolean, score double, predicted int")


def op1_quality_classifier(spark, folder: str) -> DataFrame:
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    documents = table(spark, folder, "documents").select("doc_id", "text", held_out.alias("held_out"))
    labels = table(spark, folder, "labels").where(fold("doc_id", 5) != 0)
    return score(documents, fit(documents, labels))
