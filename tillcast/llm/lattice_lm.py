"""Operator 3, LM scoring: probability of a text over all its segmentations into pieces of an existing vocabulary.

The pieces come from a tokenizer's model file; they aren't changed. A text is a series of words, each led by a blank,
and an end. Its probability is the sum over every segmentation of the product of piece probabilities; since no piece
reaches over a word's start, it is a product of sums by word, each found by the forward recursion in log space. Bytes
are pieces too, so every text has a segmentation. Piece probabilities start from the file's scores, which are ranks,
and follow expected counts (forward and backward) over all training words.

Words of the whole corpus are counted in a shuffle, and each distinct word is scored once. Documents meet the
HEAD most frequent words in their own task; all other words are joined by a shuffle, so the result is exact however
many distinct words there are.

A null or empty text is one end token. Rows are scored one by one, so repeated rows give repeated rows. A null id
learns. Without a training text all counts are 0. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import MIX, encode, fold, map_slices, owners, table, written

#: The tokenizer's model file, passes of re-estimation, and what is added to each expected count.
VOCABULARY, PASSES, SMOOTHING = "/opt/tokenizers/piece_bpe_32k.model", 3, 0.1
#: Most of the frequent words that are sent to each task; distinct words that a task counts before handing over.
HEAD, FLUSH = 1 << 17, 400_000
#: Words of more bytes are scored one by one.
LONG = 48

LN10 = math.log(10)


def pieces(path: str = VOCABULARY) -> tuple[list[bytes], np.ndarray]:
    """Pieces that lower-case text can hold, as bytes with a blank for a word's start, and first log probabilities."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranked: dict[bytes, int] = {}
    for k in range(model.get_piece_size()):
        if model.is_control(k) or model.is_unknown(k) or model.is_unused(k) or model.is_byte(k):
            continue
        text = model.id_to_piece(k).replace("▁", " ").encode()
        if text == text.lower() and b" " not in text[1:]:
            ranked.setdefault(text, int(-model.get_score(k)))
    last = max(ranked.values()) + 1
    for b in range(256):
        ranked.setdefault(bytes([b]), last)
    ranks = np.array(list(ranked.values()), float)
    chance = 1 / (ranks + 10)
    return list(ranked), np.log(chance / chance.sum())


class Lattice:
    """Sums over segmentations of words, many words at once."""

    def __init__(self, names: list[bytes], logs: np.ndarray):
        self.ids, self.logs = {p: k for k, p in enumerate(names)}, logs
        self.sizes = sorted({len(p) for p in names})
        self.bits = 17
        self.tables = self.slots(names)
        top = self.sizes[-1]
        self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(top, MIX)]), dtype=np.uint64)

    def spread(self, keys: np.ndarray, k: int) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * k) >> np.uint64(64 - self.bits)).astype(np.int64)

    def slots(self, names: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Tables of hash, id and whether a piece had to go to the next table as its slot was taken."""
        keys = np.zeros(len(names), np.uint64)
        for k, name in enumerate(names):
            h = 0
            for c in name:
                h = (h * int(MIX) + c + 1) & 0xFFFFFFFFFFFFFFFF
            keys[k] = h
        left, tables = np.arange(len(names)), []
        while len(left):
            at = self.spread(keys[left], len(tables))
            _, first = np.unique(at, return_index=True)
            held, ids = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int64)
            held[at[first]], ids[at[first]] = keys[left[first]], left[first]
            left, at = np.delete(left, first), np.delete(at, first)
            taken = np.zeros(1 << self.bits, bool)
            taken[at] = True
            tables.append((held, ids, taken))
        return tables

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ids of pieces with these hashes, -1 for none."""
        out, rest = np.full(len(keys), -1, np.int64), None
        for k, (held, ids, taken) in enumerate(self.tables):
            own = keys if rest is None else keys[rest]
            at = self.spread(own, k)
            hit = np.flatnonzero(held[at] == own)
            out[hit if rest is None else rest[hit]] = ids[at[hit]]
            more = np.flatnonzero(taken[at])
            rest = more if rest is None else rest[more]
            if not len(rest):
                break
        return out

    def arcs(self, words: list[bytes], lengths: np.ndarray):
        """(end, start, words, piece ids) of all pieces in words, which fall by length."""
        width = int(lengths[0])
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width).T.astype(np.uint64, order="C")
        prefix = np.zeros((width + 1, len(words)), np.uint64)
        for k in range(width):
            prefix[k + 1] = prefix[k] * MIX + text[k] + np.uint64(1)
        out = []
        for end in range(1, width + 1):
            live = int(np.searchsorted(-lengths, -end, "right"))
            for size in self.sizes:
                if size > end:
                    break
                found = self.find(prefix[end, :live] - prefix[end - size, :live] * self.powers[size])
                some = np.flatnonzero(found >= 0)
                if len(some):
                    out.append((end, end - size, some, found[some]))
        return out

    def forward(self, words: list[bytes], lengths: np.ndarray, arcs) -> np.ndarray:
        ahead = np.full((int(lengths[0]) + 1, len(words)), -np.inf)
        ahead[0] = 0
        for end, start, some, ids in arcs:
            ahead[end, some] = np.logaddexp(ahead[end, some], ahead[start, some] + self.logs[ids])
        return ahead

    def long_forward(self, word: bytes) -> tuple[list[float], list[list[tuple[int, int]]]]:
        """For one long word, the sums up to each end, and (start, piece id) of the pieces that end there."""
        ahead, arcs, top = [0.0], [[]], self.sizes[-1]
        for end in range(1, len(word) + 1):
            known = ((start, self.ids.get(word[start:end])) for start in range(max(0, end - top), end))
            arcs.append([(start, k) for start, k in known if k is not None])
            parts = [ahead[start] + self.logs[k] for start, k in arcs[end]]
            most = max(parts)
            ahead.append(most + math.log(sum(math.exp(p - most) for p in parts)))
        return ahead, arcs

    def long_score(self, word: bytes) -> float:
        """The same sum for one long word."""
        return self.long_forward(word)[0][-1]

    def scores(self, words: list[bytes]) -> np.ndarray:
        """Log probability of each word, led by a blank."""
        out = np.zeros(len(words))
        led = [b" " + w for w in words]
        lengths = np.array([len(w) for w in led], np.int64)
        for k in np.flatnonzero(lengths > LONG):
            out[k] = self.long_score(led[k])
        order = np.flatnonzero(lengths <= LONG)
        order = order[np.argsort(-lengths[order], kind="stable")]
        if len(order):
            short = [led[k] for k in order]
            ahead = self.forward(short, lengths[order], self.arcs(short, lengths[order]))
            out[order] = ahead[lengths[order], np.arange(len(order))]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in the words, each word as often as it is counted."""
        out = np.zeros(len(self.logs))
        led = [b" " + w for w in words]
        lengths = np.array([len(w) for w in led], np.int64)
        for k in np.flatnonzero(lengths > LONG):
            self.long_expected(led[k], counts[k], out)
        order = np.flatnonzero(lengths <= LONG)
        order = order[np.argsort(-lengths[order], kind="stable")]
        if len(order):
            short, n = [led[k] for k in order], lengths[order]
            arcs = self.arcs(short, n)
            ahead = self.forward(short, n, arcs)
            total = ahead[n, np.arange(len(order))]
            back = np.full(ahead.shape, -np.inf)
            back[n, np.arange(len(order))] = 0
            weight, uses = counts[order].astype(float), []
            for end, start, some, ids in reversed(arcs):
                step = back[end, some] + self.logs[ids]
                uses.append(weight[some] * np.exp(ahead[start, some] + step - total[some]))
                back[start, some] = np.logaddexp(back[start, some], step)
            out += np.bincount(np.concatenate([a[3] for a in reversed(arcs)]), np.concatenate(uses), minlength=len(out))
        return out

    def long_expected(self, word: bytes, count: float, out: np.ndarray) -> None:
        """Adds the expected uses of each piece in one long word."""
        ahead, arcs = self.long_forward(word)
        back = [-math.inf] * len(word) + [0.0]
        for end in range(len(word), 0, -1):
            for start, k in arcs[end]:
                step = back[end] + self.logs[k]
                out[k] += count * math.exp(ahead[start] + step - ahead[-1])
                most = max(back[start], step)
                back[start] = most + math.log(math.exp(back[start] - most) + math.exp(step - most)) if most > -math.inf else most


class WordCounts:
    """Counts of words in all and in training texts over a task."""

    def __init__(self):
        self.every, self.learned = Counter(), Counter()

    def __call__(self, rows):
        for text, held_out in zip(rows["text"], rows["held_out"], strict=True):
            words = (text or "").encode("utf-8", "surrogatepass").lower().split()
            self.every.update(words)
            if not held_out:
                self.learned.update(words)
        return self.finish() if len(self.every) >= FLUSH else None

    def finish(self):
        every, self.every = self.every, Counter()
        learned, self.learned = self.learned, Counter()
        return {"word": list(every), "uses": list(every.values()), "c": [learned[w] for w in every]}


def count_words(documents: DataFrame) -> DataFrame:
    """(word, uses, c) of every distinct word: its count in all texts and in training texts."""
    counted = map_slices(documents.select("text", "held_out"), WordCounts, "word binary, uses long, c long")
    return written(counted.groupBy("word").agg(F.sum("uses").alias("uses"), F.sum("c").alias("c")))


def estimate(words: DataFrame, ends: int, names: list[bytes], logs: np.ndarray, passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Log probabilities of pieces, and of the end, after passes over all training words."""
    known = words.where("c > 0").select("word", "c")
    end = math.log(0.01)
    for _ in range(passes):
        held = words.sparkSession.sparkContext.broadcast((names, logs))

        class Task:
            def __init__(self):
                self.lattice = Lattice(*held.value)
                self.sums = np.zeros(len(self.lattice.logs))

            def __call__(self, rows):
                self.sums += self.lattice.expected(rows["word"], np.array(rows["c"]))

            def finish(self):
                some = np.flatnonzero(self.sums)
                return {"piece": some, "n": self.sums[some]}

        total = np.zeros(len(names))
        for row in map_slices(known, Task, "piece long, n double", text="").groupBy("piece").agg(F.sum("n").alias("n")).collect():
            total[row["piece"]] = row["n"]
        everything = total.sum() + SMOOTHING * (len(names) + 1) + ends
        logs, end = np.log((total + SMOOTHING) / everything), math.log((ends + SMOOTHING) / everything)
    return logs, end


def with_scores(words: DataFrame, names: list[bytes], logs: np.ndarray) -> DataFrame:
    """Each distinct word with its log10 probability."""
    held = words.sparkSession.sparkContext.broadcast((names, logs))

    def make():
        lattice = Lattice(*held.value)
        return lambda rows: {**rows, "score": lattice.scores(rows["word"]) / LN10}

    return written(map_slices(words.select("word", "uses", "c"), make, "word binary, uses long, c long, score double", text=""))


def most_used(words: DataFrame, most: int) -> DataFrame:
    """Words used often enough that there are ``most`` of them at the utmost.

    Uses are binned on a log scale; the histogram, a few hundred rows, tells from which bin on the words fit.
    Nothing is sorted, and no task or driver gets more than ``most`` rows.
    """
    binned = words.withColumn("bin", F.floor(8 * F.log2(F.col("uses").cast("double"))).cast("int"))
    least, held = None, 0
    for row in sorted(binned.groupBy("bin").agg(F.count("*").alias("n")).collect(), reverse=True):
        held += row["n"]
        if held > most:
            break
        least = row["bin"]
    return words.where(F.lit(False)) if least is None else binned.where(F.col("bin") >= least).drop("bin")


def score(documents: DataFrame, words: DataFrame, tokens: int, kinds: int, ends: int, end: float, head: int = HEAD) -> DataFrame:
    """Scores of every document; ``words`` has each distinct word's count and score."""
    spark = documents.sparkSession
    base = lambda c: np.log10((c + 0.1) / (tokens + 0.1 * (kinds + 1)))
    first = most_used(words, head).collect()
    held = spark.sparkContext.broadcast(([bytes(r["word"]) for r in first], np.array([r["c"] for r in first], np.int64), np.array([r["score"] for r in first])))
    end_base, end_known = float(base(ends)), int(ends > 0)

    def make():
        names, counts, scores = held.value
        place = {w: k for k, w in enumerate(names)}
        known, bases, scores = np.append(counts > 0, False), np.append(base(counts), 0.0), np.append(scores, 0.0)

        def step(rows):
            ids, n, distinct = encode(rows["text"], lower=True)
            of, m = owners(n), len(rows["text"])
            at = np.array([place.get(w, -1) for w in distinct], np.int64)[ids] if len(ids) else ids
            rest = at < 0
            pairs, uses = np.unique(of[rest] * max(1, len(distinct)) + ids[rest], return_counts=True)
            docs, which = np.divmod(pairs, max(1, len(distinct)))
            row_ids = np.array(rows["row"], np.int64)
            pad = [None] * len(pairs)
            return {
                "row": np.concatenate([row_ids, row_ids[docs]]),
                "doc_id": rows["doc_id"] + pad,
                "held_out": rows["held_out"] + pad,
                "word": pa.array([None] * m + [distinct[k] for k in which], pa.binary()),
                "n": np.concatenate([n + 1, uses]),
                "n_known": np.concatenate([np.bincount(of, known[at], minlength=m).astype(np.int64) + end_known, np.zeros(len(pairs), np.int64)]),
                "base": np.concatenate([np.bincount(of, bases[at], minlength=m) + end_base, np.zeros(len(pairs))]),
                "score": np.concatenate([np.bincount(of, scores[at], minlength=m) + end / LN10, np.zeros(len(pairs))]),
            }

        return step

    schema = "row long, doc_id long, held_out boolean, word binary, n long, n_known long, base double, score double"
    numbered = documents.select("doc_id", "held_out", "text", F.monotonically_increasing_id().alias("row"))
    parts = written(map_slices(numbered, make, schema))
    rest = parts.where("word is not null").select("row", "word", "n").join(words.select("word", "c", F.col("score").alias("each")), "word")
    chance = F.log10((F.col("c") + 0.1) / F.lit(tokens + 0.1 * (kinds + 1)))
    sums = rest.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"), F.sum(F.col("n") * chance).alias("more_base"), F.sum(F.col("n") * F.col("each")).alias("more_score"),
    )
    whole = parts.where("word is null").join(sums, "row", "left").na.fill(0, ["more_known"]).na.fill(0.0, ["more_base", "more_score"])
    return whole.select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), (F.col("n_known") + F.col("more_known")).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("more_base")).alias("base_score"), (F.col("score") + F.col("more_score")).alias("score"),
    )


def lattice_scores(documents: DataFrame, vocabulary: str = VOCABULARY, head: int = HEAD) -> DataFrame:
    """Scores of ``documents`` (doc_id, held_out, text), learned from those not held out."""
    names, logs = pieces(vocabulary)
    words = count_words(documents)
    ends = documents.where("not held_out").count()
    totals = words.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    logs, end = estimate(words, ends, names, logs)
    return score(documents, with_scores(words, names, logs), (totals[0] or 0) + ends, totals[1] + int(ends > 0), ends, end, head)


def op3_lattice_lm(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.coalesce(fold("doc_id", 10) == 0, F.lit(False))
    return lattice_scores(table(spark, folder, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out")))
