"""Operator 4, personal data: patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans. The field is trained from a small labelled table by gradient descent on the
forward-backward likelihood; its tags are the four kinds and "none", its features the shapes of a word and of its two
neighbours. Viterbi decoding runs in numpy over whole documents, many at once. A decoded span joins the result if it
holds the digits or parts its kind needs and meets no base span; base spans always stay.

Decoding is exact and short: where a word's score for "none" beats every other tag by more than two transitions can
win back, the best path must pass through "none", so the chain falls apart there and only the pieces in between are
decoded.

A null or empty text has no spans. Repeated rows give repeated rows; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import map_slices, owners, table

# Kinds in the order of the result.
KINDS = ["email", "ip", "card", "phone"]
NONE, TAGS = 4, 5

#: Hashed shape features, passes and step of the training, and the penalty on weights.
FEATURES, PASSES, STEP, PENALTY = 2048, 60, 0.1, 1e-3
#: Distinct shapes whose scores a task keeps.
SHAPES_HELD = 200_000

SPACES = " \t\n\x0b\x0c\r"
SHAPE = bytes(
    ord("x") if 97 <= b <= 122 or b >= 0x80 else ord("X") if 65 <= b <= 90 else ord("d") if 48 <= b <= 57 else b
    for b in range(256)
)
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


class Patterns:
    """The base patterns, each linear in the text's length."""

    def __init__(self):
        self.digit = re.compile(r"[0-9]")
        # A run of digits is tried from its first digit only; from a later one it would fail alike.
        self.ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
        self.card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
        self.phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
        self.local = re.compile(r"[A-Za-z0-9._%+-]+\Z")
        self.host = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")

    def emails(self, text: str) -> list[tuple[int, int]]:
        found, free, at = [], 0, text.find("@")
        while at >= 0:
            start = at
            while start > free and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
                start -= 1
            host = self.host.match(text, at) if start < at else None
            if host:
                found.append((start, host.end()))
            free = host.end() if host else at + 1
            at = text.find("@", free)
        return found

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(kind, start, end), by kind and start."""
        out = [(0, a, z) for a, z in self.emails(text)]
        if self.digit.search(text):
            out += [(1, *m.span()) for m in self.ip.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split("."))]
            out += [(2, *m.span()) for m in self.card.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
            out += [(3, *m.span()) for m in self.phone.finditer(text) if 8 <= len(digits(m[0])) <= 15]
        return out


def digits(text: str) -> str:
    return "".join([c for c in text if c in "0123456789"])


def luhn(number: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(number)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def labelled_rows(n: int = 400, seed: int = 7) -> list[tuple[list[str], list[int]]]:
    """The small labelled table: made-up lines as words with a tag each."""
    draw = random.Random(seed)
    number = lambda k: "".join(draw.choices("0123456789", k=k))
    letters = lambda a, z: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(a, z)))
    hexes = lambda k: "".join(draw.choices("0123456789abcdef", k=k))

    def word():
        w = letters(1, 14)
        return draw.choice([w, w, w, w.capitalize(), w.upper(), w + draw.choice([".", ",", "!!", "%%%", "&&&", "###", "$$$", "***", ":"]), "|", "é" + w])

    def other():
        return draw.choice([
            [number(draw.randint(1, 6))], ["Version", "2.0."], ["version", f"{draw.randint(1, 9)}."], [f"{number(1)}.{number(2)}"],
            [f"20{number(2)}-0{draw.randint(1, 9)}-1{number(1)}"], [hexes(32)], ["token", "=", f'"{hexes(40)}"'], [f"{number(2)}:{number(2)}"],
            ["AKIA" + letters(16, 16).upper()], [f"${number(3)}.{number(2)}"], [number(16) + "$$$"], [number(20)], [f"{letters(2, 5)}{number(2)}"],
            [f"({letters(2, 6)})"], ["+", number(2)], [f"{number(2)}%"], [f"{letters(3, 6)}-{letters(3, 6)}"], [f"{number(1)},{number(3)},{number(3)}"],
        ])

    def private():
        kind = draw.randrange(4)
        area, head, tail = number(3), number(3), number(4)
        return kind, draw.choice([
            [[f"{letters(2, 9)}@{letters(3, 8)}.com"], [f"{letters(2, 6)}.{number(2)}@{letters(3, 7)}{number(1)}.{letters(4, 8)}.org"], [f"{letters(3, 8)}@{letters(4, 9)}"]],
            [[".".join(str(draw.randint(0, 255)) for _ in range(4))], [":".join(hexes(4) for _ in range(8))], [f"{hexes(4)}::{hexes(4)}:{hexes(4)}"]],
            [[number(16)], [number(4), number(4), number(4), number(4)], ["-".join(number(4) for _ in range(4))], [".".join(number(4) for _ in range(4))], [number(4), number(6), number(5)]],
            [["+1", f"({area})", f"{head}-{tail}"], [f"({area})", f"{head}-{tail}"], [f"{area}-{head}-{tail}"], [f"{area}.{head}.{tail}"], ["+49", number(3), number(7)], [f"+{number(2)}-{number(3)}-{number(6)}"]],
        ][kind])

    rows = []
    for _ in range(n):
        words, tags = [], []
        for _ in range(draw.randint(1, 4)):
            plain = [word() for _ in range(draw.randint(1, 6))]
            words, tags = words + plain, tags + [NONE] * len(plain)
            if draw.random() < 0.5:
                own = other()
                words, tags = words + own, tags + [NONE] * len(own)
            else:
                kind, own = private()
                if draw.random() < 0.3:
                    own = [*own[:-1], own[-1] + draw.choice([".", ",", "%%%", "###", "&&&"])]
                words, tags = words + own, tags + [kind] * len(own)
        rows.append((words, tags))
    return rows


def labelled_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(labelled_rows(), "words array<string>, tags array<int>")


def shape_features(shape: bytes) -> list[int]:
    """Hashed features of a word's shape: its runs, their lengths if of digits, ends and marks."""
    runs = [(c, len(list(g))) for c, g in groupby(shape.decode("latin-1"))]
    flat = "".join(c for c, _ in runs)
    numbers = [min(n, 21) for c, n in runs if c == "d"]
    names = ["bias", f"flat {flat}", f"head {flat[:2]}", f"tail {flat[-2:]}", f"numbers {numbers}", f"digits {min(sum(numbers), 21)}", f"groups {min(len(numbers), 6)}"]
    names += [f"has {c}" for c in "@+(:.-" if c in flat]
    if not numbers and "@" not in flat:
        names.append("plain")
    return [zlib.crc32(x.encode()) % FEATURES for x in names]


def shapes(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(SHAPE).split()


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit(rows: list[tuple[list[str], list[int]]]) -> dict[str, np.ndarray]:
    """Weights for a word, for its left and right neighbours, and for transitions; paths start and end at "none"."""
    seen: dict[bytes, int] = {}
    ids = [[seen.setdefault(s, len(seen)) for w in words for s in [shapes(w)[0]]] for words, _ in rows]
    has = np.zeros((len(seen) + 1, FEATURES), np.float32)  # the last shape stands for no neighbour
    for shape, k in seen.items():
        has[k, shape_features(shape)] = 1
    used = np.flatnonzero(has.any(axis=0))
    has = has[:, used]
    n, length = len(rows), max(map(len, ids))
    at, gold = np.full((n, length + 2), len(seen)), np.full((n, length), NONE)
    mask = np.zeros((n, length), bool)
    for k, (own, (_, tags)) in enumerate(zip(ids, rows, strict=True)):
        at[k, 1 : len(own) + 1], gold[k, : len(own)], mask[k, : len(own)] = own, tags, True
    weights = {"here": np.zeros((len(used), TAGS)), "left": np.zeros((len(used), TAGS)), "right": np.zeros((len(used), TAGS)), "move": np.zeros((TAGS, TAGS))}
    first, second = ({k: np.zeros_like(w) for k, w in weights.items()} for _ in range(2))
    truth = np.eye(TAGS)[gold] * mask[:, :, None]
    before = np.concatenate([np.full((n, 1), NONE), gold[:, :-1]], axis=1)
    moves = np.zeros((TAGS, TAGS))
    np.add.at(moves, (before[mask], gold[mask]), 1)
    ends = mask.sum(axis=1) - 1
    np.add.at(moves, (gold[np.arange(n), ends], np.full(n, NONE)), 1)
    for step in range(1, PASSES + 1):
        score = (has @ weights["here"])[at[:, 1:-1]] + (has @ weights["left"])[at[:, :-2]] + (has @ weights["right"])[at[:, 2:]]
        move = weights["move"]
        ahead, back = np.zeros((n, length, TAGS)), np.zeros((n, length, TAGS))
        ahead[:, 0] = move[NONE] + score[:, 0]
        for t in range(1, length):
            ahead[:, t] = np.where(mask[:, t, None], log_sum(ahead[:, t - 1, :, None] + move, 1) + score[:, t], ahead[:, t - 1])
        back[:, -1] = move[:, NONE]
        for t in range(length - 2, -1, -1):
            back[:, t] = np.where(mask[:, t + 1, None], log_sum(move + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2), move[:, NONE])
        total = log_sum(ahead[:, -1] + move[:, NONE], 1)
        chance = np.exp(ahead + back - total[:, None, None]) * mask[:, :, None]
        error = (truth - chance)[mask]
        pair = np.exp(ahead[:, :-1, :, None] + move + (score + back)[:, 1:, None, :] - total[:, None, None, None]) * mask[:, 1:, None, None]
        expected = pair.sum(axis=(0, 1))
        expected[NONE] += chance[:, 0].sum(axis=0)
        expected[:, NONE] += chance[np.arange(n), ends].sum(axis=0)
        grads = {"move": moves - expected}
        for name, part in (("here", at[:, 1:-1]), ("left", at[:, :-2]), ("right", at[:, 2:])):
            by_shape = np.zeros((len(has), TAGS))
            np.add.at(by_shape, part[mask], error)
            grads[name] = has.T @ by_shape
        for name, w in weights.items():
            g = grads[name] / n - PENALTY * w
            first[name] += 0.1 * (g - first[name])
            second[name] += 0.001 * (g * g - second[name])
            w += STEP * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    full = {"move": weights["move"]}
    for name in ("here", "left", "right"):
        full[name] = np.zeros((FEATURES, TAGS))
        full[name][used] = weights[name]
    return full


class Field:
    """Decodes documents with trained weights; scores of shapes are kept between slices."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights, self.move = weights, weights["move"]
        swap = self.move[:, :, None] + self.move[None, :, :]  # from, tag, to
        self.gain = (swap - swap[:, NONE : NONE + 1, :]).max()
        self.clear()

    def clear(self) -> None:
        self.seen: dict[bytes, int] = {}
        self.scores = {k: np.zeros((0, TAGS)) for k in ("here", "left", "right")}

    def numbered(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        if len(self.seen) > SHAPES_HELD:
            self.clear()
        ids, counts = [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            own = shapes(text)
            counts[k] = len(own)
            ids.extend([self.seen.setdefault(s, len(self.seen)) for s in own])
        fresh = [shape_features(s) for s in list(self.seen)[len(self.scores["here"]) :]]
        if fresh:
            for name in self.scores:
                self.scores[name] = np.concatenate([self.scores[name], [self.weights[name][f].sum(axis=0) for f in fresh]])
        return np.array(ids, np.int64), counts

    def tags(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The best tag of each word, documents apart."""
        if not len(ids):
            return np.zeros(0, np.int8)
        of = owners(counts)
        joined = of[1:] == of[:-1]
        score = self.scores["here"][ids]
        score[1:] += self.scores["left"][ids[:-1]] * joined[:, None]
        score[:-1] += self.scores["right"][ids[1:]] * joined[:, None]
        tags = np.full(len(ids), NONE, np.int8)
        others = np.delete(score, NONE, axis=1).max(axis=1)
        open_ = score[:, NONE] - others <= self.gain
        head = open_ & np.concatenate([[True], ~open_[:-1] | ~joined])
        tail = open_ & np.concatenate([~open_[1:] | ~joined, [True]])
        starts = np.flatnonzero(head)
        lengths = np.flatnonzero(tail) - starts + 1
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        if not len(starts):
            return tags
        # Viterbi over all pieces at once; a piece leaves when it ends.
        best, from_ = self.move[NONE] + score[starts], []
        finals = np.zeros(len(starts), np.int64)
        live = len(starts)
        for t in range(1, int(lengths[0]) + 1):
            going = int(np.searchsorted(-lengths, -t, "left"))  # pieces longer than t
            finals[going:live] = (best[going:live] + self.move[:, NONE]).argmax(axis=1)
            live = going
            if not live:
                break
            paths = best[:live, :, None] + self.move
            from_.append(paths.argmax(axis=1).astype(np.int8))
            best = paths.max(axis=1) + score[starts[:live] + t]
        tag = finals
        for t in range(int(lengths[0]) - 1, -1, -1):
            live = int(np.searchsorted(-lengths, -t, "left"))
            tags[starts[:live] + t] = tag[:live]
            if t:
                tag[:live] = from_[t - 1][np.arange(live), tag[:live]]
        return tags


def sound(kind: int, text: str) -> bool:
    """Whether a decoded span holds what its kind needs."""
    own = digits(text)
    if kind == 0:
        return "@" in text[1:-1]
    if kind == 1:
        parts = text.split(":")
        return 3 <= len(parts) <= 8 and len(own) >= 1 and all(len(p) <= 4 and not p.strip("0123456789abcdefABCDEF") for p in parts) and len(text) >= 9
    if kind == 2:
        return 15 <= len(own) <= 16 and len(set(own)) > 1 and luhn(own)
    return 9 <= len(own) <= 15 and not text.strip("0123456789+().-/ ")


def decoded(text: str, tags: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of neighbouring words of one kind, without marks at their ends."""
    words = [m.span() for m in re.finditer(rf"[^{SPACES}]+", text)]
    out, k = [], 0
    while k < len(words):
        z = k
        while z + 1 < len(words) and tags[z + 1] == tags[k]:
            z += 1
        if tags[k] != NONE:
            a, b = words[k][0], words[z][1]
            while a < b and not (text[a].isalnum() or text[a] in "+("):
                a += 1
            while b > a and not text[b - 1].isalnum():
                b -= 1
            if a < b and sound(int(tags[k]), text[a:b]):
                out.append((int(tags[k]), a, b))
        k = z + 1
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for k, a, z in sorted(spans))


def find(documents: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """Base counts, their digest and all spans of every document."""
    held = documents.sparkSession.sparkContext.broadcast(weights)

    def make():
        patterns, field = Patterns(), Field(held.value)

        def step(rows):
            texts = [t or "" for t in rows["text"]]
            ids, counts = field.numbered(texts)
            tags = field.tags(ids, counts)
            ends = np.cumsum(counts)
            some = set(owners(counts)[tags != NONE].tolist())
            out = {name: [] for name in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
            for k, text in enumerate(texts):
                base = patterns.spans(text)
                more = decoded(text, tags[ends[k] - counts[k] : ends[k]]) if k in some else []
                more = [s for s in more if all(s[2] <= a or s[1] >= z for _, a, z in base)]
                for n, kind in enumerate(KINDS):
                    out[f"n_{kind}"].append(sum(s[0] == n for s in base))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(base + more))
            return {"doc_id": rows["doc_id"], **out}

        return step

    return map_slices(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, SCHEMA)


def op4_personal_data(spark, folder: str) -> DataFrame:
    rows = [(list(r["words"]), list(r["tags"])) for r in labelled_table(spark).collect()]
    return find(table(spark, folder, "documents"), fit(rows))
