"""Operator 12, phrase collocation mining by HAT-trie counting.

A task counts the phrases of one to three words of its pieces in a HAT-trie for each language: a shallow trie over word
ids whose leaves are hash containers of packed ids; a container that grows beyond BURST phrases bursts into a node with
containers below. Past HELD phrases whole subtrees, the largest first, are spilled as sorted runs, cut by the prefix of
two words that each phrase has; Spark moves each prefix partition's runs to one task, which merges them. A phrase that
half the corpus repeats is one entry a run, and the continuations of a common first word spread by their second one.

In runs a word is its 64-bit hash. Runs also carry the words behind the hashes, so two words of one hash are seen where
they meet and the job is done again with other hashes: counts are exact. What leaves the merge has counts of LEAST or more.
Scores are whole numbers from decimal products of up to 38 digits.

A null text holds no word; a null language is ``und``. Texts are read whole: a very long one fills and spills the trie
as many do. Repeated rows each count. Ties in the report are ordered by the phrase's bytes. An empty table gives no rows.
Columns other than text and lang are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import map_slices, mixed, table, written

#: Least count of a candidate, most words of a phrase, and rows a language has in the report.
LEAST, WORDS, TOP = 10, 3, 2000
#: A longer candidate with this share of a candidate's count, in hundredths, takes its place.
TAKEN = 50
#: Phrases in a container before it bursts, children of a node, and levels of nodes.
BURST, FAN_BITS, DEPTH = 1 << 15, 6, 3
#: Phrases a task's tries hold, words it numbers, words of a piece taken at once, entries a merge holds before it adds up.
HELD, NUMBERED, PIECE, MERGED = 1 << 20, 1 << 20, 1 << 18, 1 << 21
#: Prefix partitions to a task, and parts that a language's candidates are ranked in before their best meet.
FINER, RANKED = 2, 16
#: Bits of a word's number in a packed phrase; 0 stands for no word.
BITS = 21
SCALE = 1_000_000

BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
RUN = "bucket int, run binary"
COUNTED = "kind int, lang string, h1 long, h2 long, h3 long, n long, word string"
PHRASES, VOCABULARY, TOTAL, CLASH = range(4)


# --- the trie -------------------------------------------------------------------------------


class Trie:
    """Counts of packed phrases: nodes fan out by the first word's number, FAN_BITS a level; leaves are hash containers."""

    def __init__(self):
        self.root: dict | list = {}
        self.size = 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.root = self._add(self.root, codes, counts, 0)

    def _add(self, node, codes, counts, level):
        if isinstance(node, dict):
            before, get = len(node), node.get
            for code, n in zip(codes.tolist(), counts.tolist(), strict=True):
                node[code] = get(code, 0) + n
            self.size += len(node) - before
            return self._burst(node, level) if len(node) > BURST and level < DEPTH else node
        slots = self._slots(codes, level)
        order = np.argsort(slots, kind="stable")
        heads = np.flatnonzero(np.diff(slots[order], prepend=-1))
        for a, z in zip(heads, [*heads[1:], len(codes)], strict=True):
            own = order[a:z]
            slot = int(slots[own[0]])
            node[slot] = self._add(node[slot], codes[own], counts[own], level + 1)
        return node

    @staticmethod
    def _slots(codes, level):
        return (codes >> (2 * BITS + FAN_BITS * level)) & ((1 << FAN_BITS) - 1)

    def _burst(self, held: dict, level: int) -> list:
        self.size -= len(held)
        node = [{} for _ in range(1 << FAN_BITS)]
        codes, counts = entries(held)
        return self._add(node, codes, counts, level)

    def spill(self, keep: int):
        """Sorted (codes, counts) of whole subtrees, the largest first, until at most ``keep`` phrases are left."""
        if isinstance(self.root, dict):
            subtrees, self.root = ([self.root] if self.size > keep else []), ({} if self.size > keep else self.root)
        else:
            sizes = [sum(map(len, leaves(x))) for x in self.root]
            subtrees, left = [], sum(sizes)
            for slot in sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True):
                if left <= keep or not sizes[slot]:
                    break
                left -= sizes[slot]
                subtrees.append(self.root[slot])
                self.root[slot] = {}
        for subtree in subtrees:
            parts = [entries(x) for x in leaves(subtree)]
            codes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            self.size -= len(codes)
            order = np.argsort(codes)
            yield codes[order], counts[order]


def entries(held: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(held.keys(), np.int64, len(held)), np.fromiter(held.values(), np.int64, len(held))


def leaves(node) -> list[dict]:
    return [node] if isinstance(node, dict) else [leaf for child in node for leaf in leaves(child)]


# --- counting in a task ---------------------------------------------------------------------


def pieces(text: str | None) -> list[list[bytes]]:
    """Words of each piece, A-Z lowered."""
    return [w for x in (text or "").encode().lower().translate(BREAKS).split(b"\n") if (w := [y for y in x.split(b" ") if y])]


def packed(ids: np.ndarray) -> np.ndarray:
    """Every phrase of two or three words; ``ids`` has a 0 between pieces."""
    one, two, three = ids[:-2], ids[1:-1], ids[2:]
    pair = (one > 0) & (two > 0)
    pairs = one[pair] << (2 * BITS) | two[pair] << BITS
    return np.concatenate([pairs, pairs[three[pair] > 0] | three[pair & (three > 0)]])


class Counter:
    """Tries and vocabulary of a task; what it returns are runs for the prefix partitions."""

    def __init__(self, buckets: int, salt: int):
        self.buckets, self.salt = buckets, salt
        self.tries: dict[str, Trie] = {}
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.uses: dict[str, np.ndarray] = {}

    def __call__(self, rows):
        out: dict[int, list[bytes]] = {}
        self.ids: dict[str, list[int]] = {}
        self.twice: dict[str, list[tuple[int, int]]] = {}
        for text, lang in zip(rows["text"], rows["lang"], strict=True):
            lang = "und" if lang is None else lang
            for words in pieces(text):
                for at in range(0, len(words), PIECE):
                    if len(self.numbers) >= NUMBERED:
                        # Numbers are used up: all that holds them goes, and numbering begins again.
                        self.count(out)
                        self.spill(out, 0)
                    numbers = self.numbers
                    ids = self.ids.setdefault(lang, [0])
                    part = [numbers.setdefault(w, len(numbers) + 1) for w in words[max(0, at - 2) : at + PIECE]]
                    ids += part
                    ids.append(0)
                    if at:  # the last two words before were counted already
                        self.twice.setdefault(lang, []).append((part[0], part[1]))
        self.count(out)
        if sum(t.size for t in self.tries.values()) > HELD:
            self.spill(out, HELD // 2)
        return self.rows(out)

    def count(self, out: dict[int, list[bytes]]) -> None:
        for lang, held in self.ids.items():
            ids = np.array([*held, 0, 0], np.int64)
            uses = np.bincount(ids, minlength=len(self.numbers) + 1)
            known = self.uses.get(lang, np.zeros(0, np.int64))
            uses[: len(known)] += known
            self.uses[lang] = uses
            codes, counts = np.unique(packed(ids), return_counts=True)
            again = np.array(self.twice.get(lang, []), np.int64).reshape(-1, 2).T
            if again.size:
                np.subtract.at(uses, again, 1)
                codes = np.concatenate([codes, again[0] << (2 * BITS) | again[1] << BITS])
                counts = np.concatenate([counts, np.full(again.shape[1], -1)])
            trie = self.tries.setdefault(lang, Trie())
            for at in range(0, len(codes), HELD // 2):
                trie.add(codes[at : at + HELD // 2], counts[at : at + HELD // 2])
                if trie.size > 2 * HELD:
                    self.spill_tries(out, HELD // 2)
        self.ids, self.twice = {}, {}

    def spill(self, out, keep: int) -> None:
        self.spill_tries(out, keep)
        if keep == 0:
            words = list(self.numbers)
            hashes = self.hashes()[1:]
            for lang, uses in self.uses.items():
                used = np.flatnonzero(uses[1:])
                keys = prefix_keys(hashes[used], np.zeros(len(used), np.int64))
                for bucket, own in by_bucket(keys, self.buckets):
                    own = used[own]
                    text = b" ".join([words[k] for k in own])
                    out.setdefault(bucket, []).append(section(lang, VOCABULARY, hashes[own], uses[1:][own], np.frombuffer(text, np.uint8)))
            self.forget()

    def spill_tries(self, out, keep: int) -> None:
        hashes = self.hashes()
        total = sum(t.size for t in self.tries.values()) or 1
        mask = (1 << BITS) - 1
        for lang, trie in self.tries.items():
            subtrees = list(trie.spill(keep * trie.size // total))
            if not subtrees:
                continue
            codes, counts = (np.concatenate(x) for x in zip(*subtrees, strict=True))
            h1, h2, h3 = (hashes[codes >> shift & mask] for shift in (2 * BITS, BITS, 0))
            keys = prefix_keys(h1, h2)
            for bucket, own in by_bucket(keys, self.buckets):
                out.setdefault(bucket, []).append(run_of(lang, h1[own], h2[own], h3[own], counts[own]))

    def hashes(self) -> np.ndarray:
        """Hash of each number's word; 0 for no word and for none else."""
        found = np.fromiter((xxhash.xxh64_intdigest(w, self.salt) or 1 for w in self.numbers), np.uint64, len(self.numbers))
        return np.concatenate([np.zeros(1, np.uint64), found]).view(np.int64)

    def finish(self):
        out: dict[int, list[bytes]] = {}
        self.spill(out, 0)
        return self.rows(out)

    def rows(self, out):
        """One row for each prefix partition, with its runs in all languages."""
        squeeze = zstandard.ZstdCompressor(level=1).compress
        return {"bucket": list(out), "run": [squeeze(b"".join(x)) for x in out.values()]} if out else None


def prefix_keys(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The key by which phrases are sorted and parted: a hash of the first two words; a single word has a second of 0."""
    return mixed(h1.view(np.uint64) ^ mixed(h2.view(np.uint64)))


def by_bucket(keys: np.ndarray, buckets: int):
    """(bucket, indices in order of their keys) for each prefix partition, which is a range of keys."""
    order = np.argsort(keys)
    of = ((keys[order] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    heads = np.flatnonzero(np.diff(of, prepend=-1))
    for a, z in zip(heads, [*heads[1:], len(of)], strict=True):
        yield int(of[a]), order[a:z]


def run_of(lang: str, h1, h2, h3, counts) -> bytes:
    """A sorted run: each prefix once, with how many phrases follow it."""
    heads = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
    return section(lang, PHRASES, h1[heads], h2[heads], np.diff(np.append(heads, len(h1))), h3, counts)


def section(lang: str, kind: int, *columns: np.ndarray) -> bytes:
    """A run as bytes: language, kind, and columns with their lengths. Wide counts are mostly zeros, which compress away."""
    name = lang.encode()
    head = np.array([kind, len(name), len(columns), *[c.nbytes for c in columns]], np.int64)
    return b"".join([head.tobytes(), name, *[c.tobytes() for c in columns]])


def sections(run: bytes):
    """(language, kind, columns as bytes) of the runs in a row."""
    raw, at = zstandard.ZstdDecompressor().decompress(run), 0
    while at < len(raw):
        kind, name, n = np.frombuffer(raw, np.int64, 3, at).tolist()
        sizes = np.frombuffer(raw, np.int64, n, at + 24).tolist()
        at += 24 + 8 * n
        lang, at = raw[at : at + name].decode(), at + name
        columns = []
        for size in sizes:
            columns.append(raw[at : at + size])
            at += size
        yield lang, kind, columns


# --- merging a prefix partition -------------------------------------------------------------


class Merge:
    """Sums of the runs of one prefix partition and language."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.held = self.settled = 0
        self.words: dict[int, tuple[bytes, int]] = {}
        self.total, self.clash = 0, False

    def add(self, kind: int, columns: list[bytes]) -> None:
        if kind == VOCABULARY:
            hashes, uses = (np.frombuffer(c, np.int64) for c in columns[:2])
            self.total += int(uses.sum())
            for h, n, word in zip(hashes.tolist(), uses.tolist(), columns[2].split(b" "), strict=True):
                known = self.words.get(h)
                self.clash |= known is not None and known[0] != word
                self.words[h] = (word, n + (known[1] if known else 0))
            return
        h1, h2, sizes, h3, counts = (np.frombuffer(c, np.int64) for c in columns)
        self.parts.append(np.stack([np.repeat(h1, sizes), np.repeat(h2, sizes), h3, counts]))
        self.held += len(h3)
        if self.held > MERGED + 2 * self.settled:
            self.merge()

    def merge(self) -> None:
        """Runs made one, sorted, each phrase once."""
        rows = np.concatenate(self.parts, axis=1)
        keys = prefix_keys(rows[0], rows[1])
        order = np.lexsort((rows[2], keys))
        rows, keys = rows[:, order], keys[order]
        if ((keys[1:] == keys[:-1]) & (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)).any():
            # Two prefixes of one key: sorted by their words as well.
            rows = rows[:, np.lexsort((rows[2], rows[1], rows[0], keys))]
        head = np.flatnonzero(np.concatenate([[True], (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)]))
        merged = rows[:, head]
        merged[3] = np.add.reduceat(rows[3], head)
        self.parts, self.held = [merged], merged.shape[1]
        self.settled = self.held

    def rows(self, lang: str, least: int) -> list[tuple]:
        out = [(VOCABULARY, lang, h, 0, 0, n, word.decode("utf-8", "replace")) for h, (word, n) in self.words.items() if n >= least]
        if self.parts:
            self.merge()
            found = self.parts[0]
            out += [(PHRASES, lang, *x, None) for x in found[:, found[3] >= least].T.tolist()]
        if self.words:
            out.append((TOTAL, lang, 0, 0, 0, self.total, None))
        if self.clash:
            out.append((CLASH, lang, 0, 0, 0, 1, None))
        return out


def merged(runs: DataFrame, least: int) -> DataFrame:
    """Counts of ``least`` or more from runs that lie by prefix partition, sorted by it."""
    schema = pa.schema([("kind", pa.int32()), ("lang", pa.string()), *[(c, pa.int64()) for c in ("h1", "h2", "h3", "n")], ("word", pa.string())])

    def batches_of(held):
        rows = [row for lang, merge in held.items() for row in merge.rows(lang, least)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def run(batches):
        at, held = None, {}
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("run"), strict=True):
                if bucket != at:
                    yield from batches_of(held)
                    at, held = bucket, {}
                for lang, kind, columns in sections(blob.as_py()):
                    if lang not in held:
                        held[lang] = Merge()
                    held[lang].add(kind, columns)
        yield from batches_of(held)

    return runs.mapInArrow(run, COUNTED)


def phrase_counts(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """(kind, lang, h1, h2, h3, n, word): counts of words and phrases from ``least`` on, and words of each language in all."""
    texts = documents.select("text", F.col("lang").cast("string").alias("lang"))
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = 0
    while True:
        runs = map_slices(texts, lambda salt=salt: Counter(FINER * tasks, salt), RUN)
        found = written(merged(runs.repartition("bucket").sortWithinPartitions("bucket"), least))
        if found.where(F.col("kind") == CLASH).isEmpty():
            return found
        salt += 1


# --- scores ---------------------------------------------------------------------------------


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)), exactly."""
    wide = lambda c: c.cast("decimal(15,0)")
    whole = (wide(a) * wide(a) * F.lit(SCALE).cast("decimal(7,0)")).cast("decimal(38,0)")
    return F.call_function("div", whole, (wide(left) * wide(right)).cast("decimal(38,0)"))


def candidates(counts: DataFrame) -> DataFrame:
    """(lang, w1, w2, w3, a, l, r, score): each candidate with its words and its lowest-scoring cut."""
    word = counts.where(F.col("kind") == VOCABULARY).select("lang", F.col("h1").alias("h"), F.col("n").alias("f"), "word")
    phrase = counts.where(F.col("kind") == PHRASES)
    pairs = phrase.where("h3 = 0").select("lang", "h1", "h2", F.col("n").alias("a"))
    triples = phrase.where("h3 != 0").select("lang", "h1", "h2", "h3", F.col("n").alias("a"))
    # The greatest count of a triple that holds a pair, on either side of it.
    holding = triples.select("lang", "h1", "h2", "a").unionByName(triples.select("lang", F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
    holding = holding.groupBy("lang", "h1", "h2").agg(F.max("a").alias("longer"))
    kept = pairs.join(holding, ["lang", "h1", "h2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < TAKEN * F.col("a")))
    left, right = pairs.withColumnRenamed("a", "f12"), pairs.select("lang", F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"))
    threes = triples.join(left, ["lang", "h1", "h2"]).join(right, ["lang", "h2", "h3"])
    nothing = F.lit(None).cast("long")
    every = kept.select("lang", "h1", "h2", F.lit(0).cast("long").alias("h3"), "a", nothing.alias("f12"), nothing.alias("f23")).unionByName(threes.select("lang", "h1", "h2", "h3", "a", "f12", "f23"))
    for k in (1, 2, 3):
        own = word.select("lang", F.col("h").alias(f"h{k}"), F.col("f").alias(f"f{k}"), F.col("word").alias(f"w{k}"))
        every = every.join(own, ["lang", f"h{k}"], "left" if k == 3 else "inner")
    two = F.col("h3") == 0
    first = F.struct(score(F.col("a"), F.col("f1"), F.when(two, F.col("f2")).otherwise(F.col("f23"))).alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.when(two, F.col("f2")).otherwise(F.col("f23")).alias("r"))
    second = F.when(~two, F.struct(score(F.col("a"), F.col("f12"), F.col("f3")).alias("score"), F.lit(2).alias("k"), F.col("f12").alias("l"), F.col("f3").alias("r")))
    cut = F.least(first, second)
    return every.withColumn("cut", cut).select("lang", "w1", "w2", "w3", "a", "cut.l", "cut.r", "cut.score")


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases: (lang, rank, phrase, a, l, r, n, score)."""
    counts = phrase_counts(documents, least)
    totals = counts.where(F.col("kind") == TOTAL).groupBy("lang").agg(F.sum("n").alias("n"))
    scored = candidates(counts).withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    order = F.desc("score"), F.desc("a"), "phrase"
    # The best of each part meet in the end: a language with most candidates is not ranked in one task.
    part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    some = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANKED))).withColumn("place", part).where(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    best = some.withColumn("rank", rank).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))
