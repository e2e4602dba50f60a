"""Operator 10, n-gram Jaccard join: a MinHash LSH forest with exact verification.

A text's shingles are its runs of five words, A-Z lowered; a shorter text is one shingle. Texts with equal shingle sets
are copies and join as one representative. Each representative has a label of LABEL minhash values in each of TREES trees.
A tree is its labels in sorted order, that is a prefix trie; the order, range-partitioned, tells how deep each label
shares its branch with a neighbour. Texts first meet on whole labels. Then the matched prefix is shortened until the share
of links found reaches RECALL, as estimated from verified pairs close to the threshold: those that one half of the trees
finds tell what the other half misses. While too few such pairs are known, one of exactly SIMILAR is assumed to exist.

Meetings whose signatures agree too little are dropped; the others' connected parts are verified exactly, shingle set
against shingle set, in blocks of bounded size. Links are counted inside the blocks; only counts and spanning edges leave
them, never all pairs. In a large meeting each text is compared with the meeting's least one; only if some are unlike it
are all of the meeting compared, in blocks of bounded size as well.

One row per row of the input: class id (least document id among all linked, directly or not, copies included) and the
number of other rows that are linked directly. A null or empty text has no shingle: a class of its own, no link. A very
long text is one set of shingles like others. Repeated rows are copies of each other. A null id can be linked; a class of
null ids only has a null id. Ties in order are broken by row. No rows give no rows.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import encode, map_slices, mixed, owners, table, windows, written
from tillcast.operators.stored_checks import may_be_in

LOG = logging.getLogger(__name__)

#: Words of a shingle, least similarity of a link, and least share of links at that similarity that must meet.
WORDS, SIMILAR, RECALL = 5, 0.8, 0.999
#: Trees, values of a label, and how many of these no other tree has.
TREES, LABEL, OWN = 40, 16, 8
#: Shortest prefix, and verified pairs near the threshold from which on their recall is measured.
SHORTEST, MEASURED = 4, 1000
#: Agreement of signatures of a pair near the threshold.
NEAR = (SIMILAR - 0.02, SIMILAR + 0.04)
#: Least agreement of signatures of a pair that is verified: over six standard deviations below SIMILAR.
AGREE = 0.65
#: A meeting of at most so many texts compares all pairs; a block of a larger one holds about so many.
SMALL, MET_BLOCK = 16, 512
#: A block of a connected part holds about so many texts, and so many shingles.
BLOCK_TEXTS, BLOCK_SHINGLES = 128, 1 << 18
#: Bits that tell which texts or signatures may be wanted: 4 MB at most.
KEY_BITS = 1 << 25
#: Shingles hashed at once, and rows of small meetings that a task pairs at once.
CHUNK, HELD = 1 << 16, 1 << 16

SIGNED = "doc_id long, text_key long, row long, n long, k1 long, k2 long, signature binary"


def found_share(similar: float, size: int, trees: int = TREES) -> float:
    """Share of pairs of this similarity that meet at a prefix of ``size`` values in some tree."""
    return 1 - (1 - similar**size) ** trees


def recall(size: int, pairs: int, first: int, second: int, both: int) -> tuple[float, float]:
    """Share of links near the threshold that meet at this prefix length, and the similarity this speaks of.

    Of ``pairs`` such pairs the first half of the trees found ``first``, the second half ``second``, and ``both`` are in
    both: what each half finds of the other's pairs is its own share. Few pairs say nothing on a small share that is missed.
    """
    if pairs < MEASURED:
        return found_share(SIMILAR, size), SIMILAR
    halves = both / max(1, second), both / max(1, first)
    missed = (1 - halves[0]) * (1 - halves[1])
    return 1 - missed, (1 - missed ** (1 / TREES)) ** (1 / size)


def shorter(size: int, similar: float) -> int:
    """The longest prefix below ``size`` at which pairs of this similarity would meet well enough."""
    return max((k for k in range(SHORTEST, size) if found_share(similar, k) >= RECALL), default=SHORTEST)


def shingle_sets(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and how many each has."""
    ids, counts, words = encode(texts, lower=True)
    # A word's hash is a sum over its bytes by place, so it is the same in every slice.
    raw = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64)
    sizes = np.array([len(w) for w in words], np.int64)
    place = (np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.uint64)
    hashes = np.zeros(len(words), np.uint64)
    np.add.at(hashes, owners(sizes), mixed(raw + np.uint64(1) + (place << np.uint64(8))))
    values, of = mixed(hashes)[ids] if len(ids) else np.zeros(0, np.uint64), owners(counts)
    keys, first = windows(values, counts, WORDS)
    at = of[first]
    for k in np.flatnonzero((counts > 0) & (counts < WORDS)):
        start = int(counts[:k].sum())
        keys = np.append(keys, windows(values[start : start + counts[k]], counts[k : k + 1], int(counts[k]))[0] + np.uint64(counts[k]))
        at = np.append(at, k)
    order = np.lexsort((keys, at))
    keys, at = keys[order], at[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (at[1:] != at[:-1])]) if len(keys) else np.zeros(0, bool)
    return keys[new], np.bincount(at[new], minlength=len(texts))


def multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(10)
    return draw.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), draw.integers(0, 1 << 32, n, dtype=np.uint32)


def minhashes(keys: np.ndarray, counts: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Signature of each non-empty set: 16 bits of the least of each permuted hash."""
    out = np.zeros((len(counts), len(factors)), np.uint16)
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] - counts[at] + CHUNK, "right")))
        some = at + np.flatnonzero(counts[at:stop])
        if len(some):
            start = ends[at] - counts[at]
            part = mixed(keys[start : ends[stop - 1]])
            high, low = (part >> np.uint64(32)).astype(np.uint32), part.astype(np.uint32)
            bounds = ends[some] - counts[some] - start
            for k in range(len(factors)):
                values = (low * factors[k] + offsets[k]) ^ (high * factors[-1 - k])
                values *= np.uint32(0x9E3779B1)
                least = np.minimum.reduceat(values, bounds)
                out[some, k] = (least * np.uint32(0x85EBCA6B)) >> np.uint32(16)
        at = stop
    return out


def signed(documents: DataFrame) -> DataFrame:
    """Each row with its shingle count, a 128-bit key of its shingle set, and its signature."""

    def make():
        factors, offsets = multipliers(TREES * OWN)

        def step(rows):
            keys, counts = shingle_sets(rows["text"])
            of = owners(counts)
            k1, k2 = np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.uint64)
            np.add.at(k1, of, mixed(keys))
            np.add.at(k2, of, mixed(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
            signatures = minhashes(keys, counts, factors, offsets)
            return {
                "doc_id": rows["doc_id"], "text_key": rows["text_key"], "row": rows["row"], "n": counts, "k1": k1.view(np.int64), "k2": k2.view(np.int64),
                "signature": [s.tobytes() if n else None for s, n in zip(signatures, counts, strict=True)],
            }

        return step

    keyed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"), F.monotonically_increasing_id().alias("row"))
    return written(map_slices(keyed, make, SIGNED))


def streamed_groups(batches, key: list[str], solve, schema: pa.Schema):
    """``solve`` applied to each run of rows with one key, over batches sorted by key; it gets the rows as an Arrow table."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in key], axis=1)
        heads = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), batch.num_rows]
        for h, t in zip(heads[:-1], heads[1:], strict=True):
            part = batch.slice(h, t - h)
            if held and any(held[0].column(k)[0].as_py() != part.column(k)[0].as_py() for k in key):
                yield pa.RecordBatch.from_pydict(solve(pa.Table.from_batches(held)), schema=schema)
                held = []
            held.append(part)
    if held:
        yield pa.RecordBatch.from_pydict(solve(pa.Table.from_batches(held)), schema=schema)


def label_places() -> np.ndarray:
    """For each tree, which values of a signature its label reads: its own first, then one each of other trees."""
    tree, place = np.arange(TREES)[:, None], np.arange(LABEL)[None, :]
    lent = (tree + 1 + (TREES // (LABEL - OWN)) * (place - OWN)) % TREES
    return np.where(place < OWN, tree * OWN + place, lent * OWN + (place - OWN) % OWN)


def labels(representatives: DataFrame) -> DataFrame:
    """(node, tree, high, low): a byte of each value of a label, the earliest the highest."""

    def make():
        places = label_places()

        def step(rows):
            n = len(rows["rep"])
            values = np.ascontiguousarray(np.frombuffer(b"".join(rows["signature"]), np.uint16).reshape(n, -1)[:, places].astype(np.uint8))
            high, low = np.moveaxis(values.view(">i8").astype(np.int64), 2, 0)
            return {"node": np.repeat(np.array(rows["rep"], np.int64), TREES), "tree": np.tile(np.arange(TREES, dtype=np.int8), n), "high": high.ravel(), "low": low.ravel()}

        return step

    return map_slices(representatives.select("rep", "signature"), make, "node long, tree byte, high long, low long", text="")


def shared_values(tree: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """How many first values each label shares with the one after it."""

    def leading(x):
        return sum((x >> np.uint64(64 - 8 * k) == 0).astype(np.int8) for k in range(1, 8)) + (x == 0)

    top, rest = ((x[1:] ^ x[:-1]).view(np.uint64) for x in (high, low))
    return np.where(tree[1:] != tree[:-1], 0, np.where(top != 0, leading(top), 8 + leading(rest)))


def forest(representatives: DataFrame) -> DataFrame:
    """Labels in the order of their trees with ``depth``, the most first values shared with a neighbour; those of SHORTEST or more.

    Any label that shares a prefix has a neighbour that does. The node is part of the order, so a range boundary may cut a
    hot label; the outermost rows of a partition, whose neighbour is elsewhere, count as deep.
    """
    columns = ["node", "tree", "high", "low"]

    def run(batches):
        held, before = None, LABEL
        for batch in batches:
            if not batch.num_rows:
                continue
            node, tree, high, low = (batch.column(c).to_numpy() for c in columns)
            if held is not None:
                node, tree, high, low = (np.concatenate([h, x]) for h, x in zip(held, (node, tree, high, low), strict=True))
            near = shared_values(tree, high, low)
            depth = np.maximum(np.concatenate([[before], near[:-1]]), near) if len(near) else near
            keep = np.flatnonzero(depth >= SHORTEST)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (node, tree, high, low)] + [pa.array(depth[keep].astype(np.int8))], [*columns, "depth"])
            held, before = [x[-1:] for x in (node, tree, high, low)], int(near[-1]) if len(near) else before
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held] + [pa.array([LABEL], pa.int8())], [*columns, "depth"])

    order = ["tree", "high", "low", "node"]
    ordered = labels(representatives).repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ordered.mapInArrow(run, "node long, tree byte, high long, low long, depth byte"))


def small_meetings(branches: DataFrame) -> DataFrame:
    """All pairs (a, b, half) of meetings (bucket, node, half) of at most SMALL nodes, sorted within partitions."""

    def pairs(bucket, node, half):
        heads = np.flatnonzero(np.concatenate([[True], np.diff(bucket) != 0]))
        sizes = np.diff(np.append(heads, len(bucket)))
        out = [(np.zeros(0, np.int64),) * 2]
        for size in np.unique(sizes[sizes > 1]):
            i, j = np.triu_indices(size, 1)
            starts = heads[sizes == size][:, None]
            out.append(((starts + i).ravel(), (starts + j).ravel()))
        i, j = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j])), pa.array(half[i])], ["a", "b", "half"])

    def run(batches):
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int8)]
        for batch in batches:
            held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("bucket", "node", "half"), strict=True)]
            if len(held[0]) > HELD:
                last = int(np.flatnonzero(held[0] != held[0][-1])[-1]) + 1 if (held[0] != held[0][-1]).any() else 0
                yield pairs(*(h[:last] for h in held))
                held = [h[last:] for h in held]
        if len(held[0]):
            yield pairs(*held)

    return branches.repartition("bucket").sortWithinPartitions("bucket", "node").mapInArrow(run, "a long, b long, half byte")


def meetings(trees: DataFrame, size: int) -> DataFrame:
    """Pairs to compare (a, b, half, bucket) of nodes whose labels share ``size`` values; ``half`` tells which trees.

    In a small meeting all meet. In a large one, which sets ``bucket``, each meets the least node: those rows come from a
    join with the meeting's least node, which Spark may split, so no task has to hold a hot meeting.
    """
    mask = lambda n: F.lit(-1 if n >= 8 else -(1 << (64 - 8 * n)) if n > 0 else 0).cast("long")
    prefix = F.xxhash64("tree", F.col("high").bitwiseAND(mask(size)), F.col("low").bitwiseAND(mask(size - 8)))
    half = F.when(F.col("tree") < TREES // 2, 1).otherwise(2).cast("byte").alias("half")
    branches = trees.where(F.col("depth") >= size).select(prefix.alias("bucket"), "node", half)
    groups = written(branches.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("least")).where("n > 1"))
    met = branches.join(groups.where(F.col("n") > SMALL).select("bucket", "least"), "bucket").where("node != least")
    large = met.select(F.col("least").alias("a"), F.col("node").alias("b"), "half", "bucket")
    small = small_meetings(branches.join(groups.where(F.col("n") <= SMALL).select("bucket"), "bucket", "left_semi"))
    return written(large.unionByName(small.withColumn("bucket", F.lit(None).cast("long"))))


def agreeing(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs (a, b, halves) with the agreement of their signatures."""
    left = signatures.select(F.col("rep").alias("a"), F.col("signature").alias("one"))
    right = signatures.select(F.col("rep").alias("b"), F.col("signature").alias("two"))

    def run(batches):
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("one", "two"))
            agree = (one == two).mean(axis=1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "halves")), pa.array(agree)], ["a", "b", "halves", "agree"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "halves", "one", "two").mapInArrow(run, "a long, b long, halves byte, agree double")


def connected(like) -> np.ndarray:
    """(least, other) for all others of 0 … n-1 that are linked, directly or not, to a least one."""
    left, edges = np.arange(len(like.rows)), []
    while len(left):
        least, left = left[0], left[1:]
        front = [least]
        while front and len(left):
            near = like(front.pop(), left)
            edges += [(least, x) for x in left[near]]
            front += left[near].tolist()
            left = left[~near]
    return np.array(edges, np.int64).reshape(-1, 2)


class Agreement:
    """Links of rows whose signatures agree enough."""

    def __init__(self, signatures: list[bytes]):
        self.rows = np.frombuffer(b"".join(signatures), np.uint16).reshape(len(signatures), -1)

    def __call__(self, k, others):
        return (self.rows[others] == self.rows[k]).mean(axis=1) >= AGREE


def met_in_blocks(members: DataFrame) -> DataFrame:
    """Edges (a, b) from the least node of what agrees in a block of a meeting: rows (bucket, i, j, node, signature), sorted.

    Trees that find the same group give the same edges, so few distinct ones are left.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def solve(rows):
        nodes = rows["node"].to_numpy()
        edges = connected(Agreement(rows["signature"].to_pylist()))
        return {"a": nodes[edges[:, 0]], "b": nodes[edges[:, 1]]}

    return members.mapInArrow(lambda batches: streamed_groups(batches, ["bucket", "i", "j"], solve, schema), "a long, b long")


def in_block_pairs(rows: DataFrame, node: str, *key: str) -> DataFrame:
    """Each row once for every pair (i, j) of blocks with its own; ``blocks`` says how many blocks the key has."""
    own = rows.withColumn("block", F.pmod(F.xxhash64(node), F.col("blocks")))
    spread = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = spread.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other", "blocks")
    return paired.repartition(*key, "i", "j").sortWithinPartitions(*key, "i", "j", node)


def candidates(representatives: DataFrame, bits: int | None = None) -> DataFrame:
    """Edges (a, b) that connect all representatives which may be alike."""
    trees, size = forest(representatives), LABEL
    while True:
        met = meetings(trees, size)
        pairs = written(met.groupBy("a", "b").agg(F.bit_or("half").alias("halves")))
        nodes = pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep"))).distinct()
        signatures = representatives.select("rep", "signature")
        if bits is not None:
            hashed = F.xxhash64("rep").alias("hash")
            signatures = may_be_in(signatures.select("*", hashed), nodes.select(hashed), bits).drop("hash")
        signatures = written(signatures.join(nodes, "rep"))
        compared = written(agreeing(pairs, signatures))
        near = compared.where(F.col("agree").between(*NEAR)).agg(
            F.count("*"), F.count_if(F.col("halves") != 2), F.count_if(F.col("halves") != 1), F.count_if(F.col("halves") == 3)
        )
        share, similar = recall(size, *near.first())
        LOG.info("prefix of %d values: recall %.5f near the threshold", size, share)
        if share >= RECALL or size == SHORTEST:
            break
        size = shorter(size, similar)
    agreed = compared.where(F.col("agree") >= AGREE).select("a", "b")
    # Where some of a large meeting don't agree with its least node, all of the meeting are compared, in blocks.
    large = met.where("bucket is not null")
    open_ = large.join(compared.where(F.col("agree") < AGREE), ["a", "b"], "left_semi").select("bucket").distinct()
    own = large.join(open_, "bucket", "left_semi")
    members = written(own.select("bucket", F.col("b").alias("rep")).union(own.select("bucket", F.col("a").alias("rep")).distinct()))
    blocks = members.groupBy("bucket").agg(F.ceil(F.count("*") / MET_BLOCK).cast("long").alias("blocks"))
    spread = in_block_pairs(members.join(blocks, "bucket").join(signatures, "rep").withColumnRenamed("rep", "node"), "node", "bucket")
    return agreed.unionByName(met_in_blocks(spread.select("bucket", "i", "j", "node", "signature")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of an edge, the label being the least node it is connected to."""
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # A label's own label, as of this round, is lower still.
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        step = written(lower.join(up, "label").select("node", "old", F.col("above").alias("label")))
        labels = step.select("node", "label")
        if step.where("old != label").isEmpty():
            return labels


def similar_pairs(keys: list[np.ndarray]) -> np.ndarray:
    """Which pairs of sorted sets have a Jaccard similarity of SIMILAR or more, exactly."""
    sizes = np.array([len(k) for k in keys])
    values, at, uses = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    of = owners(sizes)
    shared = uses > 1
    place = np.cumsum(shared) - 1
    keep = shared[at]
    of, at = of[keep], place[at[keep]]
    common = np.zeros((len(keys), len(keys)), np.float64)
    order = np.argsort(at, kind="stable")
    of, at = of[order], at[order]
    width = 4096
    for start in range(0, int(shared.sum()), width):
        a, z = np.searchsorted(at, [start, start + width])
        part = np.zeros((len(keys), width), np.float32)
        part[of[a:z], at[a:z] - start] = 1
        common += part @ part.T
    # common / (n + m - common) >= 0.8, in whole numbers.
    whole = round(SIMILAR * 100)
    both = sizes[:, None] + sizes[None, :] - common
    like = 100 * common >= whole * both
    np.fill_diagonal(like, False)
    return like


class Likeness:
    """Links of rows by a matrix of links."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows

    def __call__(self, k, others):
        return self.rows[k, others]


def verified(members: DataFrame) -> DataFrame:
    """Links and spanning edges of blocks: rows (part, i, j, block, node, copies, keys) sorted by part, i and j.

    Out come (a, links, b): links counts the rows linked to ``a`` in one block, b is set for a spanning edge.
    """
    schema = pa.schema([("a", pa.int64()), ("links", pa.int64()), ("b", pa.int64())])

    def solve(rows):
        like = similar_pairs([np.frombuffer(k, np.uint64) for k in rows["keys"].to_pylist()])
        block, copies, nodes = (rows[c].to_numpy() for c in ("block", "copies", "node"))
        if rows["i"][0] != rows["j"][0]:
            like &= block[:, None] != block[None, :]
        links = (like * copies[None, :]).sum(axis=1)
        some = np.flatnonzero(links)
        edges = connected(Likeness(like))
        none = np.zeros(len(edges), np.int64)
        return {
            "a": np.concatenate([nodes[some], nodes[edges[:, 0]]]), "links": np.concatenate([links[some], none]),
            "b": pa.array(np.concatenate([nodes[some], nodes[edges[:, 1]]]), mask=np.arange(len(some) + len(edges)) < len(some)),
        }

    return members.mapInArrow(lambda batches: streamed_groups(batches, ["part", "i", "j"], solve, schema), "a long, links long, b long")


def with_shingles(documents: DataFrame, members: DataFrame, bits: int | None = None) -> DataFrame:
    """``members`` (node, doc_id, text_key, …) with their shingle sets, from the texts they stand for."""
    texts = documents.select(F.col("doc_id").cast("long").alias("own_id"), F.xxhash64("text").alias("_tillcast_key"), "text")
    if bits is not None:
        texts = may_be_in(texts.withColumn("hash", F.col("_tillcast_key")), members.select(F.col("text_key").alias("hash")), bits).drop("hash")
    found = texts.join(members.hint("shuffle_hash"), F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("_tillcast_key") == F.col("text_key")))

    def step(rows):
        keys, counts = shingle_sets(rows["text"])
        ends = np.cumsum(counts)
        return {**{c: rows[c] for c in ("node", "part", "copies", "blocks")}, "keys": [keys[z - n : z].tobytes() for z, n in zip(ends, counts, strict=True)]}

    rows = found.select("node", "part", "copies", "blocks", "text")
    # Repeated rows of one id bring the text of their representative twice.
    return map_slices(rows, lambda: step, "node long, part long, copies long, blocks long, keys binary").dropDuplicates(["node"])


def links(documents: DataFrame, representatives: DataFrame, bits: int | None = None) -> DataFrame:
    """(a, links, b) as ``verified`` gives them, over all parts that candidates connect."""
    parts = components(candidates(representatives, bits)).select(F.col("node").alias("rep"), F.col("label").alias("part"))
    members = written(representatives.join(parts, "rep").select(F.col("rep").alias("node"), "doc_id", "text_key", "copies", "n", "part"))
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    members = members.join(members.groupBy("part").agg(blocks.cast("long").alias("blocks")), "part")
    sets = with_shingles(documents, members.select("node", "doc_id", "text_key", "copies", "part", "blocks"), bits)
    return written(verified(in_block_pairs(sets, "node", "part").select("part", "i", "j", "block", "node", "copies", "keys")))


def classes(documents: DataFrame, among: DataFrame | None = None, bits: int | None = None) -> DataFrame:
    """(doc_id, text_key, label, class_id, n_links) for each row; a class has a label of its own.

    With ``among``, rows of other ids are left out, before anything is compared and without moving a text. With ``bits``,
    so many tell which texts and signatures may be candidates', and others aren't moved either.
    """
    rows = signed(documents)
    if among is not None:
        rows = written(rows.join(among.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi"))
    groups = rows.where("n > 0").groupBy("k1", "k2").agg(F.min("row").alias("rep"), F.count("*").alias("copies"), F.min("doc_id").alias("least"))
    groups = written(groups)
    chosen = rows.select(F.col("row").alias("rep"), "doc_id", "text_key", "n", "signature").join(groups.select("rep", "copies"), "rep")
    found = links(documents, written(chosen), bits)
    counts = found.where("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    labels = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    known = groups.join(labels, "rep", "left").join(counts, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    known = written(known)
    ids = known.groupBy("label").agg(F.min("least").alias("class_id"))
    known = known.join(ids, "label").select("k1", "k2", "label", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("linked"))
    out = rows.select("doc_id", "text_key", "row", "n", "k1", "k2").join(known, ["k1", "k2"], "left")
    alone = F.col("n") == 0
    return out.select(
        "doc_id", "text_key",
        F.when(alone, F.col("row")).otherwise(F.col("label")).alias("label"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, 0).otherwise(F.col("linked")).cast("long").alias("n_links"),
    )


def by_either(one: DataFrame, other: DataFrame) -> DataFrame:
    """(doc_id, label) of two classes' rows, with labels of their own."""
    return one.select("doc_id", "label").unionByName(other.select("doc_id", (-1 - F.col("label")).alias("label")))


def later_ones(found: DataFrame) -> DataFrame:
    """Ids of documents that aren't the first of those they are linked with, from rows (doc_id, order, label).

    A document may have several rows, one for each of its texts: it links their classes.
    """
    found = written(found)
    shared = found.groupBy("label").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a != b").select("label")
    linked = written(found.join(shared, "label", "left_semi"))
    edges = linked.groupBy("doc_id").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a != b").select("a", "b")
    groups = components(edges).select(F.col("node").alias("label"), F.col("label").alias("group"))
    grouped = linked.join(groups, "label", "left").select("doc_id", "order", F.coalesce("group", "label").alias("group")).distinct()
    first = grouped.groupBy("group").agg(F.min("order").alias("first"))
    return grouped.join(first, "group").where(F.col("order") != F.col("first")).select("doc_id")


def held_once(documents: DataFrame) -> DataFrame:
    """Ids that one row has."""
    return documents.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n = 1").select("doc_id")


def one_of_each_uncut(documents: DataFrame, whole: DataFrame) -> DataFrame:
    """The documents without all but the least id of each group of near duplicates, with all their columns; of rows alike one stays.

    Documents are compared twice, by the texts that ``whole`` holds, of which their own may be a part only, and by their own:
    two are alike if either are. Rows whose id isn't held once on both sides have their own text in both.
    """
    once = written(held_once(documents).join(held_once(whole), "doc_id", "left_semi"))
    if documents.join(once, "doc_id", "left_anti").select("doc_id").isEmpty():
        found = by_either(classes(whole.select("doc_id", "text"), once, KEY_BITS), classes(documents.select("doc_id", "text"), bits=KEY_BITS))
        later = later_ones(found.withColumn("order", F.col("doc_id"))).withColumnRenamed("doc_id", "_tillcast_id")
        return documents.join(later, F.col("doc_id").cast("long") == F.col("_tillcast_id"), "left_anti")
    text = documents.schema["text"].dataType
    own = whole.join(once, "doc_id", "left_semi").select("doc_id", F.col("text").cast(text).alias("_tillcast_whole"))
    uncut = F.coalesce("_tillcast_whole", "text")
    judged = documents.join(own, "doc_id", "left").withColumns({"_tillcast_whole": uncut, "_tillcast_row": F.monotonically_increasing_id()})
    # Repeated rows without words are like no other.
    judged = written(judged.withColumn("_tillcast_key", F.xxhash64("_tillcast_whole")).dropDuplicates(["doc_id", "_tillcast_key"]))
    row = F.col("_tillcast_row").alias("doc_id")
    found = by_either(*(classes(judged.select(row, F.col(c).alias("text")), bits=KEY_BITS) for c in ("_tillcast_whole", "text")))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_tillcast_key").alias("key"))
    later = later_ones(found.join(judged.select(row, order.alias("order")), "doc_id")).withColumnRenamed("doc_id", "_tillcast_row")
    return judged.join(later, "_tillcast_row", "left_anti").select(*documents.columns)


def op10_jaccard_join(spark, folder: str) -> DataFrame:
    return classes(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links")
