"""Operator 13, sharding by histogram sort: shards of near equal bytes, found by counting and filled by one exchange.

Rows are ordered by a 64-bit key: its upper half hashes the text, its lower half the row, so equal texts lie next to each
other and yet any group of them can be cut. Splitters are searched by histograms. Each pass sums bytes and rows, exactly
and over all rows, below candidate boundaries: the cells of equal key prefixes. A splitter whose nearest boundary meets
its tolerance is found; for the others the cell that holds the target is probed more finely in the next pass, until the
boundary is within tolerance or the cell is a single key. Then rows are exchanged once, by part: a shard has as many
parts as make the exchange as wide as the session's shuffles. Histograms also count rows, so the place of a row in its
shard is its place in its part and a known offset.

Everything is DataFrame functions. The driver sees at most CELLS sums a pass, however large the table is.

A null text has no bytes and counts OVERHEAD, as an empty one; a very long text is a row like others and may fill a shard
of its own, so that others stay empty. Repeated rows are rows of their own and may be parted. A null id is hashed like
any other. Ties of the key are ordered by row number. Fewer rows than shards leave shards empty; an empty table gives no
rows. Other columns are kept; ones named like those added (size, shard, slot) give way to them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import table, written

#: Bytes that a row counts beside its text.
OVERHEAD = 16
#: How far a shard's boundary may lie from its target, as a share of a shard's bytes; how far that of a part, of a part's.
SHARD_TOLERANCE, PART_TOLERANCE = 0.002, 0.1
#: Prefix bits of the first pass; most sums that a pass brings to the driver.
FIRST_BITS, CELLS = 12, 1 << 17
#: Prefix bits by which rows find the splitters near them, which is what is broadcast.
LOOKUP_BITS = 12
KEY_BITS = 64
#: Shards of the query.
SHARDS = 40

KEY, ROW, SIZE = "_tillcast_key", "_tillcast_row", "_tillcast_size"


@dataclass(order=True)
class Splitter:
    """First key of a part, and how much lies below it; a key of 2**63 is beyond all."""

    key: int
    bytes_below: int
    rows_below: int


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def keyed(documents: DataFrame) -> DataFrame:
    """The documents with sort key, row number and size; written, so that row numbers stay what they are."""
    row = F.monotonically_increasing_id()
    upper = F.xxhash64("text").bitwiseAND(F.lit(-(1 << 32)))
    return documents.withColumn(ROW, row).withColumn(SIZE, text_bytes(F.col("text"))).withColumn(KEY, upper.bitwiseOR(F.shiftrightunsigned(F.xxhash64("doc_id", ROW), 32)))


def prefix(bits: int) -> Column:
    """The leading bits of the key, in the order of keys."""
    return F.shiftright(F.col(KEY), KEY_BITS - bits)


def histogram(rows: DataFrame, bits: int, open_bits: int = 0, cells: list[int] | None = None) -> list[tuple[int, int, int]]:
    """(cell, bytes, rows) by the leading ``bits``, in order; only of the open cells where some are given."""
    if cells is not None:
        rows = rows.where(prefix(open_bits).isin(cells))
    sums = rows.groupBy(prefix(bits).alias("cell")).agg(F.sum(SIZE).alias("bytes"), F.count("*").alias("rows"))
    return sorted(tuple(r) for r in sums.collect())


def probe(targets: list[float], tolerances: list[float], cells: list[tuple[int, int, int]], bits: int, below: tuple[int, int]):
    """For each target, a splitter, or the open cell that holds it with what lies below that.

    ``cells`` are neighbours in order of their keys, ``below`` is what lies before the first of them.
    """
    found, k, (held, rows) = [], 0, below
    for target, tolerance in zip(targets, tolerances, strict=True):
        while k < len(cells) and held + cells[k][1] <= target:
            held, rows, k = held + cells[k][1], rows + cells[k][2], k + 1
        if k == len(cells):
            found.append(Splitter((cells[-1][0] + 1) << (KEY_BITS - bits), held, rows))
            continue
        cell, size, n = cells[k]
        low = Splitter(cell << (KEY_BITS - bits), held, rows)
        high = Splitter((cell + 1) << (KEY_BITS - bits), held + size, rows + n)
        near = min(low, high, key=lambda s: abs(s.bytes_below - target))
        met = abs(near.bytes_below - target) <= tolerance or bits == KEY_BITS
        found.append(near if met else (cell, held, rows))
    return found


def splitters(rows: DataFrame, shards: int, per_shard: int = 1) -> list[Splitter]:
    """Boundaries of ``shards * per_shard`` parts, in order of their keys; empty for no rows."""
    parts = shards * per_shard
    bits = FIRST_BITS
    cells = histogram(rows, bits)
    total = sum(c[1] for c in cells)
    if not total:
        return []
    targets = [total * k / parts for k in range(1, parts)]
    tolerances = [total * (SHARD_TOLERANCE / shards if k % per_shard == 0 else PART_TOLERANCE / parts) for k in range(1, parts)]
    found = probe(targets, tolerances, cells, bits, (0, 0))
    while open_cells := sorted({s for s in found if not isinstance(s, Splitter)}):
        finer = min(KEY_BITS, bits + max(1, int(math.log2(CELLS // len(open_cells)))))
        inner = histogram(rows, finer, bits, [c[0] for c in open_cells])
        for cell, held, n in open_cells:
            own = [x for x in inner if x[0] >> (finer - bits) == cell]
            at = [k for k, s in enumerate(found) if s == (cell, held, n)]
            settled = probe([targets[k] for k in at], [tolerances[k] for k in at], own, finer, (held, n))
            for k, s in zip(at, settled, strict=True):
                found[k] = s
        bits = finer
    return sorted(found)


def part_of(rows: DataFrame, cuts: list[Splitter]) -> DataFrame:
    """The rows with ``_tillcast_part``, the number of splitters at or below their key."""
    keys = [s.key for s in cuts if s.key < 1 << (KEY_BITS - 1)]
    every = F.array(*[F.lit(k).cast("long") for k in keys]).cast("array<long>")
    first, last = F.shiftleft(F.col("_tillcast_cell"), KEY_BITS - LOOKUP_BITS), F.col("_tillcast_cell")
    near = rows.sparkSession.range(-(1 << (LOOKUP_BITS - 1)), 1 << (LOOKUP_BITS - 1)).select(F.col("id").alias("_tillcast_cell"))
    near = near.select(
        "_tillcast_cell",
        F.size(F.filter(every, lambda k: k < first)).alias("_tillcast_before"),
        F.filter(every, lambda k: F.shiftright(k, KEY_BITS - LOOKUP_BITS) == last).alias("_tillcast_inside"),
    )
    # 2**LOOKUP_BITS rows and each splitter once: a size that doesn't depend on the table.
    joined = rows.withColumn("_tillcast_cell", prefix(LOOKUP_BITS)).join(F.broadcast(near), "_tillcast_cell")
    inside = F.size(F.filter("_tillcast_inside", lambda k: k <= F.col(KEY)))
    return joined.withColumn("_tillcast_part", F.col("_tillcast_before") + inside).drop("_tillcast_cell", "_tillcast_before", "_tillcast_inside")


def place(rows: DataFrame, cuts: list[Splitter], per_shard: int) -> DataFrame:
    """The rows with ``shard`` and ``slot``, exchanged once, each part sorted by key."""
    starts = [Splitter(-(1 << (KEY_BITS - 1)), 0, 0), *cuts]
    # Splitters beyond all keys end the list; parts behind them hold no rows.
    offsets = [s.rows_below - starts[k - k % per_shard].rows_below for k, s in enumerate(starts)]
    part = F.col("_tillcast_part")
    within = F.row_number().over(Window.partitionBy(part).orderBy(KEY, ROW)).cast("long") - 1
    offset = F.get(F.array(*[F.lit(x).cast("long") for x in offsets]), part)
    placed = part_of(rows, cuts).withColumn("_tillcast_within", within)
    return placed.withColumn("shard", F.floor(part / per_shard).cast("int")).withColumn("slot", F.col("_tillcast_within") + offset).drop("_tillcast_part", "_tillcast_within")


def shard_documents(documents: DataFrame, shards: int) -> DataFrame:
    """The documents with size, shard (from 0) and slot (gapless from 0 in a shard), sorted by key within tasks."""
    rows = written(keyed(documents.drop("size", "shard", "slot")))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_shard = max(1, math.ceil(tasks / shards))
    placed = place(rows, splitters(rows, shards, per_shard), per_shard)
    return placed.withColumnRenamed(SIZE, "size").drop(KEY, ROW)


def write_shards(documents: DataFrame, shards: int, path: str) -> None:
    """One folder a shard, its files sorted as its slots are."""
    shard_documents(documents, shards).write.partitionBy("shard").parquet(path)


def op13_histogram_sort(spark, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    # All that is asked of the texts is known before they would be moved.
    checksum = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    narrow = written(keyed(documents).select("doc_id", checksum, KEY, ROW, SIZE))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_shard = max(1, math.ceil(tasks / SHARDS))
    placed = place(narrow, splitters(narrow, SHARDS, per_shard), per_shard)
    return placed.select("doc_id", F.col(SIZE).alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
