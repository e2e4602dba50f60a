"""Exact distinct counts that add up: receipts as bits.

Every receipt has a number of its own. A mart keeps, for each of its keys and each run of 64 numbers, one word whose bits
are the receipts it holds. Distinct receipts of any coarser group are the bits of its words or-ed together, so roll-ups
read the mart and never the lines again. Numbers run by city and day, so the receipts of a day share words and a mart
of few products has few; where keys are sparse there are no more words than lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a word, as a power of two.
WORD_BITS = 6


def numbered(receipts: DataFrame, near: list[str], key: str = "sale_key") -> DataFrame:
    """(key, number): a number for each receipt, neighbours by ``near`` next to each other; write it before it is used.

    Rows are sorted by ranges over all tasks, so a day that holds most receipts is numbered by many. Numbers of a task
    run on; those of tasks are apart, which costs a word each. A repeated key keeps one number.
    """
    keys = receipts.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.min(c).alias(c) for c in near])
    ordered = keys.repartitionByRange(*near, key).sortWithinPartitions(*near, key)
    return ordered.select(key, F.monotonically_increasing_id().alias("number"))


def receipt_words(lines: DataFrame, numbers: DataFrame, by: list[str], key: str = "sale_key") -> DataFrame:
    """(by, word, bits): the receipts of each group, 64 a word. Lines without a receipt count for none."""
    place = F.col("number").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    placed = lines.select(*by, key).join(numbers, key).select(*by, F.shiftright("number", WORD_BITS).alias("word"), one.alias("bit"))
    return placed.groupBy(*by, "word").agg(F.bit_or("bit").alias("bits"))


def merged(words: DataFrame, by: list[str]) -> DataFrame:
    """Words of a coarser group."""
    return words.groupBy(*by, "word").agg(F.bit_or("bits").alias("bits"))


def receipts(words: DataFrame, by: list[str]) -> DataFrame:
    """Distinct receipts of each group."""
    return merged(words, by).groupBy(*by).agg(F.sum(F.bit_count("bits")).cast("long").alias("receipts_count"))
