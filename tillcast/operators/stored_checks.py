"""Checks kept by day, so that a refresh reads the days it touched and still answers for the whole table.

For every day of a table its state holds what the declared checks found: how many nulls a column has, how often each
foreign key occurs, and a sketch of each unique key, 64 hash bits and a count in place of each row's key. States of days add
up: nulls by their counts, foreign keys against the parents as they are now, and keys by their hashes. A hash that
several rows share, on one day or on two, is only a candidate: the rows of its days are read and the keys themselves
compared, so neither is a repeated key missed nor a collision reported.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.session import written
from tillcast.sources.days import DayTable, part_of

STATE_MARK = "_checks"
DAY, KIND, CHECK, HASH, VALUE, COUNT = "day", "kind", "check", "hash", "value", "n_rows"
NULLS, KEYS, PARENTS = "nulls", "keys", "parents"
#: Bits that tell which hashes may be among others: 32 MB at most.
BITS = 1 << 28


def _entry(kind: str, check: str, keep: Column, hashed: Column | None = None, value: Column | None = None) -> Column:
    found = F.struct(
        F.lit(kind).alias(KIND),
        F.lit(check).alias(CHECK),
        (F.lit(None).cast("bigint") if hashed is None else hashed).alias(HASH),
        (F.lit(None).cast("string") if value is None else value.cast("string")).alias(VALUE),
    )
    return F.when(keep, found)


def may_be_in(rows: DataFrame, wanted: DataFrame, bits: int | None = None) -> DataFrame:
    """The rows whose hash may be one of ``wanted``, told where they lie: all that are, and of the others those whose bit one has set.

    So many bits (BITS) in pieces of 4 KB are broadcast, a bound that doesn't grow with the hashes; the more there are, the more rows pass.
    """
    place = F.pmod(HASH, F.lit(bits or BITS)) + 1
    pieces = wanted.select(place.alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    found = rows.withColumn("_place", place).withColumn("_bucket", F.bitmap_bucket_number("_place")).join(F.broadcast(pieces), "_bucket")
    at = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substr("_bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, at.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1))
    return found.where(bit == 1).select(*rows.columns)


@dataclass(frozen=True)
class StoredChecks:
    """State of the checks of ``table``: null columns, keys and foreign keys with the label of each check.

    A key of one column is not compared where it is null; in a key of several a null equals a null. Foreign keys are
    compared as text, null ones not at all. Rows without a day are a day of their own. No rows give no failures.
    """

    table: DayTable
    not_null: Mapping[str, tuple[str, ...]]
    keys: Mapping[str, tuple[str, ...]]
    parents: Mapping[str, str]

    @property
    def state(self) -> DayTable:
        t = self.table
        return DayTable(t.spark, t.root, t.layer, t.name + STATE_MARK, DAY)

    def _compared(self, check: str) -> tuple[Column, Column]:
        """Whether a row's key is compared, and its hash."""
        columns = self.keys[check]
        return (F.col(columns[0]).isNotNull() if len(columns) == 1 else F.lit(True)), F.xxhash64(*columns)

    def of_rows(self, rows: DataFrame) -> DataFrame:
        """State of rows, by day. Nulls and foreign keys, of few values, are grouped, added up in each task before the shuffle.
        A key has a row for each row that holds it, which is written where that lies: what adds up later needs no shuffle now.
        """
        day = part_of(self.table.day).alias(DAY)
        entries = [_entry(NULLS, check, F.col(c).isNull(), value=F.lit(c)) for check, columns in self.not_null.items() for c in columns]
        entries += [_entry(PARENTS, check, F.col(c).isNotNull(), value=F.col(c)) for check, c in self.parents.items()]
        keys = [_entry(KEYS, check, *self._compared(check)) for check in self.keys]
        met = [rows.select(day, F.explode(F.array_compact(F.array(*some))).alias("met")).select(DAY, "met.*") for some in (entries, keys) if some]
        if entries:
            met[0] = met[0].groupBy(*met[0].columns).agg(F.count("*").alias(COUNT))
        if keys:
            met[-1] = met[-1].withColumn(COUNT, F.lit(1).cast("bigint"))
        return reduce(DataFrame.unionByName, met)

    def replace(self, run_id: str, days: Iterable[int] | None = None) -> None:
        """Take in the rows shown on ``days`` (all without): only these days' rows are read and only their state is written.

        A state that doesn't exist yet takes in all days.
        """
        if days is not None and not self.state.manifest() and self.table.manifest():
            days = None
        self.state.replace(self.of_rows(self.table.read(days)), run_id, days, lie_by_day=True)

    def _stored(self, kind: str, days: Iterable[int] | None = None) -> DataFrame:
        return self.state.read(days).where(F.col(KIND) == kind)

    def nulls(self) -> DataFrame:
        """(check, value, n_rows): rows with a null in the column ``value``."""
        return self._stored(NULLS).groupBy(CHECK, VALUE).agg(F.sum(COUNT).alias(COUNT))

    def orphans(self, parents: Mapping[str, DataFrame]) -> DataFrame:
        """(check, value, n_rows): foreign keys that their parent, the first column of ``parents[check]``, lacks now."""
        used = self._stored(PARENTS).groupBy(CHECK, VALUE).agg(F.sum(COUNT).alias(COUNT))
        if not self.parents:
            return used
        known = [parents[check].select(F.lit(check).alias(CHECK), F.col(parents[check].columns[0]).cast("string").alias(VALUE)) for check in self.parents]
        known = reduce(DataFrame.unionByName, known).distinct().withColumn("_known", F.lit(True))
        return used.join(known, [CHECK, VALUE], "left").where(F.col("_known").isNull()).drop("_known")

    def candidates(self, days: Iterable[int] | None = None) -> DataFrame:
        """(check, hash, days): hashes that several rows share, of those met on ``days`` (any without)."""
        sketches = self._stored(KEYS)
        if days is not None:
            met = self._stored(KEYS, days).select(CHECK, HASH).distinct()
            # The touched days are the small side; history is filtered where it lies, and what is left is joined. An inner
            # join with distinct hashes, as Spark would run a semi join before the filter.
            sketches = may_be_in(sketches, met).join(met, [CHECK, HASH])
        shared = sketches.groupBy(CHECK, HASH).agg(F.sum(COUNT).alias(COUNT), F.collect_set(DAY).alias("days"))
        return shared.where(F.col(COUNT) > 1).drop(COUNT)

    def repeated(self, days: Iterable[int] | None = None) -> DataFrame:
        """(check, value, n_rows): keys that several rows have, as JSON; with ``days``, of those met on these days.

        Reads rows only of the days on which candidates lie.
        """
        shared = written(self.candidates(days), "candidates")
        lie = {(r[CHECK], r["day"]) for r in shared.select(CHECK, F.explode("days").alias("day")).distinct().collect()}
        found = [self.state.spark.createDataFrame([], f"{CHECK} string, {VALUE} string, {COUNT} bigint")]
        for check, columns in self.keys.items():
            where = {day for label, day in lie if label == check}
            if not where:
                continue
            compared, hashed = self._compared(check)
            rows = self.table.read(where).select(*columns).where(compared).withColumn(HASH, hashed)
            own = shared.where(F.col(CHECK) == check).select(HASH)
            # The hash is a function of the columns: grouped by it too, rows that a join dealt out by it stay where they are.
            groups = may_be_in(rows, own).join(own, HASH).groupBy(HASH, *columns).agg(F.count("*").alias(COUNT)).where(F.col(COUNT) > 1)
            found.append(groups.select(F.lit(check).alias(CHECK), F.to_json(F.struct(*columns)).alias(VALUE), COUNT))
        return reduce(DataFrame.unionByName, found)

    def failures(self, parents: Mapping[str, DataFrame], days: Iterable[int] | None = None) -> DataFrame:
        """(check, n_rows) of the failed checks of the whole table.

        With ``days``, those replaced since the last look, keys are looked up for these days alone, against all days.
        """
        parts = [self.nulls(), self.orphans(parents), self.repeated(days)]
        return reduce(DataFrame.unionByName, parts).groupBy(CHECK).agg(F.sum(COUNT).alias(COUNT))
