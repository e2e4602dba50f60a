"""Tables kept by day: a refresh writes the days it touched and leaves the files of all others alone.

Rows are stored by run and day and never overwritten. A small table says for each day which run's rows are shown; it is
replaced in one catalog operation, so readers see all days of a refresh at once or none. The view joins rows with it,
which prunes the partitions that are read. Versions that neither this nor the former state shows are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.session import CODEC
from tillcast.sources import tables

RUN, PART = "_run", "_day"
#: The part of rows without a day.
NO_DAY = 0
#: Partitions dropped by one statement.
DROPPED = 200


def part_of(day: str) -> Column:
    return F.coalesce(F.col(day), F.lit(NO_DAY)).cast("int")


class DayTable:
    """``layer.name`` by the days of its column ``day``, a date key."""

    def __init__(self, spark: SparkSession, root: str, layer: str, name: str, day: str = "date_key"):
        self.spark, self.root, self.layer, self.name, self.day = spark, root, layer, name, day
        self.rows, self.shown = f"{name}__days", f"{name}__shown"

    def stage(self, df: DataFrame, run_id: str, sort: Iterable[str] = (), lie_by_day: bool = False) -> DataFrame:
        """Write rows as a run's version of their days, which nobody sees yet; returns them as written.

        The same run again replaces what it wrote. Rows lie by day, in even files also where a day holds most of them;
        with ``sort``, files hold narrow ranges of it. Rows that ``lie_by_day`` already, few days a task, are written
        where they are and not shuffled again; were it not so, there would be more files.
        """
        spark, rows = self.spark, f"`{self.layer}`.`{self.rows}`"
        tables.ensure_layer(spark, self.layer, self.root)
        parted = df.withColumn(PART, part_of(self.day))
        if self.rows not in tables.table_names(spark, self.layer):
            empty = spark.createDataFrame([], df.schema).withColumns({RUN: F.lit(""), PART: F.lit(NO_DAY)})
            empty.write.partitionBy(RUN, PART).option("compression", CODEC).format("parquet").saveAsTable(f"{self.layer}.{self.rows}")
        if sort:
            dealt = parted.repartitionByRange(PART, *sort).sortWithinPartitions(PART, *sort)
        elif lie_by_day:
            dealt = parted
        else:
            dealt = parted.hint("rebalance", F.col(PART))
        view = f"{self.name}__staged"
        dealt.createOrReplaceTempView(view)
        columns = ", ".join(f"`{c}`" for c in [*df.columns, PART])
        # Rows may come from what other runs wrote to this table, so this run's are dropped and not overwritten.
        self.drop([p for p in self.partitions() if p[0] == run_id])
        spark.sql(f"INSERT INTO TABLE {rows} PARTITION ({RUN} = '{run_id}', {PART}) SELECT {columns} FROM {view}")
        spark.catalog.dropTempView(view)
        spark.catalog.refreshTable(f"{self.layer}.{self.rows}")
        return self.version(run_id)

    def version(self, run_id: str) -> DataFrame:
        """All that a run wrote."""
        return self.spark.table(f"{self.layer}.{self.rows}").where(F.col(RUN) == run_id).drop(RUN, PART)

    def partitions(self) -> list[tuple[str, int]]:
        """(run, day) of everything stored, from the catalog."""
        found = self.spark.sql(f"SHOW PARTITIONS `{self.layer}`.`{self.rows}`").collect()
        pairs = [[part.split("=", 1)[1] for part in row[0].split("/")] for row in found]
        return [(run, int(day)) for run, day in pairs if run != "__HIVE_DEFAULT_PARTITION__"]

    def manifest(self, version: str | None = None) -> dict[int, str]:
        """The run shown for each day; as many entries as the calendar has days."""
        if version is None and self.shown not in tables.table_names(self.spark, self.layer):
            return {}
        return {r[PART]: r[RUN] for r in self.spark.table(f"{self.layer}.{version or self.shown}").collect()}

    def show(self, run_id: str, days: Iterable[int] | None = None) -> DataFrame:
        """Let readers see a run's version of the days, or, without ``days``, only what the run wrote."""
        spark = self.spark
        own = {day for run, day in self.partitions() if run == run_id}
        kept = {} if days is None else {d: r for d, r in self.manifest().items() if d not in set(days)}
        if days is not None and not own <= set(days):
            raise ValueError(f"{self.layer}.{self.name}: run {run_id} wrote days that it was not to touch: {sorted(own - set(days))}")
        state = sorted((kept | dict.fromkeys(own, run_id)).items())
        frame = spark.createDataFrame(state, f"{PART} int, {RUN} string").coalesce(1)
        tables.replace_table(frame, self.root, self.layer, self.shown, run_id)
        columns = [c for c in spark.table(f"{self.layer}.{self.rows}").columns if c not in (RUN, PART)]
        listed = ", ".join(f"d.`{c}`" for c in columns)
        # One row a day: a bound that doesn't grow with the rows.
        spark.sql(
            f"CREATE OR REPLACE VIEW `{self.layer}`.`{self.name}` AS SELECT /*+ BROADCAST(s) */ {listed} FROM `{self.layer}`.`{self.rows}` d "
            f"JOIN `{self.layer}`.`{self.shown}` s ON d.`{RUN}` = s.`{RUN}` AND d.`{PART}` = s.`{PART}`"
        )
        self.drop_unseen()
        return spark.table(f"{self.layer}.{self.name}")

    def drop_unseen(self) -> None:
        """Drop versions of days that neither the present nor the former state shows."""
        seen = {(run, day) for v in tables.versions(self.spark, self.layer, self.shown) for day, run in self.manifest(v).items()}
        self.drop([p for p in self.partitions() if p not in seen])

    def drop(self, partitions: list[tuple[str, int]]) -> None:
        for at in range(0, len(partitions), DROPPED):
            listed = ", ".join(f"PARTITION ({RUN} = '{run}', {PART} = {day})" for run, day in partitions[at : at + DROPPED])
            self.spark.sql(f"ALTER TABLE `{self.layer}`.`{self.rows}` DROP IF EXISTS {listed}")

    def replace(self, df: DataFrame, run_id: str, days: Iterable[int] | None = None, lie_by_day: bool = False) -> DataFrame:
        """Write and show; with ``days``, rows of other days are an error and keep what they show."""
        self.stage(df, run_id, lie_by_day=lie_by_day)
        return self.show(run_id, days)

    def read(self, days: Iterable[int] | None = None) -> DataFrame:
        """The rows shown; of some days only, whose partitions alone are read."""
        if days is None:
            return self.spark.table(f"{self.layer}.{self.name}")
        state = self.manifest()
        wanted: dict[str, list[int]] = {}
        for day in set(days) & set(state):
            wanted.setdefault(state[day], []).append(day)
        which = F.lit(False)
        for run, own in wanted.items():
            which = which | ((F.col(RUN) == run) & F.col(PART).isin(sorted(own)))
        return self.spark.table(f"{self.layer}.{self.rows}").where(which).drop(RUN, PART)
