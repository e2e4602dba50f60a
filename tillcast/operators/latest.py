"""Keep the newest load of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: list[str], newest_by: list[str]) -> DataFrame:
    """One row per key: the greatest by ``newest_by``, nulls counted as greatest.

    A hash of the remaining columns breaks ties, so a retried task picks the same
    row and no document is dragged through the sort key.
    Spark keeps only the first row per key on each map task before the shuffle,
    which holds a hot key to one row per task.
    """
    ties = [c for c in df.columns if c not in (*key, *newest_by)]
    order = [F.col(c).desc_nulls_first() for c in newest_by]
    hashed = df.withColumn("_tie", F.xxhash64(*ties) if ties else F.lit(0))
    ranked = hashed.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order, "_tie")))
    return ranked.filter(F.col("_rank") == 1).drop("_rank", "_tie")
