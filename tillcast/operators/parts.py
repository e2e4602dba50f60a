"""Parts of a shuffle that grow in number, not in size, with the rows they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows of a part at most: a join, its sorts and three aggregates over lines take some 1.6 KB a row.
ROWS_A_PART = 200_000


def spread(df: DataFrame, rows: int, key: str) -> DataFrame:
    """``df`` of so many ``rows`` dealt out by a key that few rows share, in more parts than a shuffle has.

    Where a shuffle's parts are enough, ``df`` as it is: the join or grouping that follows deals it out.
    """
    wanted = -(-rows // ROWS_A_PART)
    if wanted <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(wanted, key)
