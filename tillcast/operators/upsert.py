"""Keyed upsert: incoming rows replace existing rows with the same key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillcast.operators.latest import latest


def upsert(
    existing: DataFrame, incoming: DataFrame, key: list[str], newest_by: list[str] | None = None
) -> DataFrame:
    """Table after the upsert. Applying the same batch again changes nothing.

    A batch may hold a key several times when ``newest_by`` says which row wins.
    """
    batch = latest(incoming, key, newest_by) if newest_by else incoming
    kept = existing.join(batch.select(*key), key, "left_anti")
    return kept.select(*existing.columns).unionByName(batch.select(*existing.columns))
