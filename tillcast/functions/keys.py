"""Stable text keys: slugs and content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(name: Column) -> Column:
    """``Rostov-on-Don`` -> ``rostov_on_don``."""
    return F.translate(F.lower(name), " -", "__")


def joined_text(*parts: Column, sep: str = "|") -> Column:
    """Key text; null parts are skipped, as the ids in existing data expect."""
    return F.concat_ws(sep, *[part.cast("string") for part in parts])


def sha256_id(*parts: Column) -> Column:
    return F.sha2(joined_text(*parts), 256)


def md5_key(text: Column) -> Column:
    return F.md5(text)
