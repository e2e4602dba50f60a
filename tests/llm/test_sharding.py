"""Histogram sort: every row once, gapless slots, near equal bytes also in one group of copies."""

import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import tables as T  # noqa: E402
from tillcast.llm import sharding as S  # noqa: E402


def even(rows, shards, slack):
    """Bytes of the shards, and no gap in their slots."""
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(sizes) <= set(range(shards))
    mean = sum(sizes.values()) / shards
    assert all(abs(sizes[k] - mean) <= slack for k in range(shards)), (mean, sizes)


def test_query_on_edge_rows(spark, tmp_path):
    rows = S.op13_histogram_sort(spark, T.folder(tmp_path)).collect()
    expected = Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in T.documents())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
    even(rows, 40, 2 * max(r["size"] for r in rows))


@pytest.mark.parametrize("tasks", ["4", "23"])
def test_a_group_of_copies_is_cut(spark, tasks):
    texts = [(k, "copy " * 20) for k in range(3000)] + [(10_000 + k, T.prose(k, 10 + k % 50)) for k in range(3000)] + [(7, None)] * 50 + [(None, "")] * 50
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        rows = S.shard_documents(docs, 7).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(texts)
    total = sum(r["size"] for r in rows)
    even(rows, 7, 2 * S.SHARD_TOLERANCE * total / 7 + 2 * max(r["size"] for r in rows))
    groups = defaultdict(set)
    for r in rows:
        groups[r["text"]].add(r["shard"])
    # Only the group that holds a third of the bytes is cut, and few others that lie at a boundary.
    assert len(groups["copy " * 20]) >= 3 and sum(len(v) > 1 for v in groups.values()) <= 7


def test_ties_and_few_rows(spark):
    docs = spark.createDataFrame([(1, "a", "x", "y")] * 3 + [(2, "bb", "x", "y")], "doc_id long, text string, shard string, slot string")
    rows = S.shard_documents(docs, 5).collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == {(1, "a"): 3, (2, "bb"): 1}
    even(rows, 5, 40)
    assert S.shard_documents(docs.limit(0), 5).collect() == []


def test_shards_are_written_in_the_order_of_their_slots(spark, tmp_path):
    docs = spark.createDataFrame([(k, T.prose(k)) for k in range(200)], "doc_id long, text string")
    S.write_shards(docs, 4, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 200
    for k in range(4):
        files = [f.collect() for f in (spark.read.parquet(p) for p in sorted(str(x) for x in (tmp_path / "shards" / f"shard={k}").glob("*.parquet")))]
        for rows in files:
            assert [r["slot"] for r in rows] == sorted(r["slot"] for r in rows)


def test_one_exchange_and_no_python(spark):
    docs = spark.createDataFrame([(k, T.prose(k)) for k in range(100)], "doc_id long, text string")
    rows = S.written(S.keyed(docs))
    plan = S.place(rows, S.splitters(rows, 4), 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Arrow" not in plan
    total = rows.agg(F.sum(S.SIZE)).first()[0]
    cuts = S.splitters(rows, 4)
    below = [rows.where(F.col(S.KEY) < s.key).agg(F.sum(S.SIZE), F.count("*")).first() for s in cuts]
    assert [tuple(b) for b in below] == [(s.bytes_below, s.rows_below) for s in cuts] and total > cuts[-1].bytes_below
