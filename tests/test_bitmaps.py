from collections import defaultdict

from tillcast.operators import bitmaps

LINES = "sale_key string, day int, product string"


def test_counts_roll_up_to_any_grain(spark, rows):
    data = [(f"r{k % 157}", 1 + k % 157 % 3, f"p{k % 7}") for k in range(600)] + [("r1", 2, "p1")] * 3 + [(None, 1, "p1"), ("unknown", 1, "p9")]
    receipts = rows("sale_key string, day int", *[(f"r{k}", 1 + k % 3) for k in range(157)], ("r0", 1), (None, 1))
    numbers = spark.createDataFrame(bitmaps.numbered(receipts, ["day"]).collect(), "sale_key string, number long")
    assert numbers.count() == 157 == numbers.select("number").distinct().count()
    words = bitmaps.receipt_words(rows(LINES, *data), numbers, ["day", "product"])
    assert words.count() < 600  # many lines share a word
    for by in (["day", "product"], ["day"], ["product"], []):
        sets = defaultdict(set)
        for sale, day, product in data:
            if sale not in (None, "unknown"):
                sets[tuple({"day": day, "product": product}[c] for c in by)].add(sale)
        found = {tuple(r[c] for c in by): r["receipts_count"] for r in bitmaps.receipts(words, by).collect()}
        assert found == {k: len(v) for k, v in sets.items()}
    # Words merged to a coarser mart go on to count right.
    coarse = bitmaps.merged(words, ["product"])
    assert bitmaps.receipts(coarse, []).first()["receipts_count"] == 157


def test_neighbours_share_words(spark, rows):
    receipts = rows("sale_key string, day int", *[(f"r{k}", k % 5) for k in range(1000)])
    numbers = spark.createDataFrame(bitmaps.numbered(receipts, ["day"]).collect(), "sale_key string, number long")
    lines = receipts.selectExpr("sale_key", "day", "'p' as product")
    assert bitmaps.receipt_words(lines, numbers, ["day"]).count() <= 1000 // 64 + 5 * 2 + 4
