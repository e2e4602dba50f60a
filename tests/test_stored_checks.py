"""Checks kept by day: touched days are read, the answer covers all of them."""

import pytest
from pyspark.sql import functions as F

from tillcast.operators import stored_checks
from tillcast.operators.stored_checks import StoredChecks
from tillcast.sources.days import DayTable

ROW = "date_key int, k string, a int, b string, city int"
LABELS = {"nulls": ("k", "b"), "one": ("k",), "two": ("a", "b")}


@pytest.fixture
def table(spark, shared):
    return DayTable(spark, shared, "checks_test", f"t{abs(hash(shared)):x}")


@pytest.fixture
def stored(table):
    return StoredChecks(table, {"nulls": LABELS["nulls"]}, {"one": LABELS["one"], "two": LABELS["two"]}, {"parent": "city"})


@pytest.fixture
def parents(rows):
    return {"parent": rows("city int", [1], [2], [2], [None])}


def plain(table, known=(1, 2)):
    """The same answers from all rows."""
    shown = table.read().collect()
    found = {"nulls": sum((r.k is None) + (r.b is None) for r in shown)}
    for check in ("one", "two"):
        counts = {}
        for r in shown:
            key = tuple(r[c] for c in LABELS[check])
            if key != (None,):
                counts[key] = counts.get(key, 0) + 1
        found[check] = sum(n for n in counts.values() if n > 1)
    found["parent"] = sum(r.city is not None and r.city not in known for r in shown)
    return {check: n for check, n in found.items() if n}


def got(failures):
    return {r.check: r.n_rows for r in failures.collect()}


def load(table, stored, frame, run, days=None):
    table.replace(frame, run, days)
    stored.replace(run, days)


FIRST = [
    [20240101, "x", 1, "p", 1],
    [20240101, "y", 2, "p", 2],
    [20240102, "z", 3, "p", 1],
    [None, "w", 4, "p", None],
]


def test_a_key_repeated_on_another_day_is_found(rows, table, stored, parents):
    load(table, stored, rows(ROW, *FIRST), "1")
    assert got(stored.failures(parents)) == {}
    late = rows(ROW, [20240103, "x", 9, "p", 1], [20240103, None, None, "q", 7], [20240103, None, None, "q", 7])
    load(table, stored, late, "2", [20240103])
    expected = {"nulls": 2, "one": 2, "two": 2, "parent": 2}
    assert got(stored.failures(parents, [20240103])) == expected == plain(table)
    assert got(stored.failures(parents)) == expected
    keys = {(r.check, r.value) for r in stored.repeated([20240103]).collect()}
    assert keys == {("one", '{"k":"x"}'), ("two", '{"b":"q"}')}
    # Other days' keys were not met again.
    assert stored.repeated([20240102]).collect() == []


def test_only_touched_days_are_read_and_written(rows, table, stored, monkeypatch):
    load(table, stored, rows(ROW, *FIRST), "1")
    read, whole = [], DayTable.read
    monkeypatch.setattr(DayTable, "read", lambda self, days=None: (read.append((self.name, days)), whole(self, days))[1])
    load(table, stored, rows(ROW, [20240102, "z", 3, "p", 1], [20240103, "v", 5, "p", 1]), "2", [20240102, 20240103])
    assert stored.repeated([20240102, 20240103]).collect() == []
    assert [days for name, days in read if name == table.name] == [[20240102, 20240103]]
    assert {day for run, day in stored.state.partitions() if run == "2"} == {20240102, 20240103}
    # A repeated key brings in the days it lies on, and no others.
    load(table, stored, rows(ROW, [20240104, "y", 6, "p", 1]), "3", [20240104])
    read.clear()
    assert [r.n_rows for r in stored.repeated([20240104]).collect()] == [2]
    assert [days for name, days in read if name == table.name] == [{20240101, 20240104}]


def test_replaced_and_emptied_days_take_their_results_along(rows, table, stored, parents):
    bad = rows(ROW, [20240101, "x", 1, "p", 1], [20240102, "x", 2, None, 5])
    load(table, stored, bad, "1")
    assert got(stored.failures(parents)) == {"nulls": 1, "one": 2, "parent": 1}
    load(table, stored, bad.limit(0), "2", [20240102])
    assert got(stored.failures(parents, [20240102])) == {} == plain(table)
    # Parents are those of now: one that goes leaves orphans without any row read.
    assert got(stored.failures({"parent": parents["parent"].where("city = 2")}, [])) == {"parent": 1}


def test_a_shared_hash_is_no_repeated_key(rows, table, stored, monkeypatch):
    monkeypatch.setattr(StoredChecks, "_compared", lambda self, check: (F.col(self.keys[check][0]).isNotNull(), F.lit(1).cast("bigint")))
    load(table, stored, rows(ROW, *FIRST), "1")
    assert stored.candidates().count() == 2
    assert stored.repeated().collect() == []


def test_state_that_is_missing_takes_in_all_days(rows, table, stored, parents):
    table.replace(rows(ROW, *FIRST), "1")
    load(table, stored, rows(ROW, [20240105, "z", 8, "p", 1]), "2", [20240105])
    assert got(stored.failures(parents, [20240105])) == {"one": 2}


def test_hot_keys_empty_tables_and_long_texts(rows, table, stored, parents):
    load(table, stored, rows(ROW).limit(0), "1")
    assert got(stored.failures(parents)) == {}
    many = [[20240101 + n % 3, "hot" if n % 3 else "k" * 70_000, n, None, 9] for n in range(60)]
    load(table, stored, rows(ROW, *many), "2", [20240101, 20240102, 20240103])
    assert got(stored.failures(parents, [20240101, 20240102, 20240103])) == {"nulls": 60, "one": 60, "parent": 60} == plain(table)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_state_of_keys_is_not_shuffled(spark, rows, table):
    keys = StoredChecks(table, {}, {"one": ("k",), "two": ("a", "b")}, {})
    of_keys = keys.of_rows(rows(ROW, *FIRST, FIRST[0]))
    assert "Exchange" not in plan(of_keys) and of_keys.count() == 10
    table.replace(rows(ROW, *FIRST, FIRST[0]), "1")
    keys.replace("1")
    assert got(keys.failures({})) == {"one": 2, "two": 2} == plain(table, (1, 2, None))


@pytest.mark.parametrize("bits", [1 << 28, 1 << 12, 1])
def test_hashes_are_told_where_they_lie(spark, monkeypatch, bits):
    monkeypatch.setattr(stored_checks, "BITS", bits)
    hashed = spark.range(2000).select("id", F.xxhash64("id").alias("hash"))
    found = stored_checks.may_be_in(hashed, hashed.where("id % 100 = 7").select("hash"))
    ids = [r.id for r in found.collect()]
    assert found.columns == ["id", "hash"] and len(ids) == len(set(ids)) and set(range(7, 2000, 100)) <= set(ids)
    assert len(ids) == (20 if bits == 1 << 28 else 2000 if bits == 1 else len(ids)) and (bits != 1 << 12 or len(ids) < 100)
    assert stored_checks.may_be_in(hashed, hashed.limit(0)).count() == 0


def test_history_is_filtered_before_it_is_shuffled(spark, rows, table, stored, monkeypatch):
    load(table, stored, rows(ROW, *FIRST), "1")
    load(table, stored, rows(ROW, [20240103, "x", 9, "p", 1]), "2", [20240103])
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        lines = plan(stored.candidates([20240103]))
        assert [r.check for r in stored.candidates([20240103]).collect()] == ["one"]
    finally:
        spark.conf.set(key, before)
    # From the history's scan upwards, its filter by bits comes before any exchange.
    assert lines.index("SortMergeJoin") < lines.index("BroadcastHashJoin [_bucket")
