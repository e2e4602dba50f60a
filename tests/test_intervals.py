import pytest

from tillcast.operators.intervals import interval_join


@pytest.fixture
def points(rows):
    return rows("city_key string, date_key int, n int", *[("a", 20240101 + k, k) for k in range(31)], ("b", 20240105, 1), (None, 20240105, 2), ("a", None, 3))


def inside(points, periods, **more):
    found = interval_join(points, periods, ["city_key"], "date_key", "lo", "hi", **more)
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("days", [1, 2, 7, 400])
def test_each_point_meets_each_period_that_holds_it_once(rows, points, days):
    periods = rows("city_key string, lo int, hi int, label string", ("a", 20240103, 20240109, "x"), ("a", 20240108, 20240108, "y"), ("b", 20231201, 20240301, "z"))
    found = inside(points, periods, bucket_days=days)
    expected = [("a", 20240101 + k, k, "x") for k in range(2, 9)] + [("a", 20240108, 7, "y"), ("b", 20240105, 1, "z")]
    assert found == sorted(expected)


def test_open_reversed_and_unknown_periods_meet_nothing(rows, points):
    periods = rows("city_key string, lo int, hi int", ("a", None, 20240109), ("a", 20240109, None), ("a", 20240109, 20240103), (None, 20240101, 20240131), ("c", 20240101, 20240131))
    assert inside(points, periods) == []


def test_points_are_exchanged_by_key_and_bucket(spark, points, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        periods = rows("city_key string, lo int, hi int", ("a", 20240103, 20240109))
        plan = interval_join(points, periods, ["city_key"], "date_key", "lo", "hi")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert exchanges and all("_bucket" in line for line in exchanges)
