from datetime import datetime
from decimal import Decimal

import pytest

from tillcast.operators import parts, rollups
from tillcast.plans import marts
from tillcast.workload import registry

CITY = "city_key string, city_slug string, city_name string"
DATE = "date_key int, date date, weekday string, is_weekend boolean"
SALES = "sale_key string, city_key string, date_key int, hour int, total_amount_rub decimal(12,2)"
ITEMS = "sale_key string, product_key string, quantity int, line_amount_rub decimal(12,2)"
WEATHER = (
    "city_key string, measured_at timestamp_ntz, date_key int, hour int, temperature_c decimal(6,2), "
    "apparent_temperature_c decimal(6,2), precipitation_mm decimal(12,5), surface_pressure_hpa decimal(8,2), "
    "loaded_at timestamp_ntz"
)


@pytest.fixture
def dims(rows):
    cities = rows(CITY, ["m", "moscow", "Moscow"], ["p", "perm", "Perm"])
    dates = rows(
        DATE,
        [20240301, "2024-03-01", "Friday", False],
        [20240302, "2024-03-02", "Saturday", True],
        [20240303, "2024-03-03", "Sunday", True],
    )
    return cities, dates


@pytest.fixture
def sales(rows):
    return rows(
        SALES,
        ["a", "m", 20240301, 10, "10.00"],
        ["b", "m", 20240301, 10, "10.01"],
        ["c", "m", 20240303, 12, "5.00"],
        ["d", "p", 20240301, 9, "7.00"],
    )


@pytest.fixture
def weather(rows):
    def hour(city, key, h, temperature, rain):
        day = f"{str(key)[:4]}-{str(key)[4:6]}-{str(key)[6:]}"
        return [city, f"{day} {h:02d}:00:00", key, h, temperature, 1, rain, 1000, "2024-03-05 00:00:00"]

    return rows(
        WEATHER,
        hour("m", 20240301, 10, 1, 0.5),
        hour("m", 20240301, 11, 2, None),
        hour("m", 20240301, 12, None, 0),
        hour("m", 20240302, 0, -1, 0),  # a day inside the period, without sales
        hour("m", 20240229, 0, 9, 9),  # outside the period
        hour("q", 20240301, 10, 1, 1),  # a city that sold nothing
    )


@pytest.fixture
def items(rows):
    return rows(
        ITEMS,
        ["a", "x", 1, "4.00"],
        ["a", "x", 2, "2.00"],  # a second line of the same product on one receipt
        ["a", "y", 1, "4.00"],
        ["b", "x", 1, "10.01"],
        ["z", "x", 1, "3.00"],  # a line without a receipt
    )


@pytest.fixture
def products(rows):
    return rows("product_key string, product_name string", ["x", "Latte"], ["y", "Tea"])


def test_daily_mart_keeps_sales_days_without_weather(sales, weather, dims):
    got = {(r.city_key, r.date_key): r for r in marts.mart_sales_weather_daily(sales, weather, *dims).collect()}
    assert set(got) == {("m", 20240301), ("m", 20240303), ("p", 20240301)}
    day = got["m", 20240301]
    assert (day.sales_count, day.total_revenue_rub, day.average_check_rub) == (2, Decimal("20.01"), Decimal("10.01"))
    assert (day.avg_temperature_c, day.min_temperature_c, day.max_temperature_c) == (1.5, 1, 2)
    assert (day.total_precipitation_mm, day.temperature_hours_count, day.precipitation_hours_count) == (Decimal("0.5"), 2, 2)
    bare = got["m", 20240303]
    assert (bare.avg_temperature_c, bare.temperature_hours_count, bare.is_weekend) == (None, 0, True)


def test_hourly_mart_is_the_weather_grid_of_the_sales_period(sales, weather, dims):
    got = {(r.city_key, r.date_key, r.hour): r for r in marts.mart_sales_weather_hourly(sales, weather, *dims).collect()}
    assert set(got) == {("m", 20240301, 10), ("m", 20240301, 11), ("m", 20240301, 12), ("m", 20240302, 0)}
    sold = got["m", 20240301, 10]
    assert (sold.sales_count, sold.total_revenue_rub, sold.average_check_rub) == (2, Decimal("20.01"), Decimal("10.005"))
    idle = got["m", 20240302, 0]
    assert (idle.sales_count, idle.total_revenue_rub, idle.average_check_rub) == (0, 0, None)
    assert idle.measured_at == datetime(2024, 3, 2)


def test_product_mart(items, sales, dims, products):
    cities, dates = dims
    mart = marts.mart_product_sales_daily(items, sales, cities, products, dates)
    got = {(r.city_key, r.product_key): r for r in mart.collect()}
    latte = got["m", "x"]
    assert (latte.units_sold, latte.receipts_count, latte.product_revenue_rub) == (4, 2, Decimal("16.01"))
    assert (latte.average_unit_price_rub, latte.revenue_share_pct) == (Decimal("4.00"), Decimal("80.01"))
    assert got["m", "y"].revenue_share_pct == Decimal("19.99")
    lost = got[None, "x"]  # the line without a receipt has no city, day or share
    assert (lost.date_key, lost.product_revenue_rub, lost.revenue_share_pct) == (None, Decimal("3.00"), None)


def test_many_lines_are_joined_in_more_parts(spark, items, sales, monkeypatch):
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions")) + 3
    monkeypatch.setattr(parts, "ROWS_A_PART", 10)
    few, many = (marts.product_days(marts.items_with_sales(items, sales, n)) for n in (10, 10 * wanted))
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(sale_key" in plan and f", {wanted}), REPARTITION_BY_NUM" in plan
    assert "REPARTITION_BY_NUM" not in few._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query", ["receipts_distinct", "rollup_receipts", "product_mart", "share_of_day", "mart_contract"])
def test_queries_of_receipt_lines_know_their_number(spark, rows, tmp_path, monkeypatch, query):
    tables = {
        "nation": rows("n_nationkey int, n_name string", [0, "PERU"]),
        "part": rows("p_partkey bigint, p_name string", [0, "tea"]),
        "customer": rows("c_custkey bigint, c_nationkey int", [1, 0]),
        "orders": rows("o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_totalprice double", [1, 1, "2024-03-01 00:00:00", 5.0]),
        "lineitem": rows(
            "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_extendedprice double",
            *[[1, k, 0, 1.0, 1.0] for k in range(30)],
        ),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(parts, "ROWS_A_PART", 3)
    found = registry.QUERIES[query](spark, str(tmp_path))
    assert ", 10), REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 1


def test_zero_revenue_day_has_no_share(rows, sales):
    items = rows(ITEMS, ["a", "x", 0, "0.00"])
    row = marts.with_day_share(marts.product_days(marts.items_with_sales(items, sales))).first()
    assert row.revenue_share_pct is None


def test_rollups(items, sales, weather, dims, products):
    cities, dates = dims
    daily = marts.mart_sales_weather_daily(sales, weather, cities, dates)
    checks = {r.city_key: r.average_check_rub for r in rollups.average_check(daily, ["city_key"]).collect()}
    assert checks == {"m": Decimal("8.34"), "p": Decimal("7.00")}  # 25.01 / 3, not a mean of day means
    assert [r.date_key for r in rollups.complete_days(daily, hours=2).collect()] == [20240301]

    sold = marts.items_with_sales(items, sales)
    mart = marts.mart_product_sales_daily(items, sales, cities, products, dates)
    shares = {r.product_key: r.revenue_share_pct for r in rollups.revenue_share(mart, ["city_key"]).filter("city_key = 'm'").collect()}
    assert shares == {"x": Decimal("80.01"), "y": Decimal("19.99")}
    receipts = {r.city_key: r.receipts_count for r in rollups.receipts(sold, ["city_key"]).collect()}
    assert receipts == {"m": 2, None: 1}  # receipt a holds both products and counts once
