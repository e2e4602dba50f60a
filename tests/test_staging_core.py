import json
from datetime import date, datetime
from decimal import Decimal

import pytest

from tillcast.operators import loads
from tillcast.plans import core, staging

ARCHIVE = "city_slug string, period_start date, period_end date, payload string, loaded_at timestamp_ntz"


def document(**hourly):
    return json.dumps({"latitude": 55.7558, "longitude": 37.6173, "hourly": hourly})


def archive(rows, *documents):
    return rows(ARCHIVE, *[["moscow", "2024-03-01", "2024-03-02", d, "2024-03-03 00:00:00"] for d in documents])


def test_parallel_arrays_become_rows(rows):
    raw = archive(
        rows,
        document(
            time=["2024-03-01T00:00", "2024-03-01T01:00"], precipitation=[0.1, None],
            temperature_2m=[-2.345, 3], surface_pressure=[1000.005, 1001], apparent_temperature=[-5, -4.5],
        ),
    )
    got = staging.stg_weather_hourly(raw).orderBy("measured_at").collect()
    assert [r.measured_at for r in got] == [datetime(2024, 3, 1, 0), datetime(2024, 3, 1, 1)]
    assert [r.precipitation_mm for r in got] == [Decimal("0.10000"), None]
    assert [r.temperature_c for r in got] == [Decimal("-2.35"), Decimal("3.00")]
    assert got[0].surface_pressure_hpa == Decimal("1000.01")
    assert got[0].latitude == Decimal("55.75580")


def test_short_and_absent_arrays_are_padded(rows):
    raw = archive(rows, document(time=["2024-03-01T00:00", "2024-03-01T01:00"], temperature_2m=[1]))
    got = staging.stg_weather_hourly(raw).orderBy("measured_at").collect()
    assert [r.temperature_c for r in got] == [Decimal("1.00"), None]
    assert [r.precipitation_mm for r in got] == [None, None]


def test_rows_without_time_or_document_are_dropped(rows):
    raw = archive(
        rows,
        document(time=["2024-03-01T00:00", None], temperature_2m=[1, 2, 3]),
        document(),
        "{}",
        None,
    )
    assert staging.stg_weather_hourly(raw).count() == 1


def test_an_overflowing_number_fails_instead_of_emptying_the_array(rows):
    raw = archive(rows, document(time=["2024-03-01T00:00"], temperature_2m=[123456]))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        staging.stg_weather_hourly(raw).collect()


def test_document_is_parsed_once(rows):
    raw = archive(rows, document(time=["2024-03-01T00:00"]))
    plan = staging.stg_weather_hourly(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_forecast_keeps_issue_and_probability(rows):
    raw = rows(
        "city_slug string, issued_at timestamp_ntz, forecast_days int, payload string, loaded_at timestamp_ntz",
        ["ufa", "2024-03-01 05:00:00", 3,
         document(time=["2024-03-01T06:00"], precipitation_probability=[100]), "2024-03-01 05:10:00"],
    )
    row = staging.stg_weather_forecast(raw).first()
    assert (row.issued_at, row.forecast_for) == (datetime(2024, 3, 1, 5), datetime(2024, 3, 1, 6))
    assert row.precipitation_probability_pct == Decimal("100.00")


def test_load_summary_and_short_documents(rows):
    docs = archive(rows, document(time=["a"] * 72), document(time=["a"] * 5), document(time=[]))
    assert tuple(loads.load_summary(docs).first()) == (3, 77, 2)
    assert sorted(r.hours for r in loads.incomplete(docs).collect()) == [0, 5]
    with pytest.raises(Exception, match="no hours in the document of moscow"):
        loads.reject_empty(docs).collect()


# --- core ----------------------------------------------------------------------------------

CITIES = "city_slug string, city_name string, latitude decimal(9,5), longitude decimal(9,5), updated_at timestamp_ntz"
STAGED = (
    "source_sale_id string, synthetic_sale_id string, synthetic_sale_item_id string, city_slug string, "
    "timezone string, sold_local_date date, sold_at timestamp_ntz, product_name string, payment_type string, "
    "amount_rub decimal(12,2), quantity int, line_number int, is_synthetic boolean"
)


@pytest.fixture
def cities(rows):
    return rows(
        CITIES,
        ["moscow", "Moscow", 55.76, 37.62, "2024-01-01 00:00:00"],
        ["perm", "Perm", 58, 56.24, "2024-01-01 00:00:00"],
    )


@pytest.fixture
def sales(rows):
    return rows(
        STAGED,
        ["s1", "a", "a1", "moscow", "Europe/Moscow", "2024-03-01", "2024-02-29 21:30:00", " Latte ", "card", "10.00", 3, 1, True],
        ["s2", "b", "b1", "moscow", "Europe/Moscow", "2024-03-01", "2024-03-01 09:00:00", "latte", "cash", "20.00", 0, 1, True],
        ["s3", "c", "c1", "atlantis", None, "2019-01-01", "2019-01-01 09:00:00", None, "cash", "5.00", 1, 1, True],
    )


def test_dim_city_keeps_cities_without_sales(cities, sales):
    got = {r.city_slug: r for r in core.dim_city(cities, sales).collect()}
    assert set(got) == {"moscow", "perm"}
    assert (got["moscow"].timezone, got["perm"].timezone) == ("Europe/Moscow", None)


def test_a_city_with_two_zones_appears_twice(cities, sales):
    moved = sales.unionByName(sales.filter("synthetic_sale_id = 'a'").replace("Europe/Moscow", "Europe/Samara", "timezone"))
    assert core.dim_city(cities, moved).filter("city_slug = 'moscow'").count() == 2


def test_dim_date_spans_to_three_years_ahead(spark):
    days = core.dim_date(spark, date(2024, 2, 29))
    first, last = days.first(), days.orderBy("date", ascending=False).first()
    assert tuple(first) == (20240101, date(2024, 1, 1), 2024, 1, "Monday", False)
    assert last.date == date(2027, 2, 28)
    assert days.count() == (date(2027, 2, 28) - date(2024, 1, 1)).days + 1


def test_dim_product_trims_and_keeps_case(sales):
    assert sorted(r.product_name for r in core.dim_product(sales).collect()) == ["Latte", "latte"]


def test_facts_keep_unmatched_rows(spark, cities, sales):
    dims = core.dim_city(cities, sales), core.dim_date(spark, date(2024, 6, 1))
    got = {r.sale_key: r for r in core.fct_sales(sales, *dims).collect()}
    assert (got["a"].date_key, got["a"].hour) == (20240301, 0)
    assert (got["b"].date_key, got["b"].hour) == (20240301, 12)
    assert (got["c"].city_key, got["c"].date_key, got["c"].hour) == (None, None, None)


def test_items_match_products_by_trimmed_name(sales):
    products = core.dim_product(sales)
    keys = {r.product_name: r.product_key for r in products.collect()}
    got = {r.sale_key: r for r in core.fct_sales_item(sales, products).collect()}
    assert (got["a"].product_key, got["a"].unit_price_rub) == (keys["Latte"], Decimal("3.33"))
    assert (got["b"].product_key, got["b"].unit_price_rub) == (keys["latte"], None)
    assert got["c"].product_key is None


WEATHER = (
    "city_slug string, period_start date, period_end date, loaded_at timestamp_ntz, measured_at timestamp_ntz, "
    "precipitation_mm decimal(12,5), temperature_c decimal(6,2), surface_pressure_hpa decimal(8,2), "
    "apparent_temperature_c decimal(6,2)"
)


def test_newest_load_of_an_hour_wins(rows, spark, cities, sales):
    hour = "2024-03-01 21:30:00"
    loads_ = rows(
        WEATHER,
        ["moscow", "2024-03-01", "2024-03-02", "2024-03-03 00:00:00", "2024-03-01 20:00:00", 0, 1, 1000, 1],
        ["moscow", "2024-03-01", "2024-03-02", "2024-03-04 00:00:00", "2024-03-01 20:00:00", 0, 2, 1000, 1],
        # equal load time: the later period end, then the later start
        ["moscow", "2024-02-01", "2024-03-02", "2024-03-04 00:00:00", hour, 0, 3, 1000, 1],
        ["moscow", "2024-02-01", "2024-03-03", "2024-03-04 00:00:00", hour, 0, 4, 1000, 1],
        ["moscow", "2024-02-02", "2024-03-03", "2024-03-04 00:00:00", hour, 0, 5, 1000, 1],
    )
    dims = core.dim_city(cities, sales), core.dim_date(spark, date(2024, 6, 1))
    got = core.fct_weather_hour(loads_, *dims).orderBy("measured_at").collect()
    assert [r.temperature_c for r in got] == [Decimal("2.00"), Decimal("5.00")]
    assert [(r.date_key, r.hour) for r in got] == [(20240301, 23), (20240302, 0)]


def test_only_one_row_per_key_and_task_is_shuffled(rows, spark, cities, sales):
    from tillcast.operators.latest import latest

    df = rows(WEATHER, ["moscow", "2024-03-01", "2024-03-02", "2024-03-03 00:00:00", "2024-03-01 20:00:00", 0, 1, 1, 1])
    plan = latest(df, ["city_slug", "measured_at"], core.NEWEST_LOAD)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle


def test_forecast_keeps_every_issue(rows, spark, cities, sales):
    forecast = rows(
        "city_slug string, issued_at timestamp_ntz, forecast_days int, loaded_at timestamp_ntz, forecast_for timestamp_ntz, "
        "precipitation_mm decimal(12,5), temperature_c decimal(6,2), surface_pressure_hpa decimal(8,2), "
        "apparent_temperature_c decimal(6,2), precipitation_probability_pct decimal(6,2)",
        ["moscow", "2024-03-01 05:00:00", 3, "2024-03-01 05:00:00", "2024-03-01 22:00:00", 0, 1, 1, 1, 1],
        ["moscow", "2024-03-01 06:00:00", 3, "2024-03-01 06:00:00", "2024-03-01 22:00:00", 0, 1, 1, 1, 1],
    )
    dims = core.dim_city(cities, sales), core.dim_date(spark, date(2024, 6, 1))
    got = core.fct_weather_forecast_hour(forecast, *dims).collect()
    assert [(r.forecast_date_key, r.forecast_hour) for r in got] == [(20240302, 1)] * 2
