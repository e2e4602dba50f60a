import json
from datetime import date, datetime, timedelta

import pytest

from tillcast.operators.quality import QualityError
from tillcast import schemas
from tillcast.plans import raw as raw_loads
from tillcast.plans import refresh
from tillcast.sources import cities as city_source
from tillcast.sources import tables

LOG = (
    "hour_of_day int, cash_type string, money decimal(3,1), coffee_name string, time_of_day string, weekday string, "
    "month_name string, weekdaysort int, monthsort int, date date, time string"
)


def document(first: datetime, hours: int) -> str:
    times = [(first + timedelta(hours=n)).strftime("%Y-%m-%dT%H:%M") for n in range(hours)]
    measures = ("precipitation", "temperature_2m", "surface_pressure", "apparent_temperature", "precipitation_probability")
    return json.dumps(
        {"latitude": 55.76, "longitude": 37.62, "hourly": {"time": times, **{m: [10 + n % 7 for n in range(hours)] for m in measures}}}
    )


@pytest.fixture
def raw(spark, rows):
    cities = city_source.seed_rows(spark, datetime(2024, 1, 1))
    slugs = [r.city_slug for r in cities.select("city_slug").collect()]
    start = datetime(2024, 2, 28)
    return {
        "cities": cities,
        "kaggle_coffee": rows(
            LOG,
            [10, "card", "38.7", "Latte", "Morning", "Fri", "Mar", 5, 3, "2024-03-01", "10:15:50.520"],
            [10, "cash", "28.9", "Tea ", "Morning", "Fri", "Mar", 5, 3, "2024-03-01", "10:45:00.000"],
            [0, "cash", "9.9", "Tea", "Night", "Sat", "Mar", 6, 3, "2024-03-02", "00:05:00.000"],
        ),
        "weather_archive": rows(
            "city_slug string, period_start date, period_end date, payload string, loaded_at timestamp_ntz",
            *[[s, "2024-02-28", "2024-03-04", document(start, 144), "2024-03-05 00:00:00"] for s in slugs],
            *[[s, "2024-03-01", "2024-03-02", document(start + timedelta(days=2), 48), "2024-03-06 00:00:00"] for s in slugs],
        ),
        "weather_forecast": rows(
            "city_slug string, issued_at timestamp_ntz, forecast_days int, payload string, loaded_at timestamp_ntz",
            *[[s, "2024-03-01 05:00:00", 3, document(start, 72), "2024-03-01 05:10:00"] for s in slugs],
        ),
    }


def test_refresh_end_to_end(spark, raw, shared):
    profiles = city_source.profile_rows(spark)
    assert refresh.fan_out(raw["kaggle_coffee"], raw["cities"], profiles, shared, "001", check_only=True) is None
    assert "synthetic_coffee_sales" not in tables.table_names(spark, "raw")
    raw["synthetic_coffee_sales"] = refresh.fan_out(raw["kaggle_coffee"], raw["cities"], profiles, shared, "001")

    published = refresh.refresh(raw, shared, "001", date(2024, 6, 1))
    assert [p["row_count"] for p in published] == [str(20 * 48), str(20 * 3), str(20 * 2)]
    daily = {(r.city_slug, r.date_key): r for r in spark.table("serving.mart_sales_weather_daily").collect()}
    moscow = daily["moscow", 20240301]
    assert (moscow.sales_count, str(moscow.total_revenue_rub), moscow.temperature_hours_count) == (2, "811.20", 24)

    # The same run again publishes the same rows.
    again = refresh.refresh(raw, shared, "002", date(2024, 6, 1))
    assert again == published

    # A broken input fails the gate and what is published stays.
    broken = raw | {"synthetic_coffee_sales": raw["synthetic_coffee_sales"].replace("card", None, "payment_type")}
    with pytest.raises(QualityError, match="core_fct_sales: not null"):
        refresh.refresh(broken, shared, "003", date(2024, 6, 1))
    assert {(r.city_slug, r.date_key): r for r in spark.table("serving.mart_sales_weather_daily").collect()} == daily


def test_a_failed_audit_shows_no_sales(spark, raw, shared):
    doubled = raw["kaggle_coffee"].unionByName(raw["kaggle_coffee"])
    spark.sql("DROP VIEW IF EXISTS raw.synthetic_coffee_sales")
    before = tables.table_names(spark, "raw")
    with pytest.raises(QualityError, match="synthetic_sale_id repeated"):
        refresh.fan_out(doubled, raw["cities"], city_source.profile_rows(spark), shared, "901")
    assert tables.table_names(spark, "raw") == before  # the refused version is gone

    args = raw["kaggle_coffee"], raw["cities"], city_source.profile_rows(spark), shared
    assert refresh.fan_out(*args, "902").count() == 60
    with pytest.raises(RuntimeError, match="there already"):
        refresh.fan_out(*args, "903")


def test_load_jobs(spark, raw, shared, tmp_path, monkeypatch):
    monkeypatch.setattr(raw_loads, "RAW", "raw_loads")
    now = datetime(2024, 3, 1)

    (tmp_path / "log.csv").write_text(
        ",".join(schemas.SALES_LOG.names) + "\n10,card,38.7,Latte,Morning,Fri,Mar,5,3,2024-03-01,10:15:50.520000\n"
    )
    assert raw_loads.load_sales_log(spark, str(tmp_path / "log.csv"), shared, "001")
    assert not raw_loads.load_sales_log(spark, str(tmp_path / "log.csv"), shared, "002")

    assert raw_loads.seed_cities(spark, shared, "001", now).count() == 20
    assert {r.updated_at for r in raw_loads.seed_cities(spark, shared, "002", now + timedelta(1)).collect()} == {now + timedelta(1)}

    def load(run, *hours, stamp="2024-03-01 05:10:00"):
        docs = [[f"c{n}", "2024-03-01 05:00:00", 3, document(now, h), stamp] for n, h in enumerate(hours)]
        landed = spark.createDataFrame([tuple(map(str, d)) for d in docs], "a string, b string, c string, d string, e string")
        typed = landed.selectExpr(
            "a city_slug", "cast(b as timestamp_ntz) issued_at", "cast(c as int) forecast_days", "d payload",
            "cast(e as timestamp_ntz) loaded_at",
        )
        return raw_loads.load_documents(typed, "weather_forecast", shared, run)

    assert load("001", 72, 5) == {"documents": 2, "total_hours": 77, "incomplete": 1}
    assert load("002", 72, 72, 72, stamp="2024-03-01 06:10:00") == {"documents": 3, "total_hours": 216, "incomplete": 0}
    table = raw_loads.read_documents(spark, "weather_forecast")
    assert sorted((r.city_slug, r.loaded_at.hour) for r in table.collect()) == [("c0", 6), ("c1", 6), ("c2", 6)]
    with pytest.raises(Exception, match="no hours in the document of c1"):
        load("003", 72, 0)
    assert raw_loads.read_documents(spark, "weather_forecast").count() == 3

    # The same run again replaces only its own batch; a late older document changes nothing.
    assert load("002", 72, 72, 72, stamp="2024-03-01 06:10:00")["documents"] == 3
    load("004", 5, stamp="2024-03-01 05:00:00")
    before = sorted(map(tuple, raw_loads.read_documents(spark, "weather_forecast").collect()))
    assert [r[4].hour for r in before] == [6, 6, 6] and raw_loads.batches(spark, "weather_forecast") == ["001", "002", "004"]
    assert raw_loads.compact(spark, "weather_forecast", "005") == 3
    assert sorted(map(tuple, raw_loads.read_documents(spark, "weather_forecast").collect())) == before
    assert raw_loads.batches(spark, "weather_forecast") == ["005"]


def test_jobs_are_parsed():
    args = refresh.parser().parse_args(["fan-out", "--path", "p.csv", "--check-only"])
    assert (args.job, args.path, args.check_only) == ("fan-out", "p.csv", True)
    with pytest.raises(SystemExit):
        refresh.parser().parse_args(["drop-everything"])
