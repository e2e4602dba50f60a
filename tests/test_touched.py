"""A refresh of touched days gives what a full rebuild gives, and writes only those days."""

import json
from datetime import date, datetime, timedelta

import pytest

from tillcast.operators import publish
from tillcast.operators.quality import QualityError
from tillcast.plans import raw as raw_loads
from tillcast.plans import refresh, touched
from tillcast.sources import cities as city_source
from tillcast.sources import tables
from tillcast.sources.days import DayTable

TODAY = date(2024, 6, 1)


# --- tables kept by day ---------------------------------------------------------------------

ROW = "date_key int, v string"


@pytest.fixture
def table(spark, shared):
    return DayTable(spark, shared, "days_test", f"t{abs(hash(shared)):x}")


def got(table, days=None):
    return sorted((r.date_key or 0, r.v) for r in table.read(days).collect())


def test_days_are_replaced_and_others_left(rows, table):
    table.replace(rows(ROW, [20240101, "a"], [20240102, "a"], [None, "a"]), "1")
    assert got(table) == [(0, "a"), (20240101, "a"), (20240102, "a")]
    table.replace(rows(ROW, [20240102, "b"], [20240102, "c"], [20240103, "b"]), "2", [20240102, 20240103])
    assert got(table) == [(0, "a"), (20240101, "a"), (20240102, "b"), (20240102, "c"), (20240103, "b")]
    assert table.manifest() == {0: "1", 20240101: "1", 20240102: "2", 20240103: "2"}
    assert {d for r, d in table.partitions() if r == "2"} == {20240102, 20240103}
    # A touched day without rows is empty afterwards; the state before stays stored, older ones go.
    table.replace(rows(ROW).limit(0), "3", [20240101])
    assert got(table) == [(0, "a"), (20240102, "b"), (20240102, "c"), (20240103, "b")]
    assert ("1", 20240102) not in table.partitions() and ("1", 20240101) in table.partitions()
    table.replace(rows(ROW, [20240105, "z"]), "4")
    assert got(table) == [(20240105, "z")]
    with pytest.raises(ValueError, match="not to touch"):
        table.replace(rows(ROW, [20240106, "z"]), "5", [20240105])
    assert got(table) == [(20240105, "z")]


def test_a_run_repeated_replaces_what_it_staged(rows, table):
    table.stage(rows(ROW, [20240101, "died"], [20240102, "died"]), "1")
    assert table.manifest() == {}
    table.replace(rows(ROW, [20240101, "whole"]), "1")
    assert got(table) == [(20240101, "whole")]


def test_a_read_of_days_prunes_partitions(rows, table):
    table.replace(rows(ROW, *[[20240101 + k, "a"] for k in range(9)]), "1")
    table.replace(rows(ROW, [20240104, "b"]), "2", [20240104])
    part = table.read([20240103, 20240104, 20240199])
    assert sorted((r.date_key, r.v) for r in part.collect()) == [(20240103, "a"), (20240104, "b")]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((" in plan and "20240103" in plan


# --- which documents ------------------------------------------------------------------------


def test_documents_that_may_hold_days(rows):
    docs = rows("period_start date, period_end date", ["2024-01-01", "2024-01-31"], ["2024-02-01", "2024-02-10"], ["2024-03-01", "2024-03-02"])
    starts = lambda days: [str(r.period_start) for r in touched.may_hold(docs, days).orderBy("period_start").collect()]
    assert starts({20240115}) == ["2024-01-01"]
    assert starts({20240201}) == ["2024-01-01", "2024-02-01"]  # a zone may shift an hour by a day
    assert starts({20240102, 20240303}) == ["2024-01-01", "2024-03-01"]
    assert len(starts({0})) == 3 and starts(set()) == [] and starts({20240220}) == []


# --- the whole refresh ----------------------------------------------------------------------


def document(first: datetime, hours: int, add: int = 0) -> str:
    times = [(first + timedelta(hours=n)).strftime("%Y-%m-%dT%H:%M") for n in range(hours)]
    names = ("precipitation", "temperature_2m", "surface_pressure", "apparent_temperature", "precipitation_probability")
    return json.dumps({"latitude": 55.76, "longitude": 37.62, "hourly": {"time": times, **{m: [10 + add + n % 7 for n in range(hours)] for m in names}}})


@pytest.fixture
def warehouse(spark, rows, shared, monkeypatch):
    """Raw tables of few cities with a first load of weather, under a layer of their own."""
    for layer in ("raw", "core", "marts", "serving"):
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")
    spark.sql("DROP DATABASE IF EXISTS raw CASCADE")
    cities = city_source.seed_rows(spark, datetime(2024, 1, 1)).where("city_slug in ('moscow', 'omsk')")
    tables.replace_table(cities, shared, "raw", "cities", "000")
    log = rows(
        "hour_of_day int, cash_type string, money decimal(3,1), coffee_name string, time_of_day string, weekday string, "
        "month_name string, weekdaysort int, monthsort int, date date, time string",
        *[[10, "card", "38.7", "Latte", "Morning", "Fri", "Mar", 5, 3, f"2024-03-0{d}", f"1{d}:15:50.520"] for d in range(1, 4)],
    )
    tables.replace_table(log, shared, "raw", "kaggle_coffee", "000")
    refresh.fan_out(log, cities, city_source.profile_rows(spark), shared, "000")
    slugs = ["moscow", "omsk"]
    start = datetime(2024, 2, 29)

    def archive(run, *docs):
        typed = rows("city_slug string, period_start date, period_end date, payload string, loaded_at timestamp_ntz", *docs)
        raw_loads.load_documents(typed, "weather_archive", shared, run)

    def forecast(run, *docs):
        typed = rows("city_slug string, issued_at timestamp_ntz, forecast_days int, payload string, loaded_at timestamp_ntz", *docs)
        raw_loads.load_documents(typed, "weather_forecast", shared, run)

    archive("001", *[[s, "2024-02-29", "2024-03-05", document(start, 144), "2024-03-09 00:00:00"] for s in slugs])
    forecast("001", *[[s, "2024-03-01 05:00:00", 3, document(datetime(2024, 3, 1, 5), 40), "2024-03-01 05:10:00"] for s in slugs])
    return archive, forecast


def everything(spark):
    names = [(touched.layer_of(m), m) for m in touched.BY_DAY] + [("serving", m) for m in touched.BY_DAY if m.startswith("mart")]
    return {(layer, m): sorted(map(repr, spark.table(f"{layer}.{m}").collect())) for layer, m in names}


def test_refreshes_of_touched_days(spark, warehouse, shared):
    archive, forecast = warehouse
    assert len(refresh.refresh_changes(spark, shared, "101", TODAY)) == 3
    assert refresh.refresh_changes(spark, shared, "102", TODAY) == []  # nothing has changed
    before = everything(spark)

    # A late document of one city: twelve hours of one UTC day, warmer by five degrees.
    archive("002", ["omsk", "2024-03-02", "2024-03-02", document(datetime(2024, 3, 2, 3), 12, 5), "2024-03-10 00:00:00"])
    published = refresh.refresh_changes(spark, shared, "103", TODAY)
    assert {p["table"] for p in published} == {"serving.mart_sales_weather_daily", "serving.mart_sales_weather_hourly"}
    after = everything(spark)
    changed = {name for name in after if after[name] != before[name]}
    assert changed == {("core", "core_fct_weather_hour"), *[(layer, f"mart_sales_weather_{x}") for layer in ("marts", "serving") for x in ("daily", "hourly")]}
    for layer, model in changed:
        parts = DayTable(spark, shared, layer, model).partitions()
        assert {day for run, day in parts if run == "103"} == {20240302}, model
    assert {run for run, _ in touched.day_table(spark, shared, "core_fct_sales").partitions()} == {"101"}

    # A failed check publishes nothing, and its days are taken up again.
    bad = json.loads(document(datetime(2024, 3, 3, 3), 12))
    bad["hourly"]["precipitation"][3] = -1
    archive("003", ["omsk", "2024-03-03", "2024-03-03", json.dumps(bad), "2024-03-10 00:00:00"])
    with pytest.raises(QualityError, match="weather values are valid"):
        refresh.refresh_changes(spark, shared, "104", TODAY)
    assert {k: v for k, v in everything(spark).items() if k[0] == "serving"} == {k: v for k, v in after.items() if k[0] == "serving"}

    # Mended; and a document of the same key with fewer hours, whose lost days are touched as well; an issue that comes
    # anew, one that is older than what is held, and a new one.
    archive(
        "004",
        ["omsk", "2024-03-03", "2024-03-03", document(datetime(2024, 3, 3, 3), 12), "2024-03-11 00:00:00"],
        ["moscow", "2024-02-29", "2024-03-05", document(datetime(2024, 2, 29), 120), "2024-03-10 00:00:00"],
    )
    forecast(
        "002",
        ["moscow", "2024-03-01 05:00:00", 3, document(datetime(2024, 3, 1, 5), 30, 2), "2024-03-01 07:00:00"],
        ["omsk", "2024-03-01 05:00:00", 3, document(datetime(2024, 3, 1, 5), 40, 4), "2024-03-01 01:00:00"],
        ["omsk", "2024-03-02 05:00:00", 3, document(datetime(2024, 3, 2, 5), 30), "2024-03-02 05:10:00"],
    )
    refresh.refresh_changes(spark, shared, "105", TODAY)
    after = everything(spark)
    # What is compacted counts as seen.
    log = raw_loads.document_log(spark, "weather_archive", shared)
    touched.note_compaction(spark, "weather_archive", log.compact("900"), "900", shared, "106")
    assert refresh.refresh_changes(spark, shared, "107", TODAY) == []
    # A changed city table rebuilds everything, which gives the same rows as all refreshes did.
    tables.replace_table(spark.table("raw.cities"), shared, "raw", "cities", "108")
    assert len(refresh.refresh_changes(spark, shared, "109", TODAY)) == 3
    assert everything(spark) == after


def test_landed_files_are_streamed_into_the_log(spark, rows, shared, tmp_path, monkeypatch):
    monkeypatch.setattr(raw_loads, "RAW", "raw_streamed")
    landing = tmp_path / "landing"
    landing.mkdir()

    def land(name, hour, hours):
        row = {"city_slug": "ufa", "issued_at": f"2024-03-01T{hour:02d}:00:00", "forecast_days": 3,
               "payload": document(datetime(2024, 3, 1), hours), "loaded_at": f"2024-03-01T{hour:02d}:10:00"}
        (landing / name).write_text(json.dumps(row) + "\n")

    land("1.json", 5, 72)
    land("2.json", 6, 5)
    found = raw_loads.stream_documents(spark, str(landing), "weather_forecast", shared, files_per_batch=1)
    assert sorted((s["total_hours"], s["incomplete"]) for s in found.values()) == [(5, 1), (72, 0)] and len(found) == 2
    assert raw_loads.stream_documents(spark, str(landing), "weather_forecast", shared) == {}
    land("3.json", 7, 72)
    assert [s["documents"] for s in raw_loads.stream_documents(spark, str(landing), "weather_forecast", shared).values()] == [1]
    assert len(raw_loads.batches(spark, "weather_forecast")) == 3 and raw_loads.read_documents(spark, "weather_forecast").count() == 3
    # A document without hours fails its batch; what is landed stays to be loaded once it is mended.
    land("4.json", 8, 0)
    with pytest.raises(Exception, match="no hours in the document of ufa"):
        raw_loads.stream_documents(spark, str(landing), "weather_forecast", shared)
    assert len(raw_loads.batches(spark, "weather_forecast")) == 3


def test_days_are_published_only_under_a_key_that_holds_them(rows, shared):
    from dataclasses import replace

    from tillcast.contracts import load_marts

    spec = replace(load_marts()["mart_sales_weather_daily"], unique_key=("city_key",))
    with pytest.raises(publish.PublishError, match="doesn't hold its day"):
        publish.publish_days(rows("city_key string", ["x"]), spec, shared, "1", [20240101])
