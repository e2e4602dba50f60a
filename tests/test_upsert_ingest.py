import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillcast import schemas
from tillcast.operators.upsert import upsert
from tillcast.sources import cities as city_source
from tillcast.sources import readers
from tillcast.sources.window import resolve_window
from tillcast.sources.log import Log
from tillcast.streaming import ingest

ROW = "k string, v int, loaded_at timestamp_ntz"


def got(df):
    return sorted(map(tuple, df.select("k", "v").collect()))


def test_upsert_replaces_adds_and_keeps(rows):
    old = rows(ROW, ["kept", 1, None], ["changed", 1, None])
    new = rows(ROW, ["changed", 2, None], ["new", 2, None])
    once = upsert(old, new, ["k"])
    assert got(once) == [("changed", 2), ("kept", 1), ("new", 2)]
    assert got(upsert(once, new, ["k"])) == got(once)  # replay


def test_newest_row_of_a_batch_wins(rows):
    new = rows(ROW, ["a", 1, "2024-01-01 00:00:00"], ["a", 2, "2024-01-02 00:00:00"])
    assert got(upsert(new.limit(0), new, ["k"], ["loaded_at"])) == [("a", 2)]


def test_composite_keys(rows):
    ddl = "city_slug string, period_start date, period_end date, payload string"
    old = rows(ddl, ["ufa", "2024-01-01", "2024-01-31", "old"], ["ufa", "2024-02-01", "2024-02-28", "old"])
    new = rows(ddl, ["ufa", "2024-01-01", "2024-01-31", "new"])
    merged = upsert(old, new, schemas.RAW_KEYS["weather_archive"])
    assert sorted((str(r.period_start), r.payload) for r in merged.collect()) == [("2024-01-01", "new"), ("2024-02-01", "old")]


def test_seeding_is_an_upsert(spark):
    first, second = datetime(2024, 1, 1), datetime(2024, 2, 1)
    once = city_source.seed_rows(spark, first)
    extra = once.limit(1).replace("moscow", "tver", "city_slug")
    twice = city_source.seed_cities(spark, once.unionByName(extra), second)
    stamps = {r.city_slug: r.updated_at for r in twice.collect()}
    assert len(stamps) == 21
    assert (stamps["rostov_on_don"], stamps["tver"]) == (second, first)


def test_every_seeded_city_has_a_profile(spark):
    cities, profiles = city_source.seed_rows(spark, datetime(2024, 1, 1)), city_source.profile_rows(spark)
    assert cities.join(profiles, "city_slug", "left_anti").count() == 0
    assert profiles.count() == 20


def test_city_list_is_ordered_and_not_empty(spark):
    cities = city_source.seed_rows(spark, datetime(2024, 1, 1))
    slugs = [r.city_slug for r in readers.ordered_cities(cities).collect()]
    assert slugs == sorted(slugs)
    with pytest.raises(ValueError, match="empty"):
        readers.ordered_cities(cities.limit(0))


def test_window():
    assert resolve_window(date(2024, 3, 6)) == (date(2022, 2, 28), date(2024, 2, 29))
    assert resolve_window(date(2024, 3, 6), end=date(2024, 1, 1)) == (date(2022, 2, 28), date(2024, 1, 1))
    assert resolve_window(date(2024, 3, 6), start=date(2024, 1, 1)) == (date(2024, 1, 1), date(2024, 2, 29))
    with pytest.raises(ValueError, match="starts after it ends"):
        resolve_window(date(2024, 3, 6), start=date(2024, 3, 1))


def test_window_filter_reaches_the_scan(spark, rows, shared):
    rows("d date, v int", ["2024-01-01", 1], ["2024-02-01", 2]).write.parquet(f"{shared}/t")
    df = spark.read.parquet(f"{shared}/t")
    part = readers.in_window(df, df["d"], date(2024, 1, 1), date(2024, 1, 31))
    assert [r.v for r in part.collect()] == [1]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2024-01-01)" in plan and "LessThan(d,2024-02-01)" in plan


def land(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def issue(payload, loaded_at, hour=5):
    return {
        "city_slug": "ufa", "issued_at": f"2024-03-01T{hour:02d}:00:00", "forecast_days": 3,
        "payload": payload, "loaded_at": f"2024-03-01T{loaded_at}",
    }


@pytest.fixture
def log(spark, shared):
    name = f"t_{abs(hash(shared)):x}"
    return Log(spark, "raw_streams", name, schemas.RAW_KEYS["weather_forecast"], shared, buckets=4)


def ingest_all(spark, tmp_path, log, **more):
    stream = ingest.landed(spark, str(tmp_path / "landing"), schemas.WEATHER_FORECAST, **more)
    ingest.ingest(stream, log.append, str(tmp_path / "checkpoint"))


def test_ingest_is_idempotent_and_resolves_reloads(spark, tmp_path, log):
    landing = tmp_path / "landing"

    def run():
        ingest_all(spark, tmp_path, log)
        return {r.issued_at.hour: r.payload for r in log.current().collect()}, log.rows().count()

    land(landing, "1.json", issue("first", "05:10:00"), issue("six", "06:10:00", 6))
    assert run() == ({5: "first", 6: "six"}, 2)
    assert run() == ({5: "first", 6: "six"}, 2)  # nothing new landed
    land(landing, "2.json", issue("again", "05:20:00"))
    assert run() == ({5: "again", 6: "six"}, 3)
    land(landing, "3.json", issue("late", "05:15:00"))  # loaded before the one in place
    assert run() == ({5: "again", 6: "six"}, 4)
    land(landing, "4.json", issue("tie", "05:20:00"))  # equal time: later batch
    assert run() == ({5: "tie", 6: "six"}, 5)
    assert len(log.compact("stream-9")) == 4 and log.batches() == ["stream-9"]
    assert run() == ({5: "tie", 6: "six"}, 2)


def test_a_batch_that_failed_after_its_write_replaces_itself(spark, tmp_path, log):
    landing, tries = tmp_path / "landing", []
    land(landing, "1.json", issue("first", "05:10:00"))

    def append(batch, batch_id):
        log.append(batch, batch_id)
        tries.append(batch_id)
        if len(tries) == 1:
            raise RuntimeError("the driver dies before the stream notes the batch")

    def run():
        ingest.ingest(ingest.landed(spark, str(landing), schemas.WEATHER_FORECAST), append, str(tmp_path / "checkpoint"))

    with pytest.raises(Exception, match="driver dies"):
        run()
    assert log.rows().count() == 1
    land(landing, "2.json", issue("second", "06:10:00", 6))
    run()
    assert tries == ["stream-0000000000", "stream-0000000000", "stream-0000000001"]
    assert log.batches() == tries[1:] and log.rows().count() == 2


def test_a_log_is_resolved_where_its_rows_lie(spark, rows, log):
    ddl = "city_slug string, issued_at timestamp_ntz, forecast_days int, payload string, loaded_at timestamp_ntz"
    for batch in range(3):
        log.append(rows(ddl, *[[f"c{k}", "2024-03-01 05:00:00", 3, f"{batch}", f"2024-03-01 0{batch}:00:00"] for k in range(batch, 20)]), f"{batch}")
    found = log.current()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    newest = {r.city_slug: r.payload for r in found.collect()}
    assert newest == {f"c{k}": str(min(k, 2)) for k in range(20)}
    assert StructType(found.schema.fields) == schemas.WEATHER_FORECAST
    # One file a bucket and batch.
    files = found.select(F.input_file_name().alias("f"), "city_slug")
    assert files.select("f").distinct().count() <= 3 * 4
    assert {r.city_slug for r in log.versions_of(["2"]).collect()} == {f"c{k}" for k in range(2, 20)}
    assert log.versions_of(["2"]).count() == 18 * 3
