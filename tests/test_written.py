"""What queries write on their way."""

import pytest
from pyspark.sql import functions as F

from tillcast.operators import fanout
from tillcast.sources import tables
from tillcast.sources.days import DayTable
from tillcast.workload import registry


@pytest.fixture
def folder(spark, rows, tmp_path):
    tables = {
        "nation": rows("n_nationkey int, n_name string", [0, "PERU"], [1, "CHINA"]),
        "part": rows("p_partkey bigint, p_name string", [0, "tea"]),
        "events": rows(
            "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
            *[[k, f"2024-01-0{1 + k % 5} {10 + k}:00:00", k, "purchase", 1.5 + k, '{"k": 0}'] for k in range(8)],
        ),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("query", ["dq_marts_match", "touched_days_refresh"])
def test_receipts_are_written_without_what_no_mart_reads(spark, folder, monkeypatch, query):
    seen, written = {}, registry.written
    monkeypatch.setattr(registry, "written", lambda df, name: seen.setdefault(name, df.columns) and written(df, name))
    registry.QUERIES[query](spark, folder).collect()
    assert set(seen["receipts"]) <= {"city_key", "date_key", "hour", "total_amount_rub"}


def test_a_fan_out_by_day_has_the_same_rows_few_days_a_task(spark, rows, shared):
    log = rows("date date, time string", *[[f"2024-03-0{1 + k % 4}" if k % 9 else None, "10:15:50.520"] for k in range(400)])
    spark_parts = fanout.tasks(log)
    dealt = fanout.dealt_out(log, by_day=True)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, log.collect()))
    parts = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.count_distinct("date").alias("days"), F.count("*").alias("n")).collect()
    assert len(parts) == spark_parts and all(p.days <= 3 and p.n < 200 for p in parts)
    one_day = fanout.dealt_out(log.withColumn("date", F.lit("2024-03-01").cast("date")), by_day=True)
    assert one_day.groupBy(F.spark_partition_id()).count().count() == spark_parts


def test_rows_that_lie_by_day_are_not_shuffled_again(spark, rows, shared, monkeypatch):
    df = rows("date_key int, v int", [20240301, 1], [20240302, 2], [None, 3])
    statements, sql = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (statements.append(self.table("lying__staged")._jdf.queryExecution().toString()) if text.startswith("INSERT") else None, sql(self, text, *a, **k))[1])
    table = DayTable(spark, shared, "lie_layer", "lying")
    shown = table.replace(df, "1", lie_by_day=True)
    assert sorted(map(str, shown.collect())) == sorted(map(str, df.collect())) and "ebalance" not in statements[0]
    table.replace(df, "2")
    assert "ebalance" in statements[1]


@pytest.mark.parametrize("query", ["sales_fanout", "staged_synthetic_sales"])
def test_a_fan_out_is_written_in_the_codec_that_halves_its_ids(spark, folder, shared, query):
    fan_out = registry.QUERIES[query](spark, folder)
    fan_out.write.parquet(f"{shared}/by-caller")
    by_caller = spark.read.parquet(f"{shared}/by-caller")
    assert by_caller.inputFiles() and all(f.endswith(".zstd.parquet") for f in by_caller.inputFiles())

    # A version of a table is written so in any session.
    key = "spark.sql.parquet.compression.codec"
    before = spark.conf.get(key)
    spark.conf.set(key, "snappy")
    try:
        version = spark.table(tables.write_version(fan_out, shared, f"layer_{query}", "t", "001"))
    finally:
        spark.conf.set(key, before)
    assert version.inputFiles() and all(f.endswith(".zstd.parquet") for f in version.inputFiles())
    assert sorted(map(str, version.collect())) == sorted(map(str, by_caller.collect())) and version.count() == 16


def test_parts_of_a_long_log_grow_in_number(spark, rows, monkeypatch):
    monkeypatch.setattr(fanout, "SALES_A_PART", 50)
    log = rows("date date, time string, coffee_name string, money decimal(10,2), cash_type string", *[["2024-03-01", f"10:{k // 60:02d}:{k % 60:02d}.000", "tea", k, "card"] for k in range(420)])
    cities = rows("city_slug string", ["a"], ["b"], ["c"], ["d"])
    zones = rows("city_slug string, timezone string, price_multiplier decimal(5,2)", ["a", "Asia/Omsk", 2], ["b", "Europe/Moscow", 1], ["c", "Asia/Omsk", 1], ["d", "Europe/Moscow", 2])
    few, many = fanout.fan_out_sales(log, cities, zones), fanout.fan_out_sales(log, cities, zones, n_sales=420)
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    dealt = fanout.dealt_out(log, parts=fanout.parts_of(log, 420))
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 9 and max(sizes) < 75 and fanout.parts_of(log, None) == fanout.parts_of(log, 30) == fanout.tasks(log)
    # Cities of a zone stand together, so the instants of a sale come in runs.
    assert "Sort [timezone" in fanout.per_city(log, zones)._jdf.queryExecution().optimizedPlan().toString()
