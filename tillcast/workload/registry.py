"""The registered queries: (session, table folder) -> DataFrame."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast import schemas
from tillcast.contracts import load_marts
from tillcast.functions import clock, keys, money, payload
from tillcast.operators import bitmaps, loads, publish, quality, rollups
from tillcast.operators.fanout import city_directory, fan_out_sales
from tillcast.operators.upsert import upsert
from tillcast.plans import checks, core, marts, staging, touched
from tillcast.session import scratch, shared_dir, written
from tillcast.sources import cities as city_source
from tillcast.sources import ndjson, readers, snapshot, tables
from tillcast.sources.days import DayTable
from tillcast.sources.log import Log
from tillcast.sources.window import resolve_window
from tillcast.streaming import ingest
from tillcast.workload.standins import Inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of queries that need a clock.
NOW = datetime(2024, 1, 31, 3, 0)
ANCHOR = date(2024, 2, 5)
# A day after all that the test tables hold.
LATE_DAY = 20991231


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Inputs(spark, folder))
    return build


def run_id() -> str:
    return f"{time.time_ns():020d}"


# --- marts -----------------------------------------------------------------------------------


@query
def daily_mart(i: Inputs) -> DataFrame:
    return i.daily_mart


@query
def hourly_mart(i: Inputs) -> DataFrame:
    return i.hourly_mart


@query
def product_mart(i: Inputs) -> DataFrame:
    return i.product_mart


@query
def sales_per_day(i: Inputs) -> DataFrame:
    return marts.sales_days(i.receipts)


@query
def weather_per_day(i: Inputs) -> DataFrame:
    return marts.weather_days(i.fct_weather)


@query
def sales_per_hour(i: Inputs) -> DataFrame:
    return marts.sales_hours(i.fct_sales)


@query
def receipts_distinct(i: Inputs) -> DataFrame:
    return marts.product_days(i.sold_items)


@query
def share_of_day(i: Inputs) -> DataFrame:
    return marts.with_day_share(marts.product_days(i.sold_items)).select(
        "city_key", "date_key", "product_key", "product_revenue_rub", "revenue_share_pct"
    )


@query
def sales_period_range_join(i: Inputs) -> DataFrame:
    period = marts.sales_period(marts.sales_hours(i.fct_sales))
    grid = marts.within_period(i.fct_weather, period)
    return grid.select("city_key", "date_key", "hour", "measured_at", "temperature_c")


@query
def rollup_avg_check(i: Inputs) -> DataFrame:
    return rollups.average_check(i.daily_mart, ["city_slug"])


@query
def rollup_share(i: Inputs) -> DataFrame:
    months = i.product_mart.withColumn("month_key", F.floor(F.col("date_key") / 100).cast("int"))
    return rollups.revenue_share(months, ["city_key", "month_key"])


@query
def complete_days(i: Inputs) -> DataFrame:
    # The test events give few hours a day with a temperature, so fewer count as complete.
    return rollups.complete_days(i.daily_mart, hours=8).select(
        "city_key", "date_key", "avg_temperature_c", "temperature_hours_count", "sales_count"
    )


@query
def rollup_receipts(i: Inputs) -> DataFrame:
    return rollups.receipts(i.sold_items, ["city_key", "product_key"])


@query
def receipt_bitmaps(i: Inputs) -> DataFrame:
    """Receipts by city and product from the words of a product-day mart; the lines are read once, for the mart."""
    words = i.receipt_words
    return bitmaps.receipts(words, ["city_key", "product_key"])


@query
def receipt_bitmaps_monthly(i: Inputs) -> DataFrame:
    """Receipts by city and month, across products, where counts of products don't add up."""
    months = i.receipt_words.withColumn("month_key", F.floor(F.col("date_key") / 100).cast("int"))
    return bitmaps.receipts(months, ["city_key", "month_key"])


@query
def touched_days_refresh(i: Inputs) -> DataFrame:
    """The daily mart after late loads: built without them, then only the days they touch are computed and replaced."""
    root, run = scratch(i.spark, "touched"), run_id()
    # The marts read these columns of a receipt; its ids, hashed for each sale and city, would be most of what is written.
    sales = written(i.fct_sales.select(*marts.DAY, "total_amount_rub"), "receipts")
    loads = written(i.weather_loads, "loads")
    newest = loads.agg(F.max("loaded_at")).first()[0]
    late = F.col("loaded_at") >= F.lit(newest - timedelta(days=2)) if newest else F.lit(False)
    weather = DayTable(i.spark, root, "touched", f"weather_{run}")
    mart = DayTable(i.spark, root, "touched", f"daily_{run}")
    weather.replace(core.fct_weather_hour(loads.where(~late), i.dim_city, i.event_dates), "1")
    mart.replace(marts.mart_sales_weather_daily(sales, weather.read(), i.dim_city, i.event_dates), "1")
    days = touched.days_of(core.fct_weather_hour(loads.where(late), i.dim_city, i.event_dates), "date_key")
    near = core.fct_weather_hour(touched.loads_near(loads, days), i.dim_city, i.event_dates)
    weather.replace(touched.on_days(near, "date_key", days), "2", days)
    of_days = touched.on_days(sales, "date_key", days)
    mart.replace(marts.mart_sales_weather_daily(of_days, weather.read(days), i.dim_city, i.event_dates), "2", days)
    return mart.read()


@query
def resolved_log(i: Inputs) -> DataFrame:
    """Weather loads appended to a keyed log in several batches, compacted in between, and resolved without an exchange."""
    log = Log(i.spark, "logs", f"loads_{run_id()}", ["city_slug", "measured_at"], scratch(i.spark, "logs"))
    loads = written(i.weather_loads, "loads")
    hour = F.hour("loaded_at")
    for batch, rows in enumerate((loads.where(hour >= 16), loads.where(hour < 8), loads.where((hour >= 8) & (hour < 16)))):
        log.append(rows, f"{batch}")
        if batch == 1:
            log.compact("1c")
    return log.current()


# --- fan-out ---------------------------------------------------------------------------------


@query
def sales_fanout(i: Inputs) -> DataFrame:
    return i.synthetic


@query
def fanout_audit(i: Inputs) -> DataFrame:
    log = i.coarse_sales_log
    result = written(fan_out_sales(log, i.cities, i.known_profiles), "fan-out")
    return quality.audit_fan_out(result, log, i.cities)


@query
def city_profiles_join(i: Inputs) -> DataFrame:
    return city_directory(i.cities, i.known_profiles)


# --- staging ---------------------------------------------------------------------------------


@query
def staged_sales_log(i: Inputs) -> DataFrame:
    return staging.stg_sales_log(i.sales_log)


@query
def staged_cities(i: Inputs) -> DataFrame:
    return staging.stg_cities(i.cities)


@query
def staged_synthetic_sales(i: Inputs) -> DataFrame:
    return i.staged_sales


@query
def payload_explode(i: Inputs) -> DataFrame:
    return staging.stg_weather_hourly(i.documents())


@query
def payload_forecast(i: Inputs) -> DataFrame:
    return staging.stg_weather_forecast(i.forecast_documents)


@query
def payload_ragged(i: Inputs) -> DataFrame:
    return staging.stg_weather_hourly(i.documents(ragged=True))


@query
def payload_coordinates(i: Inputs) -> DataFrame:
    document = F.col("payload")
    return i.documents().select(
        "user_id",
        "period_start",
        payload.json_number(document, "$.latitude").alias("latitude"),
        payload.json_number(document, "$.longitude").alias("longitude"),
    )


@query
def payload_completeness(i: Inputs) -> DataFrame:
    docs = loads.incomplete(loads.reject_empty(i.documents()).drop("hours"), expected_hours=3)
    return docs.select("user_id", "city_slug", "period_start", "hours")


@query
def load_summary(i: Inputs) -> DataFrame:
    return loads.load_summary(i.documents(), expected_hours=3)


# --- dimensions and facts ----------------------------------------------------------------------


@query
def dim_city(i: Inputs) -> DataFrame:
    return core.dim_city(i.cities, i.staged_sales)


@query
def dim_product(i: Inputs) -> DataFrame:
    return core.dim_product(i.staged_sales)


@query
def calendar(i: Inputs) -> DataFrame:
    return i.order_dates.orderBy("date")


@query
def fct_sales_local(i: Inputs) -> DataFrame:
    return i.fct_sales


@query
def fct_items(i: Inputs) -> DataFrame:
    return i.fct_items


@query
def weather_dedup(i: Inputs) -> DataFrame:
    return i.fct_weather


@query
def forecast_fact(i: Inputs) -> DataFrame:
    return i.fct_forecast


# --- scalar functions --------------------------------------------------------------------------


@query
def slug_keys(i: Inputs) -> DataFrame:
    name = F.concat_ws("-", F.col("c_mktsegment"), F.col("c_name"))
    return i.table("customer").select(
        "c_custkey", keys.slug(name).alias("slug"), keys.md5_key(keys.slug(name)).alias("slug_key")
    )


@query
def hash_ids(i: Inputs) -> DataFrame:
    # A returned line has no status here, so its part of the key is skipped.
    status = F.nullif(F.col("l_returnflag"), F.lit("R"))
    receipt = keys.sha256_id(F.col("l_orderkey"), status, F.col("l_linestatus"))
    return i.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        receipt.alias("receipt_id"),
        keys.sha256_id(receipt, F.col("l_linenumber")).alias("line_id"),
    )


@query
def tz_to_local(i: Inputs) -> DataFrame:
    placed = i.in_city(i.events).join(i.profiles, "city_slug")
    ts, zone = F.col("ts"), F.col("timezone")
    return placed.select(
        "event_id",
        clock.to_local(ts, zone).alias("local_at"),
        clock.local_date(ts, zone).alias("local_date"),
        clock.local_hour(ts, zone).alias("local_hour"),
        clock.date_key(clock.local_date(ts, zone)).alias("date_key"),
    )


@query
def tz_to_utc(i: Inputs) -> DataFrame:
    placed = i.in_city(i.events).join(i.profiles, "city_slug")
    time = F.date_format("ts", "HH:mm:ss.SSS")
    wall = clock.wall_clock(F.to_date("ts"), clock.time_text(time))
    return placed.select("event_id", clock.to_utc(wall, F.col("timezone")).alias("sold_at"))


@query
def price_rounding(i: Inputs) -> DataFrame:
    lines = i.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").cast(money.AMOUNT).alias("amount"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_discount").cast("decimal(5,2)").alias("discount"),
    )
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        money.price(F.col("amount"), F.col("discount")).alias("price"),
        money.ratio_2dp(F.col("amount"), F.col("quantity")).alias("unit_price"),
        money.ratio_2dp(F.col("amount"), (F.col("discount") * 100).cast("int")).alias("per_discount_point"),
    )


@query
def composite_keys(i: Inputs) -> DataFrame:
    line = F.struct("l_orderkey", F.nullif(F.col("l_returnflag"), F.lit("R")))
    return i.table("lineitem").agg(
        F.count("*").alias("n_rows"), F.count_distinct(line).alias("distinct_keys")
    )


# --- checks --------------------------------------------------------------------------------------


@query
def dq_not_null(i: Inputs) -> DataFrame:
    fact = core.fct_weather_hour(i.weather_loads, i.dim_city, i.event_dates)
    return quality.not_null(fact, fact.columns)


@query
def dq_null_rows(i: Inputs) -> DataFrame:
    return quality.null_rows(i.fct_weather, "temperature_c").select("city_key", "measured_at")


@query
def dq_unique(i: Inputs) -> DataFrame:
    return quality.unique(i.fct_items, "sale_item_key")


@query
def dq_unique_combo(i: Inputs) -> DataFrame:
    return quality.unique_combination(i.fct_items, ["sale_key", "line_number"])


@query
def dq_relationships(i: Inputs) -> DataFrame:
    # Receipts without a line: the receipt is the child, its lines the parent.
    return quality.relationships(i.receipts, "sale_key", i.fct_items, "sale_key")


@query
def dq_local_date(i: Inputs) -> DataFrame:
    # Some receipts got their hour without the zone, which is wrong in all cities ahead of UTC.
    naive = F.pmod((F.col("total_amount_rub") * 100).cast("bigint"), F.lit(7)) == 0
    mixed = i.fct_sales.withColumn("hour", F.when(naive, F.hour("sold_at")).otherwise(F.col("hour")))
    return quality.local_date_mismatch(mixed, i.dim_city, i.event_dates)


@query
def dq_marts_match(i: Inputs) -> DataFrame:
    # Receipts, weather and sales hours are computed once, as a refresh reads them from tables. The daily mart counts
    # a sale too many on some days; the hourly one lacks the hours whose sales fall outside the weather's. No mart and no
    # check of them reads a receipt's ids, which would be most of what is hashed and written.
    sales = written(i.fct_sales.select(*marts.HOUR, "total_amount_rub"), "receipts")
    weather = written(i.fct_weather, "weather")
    cities, dates = i.dim_city, i.event_dates
    hours = written(marts.sales_hours(sales), "sales-hours")
    hourly = marts.hourly_from_hours(hours, weather, cities, dates)
    daily = marts.mart_sales_weather_daily(sales, weather, cities, dates)
    extra = (F.col("date_key") % 7 == 0).cast("int")
    return quality.marts_vs_sales(sales, hourly, daily.withColumn("sales_count", F.col("sales_count") + extra))


@query
def dq_product_revenue(i: Inputs) -> DataFrame:
    return quality.product_revenue_vs_sales(i.product_mart, i.settled_receipts)


@query
def dq_items_receipts(i: Inputs) -> DataFrame:
    return quality.items_vs_receipts(i.settled_receipts, i.fct_items)


@query
def dq_sales_ranges(i: Inputs) -> DataFrame:
    # Every tenth receipt and its lines are net of a flat sum: cheap ones fall below zero.
    tenth = F.col("sale_key").cast("bigint") % 10 == 0
    sales = i.receipts.withColumn("total_amount_rub", F.col("total_amount_rub") - F.when(tenth, 50000).otherwise(0))
    items = i.fct_items.withColumn("line_amount_rub", F.col("line_amount_rub") - F.when(tenth, 3000).otherwise(0))
    return quality.sales_out_of_range(sales, items)


@query
def dq_weather_ranges(i: Inputs) -> DataFrame:
    return quality.weather_out_of_range(i.fct_weather, i.fct_forecast)


@query
def dq_failures(i: Inputs) -> DataFrame:
    return quality.failures(
        {
            "unique line": quality.unique_combination(i.fct_items, ["sale_key", "line_number"]),
            "receipt has lines": quality.relationships(i.receipts, "sale_key", i.fct_items, "sale_key"),
            "line has receipt": quality.relationships(i.fct_items, "sale_key", i.receipts, "sale_key"),
            "items match receipts": quality.items_vs_receipts(i.settled_receipts, i.fct_items),
        }
    )


@query
def stored_checks(i: Inputs) -> DataFrame:
    """Checks of the receipts kept by day. Those of noon come in once more on a day no calendar has, without payment
    type where paid by card: only that day is read, and its keys are found among all days."""
    root, run = scratch(i.spark, "checked"), run_id()
    table = DayTable(i.spark, root, "checked", f"receipts_{run}")
    stored = checks.stored_checks(table, "core_fct_sales")
    receipts = table.replace(i.fct_sales_by_day, "1", lie_by_day=True)
    stored.replace("1")
    late = receipts.where("hour = 12").withColumns(
        {"date_key": F.lit(LATE_DAY), "payment_type": F.when(F.col("payment_type") != "card", F.col("payment_type"))}
    )
    table.replace(late, "2", [LATE_DAY], lie_by_day=True)
    stored.replace("2", [LATE_DAY])
    return checks.stored_failures(stored, "core_fct_sales", {"core_dim_city": i.dim_city, "core_dim_date": i.event_dates}, [LATE_DAY])


@query
def freshness(i: Inputs) -> DataFrame:
    return quality.freshness(i.table("events"), "ts", NOW)


# --- upserts and ingest --------------------------------------------------------------------------


def _cells(i: Inputs, purchases: bool) -> DataFrame:
    kind = F.col("event_type") == "purchase"
    placed = i.in_city(i.events.filter(kind if purchases else ~kind))
    return placed.select(
        "city_slug",
        clock.hour_start(F.col("ts")).alias("measured_at"),
        F.col("value").cast("decimal(6,2)").alias("temperature_c"),
        F.col("ts").alias("loaded_at"),
    )


@query
def upsert_latest(i: Inputs) -> DataFrame:
    key, newest = ["city_slug", "measured_at"], ["loaded_at"]
    cells = _cells(i, purchases=False)
    empty = i.spark.createDataFrame([], cells.schema)
    existing = upsert(empty, _cells(i, purchases=False), key, newest)
    return upsert(existing, _cells(i, purchases=True), key, newest)


@query
def upsert_documents(i: Inputs) -> DataFrame:
    """A reload of the archive: ragged documents are replaced by whole ones, by user."""
    key = ["user_id", "period_start", "period_end"]
    fields = ["user_id", "city_slug", "period_start", "period_end", "payload", "loaded_at"]
    old = i.documents(ragged=True).select(*fields)
    new = i.documents().select(*fields).filter(F.hour("loaded_at") >= 12)
    merged = upsert(old, new, key)
    return staging.stg_weather_hourly(merged).select(
        "city_slug", "loaded_at", "measured_at", "precipitation_mm", "apparent_temperature_c"
    )


@query
def seed_cities(i: Inputs) -> DataFrame:
    # One existing city is renamed to a reference one, so its row is replaced.
    named = F.when(F.col("city_slug") == "nation_0", "moscow").otherwise(F.col("city_slug"))
    existing = i.cities.withColumn("city_slug", named)
    return city_source.seed_cities(i.spark, existing, NOW)


@query
def city_list(i: Inputs) -> DataFrame:
    return readers.ordered_cities(i.cities)


@query
def archive_window(i: Inputs) -> DataFrame:
    start, end = resolve_window(ANCHOR, start=date(2024, 1, 10))
    # A load's instant lies in the hour it measures, so the window can be cut before loads are resolved.
    loads_in = readers.in_window(i.weather_loads, F.col("loaded_at"), start, end)
    return core.fct_weather_hour(loads_in, i.dim_city, i.event_dates)


@query
def incremental_ingest(i: Inputs) -> DataFrame:
    events = i.table("events").schema
    stream = ingest.landed(i.spark, i.folder, events, fmt="parquet", glob="events.parquet")
    hours = stream.select(
        "user_id", clock.hour_start(F.col("ts")).alias("issued_at"), "event_type", "value",
        F.col("ts").alias("loaded_at"),
    )
    root = scratch(i.spark, "ingest")
    log = Log(i.spark, "ingest", f"hours_{run_id()}", ["user_id", "issued_at"], root)
    for _ in range(2):  # the second time nothing new has landed: no change
        ingest.ingest(hours, log.append, f"{root}/checkpoint")
    return log.current()


# --- files and publication ------------------------------------------------------------------------


@query
def csv_profiles(i: Inputs) -> DataFrame:
    path = scratch(i.spark, "profiles")
    readers.write_csv(i.profiles, path)
    return readers.read_city_profiles(i.spark, path)


@query
def csv_sales_log(i: Inputs) -> DataFrame:
    path = scratch(i.spark, "sales-log")
    log = i.sales_log.withColumn("money", F.floor(F.col("money") / 10).cast("decimal(3,1)"))
    readers.write_csv(log.select(*schemas.SALES_LOG.names), path)
    return readers.read_sales_log(i.spark, path)


@query
def snapshot_roundtrip(i: Inputs) -> DataFrame:
    root = scratch(i.spark, "snapshot")
    snapshot.export_snapshot({"synthetic_coffee_sales": i.synthetic, "cities": i.cities}, root)
    schema = i.synthetic.schema
    restored = snapshot.read_snapshot(
        i.spark, root, {"synthetic_coffee_sales": schema, "cities": schemas.CITIES}
    )
    cities = restored["cities"].select("city_slug", "city_name", "updated_at")
    return restored["synthetic_coffee_sales"].join(cities, "city_slug")


@query
def snapshot_documents(i: Inputs) -> DataFrame:
    root = scratch(i.spark, "snapshot")
    archive = i.documents().select(*schemas.WEATHER_ARCHIVE.names)
    snapshot.export_snapshot({"weather_archive": archive}, root)
    restored = snapshot.read_snapshot(i.spark, root, {"weather_archive": schemas.WEATHER_ARCHIVE})
    return staging.stg_weather_hourly(restored["weather_archive"])


@query
def ndjson_rows(i: Inputs) -> DataFrame:
    return ndjson.json_lines(i.hourly_mart.drop("average_check_rub"))


@query
def mart_contract(i: Inputs) -> DataFrame:
    spec = load_marts()["mart_product_sales_daily"]
    return publish.to_contract(i.product_mart, spec)


@query
def publish_check(i: Inputs) -> DataFrame:
    """Publish the product mart, then audit what readers see."""
    spec = load_marts()["mart_product_sales_daily"]
    root, run = f"{shared_dir(i.spark)}/warehouse", run_id()
    mart = tables.replace_table(i.product_mart, root, "marts", spec.model, run)
    publish.publish_mart(mart, spec, root, run)
    return publish.verification(i.spark.table(f"{spec.layer}.{spec.table}"), spec)


@query
def published_hours(i: Inputs) -> DataFrame:
    """Publish the hourly mart by day and read it; instants come back as UTC wall clocks."""
    spec = load_marts()["mart_sales_weather_hourly"]
    root, run = scratch(i.spark, "published"), run_id()
    layer = f"published_{run}"
    mart = DayTable(i.spark, root, layer, "source").replace(i.hourly_mart, run)
    publish.publish_days(mart, replace(spec, layer=layer), root, run)
    shown = i.spark.table(f"{layer}.{spec.table}")
    return shown.withColumn("measured_at", clock.utc_wall(F.col("measured_at")))


@query
def published_rows(i: Inputs) -> DataFrame:
    """Publish the daily mart twice; readers see one copy of it."""
    spec = load_marts()["mart_sales_weather_daily"]
    root, run = f"{shared_dir(i.spark)}/warehouse", run_id()
    mart = tables.replace_table(i.daily_mart, root, "marts", spec.model, run)
    publish.publish_mart(mart, spec, root, run + "a")
    publish.publish_mart(mart, spec, root, run + "b")
    return i.spark.table(f"{spec.layer}.{spec.table}")
