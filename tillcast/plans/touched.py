"""Refresh of touched days: what new weather loads change, and nothing else, is computed and written again.

The change set comes from the batches that no refresh has seen. A document replaces an older one of its key, so the days
of every version of the keys in those batches are touched: hours may come, change or go. Facts and marts of these days
are computed from documents that can hold them, from the facts of these days, and from sales hours; their days are
replaced, checked and published alone. Keys and days go together in every check made here (an hour of a city has one
local day); the stored checks of a model look keys up among all days none the less, without reading their rows.

A refresh that finds other inputs changed (cities, sales) rebuilds everything.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators import quality
from tillcast.plans import checks, core, marts, raw, staging
from tillcast.sources import tables
from tillcast.sources.days import NO_DAY, DayTable, part_of
from tillcast.sources.log import BATCH

#: Models kept by day, with the column of their day.
BY_DAY = {
    "core_fct_sales": "date_key",
    "core_fct_weather_hour": "date_key",
    "core_fct_weather_forecast_hour": "forecast_date_key",
    "mart_product_sales_daily": "date_key",
    "mart_sales_weather_daily": "date_key",
    "mart_sales_weather_hourly": "date_key",
}
#: What a refresh of touched days writes.
WEATHER_MODELS = ["core_fct_weather_hour", "core_fct_weather_forecast_hour", "mart_sales_weather_daily", "mart_sales_weather_hourly"]
STATE = "core_refresh_state"


def layer_of(model: str) -> str:
    return "core" if model.startswith("core_") else "marts"


def day_table(spark: SparkSession, root: str, model: str) -> DayTable:
    return DayTable(spark, root, layer_of(model), model, BY_DAY[model])


# --- what has been seen ---------------------------------------------------------------------


def present_state(spark: SparkSession) -> set[tuple[str, str]]:
    """(source, batch or version) of all that a refresh reads now."""
    state = set()
    for name in raw.DOCUMENTS:
        log = raw.document_log(spark, name)
        if log.exists():
            state |= {(name, batch) for batch in log.batches()}
    for name in ("cities", "synthetic_coffee_sales", *raw.DOCUMENTS):
        version = tables.shown_version(spark, raw.RAW, name)
        if version:
            state.add((f"table {name}", version))
    return state


def seen_state(spark: SparkSession) -> set[tuple[str, str]] | None:
    """What the last refresh had read; None before the first."""
    if STATE not in tables.table_names(spark, "core"):
        return None
    return {(r["source"], r["batch"]) for r in spark.table(f"core.{STATE}").collect()}


def note_state(spark: SparkSession, state: set[tuple[str, str]], root: str, run_id: str) -> None:
    frame = spark.createDataFrame(sorted(state), "source string, batch string").coalesce(1)
    tables.replace_table(frame, root, "core", STATE, run_id)


def new_batches(seen: set[tuple[str, str]] | None, present: set[tuple[str, str]]) -> dict[str, list[str]] | None:
    """Batches by document table that are new; None if more has changed than that."""
    if seen is None:
        return None
    tables_of = lambda state: {x for x in state if x[0].startswith("table ")}
    if tables_of(seen) != tables_of(present):
        return None
    return {name: sorted(b for source, b in present - seen if source == name) for name in raw.DOCUMENTS}


def note_compaction(spark: SparkSession, name: str, old: list[str], batch: str, root: str, run_id: str) -> None:
    """Count a compacted batch as seen if all that went into it were."""
    seen = seen_state(spark)
    if seen is not None and {(name, b) for b in old} <= seen:
        note_state(spark, (seen - {(name, b) for b in old}) | {(name, batch)}, root, run_id)


# --- which days -----------------------------------------------------------------------------


def days_of(rows: DataFrame, day: str) -> set[int]:
    """Distinct days of rows; as many as the calendar has at most."""
    return {r[0] for r in rows.select(part_of(day)).distinct().collect()}


def weather_days(documents: DataFrame, cities: DataFrame, dates: DataFrame) -> set[int]:
    """Local days that archive documents have hours of."""
    return days_of(core.fct_weather_hour(staging.stg_weather_hourly(documents), cities, dates), "date_key")


def forecast_days(documents: DataFrame, cities: DataFrame, dates: DataFrame) -> set[int]:
    return days_of(core.fct_weather_forecast_hour(staging.stg_weather_forecast(documents), cities, dates), "forecast_date_key")


def on_days(rows: DataFrame, day: str, days: set[int]) -> DataFrame:
    return rows.where(part_of(day).isin(sorted(days)))


def may_hold(documents: DataFrame, days: set[int]) -> DataFrame:
    """Archive documents whose period, a day wider for any zone, has one of the days; all if one is unknown."""
    if NO_DAY in days or not days:
        return documents if days else documents.limit(0)
    calendar = [date(d // 10000, d // 100 % 100, d % 100) for d in sorted(days)]
    # The bounds reach the scan; the list of days, no longer than the calendar, sorts out the rest.
    near = documents.where((F.col("period_end") >= F.lit(calendar[0] - timedelta(1))) & (F.col("period_start") <= F.lit(calendar[-1] + timedelta(1))))
    spread = F.sequence(F.date_sub("period_start", 1), F.date_add("period_end", 1))
    return near.where(F.arrays_overlap(spread, F.array(*[F.lit(d) for d in calendar])))


def loads_near(loads: DataFrame, days: set[int]) -> DataFrame:
    """Hourly loads whose hour lies on one of the days or next to it, in any zone."""
    return may_hold(loads.withColumns({"period_start": F.to_date("measured_at"), "period_end": F.to_date("measured_at")}), days)


# --- rows of the days -----------------------------------------------------------------------


def weather_on(documents: DataFrame, days: set[int], cities: DataFrame, dates: DataFrame) -> DataFrame:
    """The weather fact of some days, from the documents that count."""
    fact = core.fct_weather_hour(staging.stg_weather_hourly(may_hold(documents, days)), cities, dates)
    return on_days(fact, "date_key", days)


def forecast_on(held: DataFrame, changed: DataFrame, days: set[int], cities: DataFrame, dates: DataFrame) -> DataFrame:
    """The forecast fact of some days: what is held but for the issues that changed, and those as they are now."""
    now = core.fct_weather_forecast_hour(staging.stg_weather_forecast(changed), cities, dates)
    issues = changed.join(cities.select("city_slug", "city_key"), "city_slug", "left").select("city_key", "issued_at").distinct()
    # An issue of a city without a dimension has a null key, which is a key here.
    same = held["city_key"].eqNullSafe(issues["city_key"]) & (held["issued_at"] == issues["issued_at"])
    return held.join(issues, same, "left_anti").unionByName(on_days(now, "forecast_date_key", days))


def marts_on(sales: DataFrame, hours: DataFrame, weather: DataFrame, cities: DataFrame, dates: DataFrame) -> dict[str, DataFrame]:
    """The weather marts of the days that ``sales`` and ``weather`` are of; ``hours`` are the sales hours of all days."""
    return {
        "mart_sales_weather_daily": marts.mart_sales_weather_daily(sales, weather, cities, dates),
        "mart_sales_weather_hourly": marts.hourly_from_hours(hours, weather, cities, dates),
    }


# --- the refresh ----------------------------------------------------------------------------


def touched(spark: SparkSession, batches: dict[str, list[str]], cities: DataFrame, dates: DataFrame) -> dict[str, set[int]]:
    """Days that new batches touch, by document table."""
    find = {"weather_archive": weather_days, "weather_forecast": forecast_days}
    return {name: find[name](raw.document_log(spark, name).versions_of(own), cities, dates) if own else set() for name, own in batches.items()}


def rebuild_days(
    inputs: dict[str, DataFrame], batches: dict[str, list[str]], root: str, run_id: str, today: date
) -> tuple[dict[str, DataFrame], dict[str, set[int]]]:
    """Replace the touched days of the weather models; returns their rows on these days, and the days of each."""
    spark = inputs["cities"].sparkSession
    cities, hours = spark.table("core.core_dim_city"), spark.table("core.core_agg_sales_hour")
    dates = tables.replace_table(core.dim_date(spark, today), root, "core", "core_dim_date", run_id)
    days = touched(spark, batches, cities, dates)
    measured, ahead = days["weather_archive"], days["weather_forecast"]
    table = {model: day_table(spark, root, model) for model in BY_DAY}
    if measured:
        fact = weather_on(inputs["weather_archive"], measured, cities, dates)
        table["core_fct_weather_hour"].replace(fact, run_id, measured)
        weather = table["core_fct_weather_hour"].read(measured)
        for model, rows in marts_on(table["core_fct_sales"].read(measured), hours, weather, cities, dates).items():
            table[model].replace(rows, run_id, measured)
    if ahead:
        log = raw.document_log(spark, "weather_forecast")
        keys = log.rows().where(F.col(BATCH).isin(batches["weather_forecast"])).select(*log.key).distinct()
        changed = inputs["weather_forecast"].join(keys, log.key, "left_semi")
        held = table["core_fct_weather_forecast_hour"]
        held.replace(forecast_on(held.read(ahead), changed, ahead, cities, dates), run_id, ahead)
    own = {model: ahead if "forecast" in model else measured for model in WEATHER_MODELS}
    return {model: table[model].read(own[model]) for model in WEATHER_MODELS}, own


def check_model(spark: SparkSession, root: str, model: str, run_id: str, parents: dict[str, DataFrame], days: set[int] | None = None) -> DataFrame:
    """(check, n_rows) of the failed checks of a whole model, of which only the touched days are read; notes their results."""
    stored = checks.stored_checks(day_table(spark, root, model), model)
    stored.replace(run_id, days)
    return checks.stored_failures(stored, model, parents, days)


def check_days(
    models: dict[str, DataFrame], days: dict[str, set[int]], sales: DataFrame, cities: DataFrame, dates: DataFrame, root: str, run_id: str
) -> None:
    """All checks that rows of the touched days can fail, keys against all days; raise if any does."""
    parents = {"core_dim_city": cities, "core_dim_date": dates}
    wanted = {
        "weather values are valid": quality.weather_out_of_range(models["core_fct_weather_hour"], models["core_fct_weather_forecast_hour"]),
        "marts match daily sales": quality.marts_vs_sales(sales, models["mart_sales_weather_hourly"], models["mart_sales_weather_daily"]),
    }
    found = [check_model(cities.sparkSession, root, model, run_id, parents, days[model]) for model in models if days[model]]
    quality.require(reduce(DataFrame.unionByName, [quality.failures(wanted), *found]))
