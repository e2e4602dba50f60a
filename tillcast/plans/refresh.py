"""Build all models, or the days that new loads touch, check them, publish the marts."""

from __future__ import annotations

import argparse
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tillcast import schemas
from tillcast.contracts import load_marts
from tillcast.operators import quality
from tillcast.operators.fanout import fan_out_sales
from tillcast.operators.publish import publish_days
from tillcast.plans import checks, core, marts, raw, staging, touched
from tillcast.session import build_session, shared_dir
from tillcast.sources import jdbc, readers, snapshot, tables


def fan_out(sales_log: DataFrame, cities: DataFrame, profiles: DataFrame, root: str, run_id: str,
            check_only: bool = False) -> DataFrame | None:
    """Write the synthetic sales, which must not be there yet, once they pass the audit.

    The candidate version is written first, so the audit reads the rows that
    will be shown instead of computing them again for each check.
    """
    spark = sales_log.sparkSession
    candidate = fan_out_sales(sales_log, cities, profiles)
    if check_only:
        quality.require(quality.audit_fan_out(candidate, sales_log, cities))
        return None
    if "synthetic_coffee_sales" in tables.table_names(spark, "raw"):
        raise RuntimeError("raw.synthetic_coffee_sales is there already; drop it before a new fan-out")
    version = tables.write_version(candidate, root, "raw", "synthetic_coffee_sales", run_id)
    try:
        quality.require(quality.audit_fan_out(spark.table(version), sales_log, cities))
    except Exception:
        tables.refuse(spark, version)
        raise
    tables.point_to(spark, "raw", "synthetic_coffee_sales", version)
    return spark.table("raw.synthetic_coffee_sales")


def build_core(inputs: dict[str, DataFrame], root: str, run_id: str, today: date) -> dict[str, DataFrame]:
    """Staging models as views and core models as tables."""
    staged = {
        "cities": staging.stg_cities(inputs["cities"]),
        "sales_log": staging.stg_sales_log(inputs["kaggle_coffee"]),
        "synthetic_sales": staging.stg_synthetic_sales(inputs["synthetic_coffee_sales"]),
        "weather_hourly": staging.stg_weather_hourly(inputs["weather_archive"]),
        "weather_forecast": staging.stg_weather_forecast(inputs["weather_forecast"]),
    }
    for name, df in staged.items():
        tables.as_view(df, "stg", name)
    keep = Keeper("core", root, run_id)
    sales = staged["synthetic_sales"]
    cities = keep("core_dim_city", core.dim_city(staged["cities"], sales))
    dates = keep("core_dim_date", core.dim_date(sales.sparkSession, today))
    products = keep("core_dim_product", core.dim_product(sales))
    keep("core_fct_sales", core.fct_sales(sales, cities, dates))
    keep("core_fct_sales_item", core.fct_sales_item(sales, products))
    keep("core_fct_weather_hour", core.fct_weather_hour(staged["weather_hourly"], cities, dates))
    forecast = core.fct_weather_forecast_hour(staged["weather_forecast"], cities, dates)
    keep("core_fct_weather_forecast_hour", forecast)
    # Sales hours are read twice by the hourly mart and by every refresh of touched days, so they are a table.
    keep("core_agg_sales_hour", marts.sales_hours(keep.models["core_fct_sales"]))
    return keep.models


def build_marts(models: dict[str, DataFrame], root: str, run_id: str) -> dict[str, DataFrame]:
    """Mart models as tables, from the core tables."""
    keep = Keeper("marts", root, run_id)
    cities, dates, products = (models[f"core_dim_{name}"] for name in ("city", "date", "product"))
    sales, items, weather = (models[f"core_fct_{name}"] for name in ("sales", "sales_item", "weather_hour"))
    keep("mart_product_sales_daily", marts.mart_product_sales_daily(items, sales, cities, products, dates, items.count()))
    keep("mart_sales_weather_daily", marts.mart_sales_weather_daily(sales, weather, cities, dates))
    keep("mart_sales_weather_hourly", marts.hourly_from_hours(models["core_agg_sales_hour"], weather, cities, dates))
    return keep.models


class Keeper:
    """Writes models of a layer as tables, facts and marts by day, and remembers them."""

    def __init__(self, layer: str, root: str, run_id: str):
        self.layer, self.root, self.run_id = layer, root, run_id
        self.models: dict[str, DataFrame] = {}

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        if name in touched.BY_DAY:
            self.models[name] = touched.day_table(df.sparkSession, self.root, name).replace(df, self.run_id)
        else:
            self.models[name] = tables.replace_table(df, self.root, self.layer, name, self.run_id)
        return self.models[name]


def verify(models: dict[str, DataFrame], layer: str, cross: dict[str, DataFrame], root: str, run_id: str) -> None:
    """Run the declared checks of a layer and its cross-model checks; raise if any fails.

    Results of models kept by day are stored by day, for refreshes of touched days to build on.
    """
    spark = next(iter(models.values())).sparkSession
    wanted, stored = dict(cross), []
    for name in checks.DECLARED:
        if not name.startswith(layer):
            continue
        if name in touched.BY_DAY:
            stored.append(touched.check_model(spark, root, name, run_id, models))
        else:
            wanted |= checks.declared_checks(models, name)
    quality.require(reduce(DataFrame.unionByName, [quality.failures(wanted), *stored]))


def refresh(inputs: dict[str, DataFrame], root: str, run_id: str, today: date) -> list[dict[str, str]]:
    """Build, verify, publish.

    The core layer is verified before the marts are built: repeated receipt keys
    would multiply in their joins. A failed check leaves the published marts as
    they were.
    """
    specs = load_marts()
    spark = next(iter(inputs.values())).sparkSession
    models = build_core(inputs, root, run_id, today)
    verify(models, "core_", checks.core_checks(models), root, run_id)
    models |= build_marts(models, root, run_id)
    unbuilt = tables.missing_tables(spark, "marts", list(specs))
    if unbuilt:
        raise RuntimeError(f"configured marts were not built: {unbuilt}")
    verify(models, "mart_", checks.mart_checks(models), root, run_id)
    return [publish_days(models[name], spec, root, run_id) for name, spec in specs.items()]


def refresh_changes(spark: SparkSession, root: str, run_id: str, today: date) -> list[dict[str, str]]:
    """Refresh what changed since the last refresh: the days that new weather loads touch, or everything.

    What was there when the refresh began is noted when it is published, so a load that
    comes in between, or a refresh that fails, is taken up by the next one.
    """
    present = touched.present_state(spark)
    batches = touched.new_batches(touched.seen_state(spark), present)
    inputs = read_raw(spark)
    if batches is None:
        published = refresh(inputs, root, run_id, today)
    elif not any(batches.values()):
        return []
    else:
        models, days = touched.rebuild_days(inputs, batches, root, run_id, today)
        measured = days["core_fct_weather_hour"]
        sales = touched.day_table(spark, root, "core_fct_sales").read(measured)
        touched.check_days(models, days, sales, spark.table("core.core_dim_city"), spark.table("core.core_dim_date"), root, run_id)
        specs = load_marts()
        published = [publish_days(models[name], specs[name], root, run_id, measured) for name in touched.WEATHER_MODELS if name in specs and measured]
    touched.note_state(spark, present, root, run_id)
    return published


def read_raw(spark: SparkSession) -> dict[str, DataFrame]:
    """All raw tables; document tables are read from the logs that the load jobs append to."""
    logged = [name for name in raw.DOCUMENTS if raw.document_log(spark, name).exists()]
    missing = tables.missing_tables(spark, "raw", [name for name in schemas.RAW_TABLES if name not in logged])
    if missing:
        raise RuntimeError(f"raw tables are missing: {missing}")
    return {name: raw.read_documents(spark, name) if name in logged else spark.table(f"raw.{name}") for name in schemas.RAW_TABLES}


def new_run_id(now: datetime) -> str:
    return now.strftime("%Y%m%d%H%M%S")


def run(args: argparse.Namespace, spark: SparkSession, now: datetime) -> list[object]:
    """Run one job and return the lines it reports."""
    root, run_id = f"{shared_dir(spark)}/warehouse", new_run_id(now)
    if args.job == "load-sales":
        return ["loaded" if raw.load_sales_log(spark, args.path, root, run_id) else "already loaded"]
    if args.job == "seed-cities":
        return [f"{raw.seed_cities(spark, root, run_id, now.replace(tzinfo=None)).count()} cities"]
    if args.job in ("weather_archive", "weather_forecast"):
        found = raw.stream_documents(spark, args.path, args.job, root)
        return [f"{batch}: {summary}" for batch, summary in found.items()] or ["nothing new has landed"]
    if args.job == "compact":
        lines = []
        for name in raw.DOCUMENTS:
            log = raw.document_log(spark, name, root)
            if log.exists():
                old = log.compact(run_id)
                touched.note_compaction(spark, name, old, run_id, root, run_id)
                lines.append(f"{name}: {len(old)} batches made one")
        return lines
    if args.job == "fan-out":
        profiles = readers.read_city_profiles(spark, args.path)
        cities = spark.table("raw.cities")
        if not args.url:
            fan_out(spark.table("raw.kaggle_coffee"), cities, profiles, root, run_id, args.check_only)
            return ["fan-out passed its audit"]
        # The log comes from a database, in ranges of its dates, and the result goes back to a new table there.
        split = jdbc.Split("date", args.first_day, args.last_day, args.connections)
        sales = jdbc.read_table(spark, args.url, "raw.kaggle_coffee", split)
        done = fan_out(sales, cities, profiles, root, run_id, args.check_only)
        if done is not None:
            jdbc.write_table(done, args.url, "raw.synthetic_coffee_sales", args.connections)
        return ["fan-out passed its audit"]
    if args.job == "export-snapshot":
        manifest = snapshot.export_snapshot(read_raw(spark), args.path)
        return [f"{manifest.count()} files listed in {args.path}/manifest"]
    if args.job == "restore-snapshot":
        done = snapshot.restore_snapshot(spark, args.path, root, run_id)
        return ["restored" if done else "the raw layer is already there"]
    if args.job == "rebuild":
        return refresh(read_raw(spark), root, run_id, now.date())
    return refresh_changes(spark, root, run_id, now.date()) or ["nothing has changed"]


JOBS = [
    "load-sales", "seed-cities", "weather_archive", "weather_forecast", "compact", "fan-out", "refresh", "rebuild",
    "export-snapshot", "restore-snapshot",
]


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(description="Jobs of the sales and weather warehouse.")
    options.add_argument("job", choices=JOBS)
    options.add_argument("--path", help="file or folder the job reads, or the snapshot folder")
    options.add_argument("--check-only", action="store_true", help="audit the fan-out without writing it")
    options.add_argument("--url", help="database that fan-out reads the sales log from and writes to")
    options.add_argument("--first-day", help="first date of the log in the database, which splits its scan")
    options.add_argument("--last-day", help="last date of the log in the database")
    options.add_argument("--connections", type=int, default=2, help="connections to the database at once")
    return options


def main() -> None:
    args = parser().parse_args()
    spark = build_session()
    for line in run(args, spark, datetime.now(timezone.utc)):
        print(line)
    spark.stop()


if __name__ == "__main__":
    main()
