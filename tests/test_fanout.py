from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillcast.operators import fanout, quality
from tillcast.plans import staging
from tillcast.sources import cities as city_source

LOG = "cash_type string, money decimal(3,1), coffee_name string, date date, time string"


@pytest.fixture
def directory(spark):
    return city_source.seed_rows(spark, datetime(2024, 1, 1)), city_source.profile_rows(spark)


@pytest.fixture
def log(rows):
    return rows(
        LOG,
        ["card", "38.7", "Latte", "2024-03-01", "10:15:50.520"],
        ["cash", "28.9", "Tea", "2024-03-01", "00:30:00.000"],
    )


def test_every_sale_in_every_city(log, directory):
    result = fanout.fan_out_sales(log, *directory)
    assert result.columns == fanout.COLUMNS
    assert result.count() == 40
    row = result.filter("city_slug = 'krasnoyarsk' and product_name = 'Tea'").first()
    assert row.sold_at == datetime(2024, 2, 29, 17, 30)
    assert row.date == date(2024, 3, 1)
    assert row.amount_rub == Decimal("433.50")
    assert (row.quantity, row.line_number, row.is_synthetic) == (1, 1, True)


def test_source_id_is_shared_by_cities_and_others_are_not(log, directory):
    ids = fanout.fan_out_sales(log, *directory).agg(
        *[F.count_distinct(c) for c in ("source_sale_id", "synthetic_sale_id", "synthetic_sale_item_id")]
    ).first()
    assert tuple(ids) == (2, 40, 40)


def test_ids_are_hashes_of_the_key_text(log, directory):
    import hashlib

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    row = fanout.fan_out_sales(log, *directory).filter("city_slug = 'ufa' and product_name = 'Latte'").first()
    assert row.source_sale_id == sha("2024-03-01|10:15:50.520|Latte|38.7|card")
    assert row.synthetic_sale_id == sha(row.source_sale_id + "|ufa")
    assert row.synthetic_sale_item_id == sha(row.synthetic_sale_id + "|1")


def test_plan_is_the_same_for_a_long_directory(spark, log, directory):
    plans = []
    for length in (10, 20_000):
        cities = spark.range(length).selectExpr("concat('c', id) as city_slug", "'UTC' as timezone", "cast(1 as decimal(5,2)) as price_multiplier")
        pairs = fanout.per_city(log, cities)
        plans.append([line.split("(")[0].strip() for line in pairs._jdf.queryExecution().optimizedPlan().toString().split("\n")])
        assert pairs.count() == length * log.count()
    assert len(plans[0]) == len(plans[1])


def test_no_cross_join_and_no_shuffle_of_the_products(log, directory):
    plan = fanout.per_city(log, fanout.city_directory(*directory))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_ids_of_a_sale_are_hashed_before_it_is_multiplied(log, directory):
    plan = fanout.fan_out_sales(log, *directory)._jdf.queryExecution().executedPlan().toString().split("\n")
    join = next(k for k, line in enumerate(plan) if "_salt" in line and "Join" in line)
    end = next(k for k, line in enumerate(plan) if "Coalesce" in line)
    hashed = next(k for k, line in enumerate(plan) if "AS source_sale_id" in line)
    assert join < end < hashed  # a node's input stands below it


def test_clean_fan_out_passes_the_audit(log, directory):
    cities, profiles = directory
    result = fanout.fan_out_sales(log, cities, profiles)
    assert quality.audit_fan_out(result, log, cities).count() == 0
    quality.require(quality.audit_fan_out(result, log, cities))


def test_audit_reports_every_failure(rows, directory):
    cities, profiles = directory
    log = rows(
        LOG,
        ["card", "38.7", "Latte", "2024-03-01", "10:15:50.520"],
        ["card", "38.7", "Latte", "2024-03-01", "10:15:50.520"],  # identical sale
        ["card", "0.0", None, "2024-03-01", "11:00:00.000"],
        [None, "9.9", "Tea", "2024-03-01", "12:00:00.000"],  # payment type may be missing
    )
    known = profiles.filter("city_slug <> 'perm'")
    audit = quality.audit_fan_out(fanout.fan_out_sales(log, cities, known), log, cities)
    assert {r.check: r.n_rows for r in audit.collect()} == {
        "null timezone": 4,
        "null sold_at": 4,
        "null product_name": 20,
        "null amount_rub": 4,
        "amount_rub not positive": 19,
        "synthetic_sale_id repeated": 20,
        "synthetic_sale_item_id repeated": 20,
    }
    with pytest.raises(quality.QualityError, match="null timezone"):
        quality.require(audit)


def test_audit_tells_odd_ids_apart_and_shuffles_them_packed(log, directory):
    cities, profiles = directory
    result = fanout.fan_out_sales(log, cities, profiles)
    digest = F.sha2(F.lit("x"), 256)
    odd = [F.upper(digest), digest, F.concat(digest, F.lit("\n")), F.unhex(digest).cast("string"), F.lit(""), F.lit("\0"), F.lit("a")]
    base = result.limit(len(odd)).withColumn("_at", F.row_number().over(Window.orderBy("synthetic_sale_id")))
    ids = F.element_at(F.array(*odd), F.col("_at"))
    apart = base.withColumns({"synthetic_sale_id": ids, "synthetic_sale_item_id": ids})
    found = {r.check for r in quality.audit_fan_out(apart, log, cities).collect()}
    assert "synthetic_sale_id repeated" not in found and "synthetic_sale_item_id repeated" not in found
    plan = quality.audit_fan_out(result, log, cities)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(synthetic_sale" not in plan and "unhex" in plan


def test_audit_counts_lost_rows(log, directory):
    cities, profiles = directory
    result = fanout.fan_out_sales(log, cities, profiles).filter("city_slug <> 'omsk'")
    audit = quality.audit_fan_out(result, log, cities)
    assert [tuple(r) for r in audit.collect()] == [("row count off", 2)]


def test_a_second_profile_row_multiplies_and_is_noticed(log, directory):
    cities, profiles = directory
    twice = profiles.unionByName(profiles.filter("city_slug = 'omsk'"))
    audit = quality.audit_fan_out(fanout.fan_out_sales(log, cities, twice), log, cities)
    assert {r.check for r in audit.collect()} == {
        "row count off", "synthetic_sale_id repeated", "synthetic_sale_item_id repeated",
    }


def test_log_time_is_utc_in_staging_and_local_in_the_fan_out(rows, directory):
    log = rows(
        LOG + ", hour_of_day int, time_of_day string, weekday string, month_name string, weekdaysort int, monthsort int",
        ["card", "38.7", "Latte", "2024-03-01", "00:30:00.000", 0, "Night", "Fri", "Mar", 5, 3],
    )
    staged = staging.stg_sales_log(log).first()
    assert staged.ordered_at == datetime(2024, 3, 1, 0, 30)
    assert staged.transaction_amount == Decimal("38.70")
    moscow = fanout.fan_out_sales(log, *directory).filter("city_slug = 'moscow'").first()
    assert moscow.sold_at == datetime(2024, 2, 29, 21, 30)
