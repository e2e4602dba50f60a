import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillcast import contracts
from tillcast.contracts import DEFAULT_FILE, identifier, load_marts
from tillcast.operators import publish
from tillcast.sources import tables

PRODUCT = (
    "city_key string, city_slug string, city_name string, date_key int, sales_date date, product_key string, "
    "product_name string, units_sold bigint, receipts_count bigint, product_revenue_rub decimal(20,2), "
    "average_unit_price_rub decimal(20,2), revenue_share_pct decimal(7,2), extra string"
)


def line(product, units=2, revenue="10.10", name="Tea"):
    return ["m", "moscow", "Moscow", 20240301, "2024-03-01", product, name, units, 1, revenue, None, "50.00", "x"]


@pytest.fixture
def spec(spark, request):
    # Each test publishes to a layer of its own.
    from dataclasses import replace

    base = load_marts()["mart_product_sales_daily"]
    return replace(base, layer="serving_" + request.node.name[5:25])


def test_publish_and_publish_again(spark, rows, shared, spec):
    name = f"{spec.layer}.{spec.table}"
    first = rows(PRODUCT, line("x"), line("y"))
    shown = publish.publish_mart(first, spec, shared, "001")
    assert shown == {"table": name, "row_count": "2", "units_sold": "4", "receipts_count": "2", "product_revenue_rub": "20.20"}
    assert spark.table(name).columns == spec.columns
    publish.publish_mart(rows(PRODUCT, line("x", revenue="11.00")), spec, shared, "002")
    assert spark.table(name).first().product_revenue_rub == Decimal("11.00")
    publish.publish_mart(rows(PRODUCT, line("z")), spec, shared, "003")
    assert spark.table(name).count() == 1
    # The current version and the one before it are kept.
    assert tables.versions(spark, spec.layer, spec.table) == [f"{spec.table}__v002", f"{spec.table}__v003"]


@pytest.mark.parametrize(
    "bad, message",
    [
        ([], "empty"),
        ([line("x"), line("x")], "duplicate keys"),
        ([line("x", name=None)], "1 rows with a missing value"),
        ([line("x", units=-1)], "1 with a negative count"),
    ],
)
def test_a_refused_mart_leaves_the_published_one(spark, rows, shared, spec, bad, message):
    from dataclasses import replace

    spec = replace(spec, layer=spec.layer[:18] + str(abs(hash(message)) % 10**6))
    publish.publish_mart(rows(PRODUCT, line("good")), spec, shared, "001")
    with pytest.raises(publish.PublishError, match=message):
        publish.publish_mart(rows(PRODUCT, *bad) if bad else rows(PRODUCT, line("x")).limit(0), spec, shared, "002")
    assert [r.product_key for r in spark.table(f"{spec.layer}.{spec.table}").collect()] == ["good"]


def test_changed_sums_are_refused(rows, spec):
    df = rows(PRODUCT, line("x"))
    expected = publish.statistics(df, spec).first().asDict()
    actual = publish.verification(df, spec).first().asDict()
    publish.compare(expected, actual, spec)
    with pytest.raises(publish.PublishError, match="product_revenue_rub"):
        publish.compare(expected, {**actual, "product_revenue_rub": Decimal("10.11")}, spec)


def test_null_key_parts_count_as_a_key(rows, spec):
    df = rows(PRODUCT, line("x"), line(None))
    assert publish.verification(df, spec).first().distinct_keys == 2


def test_missing_column_is_refused(rows, spec):
    with pytest.raises(publish.PublishError, match="units_sold"):
        publish.to_contract(rows(PRODUCT, line("x")).drop("units_sold"), spec)


def test_published_instants_are_utc(spark, rows):
    spec = load_marts()["mart_sales_weather_hourly"]
    df = rows(
        "city_key string, date_key int, hour int, measured_at timestamp_ntz, temperature_c decimal(6,2), "
        "apparent_temperature_c decimal(6,2), precipitation_mm decimal(12,5), surface_pressure_hpa decimal(8,2), "
        "sales_count bigint, total_revenue_rub decimal(20,2), average_check_rub decimal(38,16), city_slug string, "
        "city_name string, sales_date date",
        ["m", 20240301, 0, "2024-03-01 00:00:00", 1, 1, 1, 1, 0, 0, None, "moscow", "Moscow", "2024-03-01"],
    )
    typed = publish.to_contract(df, spec)
    assert [f.dataType for f in typed.schema.fields] == [f.dataType for f in spec.schema.fields]
    assert typed.select(F.unix_seconds("measured_at")).first()[0] == 1709251200


def test_clustered_by_the_sort_key(rows, spec):
    plan = publish.clustered(rows(PRODUCT, line("x")), spec)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(city_key" in plan


# --- contracts ---------------------------------------------------------------------------


def test_identifier():
    assert identifier("_till_2") == "_till_2"
    for value in ["2till", "till-2", "till`2", "till\n", "'", "t\u00edll"]:
        with pytest.raises(ValueError):
            identifier(value)


def test_the_shipped_contracts(spark):
    specs = load_marts()
    assert list(specs) == ["mart_sales_weather_hourly", "mart_product_sales_daily", "mart_sales_weather_daily"]
    assert specs["mart_sales_weather_daily"].unique_key == ("city_key", "date_key")
    assert "average_check_rub" not in specs["mart_sales_weather_hourly"].required


@pytest.mark.parametrize(
    "change, message",
    [
        ({"table": "a b"}, "not an identifier"),
        ({"unique_key": []}, "no unique key"),
        ({"sum_columns": ["nope"]}, "unknown columns"),
        ({"unique_key": ["city_key`, 1"]}, "unknown columns"),
        ({"schema_file": "../x.ddl"}, "not a schema file name"),
        ({"schema_file": "x.sql"}, "not a schema file name"),
        ({"schema_file": "absent.ddl"}, "missing"),
    ],
)
def test_bad_contracts_are_refused(spark, change, message):
    entry = json.loads(DEFAULT_FILE.read_text())["marts"][0]
    with pytest.raises(ValueError, match=message):
        contracts.parse_spec(entry | change, DEFAULT_FILE.parent)


@pytest.mark.parametrize("ddl, message", [("a int, a int", "twice"), ("`a b` int", "not an identifier")])
def test_bad_schemas_are_refused(spark, tmp_path, ddl, message):
    (tmp_path / "x.ddl").write_text(ddl)
    with pytest.raises(ValueError, match=message):
        contracts.read_schema(tmp_path, "x.ddl")


def test_contract_lists_are_checked(spark, tmp_path):
    entries = json.loads(DEFAULT_FILE.read_text())["marts"]
    for entry in entries:
        (tmp_path / entry["schema_file"]).write_text((DEFAULT_FILE.parent / entry["schema_file"]).read_text())
    file = tmp_path / "marts.json"
    file.write_text('{"marts": []}')
    with pytest.raises(ValueError, match="no marts"):
        load_marts(file)
    file.write_text(json.dumps({"marts": [entries[0], entries[0]]}))
    with pytest.raises(ValueError, match="same target"):
        load_marts(file)


def test_a_second_publisher_is_refused(rows, shared, spark):
    spec = load_marts()["mart_product_sales_daily"]
    with publish.claimed(spark, spec, shared, "801"):
        with pytest.raises(publish.PublishError, match="another run"):
            with publish.claimed(spark, spec, shared, "802"):
                pass
    with publish.claimed(spark, spec, shared, "803"):
        pass


def test_a_refused_version_leaves_the_last_good_one(rows, shared, spark):
    from tillcast.sources import tables

    for run, good in (("1", True), ("2", True), ("3", False), ("4", True)):
        version = tables.write_version(rows("a int", [int(run)]), shared, "layer_versions", "t", run)
        tables.point_to(spark, "layer_versions", "t", version) if good else tables.refuse(spark, version)
    assert tables.versions(spark, "layer_versions", "t") == ["t__v2", "t__v4"]
    assert spark.table("layer_versions.t").first().a == 4
