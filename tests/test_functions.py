from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillcast.functions import clock, keys, money, payload, values


def one(df):
    return df.first()[0]


def column(df, expr):
    return [row[0] for row in df.select(expr).collect()]


def test_slug(rows):
    df = rows("name string", ["Rostov-on-Don"], ["Saint Petersburg"], ["ufa"], [None])
    assert column(df, keys.slug(F.col("name"))) == ["rostov_on_don", "saint_petersburg", "ufa", None]


def test_joined_text_skips_nulls(rows):
    df = rows("a string, b int", ["x", 1], [None, 2])
    assert column(df, keys.joined_text(F.col("a"), F.col("b"))) == ["x|1", "2"]


def test_hash_ids_are_hex_of_the_text(rows):
    import hashlib

    df = rows("a string, b int", ["x", 1])
    row = df.select(keys.sha256_id(F.col("a"), F.col("b")), keys.md5_key(F.col("a"))).first()
    assert row[0] == hashlib.sha256(b"x|1").hexdigest()
    assert row[1] == hashlib.md5(b"x").hexdigest()


def test_time_text(rows):
    df = rows("t string", ["10:15:50"], ["10:15:50.520000"], ["1970-01-01 23:59:59.9"], [None])
    assert column(df, clock.time_text(F.col("t"))) == ["10:15:50.000", "10:15:50.520", "23:59:59.900", None]


def test_wall_clock_is_null_without_a_time(rows):
    df = rows("d date, t string", ["2024-03-01", "10:15:50.520"], ["2024-03-01", None])
    assert column(df, clock.wall_clock(F.col("d"), F.col("t"))) == [datetime(2024, 3, 1, 10, 15, 50, 520000), None]


@pytest.mark.parametrize(
    "wall, zone, instant",
    [
        ("2024-03-01 00:30:00", "Europe/Moscow", datetime(2024, 2, 29, 21, 30)),
        ("2024-03-01 00:30:00", "Asia/Krasnoyarsk", datetime(2024, 2, 29, 17, 30)),
        ("2024-03-31 02:30:00", "Europe/Berlin", datetime(2024, 3, 31, 1, 30)),  # in the spring gap
        ("2024-10-27 02:30:00", "Europe/Berlin", datetime(2024, 10, 27, 0, 30)),  # first of the two
        ("2024-03-01 00:30:00", None, None),
    ],
)
def test_to_utc(rows, wall, zone, instant):
    df = rows("w timestamp_ntz, z string", [wall, zone])
    assert column(df, clock.to_utc(F.col("w"), F.col("z"))) == [instant]


def test_unknown_zone_fails(rows):
    df = rows("w timestamp_ntz, z string", ["2024-03-01 00:30:00", "Mars/Olympus"])
    with pytest.raises(Exception, match="Olympus"):
        column(df, clock.to_utc(F.col("w"), F.col("z")))


def test_local_date_can_differ_from_utc_date(rows):
    df = rows("t timestamp_ntz, z string", ["2024-02-29 21:30:00", "Europe/Moscow"])
    row = df.select(
        clock.local_date(F.col("t"), F.col("z")), clock.local_hour(F.col("t"), F.col("z"))
    ).first()
    assert tuple(row) == (date(2024, 3, 1), 0)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_instants_do_not_depend_on_the_session_zone(spark, rows, zone):
    df = rows("w timestamp_ntz", ["2024-07-01 12:34:56.789012"])
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        back = df.select(
            clock.utc_wall(clock.as_instant(F.col("w"))),
            F.unix_micros(clock.as_instant(F.col("w"))),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert back[0] == datetime(2024, 7, 1, 12, 34, 56, 789012)
    assert back[1] == 1719837296789012


def test_calendar_attributes(rows):
    df = rows("d date", ["2026-10-09"], ["2026-10-10"])
    got = df.select(clock.date_key(F.col("d")), clock.weekday_name(F.col("d")), clock.is_weekend(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(20261009, "Friday", False), (20261010, "Saturday", True)]


def test_iso_utc(rows):
    df = rows("w timestamp_ntz", ["2024-03-01 00:00:00"])
    assert column(df, clock.iso_utc(F.col("w"))) == ["2024-03-01T00:00:00.000000+00:00"]


def test_price_rounds_half_up(rows):
    df = rows("m decimal(12,2), f decimal(5,2)", ["3.87", "1.38"], ["0.15", "0.03"], ["0.05", "0.01"])
    assert column(df, money.price(F.col("m"), F.col("f"))) == [Decimal("53.41"), Decimal("0.05"), Decimal("0.01")]


def test_ratio_rounds_half_away_from_zero_and_survives_zero(rows):
    df = rows("t decimal(12,2), n int", ["0.05", 2], ["-0.05", 2], ["1.00", 3], ["1.00", 0], ["1.00", None])
    assert column(df, money.ratio_2dp(F.col("t"), F.col("n"))) == [
        Decimal("0.03"), Decimal("-0.03"), Decimal("0.33"), None, None,
    ]


def test_mean_has_16_decimals(rows):
    df = rows("t decimal(12,2), n bigint", ["2.00", 3])
    assert column(df, money.mean_16dp(F.col("t"), F.col("n"))) == [Decimal("0.6666666666666667")]


def test_share_of_nothing_is_null(rows):
    df = rows("p decimal(20,2), w decimal(20,2)", ["1.00", "3.00"], ["0.00", "0.00"])
    assert column(df, money.share_pct(F.col("p"), F.col("w"))) == [Decimal("33.33"), None]


def test_hours_in(rows):
    df = rows("p string", ['{"hourly":{"time":["a","b"]}}'], ['{"hourly":{}}'], ["{}"], ['{"hourly":{"time":[]}}'])
    assert column(df, payload.hours_in(F.col("p"))) == [2, 0, 0, 0]


def test_malformed_document_fails(rows):
    df = rows("p string", ['{"hourly": '])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        column(df, payload.parse_document(F.col("p")))


def test_json_number(rows):
    df = rows("p string", ['{"latitude": 55.7558}'], ["{}"])
    assert column(df, payload.json_number(F.col("p"), "$.latitude")) == [Decimal("55.75580"), None]


def test_predicates(rows):
    df = rows("a int, b int", [1, None], [None, None], [1, 1], [0, None])
    got = df.select(
        values.differs(F.col("a"), F.col("b")),
        values.differs_zero_filled(F.col("a"), F.col("b")),
        values.outside(F.col("a"), 0, 0),
    ).collect()
    assert [tuple(r) for r in got] == [
        (True, True, True), (False, False, None), (False, False, True), (True, False, False),
    ]
