import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from priceloom.functions import (
    business_day,
    clean_text,
    date_key,
    fixed_point,
    geo_label,
    local_to_utc,
    micros_to_ts,
    postal_department,
    price,
    slot_columns,
    strict_ts,
    surrogate_key,
    utc_wall_clock,
)


def one(spark, value, kind, function):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(function(F.col("x")).alias("y")).first()["y"]


def ts(text):
    return dt.datetime.fromisoformat(text)


@pytest.mark.parametrize(
    ("cp", "code"),
    [
        (None, None), ("", None), ("97400", "974"), ("98800", "988"), ("20000", "2A"), ("20199", "2A"),
        ("20200", "2B"), ("34150", "34"), ("01000", "01"), ("1000", "10"), ("7", None),
    ],
)
def test_postal_department(spark, cp, code):
    assert one(spark, cp, "string", postal_department) == code


@pytest.mark.parametrize(
    ("local", "utc"),
    [
        ("2026-06-03 00:01:00", "2026-06-02 22:01:00"),
        ("2026-01-15 00:30:00", "2026-01-14 23:30:00"),
        ("2026-03-29 02:30:00", "2026-03-29 01:30:00"),  # skipped hour
        ("2026-10-25 02:30:00", "2026-10-25 00:30:00"),  # repeated hour: the earlier instant
    ],
)
def test_local_to_utc(spark, local, utc):
    assert one(spark, ts(local), "timestamp_ntz", local_to_utc) == ts(utc)


def test_business_day_is_local(spark):
    key = one(spark, ts("2026-06-02 22:01:00"), "timestamp_ntz", lambda c: date_key(business_day(c)))
    assert key == 20260603


@pytest.mark.parametrize(
    ("raw", "value"),
    [("1.799", 1.799), ("1.79951", 1.8), (" 2 ", 2.0), ("", None), (None, None), ("1,5", None), ("1.5d", None), ("NaN", None)],
)
def test_price(spark, raw, value):
    assert one(spark, raw, "string", price) == value


@pytest.mark.parametrize(
    ("raw", "value"), [("4620114", 46.20114), ("-56700", -0.567), ("", None), ("north", None), (None, None)]
)
def test_fixed_point(spark, raw, value):
    assert one(spark, raw, "string", fixed_point) == (pytest.approx(value) if value is not None else None)


@pytest.mark.parametrize(
    ("raw", "value"),
    [
        ("2026-06-03 09:31:56", "2026-06-03 09:31:56"), ("2026-6-3 9:1:5", "2026-06-03 09:01:05"),
        ("2026-06-03T09:31:56", None), ("2026-06-03", None), ("2026-13-03 09:31:56", None),
        ("2026-06-03 09:31:56.5", None), ("bad-timestamp", None), ("", None), (None, None),
    ],
)
def test_strict_ts(spark, raw, value):
    assert one(spark, raw, "string", strict_ts) == (ts(value) if value else None)


def test_clean_text(spark):
    assert one(spark, "\t Bréhan\n", "string", clean_text) == "Bréhan"
    assert one(spark, "  ", "string", clean_text) is None


def test_surrogate_key_tells_null_from_empty(spark):
    rows = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    keys = [r[0] for r in rows.select(surrogate_key("x", "y")).collect()]
    assert len(set(keys)) == 2
    assert keys[1] == hashlib.md5(b"a-").hexdigest()


def test_slot_is_zero_padded(spark):
    df = spark.createDataFrame([(ts("2026-06-03 07:59:59"),)], "x timestamp_ntz")
    assert tuple(df.select(*slot_columns(F.col("x"))).first()) == ("2026-06-03", "07")


def test_micros_have_scale_six(spark):
    assert one(spark, 1780475640000000, "bigint", micros_to_ts) == ts("2026-06-03 08:34:00")


def test_utc_wall_clock_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.sql("select timestamp '2026-06-03 10:00:00Z' as x")
        assert df.select(utc_wall_clock(F.col("x"))).first()[0] == ts("2026-06-03 10:00:00")
        assert one(spark, 1780475640000000, "bigint", micros_to_ts) == ts("2026-06-03 08:34:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_geo_label_is_null_without_both(spark):
    df = spark.createDataFrame([(46.2, 5.1), (46.2, None)], "a double, b double")
    assert [r[0] for r in df.select(geo_label(F.col("a"), F.col("b"))).collect()] == ["46.2, 5.1", None]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris", "America/New_York"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone):
    """Also in the hour that the session's zone repeats, and with microseconds."""
    import datetime as dt

    from pyspark.sql import functions as F

    from priceloom.functions import micros_to_ts, utc_instant, utc_wall_clock

    clocks = [dt.datetime(2026, 10, 25, 0, 30), dt.datetime(2026, 10, 25, 1, 0, 0, 123456), dt.datetime(2026, 3, 29, 1, 30),
              dt.datetime(2026, 11, 1, 6, 0), dt.datetime(1969, 12, 31, 23, 59, 59, 5)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(c,) for c in clocks], "c timestamp_ntz")
        instant = utc_instant(F.col("c"))
        found = rows.select("c", F.unix_micros(instant).alias("m"), utc_wall_clock(instant).alias("back"),
                            micros_to_ts(F.unix_micros(instant)).alias("again")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    epoch = dt.datetime(1970, 1, 1)
    for r in found:
        assert r["m"] == (r["c"] - epoch) // dt.timedelta(microseconds=1)
        assert r["back"] == r["again"] == r["c"]
