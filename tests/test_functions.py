from datetime import date, datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foldergrid.functions import (
    COMPAT_DAY_MICROS,
    RANGE_KINDS,
    a1_cell,
    a1_rows,
    cell_column,
    cell_row,
    column_letters,
    column_number,
    date_to_serial,
    is_date_string,
    named_range,
    range_of_kind,
    serial_to_date,
    serial_to_millis,
    serial_to_timestamp,
    time_to_serial,
    timestamp_to_serial,
    utf8_text,
)
from foldergrid.functions.addresses import parse_address
from foldergrid.functions.text import random_name


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_column_letters_both_ways(spark):
    pairs = [(1, "A"), (26, "Z"), (27, "AA"), (46, "AT"), (52, "AZ"), (702, "ZZ"), (703, "AAA"), (18278, "ZZZ"), (18279, "AAAA")]
    df = spark.createDataFrame(pairs, "n int, s string")
    for row in df.select("n", "s", column_letters("n").alias("l"), column_number("s").alias("m")).collect():
        assert (row.l, row.m) == (row.s, row.n)


def test_letters_round_trip(spark):
    df = spark.range(1, 500_000, 7)
    assert df.where(column_number(column_letters(F.col("id"))) != F.col("id")).count() == 0


def test_cell_addresses(spark):
    data = [("A1", 1, 1), ("Z100", 100, 26), ("AZ100", 100, 52), ("1A", None, None), ("a1", None, None)]
    df = spark.createDataFrame(data, "a string, r int, c int")
    for row in df.select("*", cell_row("a").alias("row"), cell_column("a").alias("col")).collect():
        assert (row.row, row.col) == (row.r, row.c)
    assert parse_address("AZ100") == (100, 52)
    with pytest.raises(ValueError):
        parse_address("1A")


def test_range_text(spark):
    row = one(spark, a1_rows(F.lit("t"), F.lit(3), F.lit(9)), a1_cell(F.lit("t"), F.lit(28), F.lit(3)))
    assert tuple(row) == ("t!3:9", "t!AB3:AB3")


def test_serial_codecs(spark):
    ts = F.lit("1991-03-08 13:54:20").cast("timestamp")
    micros = F.lit((13 * 3600 + 54 * 60 + 20) * 1_000_000)
    for day in (86_400_000_000, COMPAT_DAY_MICROS):
        row = one(spark, date_to_serial(F.lit(date(2020, 1, 11))), timestamp_to_serial(ts, day), time_to_serial(micros, day))
        assert row[0] == 43841.0
        assert abs(row[1] - 33305.57939814815) < 1e-11
        assert abs(row[2] - 0.57939814815) < 1e-11


def test_serial_decode(spark):
    row = one(
        spark, serial_to_date(F.lit(43841.9)).cast("string"), serial_to_timestamp(F.lit(43841.5)).cast("string"),
        serial_to_timestamp(F.lit(43841.5), COMPAT_DAY_MICROS).cast("string"), serial_to_millis(F.lit(1.25)),
        serial_to_date(F.lit(-0.5)).cast("string"),
    )
    assert tuple(row) == ("2020-01-11", "2020-01-11 12:00:00", "2020-01-11 11:59:59.956", 108_000_000, "1899-12-30")


def test_timestamp_codec_is_identity_on_millis(spark):
    # -100,000 days to +100,000 days in uneven steps
    df = spark.range(0, 200_000).select(
        F.timestamp_millis((F.col("id") - 100_000) * 86_399_987 + F.col("id") % 1009).alias("ts")
    )
    assert df.where(serial_to_timestamp(timestamp_to_serial(F.col("ts"))) != F.col("ts")).count() == 0


# (kind, start day, end) at 2019-09-19T19:52:13.456+02:00, a Thursday; None is "now"
RANGES = [
    ("today", "2019-09-19", None), ("yesterday", "2019-09-18", "2019-09-18"),
    ("this_week_sun_today", "2019-09-15", None), ("this_week_mon_today", "2019-09-16", None),
    ("last_week_sun_sat", "2019-09-08", "2019-09-14"), ("last_week_mon_sun", "2019-09-09", "2019-09-15"),
    ("this_month", "2019-09-01", None), ("last_month", "2019-08-01", "2019-08-31"),
    ("this_quarter", "2019-07-01", None), ("last_3d", "2019-09-16", "2019-09-18"),
    ("last_7d", "2019-09-12", "2019-09-18"), ("last_14d", "2019-09-05", "2019-09-18"),
    ("last_28d", "2019-08-22", "2019-09-18"), ("last_30d", "2019-08-20", "2019-09-18"),
    ("last_90d", "2019-06-21", "2019-09-18"), ("this_year", "2019-01-01", None),
    ("last_year", "2018-01-01", "2018-12-31"),
]


def test_named_ranges(spark):
    spark.conf.set("spark.sql.session.timeZone", "+02:00")
    try:
        now = F.lit("2019-09-19T19:52:13.456+02:00").cast("timestamp")
        kinds = spark.createDataFrame([(k,) for k in RANGE_KINDS], "kind string")
        fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
        bounds = kinds.withColumn("r", range_of_kind(F.col("kind"), now)).select(
            "kind", F.date_format("r.start", fmt).alias("a"), F.date_format("r.end", fmt).alias("b")
        )
        got = {row.kind: (row.a, row.b) for row in bounds.collect()}
        for kind, start, end in RANGES:
            last = "2019-09-19T19:52:13.456+02:00" if end is None else f"{end}T23:59:59.999+02:00"
            assert got[kind] == (f"{start}T00:00:00.000+02:00", last), kind
            literal = one(spark, *[F.date_format(c, fmt) for c in named_range(kind, now)])
            assert tuple(literal) == got[kind]
        assert got["lifetime"] == got["custom"] == (None, None)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert named_range("custom", now, "a", "b") == ("a", "b")
    with pytest.raises(ValueError):
        named_range("last_4d", now)


def test_date_strings(spark):
    good = ["2012-06-04", "2012-06-04T19:45:45", "2012-06-04T19:45:45.456", "2012-06-04T12:00:00-08:00"]
    bad = ["2012-06-04T05:45:013.070", "2012-13-04", "2012-06-04\n", "x2012-06-04"]
    df = spark.createDataFrame([(s,) for s in good + bad], "s string").select(is_date_string(F.col("s")).alias("v"))
    assert [r.v for r in df.collect()] == [True] * len(good) + [False] * len(bad)


def test_cut_characters_become_replacement_characters(spark):
    body = F.lit("é€".encode()[:4])  # a whole é and two of three bytes of €
    assert one(spark, utf8_text(body))[0] == "é�"


def test_random_names(spark):
    names = [r[0] for r in spark.range(500).select(random_name()).collect()]
    assert len(set(names)) == 500
    assert all(len(n) == 16 and n.isalnum() and n.isascii() for n in names)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.datetimes(min_value=datetime(1800, 1, 1), max_value=datetime(2300, 1, 1)))
def test_dates_round_trip(spark, moment):
    day = F.lit(moment.replace(tzinfo=timezone.utc).date())
    assert one(spark, serial_to_date(date_to_serial(day)) == day)[0]
