"""Addresses, serial numbers, date strings and named ranges over columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
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
    option_list,
    parse_date_string,
    range_of_kind,
    serial_to_date,
    serial_to_millis,
    serial_to_timestamp,
    time_to_serial,
    timestamp_to_serial,
)
from workload.tables import table

_LETTERS_SQL = """
(CASE WHEN n > 18278 THEN chr((65 + ((n - 18279) // 17576) % 26)::INT) ELSE '' END ||
 CASE WHEN n > 702 THEN chr((65 + ((n - 703) // 676) % 26)::INT) ELSE '' END ||
 CASE WHEN n > 26 THEN chr((65 + ((n - 27) // 26) % 26)::INT) ELSE '' END ||
 chr((65 + (n - 1) % 26)::INT))
"""


def column_letter_codec(spark, sf_dir) -> DataFrame:
    n = F.col("p_partkey") + 1
    return table(spark, sf_dir, "part").select(n.alias("n"), column_letters(n).alias("letters")).withColumn(
        "back", column_number("letters").cast("bigint")
    )


COLUMN_LETTERS = f"SELECT n, {_LETTERS_SQL} AS letters, n AS back FROM (SELECT p_partkey + 1 AS n FROM part)"


def cell_address(spark, sf_dir) -> DataFrame:
    """Every customer is an address; those of one segment are malformed (row first)."""
    letters, row = column_letters(F.col("c_custkey") + 1), (F.col("c_nationkey") + 1).cast("string")
    address = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(row, letters)).otherwise(F.concat(letters, row))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", address.alias("address"), cell_row(address).alias("row"),
        cell_column(address).cast("bigint").alias("col"),
        a1_cell(F.col("c_mktsegment"), F.col("c_custkey") + 1, F.col("c_nationkey") + 1).alias("cell_range"),
        a1_rows(F.col("c_mktsegment"), F.col("c_nationkey") + 1, F.col("c_custkey") + 100).alias("row_range"),
    )


CELL_ADDRESS = f"""
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN (c_nationkey + 1) || {_LETTERS_SQL}
            ELSE {_LETTERS_SQL} || (c_nationkey + 1) END AS address,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey + 1 END AS "row",
       CASE WHEN c_mktsegment <> 'BUILDING' THEN n END AS col,
       c_mktsegment || '!' || {_LETTERS_SQL} || (c_nationkey + 1) || ':' || {_LETTERS_SQL} || (c_nationkey + 1) AS cell_range,
       c_mktsegment || '!' || (c_nationkey + 1) || ':' || (c_custkey + 100) AS row_range
FROM (SELECT *, c_custkey + 1 AS n FROM customer)
"""


def serial_date_codec(spark, sf_dir) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    serial = date_to_serial(day)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", serial.alias("serial"),
        F.date_format(serial_to_date(serial + 0.75), "yyyy-MM-dd").alias("back"),
    )


SERIAL_DATE_CODEC = """
SELECT o_orderkey, datediff('day', DATE '1899-12-30', o_orderdate::DATE)::DOUBLE AS serial,
       strftime(o_orderdate::DATE, '%Y-%m-%d') AS back FROM orders
"""


def serial_ts_codec(spark, sf_dir) -> DataFrame:
    serial = timestamp_to_serial(F.date_trunc("MILLISECOND", "ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", serial.alias("serial"), F.unix_millis(serial_to_timestamp(serial)).alias("back_ms"),
    )


SERIAL_TS_CODEC = """
SELECT event_id,
       datediff('day', DATE '1899-12-30', ts::DATE)::DOUBLE
         + (epoch_us(ts) // 1000 * 1000 % 86400000000)::DOUBLE / 86400000000.0::DOUBLE AS serial,
       epoch_us(ts) // 1000 AS back_ms
FROM events
"""


def serial_ts_compat(spark, sf_dir) -> DataFrame:
    """Serial numbers decoded with the short day: whole days lose a microsecond each."""
    serial = date_to_serial(F.col("l_shipdate").cast("date")) + F.col("l_linenumber") / F.lit(8)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.unix_millis(serial_to_timestamp(serial, COMPAT_DAY_MICROS)).alias("ms"),
        serial_to_millis(F.col("l_linenumber") / F.lit(8), COMPAT_DAY_MICROS).alias("clock_ms"),
    )


SERIAL_TS_COMPAT = """
WITH s AS (
  SELECT *, datediff('day', DATE '1899-12-30', l_shipdate::DATE)::DOUBLE + l_linenumber / 8.0::DOUBLE AS serial FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       (trunc(serial * 86399999999.0::DOUBLE)::BIGINT - 2209161600000000) // 1000 AS ms,
       trunc(l_linenumber / 8.0::DOUBLE * 86399999999.0::DOUBLE / 1000.0::DOUBLE)::BIGINT AS clock_ms
FROM s
"""


def serial_time_codec(spark, sf_dir) -> DataFrame:
    of_day = F.pmod(F.unix_millis(F.col("ts").cast("timestamp")), F.lit(86_400_000)) * 1000
    serial = time_to_serial(of_day)
    return table(spark, sf_dir, "events").select(
        "event_id", serial.alias("serial"), serial_to_millis(serial).alias("millis"),
        serial_to_millis(serial + 2).alias("millis_two_days_on"),
    )


SERIAL_TIME_CODEC = """
WITH s AS (SELECT event_id, epoch_us(ts) // 1000 % 86400000 AS ms FROM events)
SELECT event_id, (ms * 1000)::DOUBLE / 86400000000.0::DOUBLE AS serial, ms AS millis,
       ms + 172800000 AS millis_two_days_on FROM s
"""


def date_string_validity(spark, sf_dir) -> DataFrame:
    """Each event's time in a form that depends on its type; two forms are not valid."""
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_type")
    text = (
        F.when(kind == "click", F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == "view", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(kind == "purchase", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .when(kind == "signup", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:0ss"))
        .otherwise(F.date_format(ts, "yyyy/MM/dd"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", text.alias("text"), is_date_string(text).alias("valid"),
        F.unix_millis(parse_date_string(text)).alias("ms"),
    )


DATE_STRING_VALIDITY = """
WITH s AS (
  SELECT event_id, event_type, ts,
    CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%d') WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')
      WHEN 'purchase' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00') WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:0%S')
      ELSE strftime(ts, '%Y/%m/%d') END AS text
  FROM events)
SELECT event_id, text, event_type IN ('click', 'view', 'purchase') AS valid,
       CASE event_type WHEN 'click' THEN epoch_us(date_trunc('day', ts)) // 1000 WHEN 'view' THEN epoch_us(ts) // 1000
         WHEN 'purchase' THEN epoch_us(date_trunc('second', ts)) // 1000 - 7200000 END AS ms
FROM s
"""

_KINDS = [k for k in RANGE_KINDS if k != "custom"]


def range_bounds_by_row(spark, sf_dir) -> DataFrame:
    """A different range name and a different "now" in every row."""
    kind = F.element_at(F.lit(_KINDS), (F.col("user_id") % len(_KINDS) + 1).cast("int"))
    # spread the moments over years, so that months, quarters and leap days are all met
    moment = F.col("ts").cast("timestamp") + F.make_dt_interval((F.col("event_id") % 2000).cast("int"))
    bounds = range_of_kind(F.col("kind"), F.col("moment"))
    return (
        table(spark, sf_dir, "events")
        .select("event_id", kind.alias("kind"), moment.alias("moment"))
        .withColumn("bounds", bounds)
        .select(
            "event_id", "kind", F.unix_millis("bounds.start").alias("start_ms"), F.unix_millis("bounds.end").alias("end_ms")
        )
    )


RANGE_BOUNDS_BY_ROW = f"""
WITH m AS (
  SELECT event_id, ([{", ".join(repr(k) for k in _KINDS)}])[user_id % {len(_KINDS)} + 1] AS kind,
         ts + to_days((event_id % 2000)::INT) AS n FROM events),
d AS (SELECT *, date_trunc('day', n) AS t, dayofweek(n) AS w FROM m)
SELECT event_id, kind,
  epoch_us(CASE kind WHEN 'today' THEN t WHEN 'yesterday' THEN t - to_days(1)
    WHEN 'this_week_sun_today' THEN t - to_days(w::INT) WHEN 'this_week_mon_today' THEN t - to_days(((w + 6) % 7)::INT)
    WHEN 'last_week_sun_sat' THEN t - to_days((w + 1)::INT) - to_days(6)
    WHEN 'last_week_mon_sun' THEN t - to_days(CASE WHEN w = 0 THEN 7 ELSE w::INT END) - to_days(6)
    WHEN 'this_month' THEN date_trunc('month', n) WHEN 'last_month' THEN date_trunc('month', n) - to_months(1)
    WHEN 'this_quarter' THEN date_trunc('quarter', n) WHEN 'this_year' THEN date_trunc('year', n)
    WHEN 'last_year' THEN date_trunc('year', n) - to_years(1) WHEN 'lifetime' THEN NULL
    ELSE t - to_days(replace(replace(CASE WHEN kind LIKE 'last\\___d' ESCAPE '\\' OR kind LIKE 'last\\__d' ESCAPE '\\' THEN kind ELSE 'last_0d' END, 'last_', ''), 'd', '')::INT) END::TIMESTAMP) // 1000 AS start_ms,
  epoch_us(CASE kind WHEN 'yesterday' THEN t - to_milliseconds(1)
    WHEN 'last_week_sun_sat' THEN t - to_days((w + 1)::INT) + to_days(1) - to_milliseconds(1)
    WHEN 'last_week_mon_sun' THEN t - to_days(CASE WHEN w = 0 THEN 7 ELSE w::INT END) + to_days(1) - to_milliseconds(1)
    WHEN 'last_month' THEN date_trunc('month', n) - to_milliseconds(1)
    WHEN 'last_year' THEN date_trunc('year', n) - to_milliseconds(1)
    WHEN 'lifetime' THEN NULL
    ELSE CASE WHEN kind LIKE 'last%' THEN t - to_milliseconds(1) ELSE n END END::TIMESTAMP) // 1000 AS end_ms
FROM d
"""


def option_lists(spark, sf_dir) -> DataFrame:
    """Comma lists made of the customers' fields; one segment has none."""
    text = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(
        F.concat_ws(",", "c_name", "c_mktsegment", F.col("c_nationkey").cast("string"))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", F.posexplode(option_list(text)).alias("pos", "item"))


OPTION_LISTS = """
SELECT c_custkey, unnest([0, 1, 2])::INT AS pos, unnest([c_name, c_mktsegment, c_nationkey::VARCHAR]) AS item
FROM customer WHERE c_mktsegment <> 'BUILDING'
"""

QUERIES = {
    "column_letters": (column_letter_codec, COLUMN_LETTERS),
    "cell_address": (cell_address, CELL_ADDRESS),
    "serial_date_codec": (serial_date_codec, SERIAL_DATE_CODEC),
    "serial_ts_codec": (serial_ts_codec, SERIAL_TS_CODEC),
    "serial_ts_compat": (serial_ts_compat, SERIAL_TS_COMPAT),
    "serial_time_codec": (serial_time_codec, SERIAL_TIME_CODEC),
    "date_string_validity": (date_string_validity, DATE_STRING_VALIDITY),
    "range_bounds_by_row": (range_bounds_by_row, RANGE_BOUNDS_BY_ROW),
    "option_lists": (option_lists, OPTION_LISTS),
}
