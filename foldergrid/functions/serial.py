"""Spreadsheet serial numbers: days since 1899-12-30, with the time of day as a fraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day zero of a serial number.
EPOCH = "1899-12-30"

DAY_MICROS = 86_400_000_000
# The last microsecond of a day used as the length of a day. Serial numbers made
# that way are up to a microsecond off; pass it to read or write the same values.
COMPAT_DAY_MICROS = 86_399_999_999

_EPOCH_MICROS = 25_569 * DAY_MICROS  # from day zero to 1970-01-01
_FIRST_DAY, _LAST_DAY = -693_593, 2_958_465  # 0001-01-01 and 9999-12-31


def _dated(serial: Column, value: Column) -> Column:
    """Null for what no date of four digits can hold (and for a number that is none)."""
    return F.when((serial >= _FIRST_DAY) & (serial < _LAST_DAY + 1), value)


def date_to_serial(date: Column) -> Column:
    return F.datediff(date, F.lit(EPOCH).cast("date")).cast("double")


def serial_to_date(serial: Column) -> Column:
    """The fraction is dropped towards zero."""
    return _dated(serial, F.date_add(F.lit(EPOCH).cast("date"), serial.try_cast("int")))


def timestamp_to_serial(ts: Column, day_micros: int = DAY_MICROS) -> Column:
    """Whole days plus the UTC time of day as a fraction of `day_micros`."""
    micros = F.unix_micros(ts.cast("timestamp")) + F.lit(_EPOCH_MICROS)
    of_day = F.pmod(micros, F.lit(DAY_MICROS))
    days = F.floor((micros - of_day) / F.lit(DAY_MICROS))
    return days.cast("double") + of_day.cast("double") / F.lit(float(day_micros))


def serial_to_timestamp(serial: Column, day_micros: int = DAY_MICROS) -> Column:
    """Timestamp at millisecond precision.

    A serial number near today resolves about a microsecond, so the exact day
    length rounds to the millisecond that was encoded; the compat day length cuts.
    """
    if day_micros == DAY_MICROS:
        millis = F.round(_dated(serial, serial) * F.lit(day_micros / 1000.0)).cast("bigint")
        return F.timestamp_millis(millis - F.lit(_EPOCH_MICROS // 1000))
    micros = (_dated(serial, serial) * F.lit(float(day_micros))).cast("bigint") - F.lit(_EPOCH_MICROS)
    return F.date_trunc("MILLISECOND", F.timestamp_micros(micros))


def time_to_serial(micros_of_day: Column, day_micros: int = DAY_MICROS) -> Column:
    return micros_of_day.cast("double") / F.lit(float(day_micros))


def serial_to_millis(serial: Column, day_micros: int = DAY_MICROS) -> Column:
    """Milliseconds of a time cell; durations beyond a day stay beyond a day."""
    millis = serial * F.lit(float(day_micros)) / F.lit(1000.0)
    return (F.round(millis) if day_micros == DAY_MICROS else millis).try_cast("bigint")
