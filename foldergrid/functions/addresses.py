"""Spreadsheet column letters and A1 addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Columns are numbered by an int, which six letters do not pass: the one rule for options and data.
_MAX_LETTERS = 6

# Fixed value: a cell address is capital letters followed by a row number.
CELL_ADDRESS = r"^([A-Z]{1,6})([0-9]+)\z"


def column_number(letters: Column | str) -> Column:
    """'A' -> 1, 'Z' -> 26, 'AT' -> 46; null for more than six letters.

    '@' precedes 'A' in ASCII, so left padding with it adds zero digits and the
    base-26 value is a plain sum without a higher-order function.
    """
    letters = F.col(letters) if isinstance(letters, str) else letters
    padded = F.lpad(letters, _MAX_LETTERS, "@")
    value = F.lit(0)
    for place in range(_MAX_LETTERS):
        digit = F.ascii(F.substring(padded, place + 1, 1)) - F.lit(64)
        value = value + digit * F.lit(26 ** (_MAX_LETTERS - 1 - place))
    return F.when(F.length(letters).between(1, _MAX_LETTERS), value)


def column_letters(number: Column | str) -> Column:
    """1 -> 'A', 27 -> 'AA', 46 -> 'AT'; null below 1 and above six letters.

    Names of one length are consecutive, so a name is the base-26 value of the number less
    the first number of its length, with letters for digits.
    """
    number = F.col(number) if isinstance(number, str) else number
    first, length, start = F.lit(None), F.lit(None), 1
    starts = []
    for size in range(1, _MAX_LETTERS + 1):
        starts.append(start)
        start += 26**size
    for size, begin in enumerate(starts, 1):
        first = F.when(number >= begin, F.lit(begin).cast("bigint")).otherwise(first)
        length = F.when(number >= begin, F.lit(size)).otherwise(length)
    digits = F.lpad(F.conv((number - first).cast("string"), 10, 26), length, "0")
    return F.when(
        number.between(1, start - 1), F.translate(digits, "0123456789ABCDEFGHIJKLMNOP", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    )


def cell_row(address: Column | str) -> Column:
    """Row number (1-based) of an address such as 'AZ100'; null when malformed."""
    address = F.col(address) if isinstance(address, str) else address
    return F.when(address.rlike(CELL_ADDRESS), F.regexp_extract(address, CELL_ADDRESS, 2).try_cast("int"))


def cell_column(address: Column | str) -> Column:
    """Column number (1-based) of an address such as 'AZ100'; null when malformed."""
    address = F.col(address) if isinstance(address, str) else address
    return F.when(address.rlike(CELL_ADDRESS), column_number(F.regexp_extract(address, CELL_ADDRESS, 1)))


def a1_rows(title: Column, first_row: Column, last_row: Column) -> Column:
    """Whole-row range text: title!first:last (1-based rows)."""
    return F.concat(title, F.lit("!"), first_row.cast("string"), F.lit(":"), last_row.cast("string"))


def a1_cell(title: Column, column: Column, row: Column) -> Column:
    """Single-cell range text: title!B3:B3 (1-based column and row)."""
    cell = F.concat(column_letters(column), row.cast("string"))
    return F.concat(title, F.lit("!"), cell, F.lit(":"), cell)


def parse_address(text: str) -> tuple[int, int]:
    """(row, column), both 1-based, of an address given as an option."""
    import re

    match = re.fullmatch(r"([A-Z]{1,6})([0-9]+)", text)
    if not match:
        raise ValueError(f"'{text}' is no cell address: up to six capital letters and a row number.")
    column = 0
    for letter in match.group(1):
        column = column * 26 + ord(letter) - 64
    return int(match.group(2)), column
