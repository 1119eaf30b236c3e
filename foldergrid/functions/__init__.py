"""Column expressions; all of them stay inside the JVM."""

from foldergrid.functions.addresses import (
    a1_cell,
    a1_rows,
    cell_column,
    cell_row,
    column_letters,
    column_number,
)
from foldergrid.functions.dates import (
    RANGE_KINDS,
    is_date_string,
    named_range,
    parse_date_string,
    range_of_kind,
)
from foldergrid.functions.serial import (
    COMPAT_DAY_MICROS,
    DAY_MICROS,
    date_to_serial,
    serial_to_date,
    serial_to_millis,
    serial_to_timestamp,
    time_to_serial,
    timestamp_to_serial,
)
from foldergrid.functions.text import option_list, random_name, utf8_text

__all__ = [
    "COMPAT_DAY_MICROS", "DAY_MICROS", "RANGE_KINDS",
    "a1_cell", "a1_rows", "cell_column", "cell_row", "column_letters", "column_number",
    "date_to_serial", "is_date_string", "named_range", "option_list", "parse_date_string",
    "random_name", "range_of_kind", "serial_to_date", "serial_to_millis",
    "serial_to_timestamp", "time_to_serial", "timestamp_to_serial", "utf8_text",
]
