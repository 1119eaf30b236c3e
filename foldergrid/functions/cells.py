"""Cells of spreadsheet documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foldergrid.model import CELL_STRUCT

_CELL_DDL = """struct<
  formattedValue: string,
  effectiveValue: struct<numberValue: double, boolValue: boolean, stringValue: string>,
  userEnteredValue: struct<numberValue: double, stringValue: string, boolValue: boolean, formulaValue: string>,
  userEnteredFormat: struct<numberFormat: struct<type: string>>>"""


def parse_cell(raw: Column) -> Column:
    """A cell's raw JSON as the values of the cells table."""
    # an explicit option keeps the optimizer from splitting this into one parse per field
    cell = F.from_json(raw, _CELL_DDL, {"mode": "PERMISSIVE"})
    return F.struct(
        cell["formattedValue"].alias("formatted"),
        cell["effectiveValue"]["numberValue"].alias("eff_num"),
        cell["effectiveValue"]["boolValue"].alias("eff_bool"),
        cell["userEnteredValue"]["numberValue"].alias("user_num"),
        cell["userEnteredValue"]["stringValue"].alias("user_str"),
        cell["userEnteredValue"]["boolValue"].alias("user_bool"),
        cell["userEnteredValue"]["formulaValue"].alias("user_formula"),
        cell["userEnteredFormat"]["numberFormat"]["type"].alias("num_format"),
        (F.regexp_replace(raw, r"\s", "") != "{}").alias("non_empty"),
    ).cast(CELL_STRUCT)


