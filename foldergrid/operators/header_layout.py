"""Header rows and header merges of a schema; schema-sized, so built on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldergrid.operators.flatten import TARGET


def _children(kind: T.DataType) -> list[T.StructField]:
    return kind.fields if isinstance(kind, T.StructType) else []


def width(kind: T.DataType) -> int:
    """Number of leaf columns."""
    return sum(width(f.dataType) for f in _children(kind)) or 1


def depth(kind: T.DataType) -> int:
    """Levels of names below this one: 0 for a leaf."""
    return max((1 + depth(f.dataType) for f in _children(kind)), default=0)


def _placed(schema: T.StructType, level: int = 0, left: int = 0):
    """(name, level, left-most column, type) of every header."""
    for field in schema.fields:
        yield field.name, level, left, field.dataType
        if _children(field.dataType):
            yield from _placed(field.dataType, level + 1, left)
        left += width(field.dataType)


def header_cells(schema: T.StructType) -> list[tuple[int, int, str]]:
    """(row, column, name); a name stands at the left-most of its leaves."""
    return [(level, left, name) for name, level, left, _ in _placed(schema)]


def header_ranges(schema: T.StructType) -> list[tuple[int, int, int, int]]:
    """(start_row, end_row, start_col, end_col): a group runs across its leaves, a leaf above
    the bottom runs down to it. Ranges of one cell are left out."""
    rows = depth(schema)
    if rows <= 1:
        return []
    ranges = []
    for _, level, left, kind in _placed(schema):
        if _children(kind):
            ranges.append((level, level + 1, left, left + width(kind)))
        else:
            ranges.append((level, rows, left, left + 1))
    return [r for r in ranges if (r[1] - r[0]) * (r[3] - r[2]) > 1]


def header_rows_of(sheets: DataFrame, schema: T.StructType) -> DataFrame:
    """Header cells of every target sheet: the literal list exploded per sheet row."""
    cells = [
        F.struct(F.lit(r).cast("bigint").alias("row_idx"), F.lit(c).alias("col_idx"), F.lit(n).alias("user_str"))
        for r, c, n in header_cells(schema)
    ]
    return sheets.select(*TARGET, F.inline(F.array(*cells)))


def header_merges_of(sheets: DataFrame, schema: T.StructType) -> DataFrame:
    """Header merges of every target sheet."""
    ranges = header_ranges(schema)
    if not ranges:
        empty = F.expr(
            "CAST(array() AS array<struct<start_row: bigint, end_row: bigint, start_col: int, end_col: int>>)"
        )
        return sheets.select(*TARGET, F.inline(empty))
    structs = [
        F.struct(
            F.lit(a).cast("bigint").alias("start_row"), F.lit(b).cast("bigint").alias("end_row"),
            F.lit(c).alias("start_col"), F.lit(d).alias("end_col"),
        )
        for a, b, c, d in ranges
    ]
    return sheets.select(*TARGET, F.inline(F.array(*structs)))
