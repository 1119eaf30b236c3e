"""Turning long cells into typed rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldergrid.functions.cells import parse_cell
from foldergrid.functions.serial import serial_to_date, serial_to_millis, serial_to_timestamp
from foldergrid.model import CELL_VALUES, ROW_KEY, SHEET_KEY, SheetSourceOptions
from foldergrid.operators.headers import Header
from foldergrid.operators.merges import bucket_of, expanded

# Above this many columns one map per row replaces one aggregate per column: thousands of
# aggregate expressions would not compile into one method.
WIDE = 200

# which cell value a column of each type is read from
_SOURCE = {"date": "user_num", "timestamp": "user_num", "bigint": "user_num",
           "boolean": "eff_bool", "double": "eff_num", "string": "formatted"}


def typed(kind: str, source: Column, day_micros: int) -> Column:
    """A cell's source value as the column's type; a non-number in a dated column is null."""
    if kind == "date":
        return serial_to_date(source)
    if kind == "timestamp":
        return serial_to_timestamp(source, day_micros)
    if kind == "bigint":
        return serial_to_millis(source, day_micros)
    return source


def _leaves(headers: list[Header]) -> list[tuple[int, str]]:
    leaves = {}
    for header in headers:
        for col, _, kind in header.subs or ((header.col_index, header.title, header.kind),):
            leaves[(col, _SOURCE[kind])] = None
    return list(leaves)


def build_rows(
    cells: DataFrame,
    headers: list[Header],
    options: SheetSourceOptions,
    spine: DataFrame | None = None,
    fills: DataFrame | None = None,
    wide_above: int = WIDE,
) -> DataFrame:
    """One typed row per grid row: the row key, then a column per header.

    Cells, merge fills and the row spine are unioned and meet in a single aggregation on
    the row key, so there is one shuffle, no join per input, and rows without cells still
    come out when a spine is given. A fill outranks the cell it covers. Fills that come as
    blocks (`fill_blocks`) are shuffled as blocks, by the block of rows, and expanded
    in the task that builds those rows.
    """
    values = ["non_empty", *dict.fromkeys(source for _, source in _leaves(headers))]
    parts = [cells.select(*ROW_KEY, "col_idx", *values, F.lit(0).alias("_rank"))]
    blocks = fills if fills is not None and "n_rows" in fills.columns else None
    if fills is not None and blocks is None:
        parts.append(fills.select(*ROW_KEY, "col_idx", *values, F.lit(1).alias("_rank")))
    if spine is not None:
        kinds = dict(cells.dtypes)
        blank = [F.lit(None).cast(kinds[c]).alias(c) for c in values]
        parts.append(spine.select(*ROW_KEY, F.lit(-1).alias("col_idx"), *blank, F.lit(0).alias("_rank")))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)

    ranked = fills is not None
    leaves = _leaves(headers)
    keys = [*ROW_KEY]
    if blocks is not None:
        one = F.lit(1).cast("bigint")
        union = union.withColumns({"_bucket": bucket_of(F.col("row_idx")), "n_rows": one, "n_cols": F.lit(1)})
        union = union.unionByName(blocks.select(*ROW_KEY, "_bucket", "n_rows", "col_idx", "n_cols", *values, F.lit(1).alias("_rank")))
        # this shuffle serves the aggregation: a row key lies in one block
        union = expanded(union.repartition(*SHEET_KEY, "_bucket"))
        wanted = sorted({col for col, _ in leaves})
        union = union.where(F.col("col_idx").isin([-1, *wanted]) | (F.col("_rank") == 0))
        keys = [*SHEET_KEY, "_bucket", "row_idx"]
    if len(leaves) > wide_above:
        place = {col: i for i, col in enumerate(sorted({col for col, _ in leaves}))}
        built = _wide_rows(union, values, list(place), keys)
        pick = lambda col, source: F.get("_cells", F.lit(place[col]))[source]
    else:
        built = union.groupBy(*keys).agg(
            *[
                _cell_aggregate(col, source, ranked).alias(f"_{col}_{source}")
                for col, source in leaves
            ],
            F.count(F.when(F.col("non_empty"), True)).alias("_filled"),
        )
        pick = lambda col, source: (
            F.col(f"_{col}_{source}")["v"] if ranked else F.col(f"_{col}_{source}")
        )
    if options.skip_empty:
        built = built.where(F.col("_filled") > 0)
    return built.select(*ROW_KEY, *_header_columns(headers, pick, options.day_micros))


def _cell_aggregate(col: int, source: str, ranked: bool) -> Column:
    # one SQL text per column: a sheet may have many, and each Column call costs a round trip
    value = f"named_struct('r', _rank, 'v', {source})" if ranked else source
    return F.expr(f"max(CASE WHEN col_idx = {col} THEN {value} END)")


def _wide_rows(union: DataFrame, values: list[str], columns: list[int], keys: list[str]) -> DataFrame:
    """An array per row with the cell of each of `columns`, so that a column is read by its
    position. A row holds at most as many entries as the sheet has columns, twice that where
    fills cover cells.

    Every column asked for gets an entry without a cell, of the lowest rank; of the entries of
    a column, which the sort puts side by side, the last one stays.
    """
    kind = ", ".join(f"{v}: {union.schema[v].dataType.simpleString()}" for v in values)
    entry = F.struct("col_idx", "_rank", F.struct(*values).alias("cell"))
    blank = F.transform(
        F.lit(columns), lambda c: F.struct(c.alias("col_idx"), F.lit(-1).alias("_rank"), F.lit(None).cast(f"struct<{kind}>").alias("cell"))
    )
    wanted = F.col("col_idx").isin(columns) if len(columns) < max(columns) - min(columns) + 1 else F.col("col_idx").between(min(columns), max(columns))
    entries = F.collect_list(F.when(wanted, entry))
    last = F.filter(
        F.col("_list"),
        lambda e, i: F.coalesce(F.get(F.col("_list"), i + 1)["col_idx"], F.lit(-1)) != e["col_idx"],
    )
    return (
        union.groupBy(*keys)
        .agg(entries.alias("_found"), F.count(F.when(F.col("non_empty"), True)).alias("_filled"))
        .select(*ROW_KEY, "_filled", F.array_sort(F.concat("_found", blank)).alias("_list"))
        .select(*ROW_KEY, "_filled", F.transform(last, lambda e: e["cell"]).alias("_cells"))
    )


def _header_columns(headers: list[Header], pick, day_micros: int) -> list[Column]:
    columns = []
    for header in headers:
        if header.subs:
            parts = [typed(kind, pick(col, _SOURCE[kind]), day_micros).alias(name) for col, name, kind in header.subs]
            columns.append(F.struct(*parts).alias(header.title))
        else:
            source = _SOURCE[header.kind]
            columns.append(typed(header.kind, pick(header.col_index, source), day_micros).alias(header.title))
    return columns


def rows_from_arrays(
    grid: DataFrame,
    headers: list[Header],
    options: SheetSourceOptions,
    fills: DataFrame | None = None,
    spine: DataFrame | None = None,
) -> DataFrame:
    """Like `build_rows`, for rows that still hold the raw cells of a document as an array
    in column order (`values`).

    A row that arrives whole needs no shuffle at all, and only the cells of resolved columns
    are parsed. When ranges are merged or empty rows are wanted, the cells join the one
    aggregation of `build_rows`.
    """
    columns = sorted({col for header in headers for col in header.columns})
    if fills is None and spine is None:
        parsed = grid.select(
            *ROW_KEY, *[parse_cell(F.get("values", F.lit(col))).alias(f"_{col}") for col in columns]
        )
        if options.skip_empty:
            filled = [F.coalesce(F.col(f"_{col}")["non_empty"], F.lit(False)) for col in columns]
            parsed = parsed.where(reduce(or_, filled))
        pick = lambda col, source: F.col(f"_{col}")[source]
        return parsed.select(*ROW_KEY, *_header_columns(headers, pick, options.day_micros))
    long = (
        grid.select(*ROW_KEY, F.posexplode("values").alias("col_idx", "_raw"))
        .where(F.col("_raw").isNotNull() & F.col("col_idx").isin(columns))
        .select(*ROW_KEY, "col_idx", parse_cell(F.col("_raw")).alias("_cell"))
        .select(*ROW_KEY, "col_idx", *[F.col("_cell")[c].alias(c) for c in CELL_VALUES])
    )
    return build_rows(long, headers, options, spine, fills)
