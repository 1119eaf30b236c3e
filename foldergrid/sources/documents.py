"""Spreadsheet documents in JSON (properties, sheets, grid data, merges) -> tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldergrid.functions.cells import parse_cell
from foldergrid.model import CELL_VALUES, ROW_KEY

# Cells are declared as text, so that each keeps its raw JSON: an empty object is told apart
# from a cell that has only a format.
GRID_DDL = """
spreadsheetId string,
properties struct<title: string>,
sheets array<struct<
  properties: struct<sheetId: bigint, title: string, index: int,
                     gridProperties: struct<rowCount: bigint, columnCount: int>>,
  merges: array<struct<startRowIndex: bigint, endRowIndex: bigint, startColumnIndex: int, endColumnIndex: int>>,
  data: array<struct<startRow: bigint, startColumn: int, rowData: array<struct<values: array<string>>>>>
>>
"""

def read_documents(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Documents, one per line, or one per file."""
    return spark.read.schema(GRID_DDL).json(path, multiLine=whole_files)


def documents_from_text(df: DataFrame, column: str) -> DataFrame:
    """The same from a column of JSON text."""
    return df.select(F.from_json(F.col(column), GRID_DDL).alias("_d")).select("_d.*")


def _sheets(documents: DataFrame, *columns: Column) -> DataFrame:
    """One row per sheet; only the named parts of the nested sheet are read."""
    return documents.select(
        F.col("spreadsheetId").alias("spreadsheet_id"),
        F.col("properties.title").alias("spreadsheet_name"),
        F.explode("sheets").alias("_s"),
    ).select("spreadsheet_id", F.coalesce("_s.properties.sheetId", F.lit(0).cast("bigint")).alias("sheet_id"), *columns)


def sheets_of(documents: DataFrame) -> DataFrame:
    grid = "_s.properties.gridProperties"
    return _sheets(
        documents,
        F.col("spreadsheet_name"),
        F.coalesce("_s.properties.index", F.lit(0)).alias("sheet_index"),
        F.col("_s.properties.title").alias("sheet_title"),
        F.col(f"{grid}.rowCount").alias("row_count"),
        F.col(f"{grid}.columnCount").alias("col_count"),
    )


def merges_of(documents: DataFrame) -> DataFrame:
    zero, none = F.lit(0).cast("bigint"), F.lit(0)
    return _sheets(documents, F.explode("_s.merges").alias("_m")).select(
        "spreadsheet_id", "sheet_id",
        F.coalesce("_m.startRowIndex", zero).alias("start_row"), F.col("_m.endRowIndex").alias("end_row"),
        F.coalesce("_m.startColumnIndex", none).alias("start_col"), F.col("_m.endColumnIndex").alias("end_col"),
    )


def _grid_rows(documents: DataFrame) -> DataFrame:
    blocks = _sheets(documents, F.size("_s.data").alias("_blocks"), F.explode("_s.data").alias("_b"))
    rows = blocks.select(
        "spreadsheet_id", "sheet_id",
        F.coalesce("_b.startRow", F.lit(0).cast("bigint")).alias("_row"),
        F.coalesce("_b.startColumn", F.lit(0)).alias("_col"),
        F.posexplode("_b.rowData").alias("_pos", "_r"), "_blocks",
    )
    return rows.select(
        "spreadsheet_id", "sheet_id", (F.col("_row") + F.col("_pos")).alias("row_idx"), "_col", "_blocks",
        F.col("_r.values").alias("_values"),
    )


def cells_of(documents: DataFrame) -> DataFrame:
    """The long cells table."""
    return cells_of_rows(_grid_rows(documents))


def cells_of_rows(rows: DataFrame) -> DataFrame:
    """The same of grid rows (row key, `_col` of the first cell, `_values`)."""
    return (
        rows
        .select("spreadsheet_id", "sheet_id", "row_idx", "_col", F.posexplode("_values").alias("_pos", "_raw"))
        .where(F.col("_raw").isNotNull())
        .select(*ROW_KEY, (F.col("_col") + F.col("_pos")).alias("col_idx"), parse_cell(F.col("_raw")).alias("_cell"))
        .select(*ROW_KEY, "col_idx", *[F.col("_cell")[c].alias(c) for c in CELL_VALUES])
    )


def row_arrays_of(documents: DataFrame, one_block: bool = False) -> DataFrame:
    """One record per grid row with the raw `values` of its cells in column order: the form in
    which rows arrive, from which typed rows are built without a shuffle
    (`rows_from_arrays`).

    A block that starts further right is filled up with nulls. Only the sheets that come in
    several blocks are shuffled, to put the parts of a row together; with `one_block` there are
    none by the caller's word, and one found all the same fails the job.
    """
    rows = _grid_rows(documents)
    blank = F.array_repeat(F.lit(None).cast("string"), F.col("_col"))
    if one_block:
        several = F.raise_error(F.concat(F.lit("Several blocks in sheet "), "sheet_id", F.lit(" of "), "spreadsheet_id"))
        values = F.when(F.col("_blocks") == 1, F.concat(blank, "_values")).otherwise(several.cast("array<string>"))
        return rows.select(*ROW_KEY, values.alias("values"))
    whole = rows.where("_blocks = 1").select(*ROW_KEY, F.concat(blank, "_values").alias("values"))
    parts = rows.where("_blocks > 1").groupBy(*ROW_KEY).agg(F.array_sort(F.collect_list(F.struct("_col", "_values"))).alias("_parts"))
    empty = F.array().cast("array<string>")
    joined = F.aggregate(
        "_parts", empty,
        lambda done, part: F.concat(
            F.slice(done, 1, part["_col"]),
            F.array_repeat(F.lit(None).cast("string"), F.greatest(part["_col"] - F.size(done), F.lit(0))),
            F.coalesce(part["_values"], empty),
        ),
    )
    return whole.unionByName(parts.select(*ROW_KEY, joined.alias("values")))
