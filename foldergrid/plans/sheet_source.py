"""Spreadsheets -> typed rows."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from foldergrid.model import MERGES_DDL, ROW_KEY, SHEET_KEY, FileSourceOptions, SheetSourceOptions
from foldergrid.operators.catalogue import select_files
from foldergrid.operators.headers import (
    Header,
    default_headers,
    first_sheet,
    header_list,
    invalid_header_merges,
    resolve_headers,
)
from foldergrid.operators.lookup import lookup_join
from foldergrid.operators.merges import clip_merges, fill_blocks
from foldergrid.operators.rows import build_rows, rows_from_arrays
from foldergrid.operators.selection import data_cells, row_spine, select_sheets
from foldergrid.operators.sheetmeta import metadata_problems, section_problems, sheet_metadata
from foldergrid.sources.documents import cells_of, merges_of, row_arrays_of, sheets_of


def infer_headers(
    sheets: DataFrame, cells: DataFrame, merges: DataFrame, options: SheetSourceOptions
) -> list[Header]:
    """Headers of the first selected sheet, which give all rows their schema.

    Only that sheet's header and sample rows are read, and only they reach the driver.
    """
    sheet = first_sheet(select_sheets(sheets, options))
    if sheet is None:
        return []
    here = (F.col("spreadsheet_id") == F.lit(sheet["spreadsheet_id"])) & (F.col("sheet_id") == F.lit(sheet["sheet_id"]))
    if not options.has_names:
        return header_list(default_headers(cells.where(here), options, sheets.where(here)), sheet)
    if invalid_header_merges(merges.where(here), options).limit(1).collect():
        raise ValueError(f"A range that starts above row {options.header_row} reaches into the column names.")
    headers = header_list(resolve_headers(cells.where(here), merges.where(here), options), sheet)
    if not headers:
        raise ValueError(f"Row {options.header_row} of sheet {sheet} has no column names.")
    return headers


def read_sheets(
    sheets: DataFrame,
    cells: DataFrame,
    options: SheetSourceOptions,
    merges: DataFrame | None = None,
    headers: list[Header] | None = None,
    progress: Observation | None = None,
    keep_keys: bool = False,
) -> DataFrame:
    """Typed rows of every selected sheet.

    Give `headers` to skip the inference. `progress` observes the number of rows read.
    """
    problems = metadata_problems(options)
    if problems:
        raise ValueError(" ".join(problems))
    if headers is None:
        no_merges = merges if merges is not None else _no_merges(cells)
        headers = infer_headers(sheets, cells, no_merges, options)
    header_rows = 2 if any(h.subs for h in headers) else 1
    problems = section_problems(options, header_rows) if options.extract_metadata else []
    if options.extract_metadata and options.metadata_field in [h.title for h in headers]:
        problems.append(f"The metadata column would be called '{options.metadata_field}' like a column of the sheet.")
    if problems:
        raise ValueError(" ".join(problems))

    columns = sorted({col for header in headers for col in header.columns})
    wanted = select_sheets(sheets, options)
    source = cells
    if options.sheets_to_pull != "all":
        source = lookup_join(cells, wanted.select(*SHEET_KEY), SHEET_KEY, ["row_idx"], "left_semi", written=False)
    data = data_cells(source, options, header_rows, columns)
    fills = None
    if merges is not None:
        clipped = clip_merges(merges, options, header_rows, columns)
        if options.sheets_to_pull != "all":
            clipped = clipped.join(wanted.select(*SHEET_KEY), SHEET_KEY, "left_semi")
        fills = fill_blocks(source, clipped)
    spine = None if options.skip_empty else row_spine(wanted, options, header_rows)
    rows = build_rows(data, headers, options, spine, fills)
    rows = add_sheet_fields(rows, wanted, cells, options)
    if progress is not None:
        rows = rows.observe(progress, F.count(F.lit(1)).alias("rows"))
    names = [options.spreadsheet_field, options.sheet_field] if options.add_names else []
    tail = [options.metadata_field] if options.extract_metadata else []
    keys = ROW_KEY if keep_keys else []
    return rows.select(*keys, *names, *[f"`{h.title}`" for h in headers], *tail)


def documents_in_folder(
    documents: DataFrame, files: DataFrame, options: FileSourceOptions, now: Column | None = None
) -> DataFrame:
    """The spreadsheet documents whose files pass the catalogue's filters."""
    chosen = select_files(files, replace(options, file_types=("spreadsheets",)), now)
    ids = chosen.select(F.col("id").alias("spreadsheetId"))
    return lookup_join(documents, ids, ["spreadsheetId"], ["spreadsheetId"], "left_semi")


def read_documents_rows(
    documents: DataFrame, options: SheetSourceOptions, headers: list[Header] | None = None
) -> DataFrame:
    """Typed rows of spreadsheet documents.

    Rows that need nothing but their own cells (no merged ranges, no empty rows, no lookup by
    sheet) stay as they arrive: no shuffle, and only resolved columns are parsed. To read the
    same documents more than once, write their sheets, cells and merges as tables first: each
    of them is a scan of the JSON text here.
    """
    sheets, merges = sheets_of(documents), merges_of(documents)
    plain = options.skip_empty and not (options.add_names or options.extract_metadata) and options.sheets_to_pull == "all"
    if not plain or not merges.isEmpty():
        return read_sheets(sheets, cells_of(documents), options, merges, headers)
    if headers is None:
        headers = infer_headers(sheets, cells_of(documents), merges, options)
    first = options.first_data_row(2 if any(h.subs for h in headers) else 1) - 1
    several = documents.where(F.exists("sheets", lambda s: F.size(s["data"]) > 1))
    grid = row_arrays_of(documents, one_block=several.isEmpty()).where(F.col("row_idx") >= first)
    if options.fixed_last_row is not None:
        grid = grid.where(F.col("row_idx") <= options.fixed_last_row - 1)
    return rows_from_arrays(grid, headers, options).select(*[f"`{h.title}`" for h in headers])


def add_sheet_fields(rows: DataFrame, sheets: DataFrame, cells: DataFrame, options: SheetSourceOptions) -> DataFrame:
    """Spreadsheet and sheet names and the metadata map, one lookup row per sheet."""
    if not options.add_names and not options.extract_metadata:
        return rows
    info = sheets.select(
        *SHEET_KEY,
        F.col("spreadsheet_name").alias(options.spreadsheet_field),
        F.col("sheet_title").alias(options.sheet_field),
    )
    if not options.add_names:
        info = info.select(*SHEET_KEY)
    if options.extract_metadata:
        empty = F.expr("CAST(map() AS map<string,string>)")
        found = sheet_metadata(cells, options, "_metadata")
        info = info.join(found, SHEET_KEY, "left").withColumn(
            options.metadata_field, F.coalesce("_metadata", empty)
        ).drop("_metadata")
    # names are columns of the listing; metadata is an aggregation over cells
    return lookup_join(rows, info, SHEET_KEY, ["row_idx"], written=options.extract_metadata)


def _no_merges(cells: DataFrame) -> DataFrame:
    return cells.sparkSession.createDataFrame([], MERGES_DDL)
