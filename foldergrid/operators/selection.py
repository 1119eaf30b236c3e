"""Choosing sheets, rows and columns of a grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldergrid.model import SHEET_KEY, SheetSourceOptions
from foldergrid.session import shuffle_width


RUN_PAGES = 10_000


def sheet_wanted(options: SheetSourceOptions) -> Column:
    """Selected by 0-based sheet index, by title, or all."""
    if options.sheets_to_pull == "numbers":
        return F.col("sheet_index").isin([int(n) for n in options.sheet_identifiers])
    if options.sheets_to_pull == "titles":
        return F.col("sheet_title").isin(list(options.sheet_identifiers))
    return F.lit(True)


def select_sheets(sheets: DataFrame, options: SheetSourceOptions) -> DataFrame:
    return sheets.where(sheet_wanted(options))


def missing_sheets(sheets: DataFrame, options: SheetSourceOptions) -> DataFrame:
    """Spreadsheets that lack a required sheet, with what they lack.

    Only required sheets are grouped, so a group is never larger than the option list.
    """
    by_number = options.sheets_to_pull == "numbers"
    name = F.col("sheet_index").cast("string") if by_number else F.col("sheet_title")
    required = [str(i) for i in options.sheet_identifiers]
    found = F.collect_set(F.when(name.isin(required), name))
    return (
        sheets.groupBy("spreadsheet_id")
        .agg(F.array_sort(F.array_except(F.lit(required), found)).alias("missing"))
        .where(F.size("missing") > 0)
    )


def last_data_row(options: SheetSourceOptions) -> Column:
    """1-based last data row of a sheet: its own row count unless given, above the footer."""
    last = F.col("row_count") if options.auto_detect else F.lit(options.last_row)
    if options.extract_metadata and options.first_footer_row > 0:
        last = F.least(last, F.lit(options.first_footer_row - 1))
    return last.cast("bigint")


def data_cells(cells: DataFrame, options: SheetSourceOptions, header_rows: int, columns: list[int]) -> DataFrame:
    """Cells inside the data rows and the resolved columns; both bounds reach the scan."""
    first = options.first_data_row(header_rows)
    kept = cells.where(F.col("row_idx") >= first - 1)
    if options.fixed_last_row is not None:
        kept = kept.where(F.col("row_idx") <= options.fixed_last_row - 1)
    if columns:
        kept = kept.where(F.col("col_idx").between(min(columns), max(columns)))
        if len(columns) != max(columns) - min(columns) + 1:
            kept = kept.where(F.col("col_idx").isin(columns))
    return kept


def read_chunks(sheets: DataFrame, options: SheetSourceOptions, header_rows: int) -> DataFrame:
    """Paged row reads: (first_row, n_rows) per chunk of `read_buffer_rows`, 1-based.

    Pages are numbered in runs, so no array is as long as a sheet has pages.
    """
    first = F.lit(options.first_data_row(header_rows)).cast("bigint")
    step = F.lit(options.read_buffer_rows).cast("bigint")
    run = F.lit(options.read_buffer_rows * RUN_PAGES).cast("bigint")
    return (
        sheets.withColumn("_last", last_data_row(options)).where(F.col("_last") >= first)
        .withColumn("_run", F.explode_outer(F.sequence(first, F.col("_last"), run)))
        .withColumn("first_row", F.explode_outer(F.sequence("_run", F.least(F.col("_run") + run - 1, F.col("_last")), step)))
        .withColumn("n_rows", F.least(step, F.col("_last") - F.col("first_row") + 1))
        .drop("_last", "_run")
    )


def row_spine(sheets: DataFrame, options: SheetSourceOptions, header_rows: int, spread: bool = True) -> DataFrame:
    """Every data row number of every selected sheet, present in the cells or not.

    Chunks are dealt out before they are expanded, so a sheet of any length is expanded
    by many tasks.
    """
    chunks = read_chunks(sheets, options, header_rows).select(*SHEET_KEY, "first_row", "n_rows")
    if spread:
        chunks = chunks.repartition(shuffle_width(sheets.sparkSession), *SHEET_KEY, "first_row")
    rows = F.explode_outer(F.sequence(F.col("first_row") - 1, F.col("first_row") + F.col("n_rows") - 2))
    return chunks.select(*SHEET_KEY, rows.alias("row_idx"))


def sample_rows(cells: DataFrame, sheet: dict, rows: list[int]) -> DataFrame:
    """Cells of single rows (1-based) of one sheet: `sheet` has the two key columns."""
    lacking = [key for key in SHEET_KEY if sheet.get(key) is None]
    if lacking:
        raise ValueError(f"Which sheet? {', '.join(lacking)} is not given.")
    if not rows or any(row < 1 for row in rows):
        raise ValueError(f"Rows are numbered from 1, and at least one is needed: {rows}.")
    return cells.where(
        (F.col("spreadsheet_id") == F.lit(sheet["spreadsheet_id"]))
        & (F.col("sheet_id") == F.lit(sheet["sheet_id"]))
        & F.col("row_idx").isin([row - 1 for row in rows])
    )


def sheet_totals(sheets: DataFrame, options: SheetSourceOptions, header_rows: int) -> DataFrame:
    """How many data rows there are to read in each selected sheet (`total`), from the pages of the listing alone."""
    pages = read_chunks(select_sheets(sheets, options), options, header_rows)
    return pages.groupBy(*SHEET_KEY).agg(F.sum("n_rows").alias("total"))


def read_progress(rows: DataFrame, sheets: DataFrame, options: SheetSourceOptions, header_rows: int) -> DataFrame:
    """Per sheet the rows read so far (`rows` holds their row keys), the rows there are, and the share
    from 0 to 1. A sheet of which nothing is read yet is there with 0."""
    read = rows.groupBy(*SHEET_KEY).agg(F.count(F.lit(1)).alias("rows"))
    shares = sheet_totals(sheets, options, header_rows).join(read, SHEET_KEY, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    return shares.withColumn("share", F.least(F.lit(1.0), F.col("rows") / F.col("total")))


def progress_share(observed_rows: int, sheets: DataFrame, options: SheetSourceOptions, header_rows: int) -> float:
    """The share of all rows that a read has given out, by what its `progress` has observed; 1 where there are none."""
    total = sheet_totals(sheets, options, header_rows).agg(F.sum("total")).first()[0]
    return min(1.0, observed_rows / total) if total else 1.0
