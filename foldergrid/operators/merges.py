"""Merged ranges: every cell of a range takes the value of its head cell."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldergrid.model import CELL_VALUES, ROW_KEY, SHEET_KEY, SheetSourceOptions
from foldergrid.operators.lookup import fits_broadcast
from foldergrid.session import shuffle_width

BUCKET_ROWS = 1024  # rows of a block
CELL_KEY = [*ROW_KEY, "col_idx"]


def clip_merges(merges: DataFrame, options: SheetSourceOptions, header_rows: int, columns: list[int]) -> DataFrame:
    """Merged ranges cut down to the data rows and resolved columns; the head stays where it is."""
    clipped = merges.withColumn("head_row", F.col("start_row")).withColumn("head_col", F.col("start_col"))
    first = options.first_data_row(header_rows) - 1
    clipped = clipped.withColumn("start_row", F.greatest("start_row", F.lit(first).cast("bigint")))
    if options.fixed_last_row is not None:
        clipped = clipped.withColumn(
            "end_row", F.least("end_row", F.lit(options.fixed_last_row).cast("bigint"))
        )
    if columns:
        clipped = clipped.withColumn("start_col", F.greatest("start_col", F.lit(min(columns))))
        clipped = clipped.withColumn("end_col", F.least("end_col", F.lit(max(columns) + 1)))
    return clipped.where((F.col("start_row") < F.col("end_row")) & (F.col("start_col") < F.col("end_col")))


def bucket_of(row: Column) -> Column:
    """The block of rows that a row is in."""
    return F.floor(row / F.lit(BUCKET_ROWS)).cast("bigint")


def bucketed(ranges: DataFrame) -> DataFrame:
    """A row for each block of rows that a range touches: `_bucket`, and the rows of the range in it from
    `start_row` to `end_row`. Blocks are numbered in two steps, so no array is long."""
    blocks = ranges.withColumns({"_first": bucket_of(F.col("start_row")), "_last": bucket_of(F.col("end_row") - 1)})
    step = F.lit(BUCKET_ROWS).cast("bigint")
    blocks = blocks.withColumn("_from", F.explode_outer(F.sequence(F.col("_first"), F.col("_last"), step)))
    blocks = blocks.withColumn("_bucket", F.explode_outer(F.sequence(F.col("_from"), F.least(F.col("_last"), F.col("_from") + step - 1))))
    low, high = F.col("_bucket") * BUCKET_ROWS, (F.col("_bucket") + 1) * BUCKET_ROWS
    return blocks.withColumns({"start_row": F.greatest("start_row", low), "end_row": F.least("end_row", high)}).drop("_first", "_last", "_from")


def _headed(cells: DataFrame, merges: DataFrame) -> DataFrame:
    """Ranges with the values of their head; those with an empty head are left out.

    The equi join is between heads and ranges, whose keys are unique, so a range over a third
    of all rows is no hot key. Ranges of a measured size are broadcast, and then the cells are
    only filtered; more of them meet the cells in a shuffle.
    """
    if "head_row" not in merges.columns:
        merges = merges.withColumn("head_row", F.col("start_row")).withColumn("head_col", F.col("start_col"))
    keys = [*SHEET_KEY, "head_row", "head_col"]
    heads = cells.where("non_empty").select(
        *SHEET_KEY, F.col("row_idx").alias("head_row"), F.col("col_idx").alias("head_col"), *CELL_VALUES
    )
    merges = merges.where((F.col("start_row") < F.col("end_row")) & (F.col("start_col") < F.col("end_col")))
    return heads.join(F.broadcast(merges) if fits_broadcast(merges) else merges, keys, "inner")


def fill_blocks(cells: DataFrame, merges: DataFrame) -> DataFrame:
    """Merge fills as blocks: one row per range and block of rows it touches, with the head's values, the
    first row and column, and how many rows and columns from there. As many rows as ranges and
    blocks, not as covered cells; `expanded` makes cells of them where they are needed."""
    blocks = bucketed(_headed(cells, merges))
    return blocks.select(
        *SHEET_KEY, "_bucket", F.col("start_row").alias("row_idx"), (F.col("end_row") - F.col("start_row")).alias("n_rows"),
        F.col("start_col").alias("col_idx"), (F.col("end_col") - F.col("start_col")).alias("n_cols"), *CELL_VALUES,
    )


def expanded(blocks: DataFrame) -> DataFrame:
    """A row for every covered cell; rows of one cell (n_rows and n_cols 1) stay as they are."""
    others = [c for c in blocks.columns if c not in ("row_idx", "n_rows", "col_idx", "n_cols")]
    along = lambda first, n: F.explode_outer(F.when(F.col(n) > 1, F.sequence(F.col(first), F.col(first) + F.col(n) - 1)).otherwise(F.array(first)))
    rows = blocks.select(*others, "col_idx", "n_cols", along("row_idx", "n_rows").alias("row_idx"))
    return rows.select(*others, "row_idx", along("col_idx", "n_cols").alias("col_idx"))


def merge_fills(cells: DataFrame, merges: DataFrame, spread: bool = True) -> DataFrame:
    """One cell per covered position, carrying the head's values. Blocks are dealt out before they
    are expanded. Output size is the number of covered cells."""
    blocks = fill_blocks(cells, merges)
    if spread:
        blocks = blocks.repartition(shuffle_width(cells.sparkSession), *SHEET_KEY, "_bucket", "col_idx")
    return expanded(blocks).select(*CELL_KEY, *CELL_VALUES)


def fill_merged_cells(cells: DataFrame, merges: DataFrame, spread: bool = True) -> DataFrame:
    """The cells table with merged ranges filled: covered cells are replaced, others kept.

    A cell meets the ranges of its block of rows only, and is dropped where one of them covers
    it; neither what is dropped nor what is filled in is shuffled cell by cell.
    """
    columns = [*CELL_KEY, *CELL_VALUES]
    headed = _headed(cells, merges).select(*SHEET_KEY, "start_row", "end_row", "start_col", "end_col")
    blocks = bucketed(headed)
    if fits_broadcast(blocks):
        blocks = F.broadcast(blocks)
    inside = (
        reduce(and_, [F.col(f"c.{k}") == F.col(f"m.{k}") for k in (*SHEET_KEY, "_bucket")])
        & (F.col("c.row_idx") >= F.col("m.start_row")) & (F.col("c.row_idx") < F.col("m.end_row"))
        & (F.col("c.col_idx") >= F.col("m.start_col")) & (F.col("c.col_idx") < F.col("m.end_col"))
    )
    keyed = cells.select(*columns).withColumn("_bucket", bucket_of(F.col("row_idx")))
    untouched = keyed.alias("c").join(blocks.alias("m"), inside, "left_anti").select(*columns)
    return untouched.unionByName(merge_fills(cells, merges, spread).select(*columns))
