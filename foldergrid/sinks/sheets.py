"""Placed records -> grid tables and update documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from foldergrid.model import SheetSinkOptions
from foldergrid.operators.flatten import (
    CELL_DDL,
    TARGET,
    Leaf,
    data_merges,
    encode_records,
    grid_cells,
    grid_rows,
    leaf_columns,
    measure_records,
    written_schema,
)
from foldergrid.operators.header_layout import (
    depth,
    header_cells,
    header_merges_of,
    header_ranges,
    header_rows_of,
    width,
)
from foldergrid.operators.layout import place_records, sheet_extents
from foldergrid.session import cut_lineage, forget, shuffle_width


BATCHES_PER_FILE = 1000
CLUSTER_BYTES = 8 << 20  # row groups of clustered tables, so that a page is a small read


@dataclass(frozen=True)
class Layout:
    """What a schema alone decides."""

    schema: T.StructType
    leaves: list[Leaf]
    depth: int
    width: int

    @classmethod
    def of(cls, schema: T.StructType, options: SheetSinkOptions) -> Layout:
        written = written_schema(schema, options)
        return cls(written, leaf_columns(schema, options), depth(written), width(written))


def place(records: DataFrame, options: SheetSinkOptions, order_by: list[str], n_ranges: int | None = None) -> DataFrame:
    """Records with encoded cells, their first row and their batch. The records are shuffled
    as they are; cells are encoded after it."""
    layout = Layout.of(records.schema, options)
    measured = measure_records(records, options, tuple(order_by))
    return encode_records(place_records(measured, options, order_by, layout.depth, n_ranges), options)


def all_grid_rows(placed: DataFrame, layout: Layout) -> DataFrame:
    """Data rows at their absolute row index."""
    rows = grid_rows(placed, layout.leaves)
    return rows.withColumn("row_idx", F.col("first_row") + F.col("row_in_record"))


def all_cells(placed: DataFrame, layout: Layout, options: SheetSinkOptions, sheets: DataFrame) -> DataFrame:
    """Header and data cells: target, row_idx, col_idx and content."""
    data = grid_cells(all_grid_rows(placed, layout), [*TARGET, "row_idx"])
    if not options.write_schema:
        return data
    return data.unionByName(header_rows_of(sheets, layout.schema), allowMissingColumns=True)


def all_merges(placed: DataFrame, layout: Layout, options: SheetSinkOptions, sheets: DataFrame) -> DataFrame:
    """Header merges, and data merges if asked for, as absolute half-open ranges."""
    columns = [*TARGET, "start_row", "end_row", "start_col", "end_col"]
    parts = []
    if options.write_schema:
        parts.append(header_merges_of(sheets, layout.schema).select(*columns))
    if options.merge_data_cells:
        parts.append(data_merges(placed, layout.leaves, F.col("first_row")).select(*columns))
    if not parts:
        return header_merges_of(sheets, T.StructType()).select(*columns)
    merges = parts[0]
    for part in parts[1:]:
        merges = merges.unionByName(part)
    return merges


def write_sheets(
    records: DataFrame, options: SheetSinkOptions, order_by: list[str], path: str, mode: str = "errorifexists",
    clustered: bool = False,
) -> None:
    """Write grid_records, grid_cells, grid_merges and grid_sheets under `path`.

    Placing the records is the one shuffle. Its result is written first and the other tables
    are derived from it by narrow steps, so no plan repeats the shuffle and a lost executor
    costs no more than its own tasks. Partitioning by spreadsheet would make one small file per
    name and task.

    `clustered` tables are in the order of spreadsheet, sheet and row, over files as within them, at the
    price of one more shuffle of the placed records (not of their cells): a page of a sheet is then in the row
    groups of CLUSTER_BYTES that its rows are in, and a filter on sheet and row (`page_cells`) reads no other.
    """
    spark = records.sparkSession
    layout = Layout.of(records.schema, options)
    placed = place(records, options, order_by)
    if clustered:
        # the rows that ranges are sampled from and the rows themselves are those of one table
        unsorted = cut_lineage(placed)
        placed = unsorted.repartitionByRange(*TARGET, "first_row").sortWithinPartitions(*TARGET, "first_row")

    def put(df: DataFrame, name: str) -> None:
        writer = df.write.mode(mode)
        if clustered:
            writer = writer.option("parquet.block.size", CLUSTER_BYTES)
        writer.parquet(f"{path}/{name}")

    put(placed, "grid_records")
    if clustered:
        forget(unsorted)
    placed = spark.read.parquet(f"{path}/grid_records")
    put(sheet_extents(placed, options, layout.depth, layout.width), "grid_sheets")
    sheets = spark.read.parquet(f"{path}/grid_sheets")
    put(all_cells(placed, layout, options, sheets), "grid_cells")
    put(all_merges(placed, layout, options, sheets), "grid_merges")


def page_cells(cells: DataFrame, spreadsheet: str, sheet: str, first_row: int, n_rows: int) -> DataFrame:
    """The cells of some rows (from 1) of a written sheet, by filters that reach the scan."""
    return cells.where(
        (F.col("spreadsheet_name") == spreadsheet) & (F.col("sheet_name") == sheet) & F.col("row_idx").between(first_row - 1, first_row + n_rows - 2)
    )


def update_documents(placed: DataFrame, layout: Layout, options: SheetSinkOptions) -> DataFrame:
    """One update document per batch: cell updates first, then merges.

    A batch holds `max_buffer` records, which may expand to any number of rows. The rows of a
    batch are numbered through; one of at most `max_batch_rows` rows is a single document, a
    larger one is cut every `max_batch_rows` rows, and its merges are in the last document,
    after all contents. Merges of a batch that exceed a document's worth of ranges make further
    documents. Header rows travel with the sheet's first record.
    """
    head = layout.depth if options.write_schema else 0
    key = ["spreadsheet_name", "batch_no", "part_no"]
    limit = F.lit(options.max_batch_rows)
    # a window over the records of a batch, of which there are max_buffer at most
    batch = Window.partitionBy("spreadsheet_name", "batch_no")
    taken = F.col("n_rows") + F.when(F.col("is_first"), F.lit(head)).otherwise(F.lit(0))
    before = F.sum(taken).over(batch.orderBy("sheet_name", "first_row").rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumns({
        "_before": F.coalesce(before, F.lit(0)), "_last_part": F.floor((F.sum(taken).over(batch) - 1) / limit),
        "_head": F.when(F.col("is_first"), F.lit(head)).otherwise(F.lit(0)),
    })
    rows = all_grid_rows(placed, layout).select(
        *TARGET, "batch_no", F.floor((F.col("_before") + F.col("_head") + F.col("row_in_record")) / limit).alias("part_no"), "row_idx", "cells"
    )
    if head:
        header = _header_rows(placed, layout, limit)
        rows = rows.unionByName(header)
    updates = rows.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("sheet_name", "row_idx", "cells"))).alias("updates"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    merges = _batch_merges(placed, layout, options, head)
    if merges is None:
        joined = updates.withColumn(
            "merges",
            F.expr(
                "CAST(array() AS array<struct<sheet_name:string,start_row:bigint,end_row:bigint,"
                "start_col:int,end_col:int>>)"
            ),
        )
    else:
        # ranges of one record are dealt evenly over the documents that its batch needs for them
        grouped = merges.groupBy("spreadsheet_name", "batch_no", "part_no").agg(
            F.array_sort(
                F.collect_list(F.struct("sheet_name", "start_row", "end_row", "start_col", "end_col"))
            ).alias("merges")
        )
        joined = updates.join(grouped, key, "full")
    return joined.select(
        *key, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce(F.size("merges"), F.lit(0)).alias("n_merges"),
        F.to_json(F.struct("updates", "merges")).alias("document"),
    )


def _header_rows(placed: DataFrame, layout: Layout, limit: Column) -> DataFrame:
    """Header rows, numbered before the rows of the record that they travel with."""
    names = {(r, c): name for r, c, name in header_cells(layout.schema)}
    structs = []
    for r in range(layout.depth):
        cells = [
            F.struct(
                F.lit(None).cast("double").alias("user_num"), F.lit(names.get((r, c))).cast("string").alias("user_str"),
                F.lit(None).cast("boolean").alias("user_bool"), F.lit(None).cast("string").alias("num_format"),
            )
            for c in range(layout.width)
        ]
        structs.append(
            F.struct((F.col("_before") + F.lit(r)).alias("_at"), F.lit(r).cast("bigint").alias("row_idx"), F.array(*cells).cast(f"array<{CELL_DDL}>").alias("cells"))
        )
    first = placed.where("is_first").select(*TARGET, "batch_no", F.inline_outer(F.array(*structs)))
    return first.select(*TARGET, "batch_no", F.floor(F.col("_at") / limit).alias("part_no"), "row_idx", "cells")


def _batch_merges(placed: DataFrame, layout: Layout, options: SheetSinkOptions, head: int) -> DataFrame | None:
    columns = [*TARGET, "batch_no", "start_row", "end_row", "start_col", "end_col"]
    parts = []
    last = F.col("_last_part")
    if options.merge_data_cells:
        # a record of many rows has many ranges: those past the first document's worth of its rows
        # go to documents after the last one
        per_part = F.lit(max(1, options.max_batch_rows // options.max_buffer))
        merges = data_merges(placed, layout.leaves, F.col("first_row"))
        beyond = F.when(
            F.col("n_rows") > F.lit(options.max_batch_rows), F.floor((F.col("start_row") - F.col("first_row")) / per_part)
        ).otherwise(F.lit(0))
        parts.append(merges.select(*columns, (last + beyond).alias("part_no")))
    if head > 1:
        ranges = [
            F.struct(
                F.lit(a).cast("bigint").alias("start_row"), F.lit(b).cast("bigint").alias("end_row"),
                F.lit(c).alias("start_col"), F.lit(d).alias("end_col"),
            )
            for a, b, c, d in header_ranges(layout.schema)
        ]
        first = placed.where("is_first").select(*TARGET, "batch_no", last.alias("part_no"), F.inline(F.array(*ranges)))
        parts.append(first.select(*columns, "part_no"))
    if not parts:
        return None
    merges = parts[0]
    for part in parts[1:]:
        merges = merges.unionByName(part)
    return merges


def write_update_documents(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Documents as JSON lines, one folder per spreadsheet.

    Runs of batches of a spreadsheet go to one task: a small spreadsheet is one file, and one
    with a third of all batches is still written by many tasks.
    """
    spread = documents.repartition(
        shuffle_width(documents.sparkSession), "spreadsheet_name", F.floor(F.col("batch_no") / BATCHES_PER_FILE)
    )
    spread.write.mode(mode).partitionBy("spreadsheet_name").json(path)
