"""Records laid out as grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldergrid.model import SheetSinkOptions, SheetSourceOptions
from foldergrid.operators.flatten import (
    TARGET,
    data_merges,
    grid_cells,
    grid_rows,
    leaf_columns,
    non_trivial_merges,
    route,
    with_cells,
)
from foldergrid.operators.header_layout import header_merges_of, header_rows_of
from foldergrid.operators.layout import Running, batch_sizes, running_totals, sheet_extents
from foldergrid.plans.sheet_source import read_sheets
from foldergrid.session import cut_lineage, shared_folder
from foldergrid.sinks.sheets import Layout, all_cells, all_merges, place, update_documents
from foldergrid.streaming.flush import flush_sheets
from foldergrid.streaming.runs import read_runs
from workload.tables import table


def _parts(spark, sf_dir) -> DataFrame:
    """Parts with two arrays: the words of the name and the pieces of the brand; parts of
    size 1 to 3 have an empty array, and small parts have no brand array at all."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 3, F.split("p_name", " ")).otherwise(F.array().cast("array<string>")).alias("words"),
        F.col("p_retailprice").alias("price"),
        F.when(F.col("p_type") != "SMALL", F.split("p_brand", "#")).alias("brand"),
        F.col("p_type").alias("type"),
    )


_PARTS_SQL = """
WITH parts AS (
  SELECT p_partkey, p_retailprice AS price, p_type AS type,
         CASE WHEN p_size > 3 THEN string_split(p_name, ' ') ELSE [NULL] END AS words,
         CASE WHEN p_type <> 'SMALL' THEN string_split(p_brand, '#') ELSE [NULL] END AS brand FROM part),
sized AS (SELECT *, len(words) AS n1, len(brand) AS n2 FROM parts),
flat AS (
  SELECT *, (i - 1) * n2 + j - 1 AS r FROM (
    SELECT *, unnest(range(1, n2 + 1)) AS j FROM (SELECT *, unnest(range(1, n1 + 1)) AS i FROM sized)))
"""

_ROUTED = SheetSinkOptions(spreadsheet_name="parts", sheet_field="type", merge_data_cells=True)
_SKIPPED = SheetSinkOptions(spreadsheet_name="parts", sheet_field="type", skip_name_fields=True, merge_data_cells=True)


def flatten_arrays(spark, sf_dir) -> DataFrame:
    parts = _parts(spark, sf_dir)
    rows = grid_rows(with_cells(parts, _ROUTED, ("p_partkey",)), leaf_columns(parts.schema, _ROUTED))
    text = lambda i: F.col("cells")[i]["user_str"]
    return rows.select(
        "p_partkey", "sheet_name", F.col("row_in_record").cast("bigint").alias("r"), "n_rows",
        F.col("cells")[0]["user_num"].alias("key"), text(1).alias("word"),
        F.col("cells")[2]["user_num"].alias("price"), text(3).alias("brand"), text(4).alias("type"),
    )


FLATTEN_ARRAYS = _PARTS_SQL + """
SELECT p_partkey, type AS sheet_name, r, n1 * n2 AS n_rows, p_partkey::DOUBLE AS key, words[i] AS word, price,
       brand[j] AS brand, type FROM flat
"""


def flatten_merges(spark, sf_dir) -> DataFrame:
    parts = _parts(spark, sf_dir)
    merges = data_merges(with_cells(parts, _ROUTED, ("p_partkey",)), leaf_columns(parts.schema, _ROUTED))
    return non_trivial_merges(merges).select("p_partkey", "start_row", "end_row", "start_col", "end_col")


FLATTEN_MERGES = _PARTS_SQL + """
SELECT p_partkey, 0::BIGINT AS start_row, n1 * n2 AS end_row, c AS start_col, c + 1 AS end_col
FROM sized, (VALUES (0), (2), (4)) v(c) WHERE n1 * n2 > 1
UNION ALL
SELECT DISTINCT p_partkey, (i - 1) * n2, i * n2, 1, 2 FROM flat WHERE n2 > 1
"""


def flatten_structs(spark, sf_dir) -> DataFrame:
    """Customers with two records, one null for a segment; flattened to cells."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.struct("c_name", F.col("c_nationkey").alias("nation")).alias("who"),
        F.when(
            F.col("c_mktsegment") != "BUILDING",
            F.struct("c_acctbal", (F.col("c_acctbal") > 0).alias("in_credit")),
        ).alias("account"),
    )
    options = SheetSinkOptions()
    rows = grid_rows(with_cells(customers, options, ("c_custkey",)), leaf_columns(customers.schema, options))
    return grid_cells(rows, ["c_custkey"]).select("c_custkey", "col_idx", "user_num", "user_str", "user_bool")


FLATTEN_STRUCTS = """
SELECT c_custkey, c AS col_idx,
       CASE c WHEN 0 THEN c_custkey::DOUBLE WHEN 2 THEN c_nationkey::DOUBLE WHEN 3 THEN c_acctbal END AS user_num,
       CASE c WHEN 1 THEN c_name END AS user_str, CASE c WHEN 4 THEN c_acctbal > 0 END AS user_bool
FROM customer, (VALUES (0), (1), (2), (3), (4)) v(c) WHERE c < 3 OR c_mktsegment <> 'BUILDING'
"""


def flatten_vectors(spark, sf_dir) -> DataFrame:
    """Embeddings: one grid row per element of a float array."""
    vectors = table(spark, sf_dir, "embeddings")
    options = SheetSinkOptions()
    rows = grid_rows(with_cells(vectors, options, ("vec_id",)), leaf_columns(vectors.schema, options))
    return rows.select(
        "vec_id", F.col("row_in_record").cast("bigint").alias("r"), F.col("cells")[1]["user_num"].alias("value"),
        F.col("cells")[2]["user_num"].alias("label"),
    )


FLATTEN_VECTORS = """
SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS r, unnest(embedding)::DOUBLE AS value, label::DOUBLE AS label
FROM embeddings
"""


def cell_encoding(spark, sf_dir) -> DataFrame:
    """Line items with every kind of value; dates and flags are null for some."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_shipdate").cast("date")).alias("day"),
        F.when(F.col("l_linestatus") == "O", F.col("l_shipdate").cast("timestamp")).alias("moment"),
        (F.col("l_linenumber") * 3_600_000).alias("clock"),
        F.col("l_tax").cast("decimal(10,2)").alias("tax"),
        F.when(F.col("l_quantity") > 25, F.encode("l_returnflag", "UTF-8")).alias("flag"),
        F.col("l_discount").cast("float").alias("discount"),
    )
    options = SheetSinkOptions(time_fields={"clock": "millis"})
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = grid_rows(with_cells(lines, options, keys), leaf_columns(lines.schema, options))
    cell = lambda i, part: F.col("cells")[i][part]
    return rows.select(
        *keys, cell(4, "user_num").alias("day"), cell(4, "num_format").alias("day_format"),
        cell(5, "user_num").alias("moment"), cell(5, "num_format").alias("moment_format"),
        F.floor(cell(6, "user_num") * 1_000_000).alias("clock"), cell(6, "num_format").alias("clock_format"),
        cell(7, "user_num").alias("tax"), cell(7, "num_format").alias("tax_format"),
        cell(8, "user_str").alias("flag"), cell(8, "num_format").alias("flag_format"),
        cell(9, "user_num").alias("discount"),
    )


CELL_ENCODING = """
WITH s AS (SELECT *, datediff('day', DATE '1899-12-30', l_shipdate::DATE)::DOUBLE AS day FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_returnflag <> 'R' THEN day END AS day, 'DATE' AS day_format,
       CASE WHEN l_linestatus = 'O' THEN day END AS moment, 'DATE_TIME' AS moment_format,
       floor((l_linenumber * 3600000000)::DOUBLE / 86400000000.0::DOUBLE * 1000000.0::DOUBLE)::BIGINT AS clock,
       'TIME' AS clock_format, l_tax::DECIMAL(10, 2)::DOUBLE AS tax, 'NUMBER' AS tax_format,
       CASE WHEN l_quantity > 25 THEN l_returnflag END AS flag, NULL::VARCHAR AS flag_format,
       l_discount::FLOAT::DOUBLE AS discount
FROM s
"""


def target_routing(spark, sf_dir) -> DataFrame:
    """Orders go to the book of their priority, or the default; and without the name fields."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "book", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    )
    options = SheetSinkOptions(
        spreadsheet_name="general", spreadsheet_field="book", sheet_field="o_orderstatus", skip_name_fields=True
    )
    width = len(leaf_columns(orders.schema, options))
    return route(orders, options).groupBy(*TARGET).agg(
        F.count(F.lit(1)).alias("records"), F.lit(width).alias("columns")
    )


TARGET_ROUTING = """
SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE 'general' END AS spreadsheet_name,
       o_orderstatus AS sheet_name, count(*) AS records, 5 AS columns FROM orders GROUP BY ALL
"""

_NESTED = T.StructType.fromJson(
    {
        "type": "struct",
        "fields": [
            {"name": "id", "type": "long", "nullable": True, "metadata": {}},
            {
                "name": "order", "nullable": True, "metadata": {},
                "type": {
                    "type": "struct",
                    "fields": [
                        {"name": "day", "type": "date", "nullable": True, "metadata": {}},
                        {"name": "price", "type": "double", "nullable": True, "metadata": {}},
                    ],
                },
            },
            {"name": "status", "type": "string", "nullable": True, "metadata": {}},
        ],
    }
)


def _order_targets(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return route(orders, SheetSinkOptions(spreadsheet_field="o_orderpriority", sheet_field="o_orderstatus")).select(
        *TARGET
    ).distinct()


_TARGETS_SQL = "WITH s AS (SELECT DISTINCT o_orderpriority AS spreadsheet_name, o_orderstatus AS sheet_name FROM orders)"


def header_rows(spark, sf_dir) -> DataFrame:
    return header_rows_of(_order_targets(spark, sf_dir), _NESTED)


HEADER_ROWS = _TARGETS_SQL + """
SELECT s.*, row_idx::BIGINT AS row_idx, col_idx, user_str FROM s,
  (VALUES (0, 0, 'id'), (0, 1, 'order'), (1, 1, 'day'), (1, 2, 'price'), (0, 3, 'status')) v(row_idx, col_idx, user_str)
"""


def header_merges(spark, sf_dir) -> DataFrame:
    return header_merges_of(_order_targets(spark, sf_dir), _NESTED)


HEADER_MERGES = _TARGETS_SQL + """
SELECT s.*, a::BIGINT AS start_row, b::BIGINT AS end_row, c AS start_col, d AS end_col FROM s,
  (VALUES (0, 2, 0, 1), (0, 1, 1, 3), (0, 2, 3, 4)) v(a, b, c, d)
"""


def sheet_row_offsets(spark, sf_dir) -> DataFrame:
    """First row and batch of every part, sheets by type, in one book that holds them all."""
    placed = place(_parts(spark, sf_dir), _ROUTED, ["p_partkey"])
    return placed.select("p_partkey", "sheet_name", "n_rows", "first_row", "is_first", "batch_no")


SHEET_ROW_OFFSETS = _PARTS_SQL + """
, o AS (
  SELECT p_partkey, type, n1 * n2 AS n_rows,
         coalesce(sum(n1 * n2) OVER (PARTITION BY type ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
         row_number() OVER (ORDER BY p_partkey) AS k FROM sized)
SELECT p_partkey, type AS sheet_name, n_rows, before + 1 AS first_row, before = 0 AS is_first,
       (k - 1) // 50 AS batch_no FROM o
"""


def line_offsets(spark, sf_dir) -> DataFrame:
    """Running quantity of the line items of each flag: three groups hold all rows."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.col("l_quantity").cast("bigint").alias("n_rows"),
    )
    totals = [
        Running("ordinal", ("l_returnflag",), 1), Running("offset", ("l_returnflag", "l_linestatus"), "n_rows"),
    ]
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "n_rows", "l_linestatus"]
    return running_totals(lines, totals, order)


LINE_OFFSETS = """
WITH l AS (SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                  l_quantity::BIGINT AS n_rows FROM lineitem)
SELECT *, row_number() OVER (PARTITION BY l_returnflag
            ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, n_rows, l_linestatus) - 1 AS ordinal,
       coalesce(sum(n_rows) OVER (PARTITION BY l_returnflag, l_linestatus
            ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, n_rows
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
FROM l
"""


def sheet_sizes(spark, sf_dir) -> DataFrame:
    parts = _parts(spark, sf_dir)
    layout = Layout.of(parts.schema, _ROUTED)
    options = SheetSinkOptions(
        spreadsheet_name="parts", sheet_field="type", initial_rows=100, min_extension=500, initial_columns=3
    )
    return sheet_extents(with_cells(parts, options), options, layout.depth, layout.width)


SHEET_SIZES = _PARTS_SQL + """
SELECT 'parts' AS spreadsheet_name, type AS sheet_name, count(*) AS n_records, sum(n1 * n2)::BIGINT + 1 AS rows_written,
       5 AS columns_written,
       CASE WHEN sum(n1 * n2) + 1 > 100 THEN greatest(sum(n1 * n2) + 1 - 100, 500) ELSE 0 END::BIGINT AS rows_added,
       2::BIGINT AS columns_added
FROM sized GROUP BY type
"""

_BOOKS = SheetSinkOptions(spreadsheet_field="o_orderpriority", sheet_field="o_orderstatus", max_buffer=70)


def sheet_batches(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return batch_sizes(place(orders, _BOOKS, ["o_orderkey"]))


SHEET_BATCHES = """
WITH b AS (SELECT o_orderpriority AS spreadsheet_name,
                  (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) // 70 AS batch_no FROM orders)
SELECT spreadsheet_name, batch_no, count(*) AS n_records FROM b GROUP BY ALL
"""


def update_batches(spark, sf_dir) -> DataFrame:
    """Update documents of the parts: rows and merges per batch, and what is inside."""
    parts = _parts(spark, sf_dir)
    layout = Layout.of(parts.schema, _ROUTED)
    # the placed records are read three times: for rows, header rows and merges
    documents = update_documents(cut_lineage(place(parts, _ROUTED, ["p_partkey"])), layout, _ROUTED)
    inside = F.from_json(
        "document", "struct<updates: array<struct<sheet_name: string, row_idx: bigint>>, merges: array<struct<end_row: bigint>>>"
    )
    return documents.withColumn("d", inside).select(
        "batch_no", "part_no", "n_rows", F.col("n_merges").cast("bigint").alias("n_merges"),
        F.aggregate("d.updates", F.lit(0).cast("bigint"), lambda a, u: a + u["row_idx"]).alias("row_sum"),
        F.aggregate("d.merges", F.lit(0).cast("bigint"), lambda a, m: a + m["end_row"]).alias("merge_end_sum"),
    )


UPDATE_BATCHES = SHEET_ROW_OFFSETS[: SHEET_ROW_OFFSETS.rindex("SELECT p_partkey, type AS sheet_name")] + """
, p AS (SELECT s.*, before + 1 AS f, before = 0 AS is_first, (k - 1) // 50 AS batch_no
        FROM sized s JOIN (SELECT p_partkey, before, k FROM o) USING (p_partkey)),
rows AS (
  SELECT batch_no, f + unnest(range(0, n1 * n2)) AS row_idx FROM p
  UNION ALL SELECT batch_no, 0 FROM p WHERE is_first),
merges AS (
  SELECT batch_no, f + n1 * n2 AS end_row FROM p, range(3) WHERE n1 * n2 > 1
  UNION ALL SELECT batch_no, f + unnest(range(1, n1 + 1)) * n2 FROM p WHERE n2 > 1)
SELECT r.batch_no, 0::BIGINT AS part_no, n_rows, coalesce(n_merges, 0) AS n_merges, row_sum,
       coalesce(merge_end_sum, 0) AS merge_end_sum
FROM (SELECT batch_no, count(*) AS n_rows, sum(row_idx)::BIGINT AS row_sum FROM rows GROUP BY 1) r
LEFT JOIN (SELECT batch_no, count(*) AS n_merges, sum(end_row)::BIGINT AS merge_end_sum FROM merges GROUP BY 1) m USING (batch_no)
"""


def written_cells(spark, sf_dir) -> DataFrame:
    """All cells of the books of parts, headers included, at their place in the sheet."""
    parts = _parts(spark, sf_dir)
    layout = Layout.of(parts.schema, _SKIPPED)
    placed = cut_lineage(place(parts, _SKIPPED, ["p_partkey"]))
    return all_cells(placed, layout, _SKIPPED, placed.where("is_first").select(*TARGET)).select(
        "sheet_name", "row_idx", "col_idx", "user_num", "user_str"
    )


_PLACED_SQL = _PARTS_SQL + """
, o AS (
  SELECT p_partkey, 1 + coalesce(sum(n1 * n2) OVER (PARTITION BY type ORDER BY p_partkey
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS f FROM sized)
"""

WRITTEN_CELLS = _PLACED_SQL + """
SELECT * FROM (
  SELECT type AS sheet_name, f + r AS row_idx, c AS col_idx,
         CASE c WHEN 0 THEN p_partkey::DOUBLE WHEN 2 THEN price END AS user_num,
         CASE c WHEN 1 THEN words[i] WHEN 3 THEN brand[j] END AS user_str
  FROM flat JOIN o USING (p_partkey), (VALUES (0), (1), (2), (3)) v(c))
WHERE user_num IS NOT NULL OR user_str IS NOT NULL
UNION ALL
SELECT DISTINCT type, 0, c, NULL::DOUBLE, n FROM parts,
  (VALUES (0, 'p_partkey'), (1, 'words'), (2, 'price'), (3, 'brand')) v(c, n)
"""


def written_merges(spark, sf_dir) -> DataFrame:
    parts = _parts(spark, sf_dir)
    layout = Layout.of(parts.schema, _SKIPPED)
    placed = cut_lineage(place(parts, _SKIPPED, ["p_partkey"]))
    return all_merges(placed, layout, _SKIPPED, placed.where("is_first").select(*TARGET)).drop("spreadsheet_name")


WRITTEN_MERGES = _PLACED_SQL + """
SELECT type AS sheet_name, f AS start_row, f + n1 * n2 AS end_row, c AS start_col, c + 1 AS end_col
FROM sized JOIN o USING (p_partkey), (VALUES (0), (2)) v(c) WHERE n1 * n2 > 1
UNION ALL
SELECT DISTINCT type, f + (i - 1) * n2, f + i * n2, 1, 2 FROM flat JOIN o USING (p_partkey) WHERE n2 > 1
"""


def round_trip(spark, sf_dir) -> DataFrame:
    """Orders written as grids and read back with inferred headers."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderdate").cast("timestamp").alias("moment"),
        F.col("o_orderpriority").alias("priority"),
    )
    options = SheetSinkOptions(sheet_field="priority", skip_name_fields=True)
    layout = Layout.of(orders.schema, options)
    # read for the extents and for the cells
    placed = cut_lineage(place(orders, options, ["o_orderkey"]))
    sheets = cut_lineage(sheet_extents(placed, options, layout.depth, layout.width))
    index = F.substring("sheet_name", 1, 1).cast("int")
    written = all_cells(placed, layout, options, sheets)
    # read back more than once: for the headers, then for the rows
    cells = cut_lineage(written).select(
        F.col("spreadsheet_name").alias("spreadsheet_id"), index.cast("bigint").alias("sheet_id"), "row_idx", "col_idx",
        F.coalesce("user_str", F.col("user_num").cast("string")).alias("formatted"), F.col("user_num").alias("eff_num"),
        F.col("user_bool").alias("eff_bool"), "user_num", "user_str", "user_bool",
        F.lit(None).cast("string").alias("user_formula"), "num_format", F.lit(True).alias("non_empty"),
    )
    listing = sheets.select(
        F.col("spreadsheet_name").alias("spreadsheet_id"), "spreadsheet_name", index.cast("bigint").alias("sheet_id"),
        index.alias("sheet_index"), F.col("sheet_name").alias("sheet_title"), F.col("rows_written").alias("row_count"),
        F.col("columns_written").alias("col_count"),
    )
    rows = read_sheets(listing, cells, SheetSourceOptions(add_names=True))
    return rows.select(
        F.col("sheet").alias("priority"), F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"), "o_orderstatus", "o_totalprice",
        F.date_format("day", "yyyy-MM-dd").alias("day"), F.unix_millis("moment").alias("moment_ms"),
    )


ROUND_TRIP = """
SELECT o_orderpriority AS priority, o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS day, epoch_us(o_orderdate) // 1000 AS moment_ms FROM orders
"""

def flushed_offsets(spark, sf_dir) -> DataFrame:
    """The parts as a stream, flushed to sheets; where each record went."""
    parts = _parts(spark, sf_dir)
    source, out = shared_folder(spark, "parts"), shared_folder(spark, "sheets")
    parts.write.parquet(source)
    stream = spark.readStream.schema(parts.schema).parquet(source)
    query = flush_sheets(stream, _ROUTED, ["p_partkey"], out, shared_folder(spark, "flush"), available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return read_runs(spark, out, "grid_records").select(
        "p_partkey", "sheet_name", "n_rows", "first_row", "is_first", "batch_no"
    )


QUERIES = {
    "flushed_offsets": (flushed_offsets, SHEET_ROW_OFFSETS),
    "flatten_arrays": (flatten_arrays, FLATTEN_ARRAYS),
    "flatten_merges": (flatten_merges, FLATTEN_MERGES),
    "flatten_structs": (flatten_structs, FLATTEN_STRUCTS),
    "flatten_vectors": (flatten_vectors, FLATTEN_VECTORS),
    "cell_encoding": (cell_encoding, CELL_ENCODING),
    "target_routing": (target_routing, TARGET_ROUTING),
    "header_rows": (header_rows, HEADER_ROWS),
    "header_merges": (header_merges, HEADER_MERGES),
    "sheet_row_offsets": (sheet_row_offsets, SHEET_ROW_OFFSETS),
    "line_offsets": (line_offsets, LINE_OFFSETS),
    "sheet_sizes": (sheet_sizes, SHEET_SIZES),
    "sheet_batches": (sheet_batches, SHEET_BATCHES),
    "update_batches": (update_batches, UPDATE_BATCHES),
    "written_cells": (written_cells, WRITTEN_CELLS),
    "written_merges": (written_merges, WRITTEN_MERGES),
    "round_trip": (round_trip, ROUND_TRIP),
}
