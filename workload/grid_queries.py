"""Sheets, headers, merges and rows."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldergrid.functions import column_letters
from foldergrid.model import SheetSourceOptions
from foldergrid.operators.headers import (
    Header,
    cell_type,
    default_headers,
    duplicate_titles,
    resolve_headers,
    schema_mismatches,
)
from foldergrid.operators.lookup import lookup_join
from foldergrid.operators.merges import fill_merged_cells
from foldergrid.operators.rows import build_rows, rows_from_arrays
from foldergrid.operators.selection import missing_sheets, read_chunks, read_progress, sample_rows, select_sheets
from foldergrid.operators.sheetmeta import address_table, sheet_metadata
from foldergrid.plans.sheet_source import read_sheets
from foldergrid.session import shared_folder
from foldergrid.sinks.files import file_rows, write_files
from foldergrid.sources.documents import cells_of, documents_from_text, merges_of, row_arrays_of, sheets_of
from foldergrid.sources.large_documents import read_large_documents
from workload import tables as t
from workload.tables import place_sql, table

_KEY = ["spreadsheet_id", "sheet_id"]


# ---------------------------------------------------------------- sheets
def sheet_select(spark, sf_dir) -> DataFrame:
    sheets, cells = t.customer_grid(spark, sf_dir)
    options = SheetSourceOptions(sheets_to_pull="titles", sheet_identifiers=("sheet 0", "sheet 2", "sheet 9"))
    wanted = select_sheets(sheets, options).select(*_KEY)
    return lookup_join(cells, wanted, _KEY, ["row_idx"], "left_semi").select(
        *_KEY, "row_idx", "col_idx", "formatted"
    )


_CUSTOMER_SQL = f"""
WITH placed AS (SELECT *, {place_sql('c_custkey', 3, t.CUSTOMER_ROWS)} FROM customer),
sheets AS (SELECT DISTINCT spreadsheet_id, sheet_id FROM placed)
"""
_LAST = t.CUSTOMER_GRID_ROWS - 2

SHEET_SELECT = _CUSTOMER_SQL + f"""
SELECT spreadsheet_id, sheet_id, row_idx, c::INT AS col_idx,
       CASE c WHEN 0 THEN c_custkey::VARCHAR WHEN 1 THEN c_name WHEN 2 THEN floor(c_acctbal)::BIGINT::VARCHAR
              ELSE c_mktsegment END AS formatted
FROM placed, range(4) r(c) WHERE sheet_id IN (0, 2)
UNION ALL
SELECT spreadsheet_id, sheet_id, r, c, coalesce(v, CASE r WHEN 0 THEN 'Book ' || substr(spreadsheet_id, 6) ELSE 'sheet ' || sheet_id END)
FROM sheets, (VALUES (0, 0, 'book'), (0, 1, NULL), (1, 0, 'sheet'), (1, 1, NULL), {', '.join(f"(2, {i}, '{x}')" for i, x in enumerate(t.CUSTOMER_TITLES))}) h(r, c, v)
WHERE sheet_id IN (0, 2)
UNION ALL
SELECT spreadsheet_id, sheet_id, {_LAST}, c, CASE c WHEN 0 THEN 'end' ELSE 'of sheet ' || sheet_id END
FROM sheets, (VALUES (0), (3)) v(c) WHERE sheet_id IN (0, 2)
"""


def sheet_numbers(spark, sf_dir) -> DataFrame:
    sheets, _ = t.event_grid(spark, sf_dir)
    options = SheetSourceOptions(sheets_to_pull="numbers", sheet_identifiers=(0, 3))
    return select_sheets(sheets, options).select(*_KEY, "spreadsheet_name", "sheet_title")


SHEET_NUMBERS = f"""
SELECT DISTINCT spreadsheet_id, sheet_id, 'Book ' || (event_id // {t.EVENT_ROWS} // 4) AS spreadsheet_name,
       'sheet ' || sheet_id AS sheet_title
FROM (SELECT event_id, {place_sql('event_id', 1, t.EVENT_ROWS)} FROM events) WHERE sheet_id IN (0, 3)
"""


def required_sheets(spark, sf_dir) -> DataFrame:
    """Books of customers without all of four sheets and one that none has."""
    sheets, _ = t.customer_grid(spark, sf_dir)
    options = SheetSourceOptions(
        sheets_to_pull="titles", sheet_identifiers=("sheet 0", "sheet 1", "sheet 2", "sheet 3", "summary")
    )
    return missing_sheets(sheets, options).select("spreadsheet_id", F.array_join("missing", ",").alias("missing"))


REQUIRED_SHEETS = _CUSTOMER_SQL + """
, required(title) AS (VALUES ('sheet 0'), ('sheet 1'), ('sheet 2'), ('sheet 3'), ('summary')),
books AS (SELECT DISTINCT spreadsheet_id FROM sheets)
SELECT b.spreadsheet_id, string_agg(r.title, ',' ORDER BY r.title) AS missing
FROM books b, required r
WHERE NOT EXISTS (SELECT 1 FROM sheets s WHERE s.spreadsheet_id = b.spreadsheet_id AND 'sheet ' || s.sheet_id = r.title)
GROUP BY b.spreadsheet_id
"""


def paged_reads(spark, sf_dir) -> DataFrame:
    """Pages of 128 rows over every sheet of the orders."""
    sheets, _, _ = t.order_grid(spark, sf_dir)
    options = SheetSourceOptions(read_buffer_rows=128)
    return read_chunks(sheets, options, 2).select(*_KEY, "first_row", "n_rows")


PAGED_READS = f"""
WITH sheets AS (SELECT DISTINCT spreadsheet_id, sheet_id FROM (SELECT {place_sql('o_orderkey', 2, t.ORDER_ROWS)} FROM orders))
SELECT spreadsheet_id, sheet_id, f AS first_row, least(128, {t.ORDER_GRID_ROWS} - f + 1) AS n_rows
FROM (SELECT spreadsheet_id, sheet_id, unnest(range(3, {t.ORDER_GRID_ROWS} + 1, 128)) AS f FROM sheets)
"""


# ---------------------------------------------------------------- headers
def header_resolution(spark, sf_dir) -> DataFrame:
    _, cells, merges = t.order_grid(spark, sf_dir)
    return resolve_headers(cells, merges, SheetSourceOptions())


HEADER_RESOLUTION = f"""
WITH sheets AS (SELECT DISTINCT spreadsheet_id, sheet_id FROM (SELECT {place_sql('o_orderkey', 2, t.ORDER_ROWS)} FROM orders)),
h(col_index, title, sub_index, sub_title, data_col, type) AS (VALUES
  (0, 'order', 0, 'key', 0, 'double'), (0, 'order', 1, 'customer', 1, 'double'),
  (2, 'status', NULL, NULL, 2, 'string'), (3, 'D', NULL, NULL, 3, 'double'),
  (4, 'placed', 0, 'day', 4, 'date'), (4, 'placed', 1, 'F', 5, 'string'))
SELECT spreadsheet_id, sheet_id, h.* FROM sheets, h
"""


def type_inference(spark, sf_dir) -> DataFrame:
    """Types implied by every cell of the events, not by a sample row only."""
    _, cells = t.event_grid(spark, sf_dir)
    return (
        cells.where("row_idx > 0")
        .groupBy("col_idx", cell_type("formatted").alias("formatted_type"), cell_type().alias("value_type"))
        .agg(F.count(F.lit(1)).alias("cells"))
    )


TYPE_INFERENCE = """
SELECT c AS col_idx, f AS formatted_type, v AS value_type, n AS cells FROM (SELECT count(*) AS n FROM events),
  (VALUES (0, 'string', 'double'), (1, 'timestamp', 'timestamp'), (2, 'bigint', 'bigint'), (3, 'string', 'double'),
          (4, 'string', 'string'), (5, 'string', 'double'), (6, 'boolean', 'boolean')) t(c, f, v)
"""


def default_column_names(spark, sf_dir) -> DataFrame:
    """A grid without titles: sheets are as wide as the words of their first part's name."""
    parts = t.in_sheets(table(spark, sf_dir, "part"), "p_partkey", 0, 10)
    cells = parts.select(
        *_KEY, "row_idx", F.posexplode(F.split(F.concat_ws(" ", "p_name", "p_type", "p_brand"), "[ #]")).alias("col_idx", "formatted")
    )
    headers = default_headers(cells, SheetSourceOptions(column_names="no_column_names", auto_detect=False, last_column=4, last_row=10))
    return headers.select(*_KEY, "col_index", "title", "type")


DEFAULT_COLUMN_NAMES = f"""
WITH w AS (
  SELECT {place_sql('p_partkey', 0, 10)},
         least(4, len(regexp_split_to_array(p_name || ' ' || p_type || ' ' || p_brand, '[ #]'))) AS width
  FROM part),
f AS (SELECT * FROM w WHERE row_idx = 0)
SELECT spreadsheet_id, sheet_id, c::INT AS col_index, chr((65 + c)::INT) AS title, 'string' AS type
FROM (SELECT *, unnest(range(0, width)) AS c FROM f)
"""


def duplicate_headers(spark, sf_dir) -> DataFrame:
    """Twenty parts make one title row; part types repeat within it."""
    parts = table(spark, sf_dir, "part").select(
        F.concat(F.lit("book-"), F.floor(F.col("p_partkey") / 80)).alias("spreadsheet_id"),
        (F.floor(F.col("p_partkey") / 20) % 4).alias("sheet_id"),
        F.col("p_partkey"), "p_type", "p_brand", "p_size",
    )
    cells = t.long_cells(
        parts.withColumn("row_idx", F.lit(0).cast("bigint")),
        t.cell("p_partkey % 20", "CASE WHEN p_size > 10 THEN p_brand ELSE p_type END"),
    )
    merges = spark.createDataFrame([], "spreadsheet_id string, sheet_id bigint, start_row bigint, end_row bigint, start_col int, end_col int")
    headers = resolve_headers(cells, merges, SheetSourceOptions())
    return duplicate_titles(headers).select(*_KEY, "title", "uses")


DUPLICATE_HEADERS = """
SELECT 'book-' || (p_partkey // 80) AS spreadsheet_id, (p_partkey // 20) % 4 AS sheet_id,
       CASE WHEN p_size > 10 THEN chr((65 + p_partkey % 20)::INT) ELSE p_type END AS title, count(*) AS uses
FROM part GROUP BY ALL HAVING count(*) > 1
"""


def schema_consistency(spark, sf_dir) -> DataFrame:
    """Sheets of orders whose second title names the status of their first order: those that
    differ from the first sheet of their book."""
    orders = t.in_sheets(table(spark, sf_dir, "orders"), "o_orderkey", 1, 100)
    titles = t.long_cells(
        orders.where("row_idx = 1").withColumn("row_idx", F.lit(0).cast("bigint")),
        t.cell(0, "'key'"), t.cell(1, "concat('status_', o_orderstatus)"),
    )
    cells = t.long_cells(orders, t.number_cell(0, "o_orderkey"), t.cell(1, "o_orderpriority")).unionByName(titles)
    merges = spark.createDataFrame([], "spreadsheet_id string, sheet_id bigint, start_row bigint, end_row bigint, start_col int, end_col int")
    return schema_mismatches(resolve_headers(cells, merges, SheetSourceOptions()))


SCHEMA_CONSISTENCY = f"""
WITH h AS (SELECT * FROM (SELECT o_orderstatus AS s, {place_sql('o_orderkey', 1, 100)} FROM orders) WHERE row_idx = 1)
SELECT a.spreadsheet_id, a.sheet_id, b.sheet_id AS expected_sheet_id
FROM h a JOIN (SELECT spreadsheet_id, min(sheet_id) AS sheet_id, arg_min(s, sheet_id) AS s FROM h GROUP BY 1) b
  USING (spreadsheet_id) WHERE a.s <> b.s
"""


# ---------------------------------------------------------------- merges
def merge_fill(spark, sf_dir) -> DataFrame:
    _, cells, merges = t.conversation_grid(spark, sf_dir)
    return fill_merged_cells(cells, merges).select(*_KEY, "row_idx", "col_idx", F.md5("formatted").alias("md5"))


_CONVERSATION_SQL = """
WITH rows AS (
  SELECT *, 'book-' || (conv_id // 100) AS spreadsheet_id, (conv_id // 20) % 5 AS sheet_id,
         conv_id % 20 * 1000000000 + turn AS row_idx FROM conversations),
spans AS (
  SELECT spreadsheet_id, sheet_id, conv_id, min(row_idx) AS a, max(row_idx) AS b, bool_or(role = 'system') AS by_system
  FROM rows GROUP BY ALL)
"""

MERGE_FILL = _CONVERSATION_SQL + """
, cells AS (
  SELECT spreadsheet_id, sheet_id, row_idx, c AS col_idx, CASE WHEN c = 3 THEN text ELSE role END AS formatted
  FROM rows, (VALUES (1), (2), (3)) v(c)
  UNION ALL SELECT spreadsheet_id, sheet_id, a, 0, CASE WHEN by_system THEN NULL ELSE 'conversation ' || conv_id END FROM spans),
heads AS (SELECT * FROM spans WHERE NOT by_system)
SELECT c.spreadsheet_id, c.sheet_id, c.row_idx, c.col_idx, md5(c.formatted) AS md5
FROM cells c LEFT JOIN heads h ON c.spreadsheet_id = h.spreadsheet_id AND c.sheet_id = h.sheet_id
  AND c.row_idx BETWEEN h.a AND h.b AND c.col_idx < 2
WHERE h.conv_id IS NULL
UNION ALL
SELECT spreadsheet_id, sheet_id, r, col, md5('conversation ' || conv_id)
FROM (SELECT *, unnest(range(a, b + 1)) AS r FROM heads), (VALUES (0), (1)) v(col)
"""

_CONVERSATION_HEADERS = [
    Header(0, "name", "string"), Header(1, "name_again", "string"), Header(2, "role", "string"),
    Header(3, "text", "string"),
]


def merged_rows(spark, sf_dir) -> DataFrame:
    """Rows of merged sheets: fills and cells meet in the aggregation that builds the rows."""
    sheets, cells, merges = t.conversation_grid(spark, sf_dir)
    options = SheetSourceOptions(column_names="no_column_names", skip_empty=True)
    rows = read_sheets(sheets, cells, options, merges, _CONVERSATION_HEADERS, keep_keys=True)
    return rows.select(*_KEY, "row_idx", "name", "name_again", "role", F.md5("text").alias("text_md5"))


MERGED_ROWS = _CONVERSATION_SQL + """
SELECT r.spreadsheet_id, r.sheet_id, r.row_idx,
       CASE WHEN NOT by_system THEN 'conversation ' || conv_id END AS name,
       CASE WHEN by_system THEN role ELSE 'conversation ' || conv_id END AS name_again, role, md5(text) AS text_md5
FROM rows r JOIN spans USING (spreadsheet_id, sheet_id, conv_id)
"""


# ---------------------------------------------------------------- rows
def grid_to_rows(spark, sf_dir) -> DataFrame:
    """Events with every row of every sheet, blank ones included; headers are inferred."""
    sheets, cells = t.event_grid(spark, sf_dir)
    rows = read_sheets(sheets, cells, SheetSourceOptions(read_buffer_rows=100), keep_keys=True)
    return rows.select(
        *_KEY, "row_idx", F.col("event_id").cast("bigint").alias("event_id"), F.unix_millis("ts").alias("ts_ms"),
        F.col("clock").alias("clock_ms"), F.col("user").cast("bigint").alias("user_id"), "kind", "value", "high",
    )


def _event_rows(join: str) -> str:
    return f"""
WITH placed AS (SELECT *, {place_sql('event_id', 1, t.EVENT_ROWS)} FROM events),
sheets AS (SELECT DISTINCT spreadsheet_id, sheet_id FROM placed),
spine AS (SELECT spreadsheet_id, sheet_id, unnest(range(1, {t.EVENT_GRID_ROWS})) AS row_idx FROM sheets)
SELECT spreadsheet_id, sheet_id, row_idx, event_id, epoch_us(ts) // 1000 AS ts_ms,
       epoch_us(ts) // 1000 % 86400000 AS clock_ms, user_id, event_type AS kind, value, value > 50 AS high
FROM spine {join} JOIN placed USING (spreadsheet_id, sheet_id, row_idx)
"""


GRID_TO_ROWS = _event_rows("LEFT")


def grid_to_rows_skip_empty(spark, sf_dir) -> DataFrame:
    sheets, cells = t.event_grid(spark, sf_dir)
    rows = read_sheets(sheets, cells, SheetSourceOptions(skip_empty=True), keep_keys=True)
    return rows.select(
        *_KEY, "row_idx", F.col("event_id").cast("bigint").alias("event_id"), F.unix_millis("ts").alias("ts_ms"),
        F.col("clock").alias("clock_ms"), F.col("user").cast("bigint").alias("user_id"), "kind", "value", "high",
    )


GRID_TO_ROWS_SKIP_EMPTY = _event_rows("INNER")


def formatted_rows(spark, sf_dir) -> DataFrame:
    """Numbers as their formatted text, and fewer columns and rows than the sheet has."""
    sheets, cells = t.event_grid(spark, sf_dir)
    options = SheetSourceOptions(
        formatting="formatted", auto_detect=False, last_column=6, last_row=900, skip_empty=True
    )
    return read_sheets(sheets, cells, options, keep_keys=True).select(
        *_KEY, "row_idx", "event_id", F.unix_millis("ts").alias("ts_ms"), F.col("user").alias("user_id"), "kind", "value"
    )


FORMATTED_ROWS = f"""
WITH placed AS (SELECT *, {place_sql('event_id', 1, t.EVENT_ROWS)} FROM events)
SELECT spreadsheet_id, sheet_id, row_idx, event_id::VARCHAR AS event_id, epoch_us(ts) // 1000 AS ts_ms,
       user_id::VARCHAR AS user_id, event_type AS kind, floor(value)::BIGINT::VARCHAR AS value
FROM placed WHERE row_idx < 900
"""


def nested_header_rows(spark, sf_dir) -> DataFrame:
    sheets, cells, merges = t.order_grid(spark, sf_dir)
    rows = read_sheets(sheets, cells, SheetSourceOptions(skip_empty=True), merges, keep_keys=True)
    return rows.select(
        *_KEY, "row_idx", F.col("order.key").cast("bigint").alias("key"),
        F.col("order.customer").cast("bigint").alias("customer"), "status", F.col("D").alias("total"),
        F.date_format("placed.day", "yyyy-MM-dd").alias("day"), F.col("placed.F").alias("priority"),
    )


NESTED_HEADER_ROWS = f"""
SELECT {place_sql('o_orderkey', 2, t.ORDER_ROWS)}, o_orderkey AS key, o_custkey AS customer, o_orderstatus AS status,
       o_totalprice AS total, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority AS priority FROM orders
"""


def wide_rows(spark, sf_dir) -> DataFrame:
    """Embeddings as grids of 64 number columns, built through one map per row."""
    vectors = t.in_sheets(table(spark, sf_dir, "embeddings"), "vec_id", 0, 200)
    cells = vectors.select(*_KEY, "row_idx", F.posexplode("embedding").alias("col_idx", "_v")).select(
        *_KEY, "row_idx", "col_idx",
        *[
            F.col("_v").cast("double").alias(c) if c in ("eff_num", "user_num")
            else F.lit(True).alias(c) if c == "non_empty"
            else F.lit(None).cast("boolean" if c.endswith("bool") else "string").alias(c)
            for c in t_cell_values()
        ],
    )
    headers = [Header(i, f"v{i}", "double") for i in range(64)]
    options = SheetSourceOptions(column_names="no_column_names", skip_empty=True)
    rows = build_rows(cells, headers, options, wide_above=32)
    total = sum((F.col(f"v{i}") * (i + 1) for i in range(1, 64)), F.col("v0"))
    return rows.select(*_KEY, "row_idx", "v0", "v31", "v63", F.round(total, 4).alias("weighted"))


def t_cell_values() -> list[str]:
    from foldergrid.model import CELL_VALUES

    return CELL_VALUES


WIDE_ROWS = f"""
SELECT {place_sql('vec_id', 0, 200)}, embedding[1]::DOUBLE AS v0, embedding[32]::DOUBLE AS v31,
       embedding[64]::DOUBLE AS v63,
       round(list_sum(list_transform(range(1, 65), lambda i: embedding[i]::DOUBLE * i)), 4) AS weighted
FROM embeddings
"""


# ---------------------------------------------------------------- metadata
_META = SheetSourceOptions(
    column_names="custom_row", names_row=3, skip_empty=True, add_names=True, spreadsheet_field="book_name",
    sheet_field="sheet_name", extract_metadata=True, first_header_row=1, last_header_row=2,
    first_footer_row=_LAST + 1, last_footer_row=_LAST + 2,
    metadata_cells=f"A1:B1,A2:B2,A{_LAST + 1}:D{_LAST + 1},C1:D1",
)


def _map_text(column: str):
    entries = F.array_sort(F.map_entries(column))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def sheet_metadata_map(spark, sf_dir) -> DataFrame:
    """The key A2 is named twice: the later pair, whose value cell is absent, counts."""
    _, cells = t.customer_grid(spark, sf_dir)
    options = replace(_META, metadata_cells=_META.metadata_cells + ",A2:C2")
    return sheet_metadata(cells, options).select(*_KEY, _map_text("metadata").alias("metadata"))


SHEET_METADATA_MAP = _CUSTOMER_SQL + """
SELECT spreadsheet_id, sheet_id,
       'book=Book ' || substr(spreadsheet_id, 6) || ',end=of sheet ' || sheet_id || ',sheet=' AS metadata FROM sheets
"""


def add_name_fields(spark, sf_dir) -> DataFrame:
    """Customer rows with book and sheet name in front and the metadata map behind."""
    sheets, cells = t.customer_grid(spark, sf_dir)
    rows = read_sheets(sheets, cells, _META, keep_keys=True)
    return rows.select(
        "row_idx", "book_name", "sheet_name", F.col("id").cast("bigint").alias("id"), "name", "balance", "segment",
        _map_text("metadata").alias("metadata"),
    )


ADD_NAME_FIELDS = _CUSTOMER_SQL + """
SELECT row_idx, 'Book ' || substr(spreadsheet_id, 6) AS book_name, 'sheet ' || sheet_id AS sheet_name,
       c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
       'book=Book ' || substr(spreadsheet_id, 6) || ',end=of sheet ' || sheet_id || ',sheet=sheet ' || sheet_id AS metadata
FROM placed
"""


def metadata_addresses(spark, sf_dir) -> DataFrame:
    """Option texts of two pairs and one entry that is no pair, one text per customer."""
    letters = column_letters(F.col("c_custkey") + 1)
    row = (F.col("c_nationkey") + 1).cast("string")
    text = F.concat(letters, row, F.lit(":B7,AB12:"), letters, F.lit("3,"), letters, row)
    options = table(spark, sf_dir, "customer").select("c_custkey", text.alias("metadata_cells"))
    pairs = address_table(options).drop("metadata_cells")
    return pairs.withColumns(
        {"key_column": F.col("key_column").cast("bigint"), "value_column": F.col("value_column").cast("bigint")}
    )


METADATA_ADDRESSES = """
SELECT c_custkey, c_nationkey + 1 AS key_row, c_custkey + 1 AS key_column, 7 AS value_row, 2::BIGINT AS value_column FROM customer
UNION ALL SELECT c_custkey, 12, 28, 3, c_custkey + 1 FROM customer
"""


# ---------------------------------------------------------------- documents
def _document_texts(spark, sf_dir) -> DataFrame:
    """Customers as spreadsheet documents in JSON, one sheet of at most 100 rows each: the
    first row holds titles, merged over the last two columns; every tenth row is missing."""
    customers = t.in_sheets(table(spark, sf_dir, "customer"), "c_custkey", 1, 100, 1)
    number = lambda c: F.struct(
        F.floor(c).cast("string").alias("formattedValue"),
        F.struct(c.cast("double").alias("numberValue")).alias("effectiveValue"),
        F.struct(c.cast("double").alias("numberValue")).alias("userEnteredValue"),
    )
    text = lambda c: F.struct(
        c.alias("formattedValue"), F.struct(c.alias("stringValue")).alias("effectiveValue"),
        F.struct(c.alias("stringValue")).alias("userEnteredValue"),
    )
    values = F.array(
        F.to_json(number(F.col("c_custkey"))), F.to_json(text(F.col("c_name"))),
        F.to_json(number(F.col("c_acctbal"))),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("{}")).otherwise(F.to_json(text(F.col("c_mktsegment")))),
    )
    row = F.struct(F.col("row_idx"), F.concat(F.lit('{"values":['), F.array_join(values, ","), F.lit("]}")).alias("json"))
    data = customers.groupBy("spreadsheet_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    titles = '{"values":[' + ",".join(
        "{}" if name is None else f'{{"formattedValue":"{name}"}}' for name in ("id", "name", "money", None)
    ) + "]}"
    block = F.transform(
        "rows",
        lambda r: F.concat(F.lit('{"startRow":'), r["row_idx"].cast("string"), F.lit(',"rowData":['), r["json"], F.lit("]}")),
    )
    document = F.concat(
        F.lit('{"spreadsheetId":"'), F.col("spreadsheet_id"), F.lit('","properties":{"title":"T '), F.col("spreadsheet_id"),
        F.lit('"},"sheets":[{"properties":{"sheetId":0,"title":"only","gridProperties":{"rowCount":120,"columnCount":4}},'),
        F.lit('"merges":[{"endRowIndex":1,"startColumnIndex":2,"endColumnIndex":4}],"data":[{"rowData":['), F.lit(titles),
        F.lit("]},"), F.array_join(block, ","), F.lit("]}]}"),
    )
    return data.select(document.alias("json"))


def _documents(spark, sf_dir) -> DataFrame:
    return documents_from_text(_document_texts(spark, sf_dir), "json")


_DOCUMENT_HEADERS = [
    Header(0, "id", "double"), Header(1, "name", "string"), Header(2, "balance", "double"), Header(3, "segment", "string"),
]


def document_rows(spark, sf_dir) -> DataFrame:
    """Rows straight from documents: they arrive whole, so nothing is shuffled to build them."""
    grid = row_arrays_of(_documents(spark, sf_dir))
    options = SheetSourceOptions(skip_empty=True)
    rows = rows_from_arrays(grid, _DOCUMENT_HEADERS, options)
    return rows.select(
        "spreadsheet_id", "row_idx", F.col("id").cast("bigint").alias("id"), "name", "balance", "segment"
    )


DOCUMENT_ROWS = f"""
SELECT spreadsheet_id, row_idx, c_custkey AS id, c_name AS name, c_acctbal AS balance,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment
FROM (SELECT *, {place_sql('c_custkey', 1, 100, 1)} FROM customer)
UNION ALL SELECT DISTINCT spreadsheet_id, 0, NULL::BIGINT, 'name', NULL::DOUBLE, NULL FROM (SELECT {place_sql('c_custkey', 1, 100, 1)} FROM customer)
"""


def document_cells(spark, sf_dir) -> DataFrame:
    """The long cells of documents, per column and emptiness."""
    cells = cells_of(_documents(spark, sf_dir))
    return cells.groupBy("spreadsheet_id", "col_idx", "non_empty").agg(
        F.count(F.lit(1)).alias("cells"), F.count("eff_num").alias("numbers"), F.count("user_str").alias("texts")
    )


DOCUMENT_CELLS = f"""
WITH placed AS (SELECT *, {place_sql('c_custkey', 1, 100, 1)} FROM customer),
cells AS (
  SELECT spreadsheet_id, c, c <> 3 OR c_mktsegment <> 'BUILDING' AS non_empty, c IN (0, 2) AS number, c IN (1, 3) AS text FROM placed, range(4) r(c)
  UNION ALL SELECT DISTINCT spreadsheet_id, c, c <> 3, false, false FROM placed, range(4) r(c))
SELECT spreadsheet_id, c::INT AS col_idx, non_empty, count(*) AS cells,
       count(*) FILTER (WHERE number) AS numbers, count(*) FILTER (WHERE text AND non_empty) AS texts
FROM cells GROUP BY ALL
"""


def document_sheets(spark, sf_dir) -> DataFrame:
    """Sheet listing joined to its merges."""
    documents = _documents(spark, sf_dir)
    listed = sheets_of(documents).join(merges_of(documents), _KEY)
    return listed.select(
        "spreadsheet_id", "spreadsheet_name", "sheet_index", "sheet_title", "row_count",
        "start_row", "end_row", "start_col", "end_col",
    )


DOCUMENT_SHEETS = f"""
SELECT DISTINCT spreadsheet_id, 'T ' || spreadsheet_id AS spreadsheet_name, 0 AS sheet_index, 'only' AS sheet_title,
       120::BIGINT AS row_count, 0::BIGINT AS start_row, 1::BIGINT AS end_row, 2 AS start_col, 4 AS end_col
FROM (SELECT {place_sql('c_custkey', 1, 100, 1)} FROM customer)
"""

def reading_progress(spark, sf_dir) -> DataFrame:
    """How far a read of the filled rows of every event sheet has come: rows, all rows, and their share."""
    sheets, cells = t.event_grid(spark, sf_dir)
    options = SheetSourceOptions(skip_empty=True)
    rows = read_sheets(sheets, cells, options, headers=[Header(0, "event_id", "double")], keep_keys=True)
    return read_progress(rows, sheets, options, 1)


READING_PROGRESS = f"""
WITH placed AS (SELECT *, {place_sql('event_id', 1, t.EVENT_ROWS)} FROM events),
n AS (SELECT spreadsheet_id, sheet_id, count(*) AS rows, {t.EVENT_GRID_ROWS - 1}::BIGINT AS total FROM placed GROUP BY ALL)
SELECT *, rows / total AS share FROM n
"""


def single_rows(spark, sf_dir) -> DataFrame:
    """The title row and two data rows of one sheet, fetched by their numbers."""
    _, cells = t.event_grid(spark, sf_dir)
    rows = sample_rows(cells, {"spreadsheet_id": "book-0", "sheet_id": 0}, [1, 2, 13])
    return rows.groupBy("row_idx").agg(
        F.count(F.lit(1)).alias("cells"), F.max(F.when(F.col("col_idx") == 0, F.col("eff_num"))).alias("number"),
        F.max(F.when(F.col("col_idx") == 4, F.col("formatted"))).alias("kind"),
    )


SINGLE_ROWS = f"""
SELECT row_idx, 7::BIGINT AS cells, event_id::DOUBLE AS number, event_type AS kind
FROM (SELECT *, {place_sql('event_id', 1, t.EVENT_ROWS)} FROM events) WHERE spreadsheet_id = 'book-0' AND sheet_id = 0 AND row_idx IN (1, 12)
UNION ALL SELECT 0, {sum(title is not None for title in t.EVENT_TITLES)}, NULL, '{t.EVENT_TITLES[4]}'
"""

def large_document_cells(spark, sf_dir) -> DataFrame:
    """The same cells from files that are cut at their rows, as documents of any size are."""
    texts = _document_texts(spark, sf_dir).select(F.encode("json", "UTF-8").alias("body"))
    folder = shared_folder(spark, "documents")
    write_files(file_rows(texts), folder)
    cells = read_large_documents(spark, folder).cells()
    return cells.groupBy("spreadsheet_id", "col_idx", "non_empty").agg(
        F.count(F.lit(1)).alias("cells"), F.count("eff_num").alias("numbers"), F.count("user_str").alias("texts"),
        F.sum("row_idx").alias("row_sum"),
    )


LARGE_DOCUMENT_CELLS = DOCUMENT_CELLS.replace("SELECT spreadsheet_id, c, c", "SELECT spreadsheet_id, row_idx, c, c").replace(
    "SELECT DISTINCT spreadsheet_id, c, c", "SELECT DISTINCT spreadsheet_id, 0, c, c").replace("AS texts", "AS texts, sum(row_idx)::BIGINT AS row_sum")

QUERIES = {
    "sheet_select": (sheet_select, SHEET_SELECT),
    "sheet_numbers": (sheet_numbers, SHEET_NUMBERS),
    "required_sheets": (required_sheets, REQUIRED_SHEETS),
    "paged_reads": (paged_reads, PAGED_READS),
    "header_resolution": (header_resolution, HEADER_RESOLUTION),
    "type_inference": (type_inference, TYPE_INFERENCE),
    "default_headers": (default_column_names, DEFAULT_COLUMN_NAMES),
    "duplicate_headers": (duplicate_headers, DUPLICATE_HEADERS),
    "schema_consistency": (schema_consistency, SCHEMA_CONSISTENCY),
    "merge_fill": (merge_fill, MERGE_FILL),
    "merged_rows": (merged_rows, MERGED_ROWS),
    "grid_to_rows": (grid_to_rows, GRID_TO_ROWS),
    "grid_to_rows_skip_empty": (grid_to_rows_skip_empty, GRID_TO_ROWS_SKIP_EMPTY),
    "formatted_rows": (formatted_rows, FORMATTED_ROWS),
    "nested_header_rows": (nested_header_rows, NESTED_HEADER_ROWS),
    "wide_rows": (wide_rows, WIDE_ROWS),
    "sheet_metadata_map": (sheet_metadata_map, SHEET_METADATA_MAP),
    "add_name_fields": (add_name_fields, ADD_NAME_FIELDS),
    "metadata_addresses": (metadata_addresses, METADATA_ADDRESSES),
    "reading_progress": (reading_progress, READING_PROGRESS),
    "single_rows": (single_rows, SINGLE_ROWS),
    "document_rows": (document_rows, DOCUMENT_ROWS),
    "document_cells": (document_cells, DOCUMENT_CELLS),
    "large_document_cells": (large_document_cells, LARGE_DOCUMENT_CELLS),
    "document_sheets": (document_sheets, DOCUMENT_SHEETS),
}
