"""The driver's tables as files, sheets, cells and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldergrid.functions import date_to_serial, time_to_serial, timestamp_to_serial
from foldergrid.model import CELL_FIELDS, FOLDER_MIME, NATIVE_MIMES
from foldergrid.session import use_defaults

# the moment every "now" stands for
NOW = "2019-09-19 19:52:13.456"
PART_BYTES = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_defaults(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


# ---------------------------------------------------------------- files
def _catalogue(documents: DataFrame) -> DataFrame:
    created = F.timestamp_seconds(F.lit(1514764800) + F.col("doc_id") * 43200)  # 2018-01-01 + 12 h each
    return documents.select(
        F.concat(F.lit("doc-"), "doc_id").alias("id"),
        F.concat(F.lit("doc-"), "doc_id", F.lit(".txt")).alias("name"),
        F.octet_length("text").cast("bigint").alias("size"),
        F.array("lang").alias("parents"),
        created.alias("createdTime"),
        F.timestamp_seconds(F.unix_seconds(created) + F.col("n_chars") * 60).alias("modifiedTime"),
        (F.col("n_chars") > 2000).alias("starred"),
        F.lit(False).alias("trashed"),
        F.col("source"),
        F.encode("text", "UTF-8").alias("body"),
        F.col("doc_id"), F.col("lang"), F.col("n_chars"),
    )


def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a plain text file."""
    return _catalogue(table(spark, sf_dir, "documents")).withColumn("mimeType", F.lit("text/plain"))


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as an HTML file."""
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), "page_id").alias("id"),
        F.lit("text/html").alias("mimeType"),
        F.octet_length("html").cast("bigint").alias("size"),
        F.encode("html", "UTF-8").alias("body"),
    )


def both_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["id", "mimeType", "size", "body"]
    return text_files(spark, sf_dir).select(*columns).unionByName(page_files(spark, sf_dir))


# what the documents of a source are stored as; sources not named here hold plain text
KINDS = {
    "src0": NATIVE_MIMES["documents"], "src1": NATIVE_MIMES["spreadsheets"], "src2": NATIVE_MIMES["drawings"],
    "src3": NATIVE_MIMES["presentations"], "src4": NATIVE_MIMES["appsScripts"],
    "src5": "application/vnd.google-apps.form", "src6": FOLDER_MIME,
}


def mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a MIME type by their source; native files have no size and no body."""
    files = _catalogue(table(spark, sf_dir, "documents"))
    mime = F.lit("text/plain")
    for source, kind in KINDS.items():
        mime = F.when(F.col("source") == source, F.lit(kind)).otherwise(mime)
    stored = mime == F.lit("text/plain")
    return (
        files.withColumn("mimeType", mime)
        .withColumn("size", F.when(stored, F.col("size")))
        .withColumn("body", F.when(stored, F.col("body")))
    )


FILES_SQL = """
WITH catalogue AS (
  SELECT doc_id, lang, source, n_chars, text,
         'doc-' || doc_id AS id, 'doc-' || doc_id || '.txt' AS name,
         octet_length(encode(text))::BIGINT AS bytes,
         TIMESTAMP '2018-01-01' + to_hours(12 * doc_id) AS created,
         TIMESTAMP '2018-01-01' + to_hours(12 * doc_id) + to_minutes(n_chars) AS modified
  FROM documents),
files AS (
  SELECT *, CASE source """ + " ".join(f"WHEN '{s}' THEN '{k}'" for s, k in KINDS.items()) + """
            ELSE 'text/plain' END AS mime,
         CASE WHEN source IN (""" + ", ".join(f"'{s}'" for s in KINDS) + """) THEN NULL ELSE bytes END AS size
  FROM catalogue)
"""


# ---------------------------------------------------------------- cells
def cell(
    col: int | str,
    formatted: str = "NULL",
    num: str = "NULL",
    flag: str = "NULL",
    fmt: str | None = None,
    non_empty: str = "true",
) -> str:
    """SQL of one cell; text unless a number or a flag is given."""
    text = formatted if num == flag == "NULL" else "NULL"
    values = {
        "formatted": formatted, "eff_num": num, "eff_bool": flag, "user_num": num, "user_str": text,
        "user_bool": flag, "user_formula": "NULL", "num_format": f"'{fmt}'" if fmt else "NULL", "non_empty": non_empty,
    }
    fields = [f"'{name}', CAST({values[name]} AS {kind})" for name, kind in CELL_FIELDS.items()]
    return f"named_struct('col_idx', CAST({col} AS int), {', '.join(fields)})"


def number_cell(col: int, value: str, fmt: str | None = None) -> str:
    return cell(col, f"CAST(floor({value}) AS string)", value, fmt=fmt)


def in_sheets(df: DataFrame, key: str, first_row: int, rows_per_sheet: int, sheets_per_book: int = 4) -> DataFrame:
    """Place rows by their dense key: books of sheets of `rows_per_sheet` keys, with a blank
    row after every ten rows. Grid positions are an expression of the key."""
    place = F.col(key) % rows_per_sheet
    sheet = F.floor(F.col(key) / rows_per_sheet)
    return df.withColumns(
        {
            "spreadsheet_id": F.concat(F.lit("book-"), F.floor(sheet / sheets_per_book)),
            "sheet_id": (sheet % sheets_per_book).cast("bigint"),
            "row_idx": (F.lit(first_row) + place + F.floor(place / 10)).cast("bigint"),
        }
    )


def place_sql(key: str, first_row: int, rows_per_sheet: int, sheets_per_book: int = 4) -> str:
    """The same placement in SQL."""
    return (
        f"'book-' || ({key} // {rows_per_sheet} // {sheets_per_book}) AS spreadsheet_id, "
        f"({key} // {rows_per_sheet}) % {sheets_per_book} AS sheet_id, "
        f"{first_row} + {key} % {rows_per_sheet} + ({key} % {rows_per_sheet}) // 10 AS row_idx"
    )


def long_cells(df: DataFrame, *cells: str) -> DataFrame:
    return df.selectExpr("spreadsheet_id", "sheet_id", "row_idx", f"inline_outer(array({', '.join(cells)}))")


def sheet_list(placed: DataFrame, rows: int, columns: int) -> DataFrame:
    """The sheets that hold any row of `placed`."""
    return placed.select("spreadsheet_id", "sheet_id").distinct().select(
        "spreadsheet_id",
        F.concat(F.lit("Book "), F.substring("spreadsheet_id", 6, 20)).alias("spreadsheet_name"),
        "sheet_id",
        F.col("sheet_id").cast("int").alias("sheet_index"),
        F.concat(F.lit("sheet "), "sheet_id").alias("sheet_title"),
        F.lit(rows).cast("bigint").alias("row_count"),
        F.lit(columns).alias("col_count"),
    )


def title_cells(sheets: DataFrame, row: int, titles: list[str | None]) -> DataFrame:
    """A row of titles in every sheet."""
    cells = [cell(i, f"'{t}'") for i, t in enumerate(titles) if t is not None]
    return long_cells(sheets.withColumn("row_idx", F.lit(row).cast("bigint")), *cells)


EVENT_TITLES = ["event_id", "ts", "clock", "user", "kind", "value", "high"]
EVENT_ROWS = 1000                 # per sheet
EVENT_GRID_ROWS = 1 + 1000 + 100  # title row, rows, blanks


def event_grid(spark: SparkSession, sf_dir: str):
    """(sheets, cells) of the events: one title row, seven typed columns."""
    placed = in_sheets(table(spark, sf_dir, "events"), "event_id", 1, EVENT_ROWS)
    ts = F.date_trunc("MILLISECOND", "ts")
    events = placed.withColumns(
        {
            "ts_serial": timestamp_to_serial(ts),
            "time_serial": time_to_serial(F.pmod(F.unix_micros(ts), F.lit(86_400_000_000))),
        }
    )
    cells = long_cells(
        events,
        number_cell(0, "event_id"),
        number_cell(1, "ts_serial", "DATE_TIME"),
        number_cell(2, "time_serial", "TIME"),
        number_cell(3, "user_id"),
        cell(4, "event_type"),
        number_cell(5, "value"),
        cell(6, "upper(CAST(value > 50 AS string))", flag="value > 50"),
    )
    sheets = sheet_list(placed, EVENT_GRID_ROWS, 7)
    return sheets, cells.unionByName(title_cells(sheets, 0, EVENT_TITLES))


ORDER_ROWS = 1000
ORDER_GRID_ROWS = 2 + 1000 + 100
ORDER_TITLES = ["order", None, "status", "total price", "placed", None]
ORDER_SUBTITLES = ["key", "customer", "unused", "unused", "day", "9th"]
ORDER_MERGES = [(0, 1, 0, 2), (0, 1, 4, 6), (0, 2, 2, 3)]


def order_grid(spark: SparkSession, sf_dir: str):
    """(sheets, cells, merges) of the orders: two title rows, two column groups."""
    placed = in_sheets(table(spark, sf_dir, "orders"), "o_orderkey", 2, ORDER_ROWS)
    orders = placed.withColumn("day_serial", date_to_serial(F.col("o_orderdate").cast("date")))
    cells = long_cells(
        orders,
        number_cell(0, "o_orderkey"),
        number_cell(1, "o_custkey"),
        cell(2, "o_orderstatus"),
        number_cell(3, "o_totalprice"),
        number_cell(4, "day_serial", "DATE"),
        cell(5, "o_orderpriority"),
    )
    sheets = sheet_list(placed, ORDER_GRID_ROWS, 6)
    cells = cells.unionByName(title_cells(sheets, 0, ORDER_TITLES)).unionByName(
        title_cells(sheets, 1, ORDER_SUBTITLES)
    )
    ranges = ", ".join(
        f"named_struct('start_row', {a}L, 'end_row', {b}L, 'start_col', {c}, 'end_col', {d})"
        for a, b, c, d in ORDER_MERGES
    )
    return sheets, cells, sheets.selectExpr("spreadsheet_id", "sheet_id", f"inline(array({ranges}))")


CUSTOMER_ROWS = 500
CUSTOMER_TITLES = ["id", "name", "balance", "segment"]
CUSTOMER_GRID_ROWS = 3 + 500 + 50 + 2  # two metadata rows, titles, rows with blanks, footer


def customer_grid(spark: SparkSession, sf_dir: str):
    """(sheets, cells) of the customers: metadata rows above the titles and below the data."""
    customers = in_sheets(table(spark, sf_dir, "customer"), "c_custkey", 3, CUSTOMER_ROWS)
    cells = long_cells(
        customers,
        number_cell(0, "c_custkey"),
        cell(1, "c_name"),
        number_cell(2, "c_acctbal"),
        cell(3, "c_mktsegment"),
    )
    sheets = sheet_list(customers, CUSTOMER_GRID_ROWS, 4)
    footer = CUSTOMER_GRID_ROWS - 2
    meta = [
        f"named_struct('row_idx', {row}L, 'cell', {cell(col, text)})"
        for row, col, text in (
            (0, 0, "'book'"), (0, 1, "spreadsheet_name"), (1, 0, "'sheet'"), (1, 1, "sheet_title"),
            (footer, 0, "'end'"), (footer, 3, "concat('of ', sheet_title)"),
        )
    ]
    found = sheets.selectExpr("spreadsheet_id", "sheet_id", f"inline(array({', '.join(meta)}))").select(
        "spreadsheet_id", "sheet_id", "row_idx", "cell.*"
    )
    return sheets, cells.unionByName(found).unionByName(title_cells(sheets, 2, CUSTOMER_TITLES))


def conversation_grid(spark: SparkSession, sf_dir: str):
    """(sheets, cells, merges): the name of a conversation stands once, merged down its turns
    and across two columns; role and text of each turn follow.

    Conversations that open with a system turn have an empty head.
    """
    turns = table(spark, sf_dir, "conversations")
    rows = turns.withColumns(
        {
            "spreadsheet_id": F.concat(F.lit("book-"), F.floor(F.col("conv_id") / 100)),
            "sheet_id": F.floor(F.col("conv_id") / 20) % 5,
            "row_idx": F.col("conv_id") % 20 * 1_000_000_000 + F.col("turn"),
        }
    )
    cells = long_cells(rows, cell(1, "role"), cell(2, "role"), cell(3, "text"))
    spans = rows.groupBy("spreadsheet_id", "sheet_id", "conv_id").agg(
        F.min("row_idx").alias("start_row"),
        (F.max("row_idx") + 1).alias("end_row"),
        F.max(F.col("role") == "system").alias("opened_by_system"),
    )
    heads = long_cells(
        spans.withColumn("row_idx", F.col("start_row")),
        cell(
            0, "CASE WHEN NOT opened_by_system THEN concat('conversation ', conv_id) END",
            non_empty="NOT opened_by_system",
        ),
    )
    merges = spans.select(
        "spreadsheet_id", "sheet_id", "start_row", "end_row", F.lit(0).alias("start_col"), F.lit(2).alias("end_col")
    )
    sheets = sheet_list(rows, 20_000_000_000, 4)
    return sheets, cells.unionByName(heads), merges
