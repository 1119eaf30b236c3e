"""Spreadsheet documents that are too large for one row: read in blocks of rows.

`spark.read.text` splits a file of any size by byte ranges, and at a separator of the caller's. A document
is cut at its `"values"` keys, which is where the cells of a grid row begin. What stands right before such a key tells
what it is: `]},{` goes on with the next row of the same `rowData` array, `"rowData":[{` opens a new one, and
anything else belongs to a cell (a list of allowed values, say), so that the pieces on either side are one row. These
characters are never part of a string there, since a string would end with a quote before them.

Pieces are numbered in file order by running totals that span tasks. Rows are parsed one by one with `from_json`; what is left of
a document without its rows (properties, merges, where blocks start) is one small document. No task holds more
of a document than a row and that rest, whose size does not grow with the rows.

One document per file. Rows without cells (`{}`) count. A file without any row is its rest alone; text
that is no JSON gives a document of nulls, as it does in `read_documents`.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldergrid.operators.layout import Running, running_totals
from foldergrid.operators.lookup import lookup_join
from foldergrid.session import cut_lineage
from foldergrid.sources.documents import GRID_DDL, cells_of_rows, documents_from_text

KEY = '"values"'
MARK = "#"  # the one cell that stands for the rows of a block in what is left of a document
NEXT_ROW = r"\]([\s,{}]*+)\z"
NEW_BLOCK = r'"rowData"\s*:\s*\[([\s,{}]*+)\z'


@dataclass(frozen=True)
class LargeDocuments:
    """`documents` without their rows, for `sheets_of` and `merges_of`, and `rows` of the grid."""

    documents: DataFrame
    rows: DataFrame

    def cells(self) -> DataFrame:
        """The long cells table, as `cells_of` gives it."""
        return cells_of_rows(self.rows)


def read_large_documents(spark: SparkSession, path: str) -> LargeDocuments:
    pieces = cut_lineage(_pieces(spark, path))
    rows = cut_lineage(_rows(pieces))
    rest = cut_lineage(_rests(rows))
    documents = documents_from_text(rest, "json")
    # the n-th block that has rows, in the order of sheets and blocks, is the n-th that the file opens
    listed = rest.select("file", F.from_json("json", GRID_DDL).alias("_d")).select(
        "file", F.col("_d.spreadsheetId").alias("spreadsheet_id"), F.posexplode("_d.sheets").alias("_at", "_s")
    ).select(
        "file", "spreadsheet_id", "_at", F.coalesce("_s.properties.sheetId", F.lit(0).cast("bigint")).alias("sheet_id"),
        F.posexplode("_s.data").alias("_in", "_b"),
    ).where(F.exists("_b.rowData", lambda row: row["values"].isNotNull())).select(
        "file", "spreadsheet_id", "sheet_id", "_at", "_in",
        F.coalesce("_b.startRow", F.lit(0).cast("bigint")).alias("start_row"), F.coalesce("_b.startColumn", F.lit(0)).alias("_col"),
        F.expr("cast(array_position(transform(_b.rowData, r -> r.values is not null), true) - 1 as bigint)").alias("_leading"),
    )
    numbered = running_totals(listed, [Running("block_no", ("file",), 1)], ["_at", "_in"])
    first = rows.where("row_no > 0").groupBy("file", "block_no").agg(F.min("weight_before").alias("_first"))
    # as many rows as there are blocks on both sides, from files that are small: not to be broadcast by their size
    blocks = numbered.withColumn("block_no", F.col("block_no") + 1).join(first.hint("merge"), ["file", "block_no"])
    placed = lookup_join(rows.where("row_no > 0"), blocks, ["file", "block_no"], ["row_no"], "inner")
    values = F.from_json(F.concat(F.lit("{" + KEY), "text"), "values array<string>")["values"]
    return LargeDocuments(documents, placed.select(
        "spreadsheet_id", "sheet_id", (F.col("start_row") + F.col("_leading") + F.col("weight_before") - F.col("_first")).alias("row_idx"),
        "_col", values.alias("_values"),
    ))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between `"values"` keys, in file order: `opens` a row, `opens_block` of rows, and how many
    rows there are from its own row to the next one with cells (`weight`)."""
    whitespace = " \t\r\n"
    read = spark.read.option("lineSep", KEY).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("text"),
    )
    bare = lambda pattern: F.translate(F.regexp_extract("text", pattern, 1), whitespace, "")
    kinds = read.withColumns({
        "_next": bare(NEXT_ROW), "opens_block": F.col("text").rlike(NEW_BLOCK),
    })
    # } ,{} ,{} ,{ : the end of a row, rows without cells, the start of the next row
    goes_on = F.col("_next").rlike(r"\A\}(,\{\})*+,\{\z")
    return kinds.select(
        "file", "split", "id", "text", "opens_block", (goes_on | F.col("opens_block")).alias("opens"),
        F.when(goes_on, F.floor(F.length("_next") / 3)).when(F.col("opens_block"), 1).otherwise(0).cast("bigint").alias("weight"),
    )


def _rows(pieces: DataFrame) -> DataFrame:
    """A row per grid row with cells (`row_no` from 1) and one for what stands before the first (0): its
    text, the block it is in, the rows before it, and whether it is the last of its block."""
    totals = [Running("row_no", ("file",), "_opens"), Running("block_no", ("file",), "_opens_block"), Running("weight_before", ("file",), "weight")]
    flagged = pieces.withColumns({"_opens": F.col("opens").cast("bigint"), "_opens_block": F.col("opens_block").cast("bigint")})
    numbered = running_totals(flagged, totals, ["split", "id"])
    piece = F.struct("split", "id", "text", "opens", "opens_block")
    return numbered.groupBy("file", "row_no").agg(
        F.max("block_no").alias("block_no"), F.min("weight_before").alias("weight_before"), F.array_sort(F.collect_list(piece)).alias("_pieces")
    ).select(
        "file", "row_no", "block_no", "weight_before",
        F.array_join(F.transform("_pieces", lambda p: p["text"]), KEY).alias("text"),
        (~F.element_at("_pieces", -1)["opens"] | F.element_at("_pieces", -1)["opens_block"]).alias("ends_block"),
    )


def _rests(rows: DataFrame) -> DataFrame:
    """The documents without their rows (file, json): the head, and what follows the last row of each block."""
    def tails(batches):
        decoder = json.JSONDecoder()
        for batch in batches:
            found = []
            for row_no, text in zip(batch.column("row_no").to_pylist(), batch.column("text").to_pylist()):
                if row_no:
                    try:
                        start = len(text) - len(text.lstrip(" \t\r\n:"))
                        text = f'{KEY}:["{MARK}"]' + text[decoder.raw_decode(text, start)[1]:]
                    except ValueError:
                        text = KEY + text
                found.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("row_no"), pa.array(found, pa.string())], names=["file", "row_no", "text"])

    kept = rows.where("row_no = 0 OR ends_block").select("file", "row_no", "text")
    cut = kept.mapInArrow(tails, "file string, row_no bigint, text string")
    parts = F.array_sort(F.collect_list(F.struct("row_no", "text")))
    return cut.groupBy("file").agg(parts.alias("_parts")).select("file", F.array_join(F.transform("_parts", lambda p: p["text"]), "").alias("json"))
