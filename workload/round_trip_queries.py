"""Sinks, streams and listings run more than once and read back; groups that are null or large."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldergrid.model import FileSourceOptions, SheetSinkOptions
from foldergrid.operators.flatten import non_trivial_merges
from foldergrid.operators.layout import Running, running_totals
from foldergrid.session import cut_lineage, shared_folder
from foldergrid.sinks.files import write_files
from foldergrid.sinks.sheets import Layout, page_cells, place, update_documents, write_sheets
from foldergrid.sources.folder import list_folder, read_parts
from foldergrid.streaming.flush import flush_sheets
from foldergrid.streaming.ingest import ingest_new_files, read_ingested
from foldergrid.streaming.runs import read_runs
from workload.sink_queries import _ROUTED, _SKIPPED, SHEET_ROW_OFFSETS, WRITTEN_CELLS, _parts
from workload.tables import table

_TOKEN = r" \([0-9a-f]{32}\)"

# names with separators, empty, hidden, like a staging folder, and used by many
_NAME_SQL = """CASE item_id % 6 WHEN 0 THEN concat('a/', item_id % 12) WHEN 1 THEN '' WHEN 2 THEN concat('_staging_', item_id, '.txt')
  WHEN 3 THEN 'same.txt' WHEN 4 THEN concat('a_', (item_id - 4) % 12) ELSE concat('.', item_id) END"""


def repeated_file_names(spark, sf_dir) -> DataFrame:
    """Two runs of the file sink into one folder: every record is a file of its own."""
    rows = table(spark, sf_dir, "benchmark").select(
        F.expr(_NAME_SQL).alias("name"), F.lit("text/plain").alias("mimeType"), F.encode("text", "UTF-8").alias("body")
    )
    folder = shared_folder(spark, "names")
    for _ in range(2):
        write_files(rows, folder)
    parts = read_parts(list_folder(spark, folder))
    return parts.select(F.regexp_replace("name", _TOKEN, " (+)").alias("name"), "size", F.md5("body").alias("body_md5"))


REPEATED_FILE_NAMES = f"""
WITH n AS (SELECT {_NAME_SQL} AS name, text FROM benchmark),
f AS (SELECT CASE WHEN name = '' THEN 'unnamed' ELSE replace(name, '/', '_') END AS file, text FROM n),
c AS (SELECT *, count(*) OVER (PARTITION BY file) AS uses FROM f),
runs AS (SELECT c.*, run, uses > 1 OR run = 1 AS suffixed FROM c, range(2) r(run)),
e AS (SELECT *, regexp_extract(file, '^.+?(\\.[^.]*)?$', 1) AS ending FROM runs)
SELECT CASE WHEN suffixed THEN substr(file, 1, length(file) - length(ending)) || ' (+)' || ending ELSE file END AS name,
       octet_length(encode(text))::BIGINT AS size, md5(text) AS body_md5 FROM e
"""


def nested_listing(spark, sf_dir) -> DataFrame:
    """A tree three levels deep, listed level by level."""
    items = table(spark, sf_dir, "benchmark").withColumn("level", F.col("item_id") % 3)
    root = shared_folder(spark, "tree")
    for level, below in enumerate(("", "/b", "/b/c")):
        rows = items.where(F.col("level") == level).select(
            F.concat(F.lit("item "), "item_id").alias("name"), F.lit(None).cast("string").alias("mimeType"), F.encode("text", "UTF-8").alias("body")
        )
        write_files(rows, f"{root}{below}")
    return list_folder(spark, root, recursive=True).select("name", "size", F.substring(F.col("parents")[0], len(root) + 1, 100).alias("parent"))


NESTED_LISTING = """
SELECT 'item ' || item_id AS name, octet_length(encode(text))::BIGINT AS size,
       CASE item_id % 3 WHEN 0 THEN '' WHEN 1 THEN '/b' ELSE '/b/c' END AS parent FROM benchmark
"""


def ingested_runs(spark, sf_dir) -> DataFrame:
    """Four runs over a folder that grows between the first and the third; the others find nothing new."""
    items = table(spark, sf_dir, "benchmark")
    folder, out = shared_folder(spark, "inbox"), shared_folder(spark, "ingested")
    options = FileSourceOptions(folder=folder, properties=("name",))
    for half in (0, 1):
        write_files(items.where(F.col("item_id") % 2 == half).select(
            F.concat(F.lit("item-"), "item_id").alias("name"), F.lit(None).cast("string").alias("mimeType"), F.encode("text", "UTF-8").alias("body")
        ), folder)
        for _ in range(2):
            ingest_new_files(spark, folder, out, options)
    return read_ingested(spark, out).select("name", F.md5("body").alias("body_md5"), F.col("run").cast("int").alias("run"))


INGESTED_RUNS = """
SELECT 'item-' || item_id AS name, md5(text) AS body_md5, CAST(2 * (item_id % 2) AS INTEGER) AS run FROM benchmark
"""


def flushed_twice(spark, sf_dir) -> DataFrame:
    """The parts in two flushes: the second goes on where the first ended, sheet by sheet."""
    parts = _parts(spark, sf_dir)
    half = parts.agg(F.max("p_partkey")).first()[0] // 2
    source, out, checkpoint = (shared_folder(spark, name) for name in ("halves", "sheets", "flush"))
    for own in (F.col("p_partkey") <= half, F.col("p_partkey") > half):
        parts.where(own).write.mode("append").parquet(source)
        stream = spark.readStream.schema(parts.schema).parquet(source)
        query = flush_sheets(stream, _ROUTED, ["p_partkey"], out, checkpoint, available_now=True)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return read_runs(spark, out, "grid_records").select("p_partkey", "sheet_name", "n_rows", "first_row", "is_first")


FLUSHED_TWICE = f"SELECT p_partkey, sheet_name, n_rows, first_row, is_first FROM ({SHEET_ROW_OFFSETS})"


def sheets_read_back(spark, sf_dir) -> DataFrame:
    """The cells that the sheet sink has written."""
    path = shared_folder(spark, "written")
    write_sheets(_parts(spark, sf_dir), _SKIPPED, ["p_partkey"], path)
    return spark.read.parquet(f"{path}/grid_cells").select("sheet_name", "row_idx", "col_idx", "user_num", "user_str")


def clustered_pages(spark, sf_dir) -> DataFrame:
    """Orders written as clustered sheets, and the pages that their rows are in by the filter of a page."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("priority"))
    options = SheetSinkOptions(spreadsheet_name="orders", sheet_field="priority", skip_name_fields=True)
    path = shared_folder(spark, "clustered")
    write_sheets(orders, options, ["o_orderkey"], path, clustered=True)
    cells = spark.read.parquet(f"{path}/grid_cells")
    sheets = [r["sheet_name"] for r in spark.read.parquet(f"{path}/grid_sheets").orderBy("sheet_name").collect()]
    pages = [page_cells(cells, "orders", sheet, 11 * (i + 1), 10) for i, sheet in enumerate(sheets)]
    return reduce(DataFrame.unionByName, pages).select("sheet_name", "row_idx", "col_idx", "user_num")


CLUSTERED_PAGES = """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority AS sheet_name, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS row_idx,
                  dense_rank() OVER (ORDER BY o_orderpriority) AS i FROM orders)
SELECT sheet_name, row_idx, c::INT AS col_idx, CASE c WHEN 0 THEN o_orderkey ELSE o_custkey END::DOUBLE AS user_num
FROM o, range(2) r(c) WHERE row_idx BETWEEN 11 * i - 1 AND 11 * i + 8
"""


def null_group_offsets(spark, sf_dir) -> DataFrame:
    """Running quantities where the largest group has no name."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.expr("nullif(l_returnflag, 'N')").alias("flag"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.col("l_quantity").cast("bigint").alias("n_rows"),
    )
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "n_rows"]
    return running_totals(lines, [Running("offset", ("flag",), "n_rows")], order).select("flag", *order, "offset")


NULL_GROUP_OFFSETS = """
WITH l AS (SELECT nullif(l_returnflag, 'N') AS flag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                  CAST(l_quantity AS BIGINT) AS n_rows FROM lineitem)
SELECT *, coalesce(sum(n_rows) OVER (PARTITION BY flag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, n_rows
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM l
"""


_LARGE = SheetSinkOptions(spreadsheet_name="customers", merge_data_cells=True, max_buffer=3, max_batch_rows=1000)


def large_record_batches(spark, sf_dir) -> DataFrame:
    """Update documents of records of hundreds of rows: cut only past the limit, merges last."""
    orders = table(spark, sf_dir, "orders").groupBy(F.floor(F.col("o_custkey") / 50).alias("block")).agg(
        F.array_sort(F.collect_list("o_orderkey")).alias("orders")
    )
    layout = Layout.of(orders.schema, _LARGE)
    documents = update_documents(cut_lineage(place(orders, _LARGE, ["block"])), layout, _LARGE)
    return documents.select("batch_no", "part_no", "n_rows", F.col("n_merges").cast("bigint").alias("n_merges"))


LARGE_RECORD_BATCHES = """
WITH r AS (SELECT o_custkey // 50 AS block, count(*) AS n FROM orders GROUP BY 1),
k AS (SELECT *, (row_number() OVER (ORDER BY block) - 1) // 3 AS batch_no, row_number() OVER (ORDER BY block) = 1 AS is_first FROM r),
o AS (SELECT *, n + is_first::INT AS taken,
             coalesce(sum(n + is_first::INT) OVER (PARTITION BY batch_no ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
             sum(n + is_first::INT) OVER (PARTITION BY batch_no)::BIGINT AS total FROM k),
rows AS (SELECT batch_no, (before + unnest(range(0, taken::BIGINT))) // 1000 AS part_no FROM o),
merges AS (SELECT batch_no, (total - 1) // 1000 AS part_no, count(*) AS n_merges FROM o WHERE n > 1 GROUP BY ALL)
SELECT batch_no, part_no, count(*) AS n_rows, coalesce(any_value(n_merges), 0)::BIGINT AS n_merges
FROM rows LEFT JOIN merges USING (batch_no, part_no) GROUP BY batch_no, part_no
"""


def joined_ranges(spark, sf_dir) -> DataFrame:
    """Ranges of the turns of each speaker, of which those of a single cell join nothing."""
    turns = table(spark, sf_dir, "conversations")
    ranges = turns.groupBy("conv_id", "role").agg(
        F.min("turn").alias("start_row"), (F.min("turn") + F.count(F.lit(1))).alias("end_row"),
        F.lit(0).alias("start_col"), F.max(F.when(F.col("role") == "system", 0).otherwise(1)).alias("end_col"),
    )
    return non_trivial_merges(ranges)


JOINED_RANGES = """
SELECT conv_id, role, min(turn) AS start_row, min(turn) + count(*) AS end_row, 0 AS start_col, 1 AS end_col
FROM conversations WHERE role <> 'system' GROUP BY conv_id, role HAVING count(*) > 1
"""


QUERIES = {
    "repeated_file_names": (repeated_file_names, REPEATED_FILE_NAMES),
    "nested_listing": (nested_listing, NESTED_LISTING),
    "ingested_runs": (ingested_runs, INGESTED_RUNS),
    "flushed_twice": (flushed_twice, FLUSHED_TWICE),
    "clustered_pages": (clustered_pages, CLUSTERED_PAGES),
    "sheets_read_back": (sheets_read_back, WRITTEN_CELLS),
    "null_group_offsets": (null_group_offsets, NULL_GROUP_OFFSETS),
    "large_record_batches": (large_record_batches, LARGE_RECORD_BATCHES),
    "joined_ranges": (joined_ranges, JOINED_RANGES),
}
