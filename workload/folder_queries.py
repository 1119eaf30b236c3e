"""Folders as a data source: selections, a sink that is cut short, versions of files; buffered flushes."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldergrid.operators.bodies import read_bodies
from foldergrid.operators.catalogue import not_a_folder, of_types
from foldergrid.session import path_exists, shared_folder, shuffle_width
from foldergrid.sinks.files import write_files
from foldergrid.sources.folder_files import FORMAT, read_folder, use_folder_files
from foldergrid.streaming.flush import flush_sheets
from foldergrid.streaming.ingest import stream_versions
from foldergrid.streaming.runs import RunLog, read_runs
from workload.sink_queries import _PARTS_SQL, _ROUTED, _parts
from workload.tables import FILES_SQL, PART_BYTES, mixed_files, table


def _page_files(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.encode("html", "UTF-8").alias("body"), F.lit(None).cast("string").alias("mimeType"),
        F.concat("page_id", F.when(F.col("page_id") % 3 == 0, ".html").when(F.col("page_id") % 3 == 1, ".txt").otherwise("")).alias("name"),
    )


_PAGE_FILES_SQL = """
WITH f AS (SELECT page_id || CASE page_id % 3 WHEN 0 THEN '.html' WHEN 1 THEN '.txt' ELSE '' END AS name, encode(html) AS body FROM pages),
s AS (SELECT *, octet_length(body)::BIGINT AS size FROM f)
"""


def folder_selection(spark, sf_dir) -> DataFrame:
    """Pages written as files and read back by a condition that the listing decides, in 4 KB parts."""
    folder = shared_folder(spark, "pages")
    write_files(_page_files(spark, sf_dir), folder)
    parts = read_folder(
        spark, folder, "mimeType = 'text/html' AND NOT name LIKE '9%' AND size > 300 AND length(name) > 1",
        ["name", "size", "offset", "body"], max_part_bytes=PART_BYTES,
    )
    return parts.select("name", "size", "offset", F.md5("body").alias("part_md5"))


FOLDER_SELECTION = _PAGE_FILES_SQL + f"""
SELECT name, size, o AS "offset", md5(unhex(substr(hex(body), 2 * o + 1, 2 * {PART_BYTES}))) AS part_md5
FROM (SELECT *, unnest(range(0, size, {PART_BYTES})) AS o FROM s WHERE name LIKE '%.html' AND NOT name LIKE '9%' AND size > 300)
"""


def folder_names(spark, sf_dir) -> DataFrame:
    """Names and sizes of all page files: nothing is opened, and one DataFrame serves two selections."""
    folder = shared_folder(spark, "pages")
    use_folder_files(spark)
    _page_files(spark, sf_dir).select("name", "body").write.format(FORMAT).mode("append").save(folder)
    files = read_folder(spark, folder, columns=["name", "mimeType", "size"])
    plain, rest = files.where("mimeType = 'text/plain'"), files.where("mimeType <> 'text/plain'")
    return plain.select("name", "size", F.lit(1).alias("kind")).union(rest.select("name", "size", F.lit(2).alias("kind")))


FOLDER_NAMES = _PAGE_FILES_SQL + """
SELECT name, size, CASE WHEN name LIKE '%.txt' THEN 1 ELSE 2 END AS kind FROM s
"""


def folder_commits(spark, sf_dir) -> DataFrame:
    """A job whose last file cannot be made, then one that can, into one folder: only the second leaves files,
    one per record though all have few names."""
    use_folder_files(spark)
    folder = shared_folder(spark, "commits")
    named = table(spark, sf_dir, "pages").select(
        F.encode("html", "UTF-8").alias("body"), F.concat(F.lit("p"), F.col("page_id") % 7, F.lit(".html")).alias("name")
    )
    last = named.agg(F.max(F.octet_length("body"))).first()[0]
    broken = F.when(F.octet_length("body") == last, F.raise_error(F.lit("not written")).cast("binary")).otherwise(F.col("body"))
    for rows in (named.withColumn("body", broken), named):
        try:
            rows.select("name", "body").write.format(FORMAT).mode("append").save(folder)
        except Exception as failed:
            if "not written" not in str(failed) or path_exists(spark, folder):
                raise
    stem = F.regexp_extract("name", "^(p[0-9])", 1)
    files = read_folder(spark, folder)
    return files.groupBy(stem.alias("stem"), F.md5("body").alias("body_md5")).agg(F.count(F.lit(1)).alias("files"))


FOLDER_COMMITS = """
SELECT 'p' || page_id % 7 AS stem, md5(html) AS body_md5, count(*) AS files FROM pages GROUP BY ALL
"""


def folder_versions(spark, sf_dir) -> DataFrame:
    """A folder as a stream in three batches: files, empty and hidden ones among them, then more files, then changed
    ones. Every version comes once."""
    items = table(spark, sf_dir, "benchmark").select("item_id", F.encode("text", "UTF-8").alias("body"))
    name = F.concat(F.when(F.col("item_id") % 5 == 0, ".").otherwise("f"), "item_id").alias("name")
    empty = F.when(F.col("item_id") % 7 == 0, F.lit(b"")).otherwise(F.col("body"))
    mime = F.lit(None).cast("string").alias("mimeType")
    folder, out, checkpoint = (shared_folder(spark, n) for n in ("inbox", "versions", "checkpoint"))
    steps = [("item_id % 2 = 0", empty), ("item_id % 2 = 1", empty), ("item_id % 3 = 0", F.concat(F.lit(b"again "), "body"))]
    for batch, (own, body) in enumerate(steps):
        time.sleep(0.05)  # a later batch has later times
        rows = items.where(own).select(name, mime, body.alias("body"))
        if batch < 2:
            write_files(rows, folder)
        else:
            rows.select("name", "body").foreachPartition(_rewriter(folder))
        query = stream_versions(spark, folder, settle_ms=0).writeStream.format("parquet").option("checkpointLocation", checkpoint)
        query = query.trigger(availableNow=True).start(out)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return spark.read.parquet(out).select("name", "size", F.md5("body").alias("body_md5"))


def _rewriter(folder: str):
    def rewrite(rows):
        from foldergrid.sources.listing import located

        for row in rows:
            system, path = located(f"{folder}/{row['name']}")
            with system.open_output_stream(path) as out:
                out.write(bytes(row["body"]))

    return rewrite


FOLDER_VERSIONS = """
WITH v AS (
  SELECT item_id, CASE WHEN item_id % 7 = 0 THEN '' ELSE text END AS body FROM benchmark
  UNION ALL SELECT item_id, 'again ' || text FROM benchmark WHERE item_id % 3 = 0)
SELECT CASE WHEN item_id % 5 = 0 THEN '.' ELSE 'f' END || item_id AS name, octet_length(encode(body))::BIGINT AS size, md5(body) AS body_md5 FROM v
"""


def untyped_files(spark, sf_dir) -> DataFrame:
    """Files of which a third have no type: they are binary files, read as they are."""
    files = mixed_files(spark, sf_dir).withColumn("mimeType", F.expr("CASE WHEN doc_id % 3 > 0 THEN mimeType END"))
    chosen = files.where(not_a_folder() & of_types(("binary",)))
    bodies = read_bodies(chosen.select("id", "mimeType", "size", "body"), PART_BYTES)
    return bodies.groupBy("id", "mimeType").agg(F.count(F.lit(1)).alias("parts"), F.sum(F.octet_length("body")).alias("bytes"))


UNTYPED_FILES = FILES_SQL + f"""
SELECT id, CASE WHEN doc_id % 3 > 0 THEN mime END AS "mimeType",
       greatest(1, coalesce((size + {PART_BYTES} - 1) // {PART_BYTES}, 1)) AS parts, size AS bytes
FROM files WHERE doc_id % 3 = 0 OR mime = 'text/plain'
"""


_PER_BUFFER, _BUFFERS = 40, 4


def counted_flushes(spark, sf_dir) -> DataFrame:
    """The parts as a stream into buffers of their sheet: full ones are flushed at once, what is left when its time is up."""
    parts = _parts(spark, sf_dir)
    source, out, checkpoint = (shared_folder(spark, name) for name in ("parts", "sheets", "flush"))
    parts.repartition(shuffle_width(spark)).write.parquet(source)  # all of it is there when the stream starts: one batch
    total = spark.read.parquet(source).count()
    stream = spark.readStream.schema(parts.schema).parquet(source)
    query = flush_sheets(
        stream, _ROUTED, ["p_partkey"], out, checkpoint, interval_seconds=3, max_records=_PER_BUFFER, lane=F.col("p_partkey") % _BUFFERS
    )
    log, full, written = RunLog(spark, out, "flush_id"), -1, 0
    try:
        while written < total:
            if query.exception() is not None:
                raise query.exception()
            time.sleep(0.5)
            last, full = full, log.full(log.last())
            if full > last:  # a flush with records has ended
                written = read_runs(spark, out, "grid_records").count()
    finally:
        # not in the middle of a batch; one that takes longer than the trigger is followed by the next without a
        # pause, so what is waited for is the end of this one
        ended = log.last()
        while query.isActive and query.status["isTriggerActive"] and log.last() == ended:
            time.sleep(0.05)
        query.stop()
    flushed = read_runs(spark, out, "grid_flushes").groupBy("sheet_name", "reason").agg(F.sum("records").alias("records"))
    rows = read_runs(spark, out, "grid_records").groupBy("sheet_name").agg(F.sum("n_rows").alias("n_rows"), F.max(F.col("first_row") + F.col("n_rows")).alias("rows_end"))
    return flushed.join(rows, "sheet_name")


COUNTED_FLUSHES = _PARTS_SQL + f"""
, b AS (SELECT type AS sheet_name, p_partkey % {_BUFFERS} AS lane, count(*) AS n FROM sized GROUP BY ALL),
r AS (
  SELECT sheet_name, 'count' AS reason, sum(n // {_PER_BUFFER} * {_PER_BUFFER})::BIGINT AS records FROM b GROUP BY sheet_name
  UNION ALL SELECT sheet_name, 'time', sum(n % {_PER_BUFFER})::BIGINT FROM b GROUP BY sheet_name),
s AS (SELECT type AS sheet_name, sum(n1 * n2)::BIGINT AS n_rows FROM sized GROUP BY type)
SELECT sheet_name, reason, records, n_rows, n_rows + 1 AS rows_end FROM r JOIN s USING (sheet_name) WHERE records > 0
"""

QUERIES = {
    "folder_selection": (folder_selection, FOLDER_SELECTION),
    "folder_names": (folder_names, FOLDER_NAMES),
    "folder_commits": (folder_commits, FOLDER_COMMITS),
    "folder_versions": (folder_versions, FOLDER_VERSIONS),
    "untyped_files": (untyped_files, UNTYPED_FILES),
    "counted_flushes": (counted_flushes, COUNTED_FLUSHES),
}
