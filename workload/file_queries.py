"""Catalogue, byte ranges, bodies, renditions, metadata, file sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldergrid.functions import RANGE_KINDS
from foldergrid.functions.dates import named_range
from foldergrid.model import FOLDER_MIME, NATIVE_MIMES, NATIVE_PREFIX, FileSourceOptions
from foldergrid.operators.bodies import cut_bodies, export_mime, plan_parts, read_bodies
from foldergrid.operators.catalogue import concat_listings, first_files, is_native, modified_within, select_files
from foldergrid.operators.metadata import project_metadata
from foldergrid.plans.file_source import read_files
from foldergrid.session import shared_folder
from foldergrid.sinks.files import file_rows, write_files
from foldergrid.sources.folder import list_folder, read_parts
from workload.tables import FILES_SQL, NOW, PART_BYTES, both_files, mixed_files, now, page_files, table, text_files


def file_catalog_filter(spark, sf_dir) -> DataFrame:
    options = FileSourceOptions(
        folder="en",
        file_types=("binary", "documents", "spreadsheets"),
        filter="size IS NULL OR size > 1000 OR name LIKE '%7.txt'",
    )
    return select_files(mixed_files(spark, sf_dir), options, now()).select("id", "mimeType", "size")


FILE_CATALOG_FILTER = FILES_SQL + f"""
SELECT id, mime AS "mimeType", size FROM files
WHERE lang = 'en' AND mime <> '{FOLDER_MIME}'
  AND (NOT starts_with(mime, '{NATIVE_PREFIX}')
       OR mime IN ('{NATIVE_MIMES["documents"]}', '{NATIVE_MIMES["spreadsheets"]}'))
  AND (size IS NULL OR size > 1000 OR name LIKE '%7.txt')
"""


def single_file(spark, sf_dir) -> DataFrame:
    files = text_files(spark, sf_dir)
    newest = files.agg(F.max(F.struct("modifiedTime", "id")).alias("m")).first()["m"]["id"]
    options = FileSourceOptions(file_id=newest, filter="size < 0", date_range="today")
    return select_files(files, options, now()).select("id", "name", "size")


SINGLE_FILE = FILES_SQL + """
SELECT id, name, bytes AS size FROM files ORDER BY modified DESC, id DESC LIMIT 1
"""


def first_files_by_name(spark, sf_dir) -> DataFrame:
    files = mixed_files(spark, sf_dir)
    chosen = select_files(files, FileSourceOptions(folder="en", file_types=("binary",)), now())
    return first_files(chosen, 40).select("id", "name", "size")


FIRST_FILES = FILES_SQL + """
SELECT id, name, size FROM files WHERE lang = 'en' AND mime = 'text/plain' ORDER BY name, id LIMIT 40
"""


def listing_groups(spark, sf_dir) -> DataFrame:
    listed = concat_listings(mixed_files(spark, sf_dir), ("binary", "drawings", "presentations", "appsScripts"))
    return listed.groupBy("mimeType").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0).cast("bigint")).alias("bytes")
    )


LISTING_GROUPS = FILES_SQL + f"""
SELECT mime AS "mimeType", count(*) AS files, coalesce(sum(size), 0)::BIGINT AS bytes FROM files
WHERE NOT starts_with(mime, '{NATIVE_PREFIX}')
   OR mime IN ('{NATIVE_MIMES["drawings"]}', '{NATIVE_MIMES["presentations"]}', '{NATIVE_MIMES["appsScripts"]}')
GROUP BY mime
"""

# (start, end) of every kind at NOW, a Thursday
_RANGES = {
    "today": ("2019-09-19", NOW), "yesterday": ("2019-09-18", "2019-09-18 23:59:59.999"),
    "this_week_sun_today": ("2019-09-15", NOW), "this_week_mon_today": ("2019-09-16", NOW),
    "last_week_sun_sat": ("2019-09-08", "2019-09-14 23:59:59.999"),
    "last_week_mon_sun": ("2019-09-09", "2019-09-15 23:59:59.999"),
    "this_month": ("2019-09-01", NOW), "last_month": ("2019-08-01", "2019-08-31 23:59:59.999"),
    "this_quarter": ("2019-07-01", NOW), "last_3d": ("2019-09-16", "2019-09-18 23:59:59.999"),
    "last_7d": ("2019-09-12", "2019-09-18 23:59:59.999"), "last_14d": ("2019-09-05", "2019-09-18 23:59:59.999"),
    "last_28d": ("2019-08-22", "2019-09-18 23:59:59.999"), "last_30d": ("2019-08-20", "2019-09-18 23:59:59.999"),
    "last_90d": ("2019-06-21", "2019-09-18 23:59:59.999"), "this_year": ("2019-01-01", NOW),
    "last_year": ("2018-01-01", "2018-12-31 23:59:59.999"), "lifetime": (None, None),
    "custom": ("2018-03-01", "2018-06-30 12:00:00"),
}


def modified_range_counts(spark, sf_dir) -> DataFrame:
    """Every kind in one pass: two aggregates per kind, turned into rows at the end."""
    custom = [F.lit(t).cast("timestamp") for t in _RANGES["custom"]]
    totals, kinds = [], []
    for kind in RANGE_KINDS:
        start, end = named_range(kind, now(), *custom)
        hit = F.lit(True) if start is None else F.col("modifiedTime").between(start, end)
        totals += [F.count(F.when(hit, 1)).alias(f"n_{kind}"), F.sum(F.when(hit, F.col("size"))).alias(f"b_{kind}")]
        kinds.append(F.struct(F.lit(kind).alias("kind"), F.col(f"n_{kind}").alias("files"), F.col(f"b_{kind}").alias("bytes")))
    return text_files(spark, sf_dir).agg(*totals).select(F.inline(F.array(*kinds))).where("files > 0")


MODIFIED_RANGE_COUNTS = FILES_SQL + ", ranges(kind, a, b) AS (VALUES " + ", ".join(
    f"('{kind}', {'NULL' if a is None else f'TIMESTAMP {a!r}'}, {'NULL' if b is None else f'TIMESTAMP {b!r}'})"
    for kind, (a, b) in _RANGES.items()
) + """)
SELECT kind, count(*) AS files, sum(bytes)::BIGINT AS bytes
FROM files JOIN ranges ON a IS NULL OR modified BETWEEN a AND b GROUP BY kind
"""


def modified_custom_range(spark, sf_dir) -> DataFrame:
    chosen = text_files(spark, sf_dir).where(
        modified_within("custom", now(), "2018-02-01", "2018-12-31T23:30:00-08:00")
    )
    return chosen.select("id", "size", F.unix_millis("modifiedTime").alias("modified_ms"))


MODIFIED_CUSTOM_RANGE = FILES_SQL + """
SELECT id, bytes AS size, epoch_ms(modified) AS modified_ms FROM files
WHERE modified BETWEEN TIMESTAMP '2018-02-01' AND TIMESTAMP '2019-01-01 07:30:00'
"""


def byte_range_splits(spark, sf_dir) -> DataFrame:
    files = both_files(spark, sf_dir).select("id", "mimeType", "size")
    return plan_parts(files, PART_BYTES).select("id", "bytes_from", "bytes_to", "is_partitioned")


_BOTH_SQL = """
WITH both_files AS (
  SELECT 'doc-' || doc_id AS id, encode(text) AS body FROM documents
  UNION ALL SELECT 'page-' || page_id, encode(html) FROM pages),
sized AS (SELECT *, octet_length(body)::BIGINT AS size FROM both_files)
"""

BYTE_RANGE_SPLITS = _BOTH_SQL + f"""
SELECT id, CASE WHEN size > {PART_BYTES} THEN p END AS bytes_from,
       CASE WHEN size > {PART_BYTES} THEN least(size, p + {PART_BYTES}) - 1 END AS bytes_to,
       size > {PART_BYTES} AS is_partitioned
FROM (SELECT id, size, unnest(CASE WHEN size > {PART_BYTES} THEN range(0, size, {PART_BYTES}) ELSE [0] END) AS p
      FROM sized)
"""


def body_parts(spark, sf_dir) -> DataFrame:
    return cut_bodies(both_files(spark, sf_dir), PART_BYTES).select(
        "id", "offset", F.octet_length("body").cast("bigint").alias("bytes"), F.md5("body").alias("part_md5")
    )


BODY_PARTS = _BOTH_SQL + f"""
, parts AS (
  SELECT id, p AS "offset", substr(hex(body), 2 * p + 1, 2 * {PART_BYTES}) AS part
  FROM (SELECT id, body, unnest(CASE WHEN size = 0 THEN [0] ELSE range(0, size, {PART_BYTES}) END) AS p FROM sized))
SELECT id, "offset", (length(part) // 2)::BIGINT AS bytes, md5(unhex(part)) AS part_md5 FROM parts
"""


def body_text(spark, sf_dir) -> DataFrame:
    """Whole bodies as text, of all folders."""
    records = project_metadata(cut_bodies(text_files(spark, sf_dir), 0), ("id",), "string")
    return records.select("id", "offset", F.char_length("body").cast("bigint").alias("chars"), F.md5("body").alias("md5"))


BODY_TEXT = """
SELECT 'doc-' || doc_id AS id, 0::BIGINT AS "offset", length(text)::BIGINT AS chars, md5(text) AS md5
FROM documents
"""


def body_text_parts(spark, sf_dir) -> DataFrame:
    """Parts of 500 bytes as text; a character that a cut divides counts on both sides."""
    records = project_metadata(cut_bodies(text_files(spark, sf_dir), 500), ("id",), "string")
    return records.select("id", "offset", F.char_length("body").cast("bigint").alias("chars"))


# of a character of two bytes a cut leaves one byte on either side, and each reads as U+FFFD
BODY_TEXT_PARTS = """
WITH f AS (SELECT 'doc-' || doc_id AS id, hex(encode(text)) AS h FROM documents),
p AS (SELECT id, o AS "offset", substr(h, 2 * o + 1, 1000) AS h FROM (SELECT *, unnest(range(0, greatest(length(h) // 2, 1), 500)) AS o FROM f)),
n AS (SELECT *, [substr(h, 2 * i + 1, 1) IN ('8', '9', 'A', 'B') for i in range(length(h) // 2)] AS inner_byte FROM p)
SELECT id, "offset", (len(list_filter(inner_byte, lambda b: NOT b)) + coalesce(inner_byte[1], false)::INT)::BIGINT AS chars FROM n
"""

_FORMATS = {"documents": "text/html", "spreadsheets": "text/csv", "drawings": "image/png", "presentations": "text/plain"}


def _renditions(spark, sf_dir) -> DataFrame:
    """Each native file in every format it is asked for and in one nobody asks for."""
    native = mixed_files(spark, sf_dir).where(is_native() & (F.col("mimeType") != FOLDER_MIME))
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    wanted = native.select("id", "doc_id", export_mime(_FORMATS).alias("asked"))
    formats = F.array_compact(F.array("asked", F.lit("application/pdf")))
    return (
        wanted.where(F.col("asked").isNotNull()).join(texts, "doc_id")
        .select("id", "text", F.explode_outer(formats).alias("export_mime"))
        .select("id", "export_mime", F.encode(F.concat("export_mime", F.lit("\n"), "text"), "UTF-8").alias("content"))
    )


def rendition_select(spark, sf_dir) -> DataFrame:
    files = mixed_files(spark, sf_dir).where(F.col("mimeType") != FOLDER_MIME)
    bodies = read_bodies(
        files.select("id", "mimeType", "size", "body"), PART_BYTES, _renditions(spark, sf_dir), _FORMATS
    )
    return bodies.select("id", "mimeType", "size", "offset", F.md5("body").alias("body_md5"))


RENDITION_SELECT = FILES_SQL + f"""
, exported AS (
  SELECT id, mime, size, text,
         CASE mime WHEN '{NATIVE_MIMES["documents"]}' THEN 'text/html' WHEN '{NATIVE_MIMES["spreadsheets"]}' THEN 'text/csv'
                   WHEN '{NATIVE_MIMES["drawings"]}' THEN 'image/png' WHEN '{NATIVE_MIMES["presentations"]}' THEN 'text/plain'
                   WHEN '{NATIVE_MIMES["appsScripts"]}' THEN '{NATIVE_MIMES["appsScripts"]}+json' END AS target
  FROM files WHERE mime <> '{FOLDER_MIME}' AND mime <> 'text/plain')
SELECT id, coalesce(target, mime) AS "mimeType",
       CASE WHEN target IS NOT NULL THEN octet_length(encode(target || chr(10) || text))::BIGINT END AS size,
       0::BIGINT AS "offset",
       md5(CASE WHEN target IS NULL THEN '' ELSE target || chr(10) || text END) AS body_md5
FROM exported
UNION ALL
SELECT id, mime, size, p, md5(unhex(substr(hex(encode(text)), 2 * p + 1, 2 * {PART_BYTES})))
FROM (SELECT id, mime, size, text, unnest(range(0, size, {PART_BYTES})) AS p FROM files WHERE mime = 'text/plain')
"""

_PROPERTIES = (
    "id", "name", "size", "createdTime", "modifiedTime", "starred", "trashedTime", "parents", "properties",
    "imageMediaMetadata.width", "imageMediaMetadata.location.latitude", "imageMediaMetadata.aperture",
    "videoMediaMetadata.durationMillis",
)


def file_metadata_projection(spark, sf_dir) -> DataFrame:
    """The flagship: catalogue filter, date range, 4 KB parts, metadata projection."""
    files = text_files(spark, sf_dir).withColumns(
        {
            "properties": F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")),
            "imageMediaMetadata": F.when(
                F.col("n_chars") > 500,
                F.struct(
                    F.col("n_chars").cast("int").alias("width"), (F.col("n_chars") / 4).cast("float").alias("aperture"),
                    F.struct((F.col("doc_id") / 8).alias("latitude")).alias("location"),
                ),
            ),
            "videoMediaMetadata": F.when(
                F.col("n_chars") <= 500, F.struct((F.col("n_chars") * 10).alias("durationMillis"))
            ),
        }
    )
    options = FileSourceOptions(
        folder="en", file_types=("binary",), date_range="last_year", properties=_PROPERTIES, max_part_bytes=PART_BYTES
    )
    records = read_files(files, options, now=now())
    return records.select(
        "id", "name", "size", "offset",
        F.unix_millis("createdTime").alias("created_ms"), F.unix_millis("modifiedTime").alias("modified_ms"),
        "starred", F.col("trashedTime").isNull().alias("never_trashed"), F.array_join("parents", "/").alias("parents"),
        F.array_join(
            F.transform(F.array_sort(F.map_entries("properties")), lambda e: F.concat(e["key"], F.lit("="), e["value"])),
            ",",
        ).alias("properties"),
        F.col("imageMediaMetadata.width").alias("image_width"),
        F.col("imageMediaMetadata.aperture").cast("double").alias("image_aperture"),
        F.col("imageMediaMetadata.location.latitude").alias("latitude"),
        F.col("videoMediaMetadata.durationMillis").alias("duration_ms"),
        F.md5("body").alias("body_md5"),
    )


FILE_METADATA_PROJECTION = FILES_SQL + f"""
, parts AS (
  SELECT *, unnest(CASE WHEN bytes = 0 THEN [0] ELSE range(0, bytes, {PART_BYTES}) END) AS p FROM files
  WHERE lang = 'en' AND modified BETWEEN TIMESTAMP '2018-01-01' AND TIMESTAMP '2018-12-31 23:59:59.999')
SELECT id, name, bytes AS size, p AS "offset", epoch_ms(created) AS created_ms, epoch_ms(modified) AS modified_ms,
       n_chars > 2000 AS starred, TRUE AS never_trashed, lang AS parents,
       'lang=' || lang || ',source=' || source AS properties,
       CASE WHEN n_chars > 500 THEN n_chars::INT END AS image_width,
       CASE WHEN n_chars > 500 THEN n_chars / 4.0::DOUBLE END AS image_aperture,
       CASE WHEN n_chars > 500 THEN doc_id / 8.0::DOUBLE END AS latitude,
       CASE WHEN n_chars <= 500 THEN n_chars * 10 END AS duration_ms,
       md5(unhex(substr(hex(encode(text)), 2 * p + 1, 2 * {PART_BYTES}))) AS body_md5
FROM parts
"""


def file_sink_rows(spark, sf_dir) -> DataFrame:
    """Labelled documents become named files, the others get random names; toxic ones are
    written empty, and only good ones have a MIME type."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = documents.join(labels, "doc_id", "left")
    records = joined.select(
        F.when(F.coalesce("toxic", F.lit(0)) == 0, F.encode("text", "UTF-8")).alias("body"),
        F.when(F.col("quality").isNotNull(), F.concat(F.lit("doc-"), "doc_id")).alias("name"),
        F.when(F.col("quality") == 1, F.lit("text/plain")).alias("mimeType"),
    )
    given = F.col("name").startswith("doc-")
    return file_rows(records).select(
        F.when(given, F.col("name")).alias("name"),
        F.when(~given, F.length("name")).alias("random_length"),
        "mimeType", F.octet_length("body").cast("bigint").alias("size"), F.md5("body").alias("body_md5"),
    )


FILE_SINK_ROWS = """
WITH r AS (
  SELECT CASE WHEN coalesce(toxic, 0) = 0 THEN text ELSE '' END AS body,
         CASE WHEN quality IS NOT NULL THEN 'doc-' || doc_id END AS name,
         CASE WHEN quality = 1 THEN 'text/plain' END AS mime
  FROM documents LEFT JOIN labels USING (doc_id))
SELECT name, CASE WHEN name IS NULL THEN 16 END AS random_length, mime AS "mimeType",
       octet_length(encode(body))::BIGINT AS size, md5(body) AS body_md5 FROM r
"""


def projected_pages(spark, sf_dir) -> DataFrame:
    """Pages cut at 1 KB with the default projection (no metadata requested)."""
    parts = cut_bodies(page_files(spark, sf_dir), 1024)
    return project_metadata(parts, ()).groupBy("offset").agg(
        F.count(F.lit(1)).alias("parts"), F.sum(F.octet_length("body")).cast("bigint").alias("bytes")
    )


PROJECTED_PAGES = """
WITH p AS (SELECT octet_length(encode(html))::BIGINT AS size FROM pages),
q AS (SELECT size, unnest(range(0, size, 1024)) AS "offset" FROM p)
SELECT "offset", count(*) AS parts, sum(least(1024, size - "offset"))::BIGINT AS bytes FROM q GROUP BY "offset"
"""

def folder_round_trip(spark, sf_dir) -> DataFrame:
    """Pages written as real files to a shared folder, listed, and read back in 4 KB ranges."""
    pages = table(spark, sf_dir, "pages").select(
        F.encode("html", "UTF-8").alias("body"), F.concat(F.lit("page "), "page_id", F.lit(".html")).alias("name")
    )
    folder = shared_folder(spark, "pages")
    write_files(file_rows(pages), folder)
    parts = read_parts(list_folder(spark, folder), PART_BYTES)
    return parts.select("name", "mimeType", "size", "offset", F.md5("body").alias("part_md5"))


FOLDER_ROUND_TRIP = f"""
WITH p AS (SELECT 'page ' || page_id || '.html' AS name, encode(html) AS body FROM pages),
q AS (SELECT name, octet_length(body)::BIGINT AS size, body FROM p)
SELECT name, 'text/html' AS "mimeType", size, o AS "offset",
       md5(unhex(substr(hex(body), 2 * o + 1, 2 * {PART_BYTES}))) AS part_md5
FROM (SELECT *, unnest(range(0, size, {PART_BYTES})) AS o FROM q)
"""

QUERIES = {
    "folder_round_trip": (folder_round_trip, FOLDER_ROUND_TRIP),
    "file_catalog_filter": (file_catalog_filter, FILE_CATALOG_FILTER),
    "single_file": (single_file, SINGLE_FILE),
    "first_files": (first_files_by_name, FIRST_FILES),
    "listing_groups": (listing_groups, LISTING_GROUPS),
    "modified_range_counts": (modified_range_counts, MODIFIED_RANGE_COUNTS),
    "modified_custom_range": (modified_custom_range, MODIFIED_CUSTOM_RANGE),
    "byte_range_splits": (byte_range_splits, BYTE_RANGE_SPLITS),
    "body_parts": (body_parts, BODY_PARTS),
    "body_text": (body_text, BODY_TEXT),
    "body_text_parts": (body_text_parts, BODY_TEXT_PARTS),
    "projected_pages": (projected_pages, PROJECTED_PAGES),
    "rendition_select": (rendition_select, RENDITION_SELECT),
    "file_metadata_projection": (file_metadata_projection, FILE_METADATA_PROJECTION),
    "file_sink_rows": (file_sink_rows, FILE_SINK_ROWS),
}
