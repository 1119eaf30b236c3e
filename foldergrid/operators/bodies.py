"""Byte ranges, bodies and renditions of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldergrid.functions.text import utf8_text
from foldergrid.model import EXPORT_FORMATS, NATIVE_MIMES, SCRIPT_EXPORT_MIME
from foldergrid.operators.catalogue import is_binary, is_native
from foldergrid.operators.lookup import fits_broadcast

_NO_RANGE = "CAST(NULL AS struct<bytes_from: bigint, bytes_to: bigint>)"


def byte_ranges(size: Column, max_bytes: int) -> Column:
    """array<struct<bytes_from, bytes_to>> with inclusive ends; one null entry when the file
    is read as a whole (no maximum, unknown size, or a size within the maximum)."""
    whole = F.array(F.expr(_NO_RANGE))
    if max_bytes <= 0:
        return whole
    step = F.lit(max_bytes).cast("bigint")
    cut = F.transform(
        F.sequence(F.lit(0).cast("bigint"), size - 1, step),
        lambda p: F.struct(p.alias("bytes_from"), (F.least(size, p + step) - 1).alias("bytes_to")),
    )
    return F.when(size > F.lit(max_bytes), cut).otherwise(whole)


# parts that are numbered in one array
CHUNK_PARTS = 10_000


def plan_parts(files: DataFrame, max_bytes: int) -> DataFrame:
    """One row per part to read; native files are never split.

    Parts are numbered in chunks, so no array is as long as a file has parts.
    """
    size = F.when(is_native(), F.lit(None)).otherwise(F.col("size")) if "mimeType" in files.columns else F.col("size")
    none = F.lit(None).cast("bigint")
    if max_bytes <= 0:
        return files.withColumns({"bytes_from": none, "bytes_to": none, "is_partitioned": F.lit(False)})
    step, wide = F.lit(max_bytes).cast("bigint"), F.lit(max_bytes * CHUNK_PARTS).cast("bigint")
    split = F.coalesce(size > step, F.lit(False))
    return (
        files.withColumn("_size", F.when(split, size))
        .withColumn("_from", F.explode_outer(F.sequence(F.lit(0).cast("bigint"), F.col("_size") - 1, wide)))
        .withColumn("bytes_from", F.explode_outer(F.sequence("_from", F.least(F.col("_from") + wide, F.col("_size")) - 1, step)))
        .withColumn("bytes_to", F.least(F.col("bytes_from") + step, F.col("_size")) - 1)
        .withColumn("is_partitioned", F.col("bytes_from").isNotNull())
        .drop("_size", "_from")
    )


def cut_bodies(files: DataFrame, max_bytes: int) -> DataFrame:
    """`body` whole or cut at `max_bytes`, with the `offset` of each part.

    The slices are made before the explode, so the whole body is not copied per part. The
    array is never empty; `inline` proper would make Spark add a filter on its size, which
    cuts every body a second time.
    """
    if max_bytes <= 0:
        return files.withColumn("offset", F.lit(0).cast("bigint"))
    length = F.octet_length("body").cast("bigint")
    step = F.lit(max_bytes).cast("bigint")
    parts = F.transform(
        F.sequence(F.lit(0).cast("bigint"), length - 1, step),
        lambda p: F.struct(
            F.substring(F.col("body"), (p + 1).cast("int"), F.lit(max_bytes)).alias("body"),
            p.alias("offset"),
        ),
    )
    whole = F.array(F.struct(F.col("body").alias("body"), F.lit(0).cast("bigint").alias("offset")))
    others = [F.col(c) for c in files.columns if c != "body"]
    return files.select(
        *others, F.inline_outer(F.when(length > F.lit(max_bytes), parts).otherwise(whole)).alias("body", "offset")
    )


def export_mime(formats: dict[str, str] | None = None) -> Column:
    """MIME type a native file is exported as; null for types that have no rendition."""
    formats = formats or {}
    chosen = F.lit(None).cast("string")
    for kind, mime in NATIVE_MIMES.items():
        target = SCRIPT_EXPORT_MIME if kind == "appsScripts" else formats.get(kind, EXPORT_FORMATS[kind][0])
        chosen = F.when(F.col("mimeType") == F.lit(mime), F.lit(target)).otherwise(chosen)
    return chosen


def with_renditions(files: DataFrame, renditions: DataFrame, formats: dict[str, str] | None = None) -> DataFrame:
    """Bodies of native files, taken from `renditions(id, export_mime, content)`.

    MIME type and size are those of the rendition; native types without one get an empty
    body. An exportable file whose rendition is missing fails the job.
    Pass native files only: binary bodies must not take part in the shuffle of this join.
    """
    wanted = files.drop("body").withColumn("export_mime", export_mime(formats))
    missing = F.raise_error(F.concat(F.lit("No rendition "), "export_mime", F.lit(" for file "), "id"))
    body = (
        F.when(F.col("export_mime").isNull(), F.lit(b""))
        .when(F.col("content").isNotNull(), F.col("content"))
        .otherwise(missing.cast("binary"))
    )
    asked = [(formats or {}).get(kind, mimes[0]) for kind, mimes in EXPORT_FORMATS.items()]
    offered = renditions.where(F.col("export_mime").isin(sorted({*asked, SCRIPT_EXPORT_MIME})))
    # keys only: few enough are broadcast, and then no rendition of another file is shuffled
    keys = wanted.where(F.col("export_mime").isNotNull()).select("id", "export_mime").distinct()
    if fits_broadcast(keys):
        offered = offered.join(F.broadcast(keys), ["id", "export_mime"], "left_semi")
    # contents are never broadcast, however few files are asked for
    joined = wanted.join(offered.hint("merge"), ["id", "export_mime"], "left")
    return joined.select(
        *[
            F.coalesce("export_mime", "mimeType").alias("mimeType")
            if c == "mimeType"
            else F.coalesce(F.octet_length("content").cast("bigint"), "size").alias("size")
            if c == "size"
            else F.col(c)
            for c in files.columns
            if c != "body"
        ],
        body.alias("body"),
    )


def read_bodies(
    files: DataFrame,
    max_bytes: int = 0,
    renditions: DataFrame | None = None,
    formats: dict[str, str] | None = None,
) -> DataFrame:
    """Bodies of every selected file: binary ones cut into parts, native ones exported whole.

    Only the native rows meet the rendition table; binary rows stay in a narrow plan.
    """
    binary = cut_bodies(files.where(is_binary()), max_bytes)
    if renditions is None:
        renditions = files.sparkSession.createDataFrame([], "id string, export_mime string, content binary")
    native = with_renditions(files.where(is_native()), renditions, formats)
    return binary.unionByName(native.withColumn("offset", F.lit(0).cast("bigint")))


def body_column(body_format: str) -> Column:
    return utf8_text(F.col("body")) if body_format.lower() == "string" else F.col("body")
