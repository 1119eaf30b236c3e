"""Reading only what is new in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foldergrid.model import FileSourceOptions
from foldergrid.operators.bodies import cut_bodies
from foldergrid.operators.metadata import project_metadata
from foldergrid.sources.folder import list_folder, mime_of, read_parts
from foldergrid.sources.folder_files import FORMAT, use_folder_files
from foldergrid.streaming.runs import RunLog, read_runs


SEEN_DDL = "id string, modifiedTime timestamp"
RUN = "run"


def save(df: DataFrame, target: str) -> str:
    df.write.mode("overwrite").parquet(target)
    return target


def ingest_new_files(
    spark: SparkSession, folder: str, out: str, options: FileSourceOptions, recursive: bool = False
) -> int:
    """One scheduled run: the records of files that no earlier run has read (or that have
    changed since) are written under `out`/records; returns the number of the run.

    A run writes what it reads, its records and the list of files they came from, each to a folder of
    its own, and counts once its entry is written (`RunLog`), whether it found files or not. A
    run that failed before is repeated under the same number and overwrites what it left, so every file is in the
    records of `read_ingested` once per version.
    """
    log = RunLog(spark, out, RUN)
    run = log.last() + 1
    listing = list_folder(spark, folder, recursive)
    if run:
        listing = listing.join(log.read("seen", SEEN_DDL).select("id", "modifiedTime"), ["id", "modifiedTime"], "left_anti")
    # what this run reads is fixed before it is read
    files = spark.read.parquet(save(listing, log.folder("batch", run)))
    records = project_metadata(
        read_parts(files, options.max_part_bytes), options.properties, options.body_format
    )
    save(records, log.folder("records", run))
    save(files.select("id", "modifiedTime"), log.folder("seen", run))
    log.end(run, ["batch", "records", "seen"])
    return run


def read_ingested(spark: SparkSession, out: str) -> DataFrame:
    """The records of all runs that count, with the number of their run."""
    return read_runs(spark, out, "records", RUN)


def stream_versions(
    spark: SparkSession, folder: str, recursive: bool = False, max_part_bytes: int = 0, settle_ms: int = 1000
) -> DataFrame:
    """A folder as a stream of its files, in parts: every version of a file comes once, also empty files and hidden names.
    What has been read is kept in the query's checkpoint, as a modification time."""
    use_folder_files(spark)
    reader = spark.readStream.format(FORMAT).option("recursive", recursive).option("maxPartBytes", max_part_bytes)
    return reader.option("settleMillis", settle_ms).load(folder)


def stream_folder(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same folder as a stream of files with their bodies, each coming once.

    This is Spark's file stream, which passes over empty files and hidden names; use
    `stream_versions` or `ingest_new_files` where those count.
    """
    ddl = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(ddl)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return reader.load(folder).select(
        F.col("path").alias("id"), name.alias("name"), mime_of(name).alias("mimeType"), F.col("length").alias("size"),
        F.array(F.lit(folder)).alias("parents"), F.col("modificationTime").alias("modifiedTime"),
        F.col("content").alias("body"),
    )


def stream_records(files: DataFrame, options: FileSourceOptions, out: str, checkpoint: str) -> StreamingQuery:
    """Append the records of a file stream to a table and stop when all is read."""
    records = project_metadata(cut_bodies(files, options.max_part_bytes), options.properties, options.body_format)
    return (
        records.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
