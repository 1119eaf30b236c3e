"""Folders of real files: listing them as a catalogue and reading byte ranges of them."""

from __future__ import annotations

import mimetypes
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldergrid.operators.bodies import plan_parts
from foldergrid.session import cut_lineage, shuffle_width
from foldergrid.sources.listing import PAGE, entries, file_locator, shares_of

TASK_BYTES = 1 << 30  # that one task reads, one part after the other


def mime_of(name: Column) -> Column:
    """MIME type by file extension, from the standard library's own table: a fresh instance
    without files, so that it is the same on every machine."""
    known = mimetypes.MimeTypes(filenames=()).types_map[True]
    table = F.create_map(*[F.lit(x) for pair in sorted(known.items()) for x in pair])
    extension = F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))
    return F.coalesce(F.try_element_at(table, extension), F.lit("application/octet-stream"))


LISTING_DDL = "path string, length bigint, modified_ms bigint, is_folder boolean, shares int"


def list_folder(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Catalogue of a folder's files, without reading any of them.

    Listing runs in tasks and is never held by the driver. A folder of more than PAGE names is dealt to
    SHARES tasks by a hash of the name: each passes over all names, which is cheap, and looks at the
    files of its own share only. With `recursive` the tree is listed level by level: the folders
    of a level are dealt over the tasks, and what they hold is written to the shared folder
    before the next level starts. Spark's own file index is not used here because it leaves out
    empty files and names that begin with an underscore or a dot. Links to files are listed, links to
    folders and dangling ones are passed over.
    """
    root = folder.rstrip("/")
    shares = shares_of(root)
    listed = _listed(_dealt(spark.createDataFrame([(root, shares)], "path string, shares int"))) if shares > 1 else (
        spark.createDataFrame([(root,)], "path string").mapInArrow(_lister(split=False), LISTING_DDL)
    )
    if recursive:
        level = cut_lineage(listed)
        levels = [level]
        while True:
            folders, split = level.agg(F.max(F.col("is_folder") & F.isnull("shares")), F.max("shares")).first()
            if split:
                # the same level: folders that were too large for one task
                level = cut_lineage(_listed(_dealt(level.where("shares > 1"))))
            elif folders:
                below = level.where("is_folder AND shares IS NULL").select("path").repartition(4 * shuffle_width(spark), "path")
                level = cut_lineage(below.mapInArrow(_lister(split=True), LISTING_DDL))
            else:
                break
            levels.append(level)
        listed = reduce(DataFrame.unionByName, levels)
    files = listed.where("NOT is_folder")
    name = F.regexp_extract("path", r"(?s)([^/]+)\z", 1)
    return files.select(
        F.col("path").alias("id"),
        name.alias("name"),
        mime_of(name).alias("mimeType"),
        F.col("length").alias("size"),
        F.array(F.regexp_extract("path", r"(?s)^(.*)/[^/]*\z", 1)).alias("parents"),
        F.timestamp_millis("modified_ms").alias("modifiedTime"),
    )


def list_names(spark: SparkSession, folder: str) -> DataFrame:
    """The names a folder holds, of files and of folders."""
    listed = spark.createDataFrame([(folder.rstrip("/"),)], "path string").mapInArrow(_lister(split=False), LISTING_DDL)
    return listed.select(F.regexp_extract("path", r"(?s)([^/]+)\z", 1).alias("name"))


def _dealt(folders: DataFrame) -> DataFrame:
    """A row for each share of each folder (path, shares), in a partition of its own."""
    shares = folders.select("path", "shares", F.explode(F.expr("sequence(0, shares - 1)")).alias("share"))
    return shares.repartition(4 * shuffle_width(folders.sparkSession), "path", "share")


def _listed(shares: DataFrame) -> DataFrame:
    return shares.mapInArrow(_lister(split=False), LISTING_DDL)


def _lister(split: bool):
    """Lists each folder, or share of a folder, of a task, a page at a time. With `split` a folder
    that is too large for one task comes back as a row that says into how many shares to deal it."""

    def page_of(folder, found):
        import pyarrow as pa

        names, sizes, times, folders = zip(*found)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([f"{folder}/{name}" for name in names], pa.string()),
                pa.array([None if d else n for n, d in zip(sizes, folders)], pa.int64()),
                pa.array(times, pa.int64()), pa.array(folders, pa.bool_()), pa.nulls(len(names), pa.int32()),
            ],
            names=["path", "length", "modified_ms", "is_folder", "shares"],
        )

    def lists(batches):
        from itertools import batched

        import pyarrow as pa

        for batch in batches:
            dealt = "share" in batch.schema.names
            for row in batch.to_pylist():
                folder, shares = row["path"], 1 if dealt or not split else shares_of(row["path"])
                if shares > 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([folder], pa.string()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([True]), pa.array([shares], pa.int32())],
                        names=["path", "length", "modified_ms", "is_folder", "shares"],
                    )
                    continue
                share, of = (row["share"], row["shares"]) if dealt else (0, 1)
                # folders below are looked at by the first share alone
                for found in batched(entries(folder, share, of, folders=share == 0), PAGE):
                    yield page_of(folder, found)

    return lists


def read_parts(files: DataFrame, max_bytes: int = 0, tasks: int | None = None) -> DataFrame:
    """`body` and `offset` of every part of every listed file (`id` is its path).

    The ranges are planned as rows and dealt over tasks, so one huge file is read by many of
    them and each task holds one part at a time. Ranges are tiny and reads are not, so the
    number of tasks is explicit: by the bytes to be read, which one aggregate adds up.
    """
    spark = files.sparkSession
    if tasks is None:
        total = files.agg(F.sum("size")).first()[0] or 0
        tasks = max(4 * shuffle_width(spark), -(-total // TASK_BYTES))
    parts = plan_parts(files, max_bytes).repartition(tasks, "id", "bytes_from")
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    return parts.mapInArrow(_range_reader(), f"{out}, body binary, offset bigint")


def _range_reader():
    """Opens each range's file, seeks, and gives out one record at a time."""
    located = file_locator()

    def read(batches):
        import pyarrow as pa

        plan = ("bytes_from", "bytes_to", "is_partitioned")
        for batch in batches:
            table = pa.Table.from_batches([batch])
            kept = table.drop_columns([c for c in plan if c in table.column_names])
            ranges = zip(*(table[c].to_pylist() for c in ("id", "bytes_from", "bytes_to")))
            for i, (path, start, end) in enumerate(ranges):
                system, inner = located(path)
                with system.open_input_file(inner) as source:
                    source.seek(start or 0)
                    body = source.read(None if end is None else end - start + 1)
                record = kept.slice(i, 1)
                record = record.append_column("body", pa.array([body], pa.binary()))
                record = record.append_column("offset", pa.array([start or 0], pa.int64()))
                yield from record.to_batches()

    return read
