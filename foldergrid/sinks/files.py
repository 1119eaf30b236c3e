"""Records -> files of a folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldergrid.functions.text import clean_name, marked_name, random_name
from foldergrid.operators.lookup import lookup_join
from foldergrid.session import cut_lineage, forget, path_exists, remove_folder, shuffle_width
from foldergrid.sources.folder import list_names
from foldergrid.sources.listing import file_locator, move_new, there

MANIFEST_DDL = "name string, mimeType string, size bigint, staged string"


def file_schema_problems(
    schema: T.StructType, body_field: str, name_field: str | None = None, mime_field: str | None = None
) -> list[str]:
    """The body must be binary; name and MIME type, if named, must be strings."""
    problems = []
    wanted = ((body_field, T.BinaryType), (name_field, T.StringType), (mime_field, T.StringType))
    for name, kind in wanted:
        if not name:
            continue
        if name not in schema.names:
            problems.append(f"There is no column '{name}' in the records.")
        elif not isinstance(schema[name].dataType, kind):
            problems.append(
                f"Column '{name}' holds {schema[name].dataType.simpleString()}, "
                f"files need {kind().simpleString()} there."
            )
    return problems


def file_rows(
    records: DataFrame,
    body_field: str = "body",
    name_field: str | None = "name",
    mime_field: str | None = "mimeType",
    seed: int | None = None,
) -> DataFrame:
    """(name, mimeType, body) per record: a missing body is empty, a missing name is random,
    a missing MIME type stays null."""
    present = records.columns
    name = F.col(name_field) if name_field in present else F.lit(None).cast("string")
    mime = F.col(mime_field) if mime_field in present else F.lit(None).cast("string")
    body = F.col(body_field) if body_field in present else F.lit(None).cast("binary")
    return records.select(
        F.coalesce(name, random_name(seed)).alias("name"),
        mime.alias("mimeType"),
        F.coalesce(body, F.lit(b"")).alias("body"),
    )


def write_files(rows: DataFrame, folder: str) -> DataFrame:
    """Write file rows into `folder`; returns the manifest (name, mimeType, size, path).

    Tasks write bodies to a staging folder beside the target, each attempt to names of its
    own, and the manifest of committed attempts is saved as a table. A second job, which only
    moves files, publishes from that table: bodies are never shuffled, nothing passes through
    the driver, and files of lost or repeated attempts are never published. Moving is
    idempotent, so publishing may be retried. Every record makes a new file: a file whose name
    another one of the run or of the folder has gets a suffix, before which a name that gets too long is cut.
    The staging folder is removed in the end, also when the run fails; files published by then stay.
    """
    spark = rows.sparkSession
    folder = folder.rstrip("/")
    run = f"{folder}.staging-{uuid.uuid4().hex}"
    staged = rows.select("name", "mimeType", "body").mapInArrow(_stager(f"{run}/files"), MANIFEST_DDL)
    try:
        return _published(staged, folder)
    finally:
        remove_folder(spark, run)


def _published(staged: DataFrame, folder: str) -> DataFrame:
    spark = staged.sparkSession
    manifest = cut_lineage(staged.withColumn("_file", clean_name(F.col("name"))))

    # only names leave their rows here; a name on a third of all rows is one count per task
    taken = manifest.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_file")
    if path_exists(spark, folder):
        taken = taken.union(list_names(spark, folder)).distinct()
    token = F.regexp_extract("staged", r"([^/]+)$", 1)
    suffixed = marked_name(F.col("_file"), F.concat(F.lit(" ("), token, F.lit(")")))
    into = F.concat(F.lit(folder + "/"), F.col("_file"))
    spare = F.concat(F.lit(folder + "/"), suffixed)
    targets = cut_lineage(
        lookup_join(manifest, taken.withColumn("_taken", F.lit(True)), ["_file"], ["staged"])
        .select("name", "mimeType", "size", "staged", F.when(F.col("_taken"), spare).otherwise(into).alias("path"), spare.alias("spare"))
    )
    published = cut_lineage(targets.repartition(shuffle_width(spark), "staged").mapInArrow(
        _publisher(folder), "name string, mimeType string, size bigint, path string"
    ))
    forget(manifest, targets)
    return published


def _stager(root: str):
    """Writes each body of a task to a file of its own and gives out manifest rows."""
    located = file_locator()

    def stage(batches):
        import uuid

        import pyarrow as pa

        system, base = located(root)
        system.create_dir(base, recursive=True)
        for batch in batches:
            tokens, sizes = [], []
            for body in batch.column("body"):
                content = body.as_buffer()
                tokens.append(uuid.uuid4().hex)
                sizes.append(len(content))
                with system.open_output_stream(f"{base}/{tokens[-1]}") as out:
                    out.write(content)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("name"), batch.column("mimeType"), pa.array(sizes, pa.int64()),
                    pa.array([f"{root}/{token}" for token in tokens], pa.string()),
                ],
                names=["name", "mimeType", "size", "staged"],
            )

    return stage


def _publisher(folder: str):
    """Moves staged files to their final path; a file already moved is left alone, and a path
    that was taken meanwhile is passed over for the spare one, which only this file can have."""
    located = file_locator()

    def publish(batches):
        import pyarrow as pa

        for batch in batches:
            paths = []
            for staged, path, spare in zip(*(batch.column(c).to_pylist() for c in ("staged", "path", "spare"))):
                system, source = located(staged)
                if there(system, source):
                    system.create_dir(located(folder)[1], recursive=True)
                    if not move_new(system, source, located(path)[1]):
                        path = spare
                        if not move_new(system, source, located(spare)[1]):
                            raise FileExistsError(f"{spare} is there already.")
                elif there(system, located(spare)[1]):
                    path = spare
                elif not there(system, located(path)[1]):
                    raise FileNotFoundError(f"Neither {staged} nor {path} is there.")
                paths.append(path)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("name", "mimeType", "size")), pa.array(paths, pa.string())],
                names=["name", "mimeType", "size", "path"],
            )

    return publish
