"""What several of the operators share: text columns, chunks of an Arrow batch, folds, bounded samples."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# characters of text that a task works on at once, whatever the size of the Arrow batch
CHUNK_CHARS = 1 << 20

# rows of an Arrow batch, which is whole in the memory of a Python worker: whole documents are long
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches of at most BATCH_ROWS rows from now on."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)
    return spark


def chunks(texts: Iterable[str | None], size: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Lists of texts of about `size` characters together (null reads as empty); a longer
    text is a list of its own."""
    held, chars = [], 0
    for text in texts:
        text = text or ""
        if held and chars + len(text) > size:
            yield held
            held, chars = [], 0
        held.append(text)
        chars += len(text)
    if held:
        yield held


def texts_of(column: pa.Array) -> Iterator[str | None]:
    """The values of a text column, a slice at a time."""
    for start in range(0, len(column), 256):
        yield from column.slice(start, 256).to_pylist()


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`. A null id is in no fold (null)."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def held_out(id_column: str, folds: int) -> Column:
    """Whether the row is in fold 0; a null id is never held out."""
    return F.coalesce(fold(id_column, folds) == 0, F.lit(False))


def labelled(labels: DataFrame, id_column: str, label_column: str, folds: int) -> DataFrame:
    """(id, label) of the training folds: one row per id, rows without id or label left out,
    the larger label where an id has several."""
    return (
        labels.select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isNotNull())
        .where(~held_out("_id", folds))
        .groupBy("_id").agg(F.max("_label").alias("_label"))
    )


def bounded_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """About `limit` rows at most, picked by a hash of their key: no sort, and the same rows
    however the table is partitioned. A table within the limit is kept whole."""
    count = df.count()
    if count <= limit:
        return df
    share = math.floor(limit / count * (1 << 40))
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 40)) < share)


def free_name(df: DataFrame, name: str) -> str:
    """`name` behind as many underscores as make it the name of no column."""
    taken = {column.lower() for column in df.columns}
    name = "_" + name
    while name.lower() in taken:
        name = "_" + name
    return name
