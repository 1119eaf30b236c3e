"""Joining a large table to a lookup table whose keys may be very unevenly used."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldergrid.session import cut_lineage, shuffle_width

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
BUSY_ROWS = 10_000  # as many rows of one key are no burden to a task


def fits_broadcast(
    small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measure rows and text-rendered bytes of a lookup table (one aggregate job)."""
    width = F.coalesce(F.octet_length(F.to_json(F.struct(*small.columns))), F.lit(0))
    rows, size = small.agg(F.count(F.lit(1)), F.sum(width.cast("bigint"))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    written: bool = True,
) -> DataFrame:
    """`big` joined to `small` (one row per key, `how` left, inner or left_semi).

    The lookup table is computed once, written, and measured there; one that is cheap to compute twice, like the
    columns of a table, need not be `written`. A small one is broadcast.
    Beyond the bound both sides are shuffled, whatever Spark makes of their files: a few bytes of Parquet may be many
    rows. The keys of `big` are counted then (it is read once more), and those that hold a large share of it are
    salted: their lookup rows are repeated per salt and their rows spread over the salts by `spread_by`, as many
    as the shuffle has partitions, so that a key holding a third of `big` is no single task. All other
    lookup rows are there once. Rows without a key, which find nothing, are spread too.
    """
    if written:
        small = cut_lineage(small)
    if fits_broadcast(small, max_rows, max_bytes):
        return big.join(F.broadcast(small), on, how)
    salts = shuffle_width(big.sparkSession)
    one, salt = F.lit(0).cast("bigint"), F.pmod(F.xxhash64(*spread_by), F.lit(salts))
    spread, copied = reduce(or_, [F.col(c).isNull() for c in on]), F.lit(False)
    busy = _busy_keys(big, on, salts)
    if busy is not None:
        busy = F.broadcast(busy.withColumn("_busy", F.lit(True)))
        big, small = big.join(busy, on, "left"), small.join(busy, on, "left")
        copied = F.col("_busy").isNotNull()
        spread = spread | copied
    salted = big.withColumn("_salt", F.when(spread, salt).otherwise(one)).drop("_busy")
    every = F.sequence(one, F.lit(salts - 1).cast("bigint"))
    copies = small.withColumn("_salt", F.explode(F.when(copied, every).otherwise(F.array(one)))).drop("_busy")
    return salted.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")


def _busy_keys(big: DataFrame, on: list[str], salts: int) -> DataFrame | None:
    """The keys that hold more of `big` than an eighth of a salt's share, at most eight times as many as salts."""
    counts = cut_lineage(
        big.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > BUSY_ROWS)
    )
    rows = counts.agg(F.sum("_n")).first()[0]
    return None if rows is None else counts.where(F.col("_n") > rows / (8 * salts)).select(*on)
