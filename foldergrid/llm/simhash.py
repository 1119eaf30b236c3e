"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint takes the majority of every bit of the hashes of a text's word shingles.
Copies are one fingerprint from then on. Two fingerprints within the radius agree on at
least one of radius + 1 ranges of bits, so each is put, once per range, into a cell by the
leading bits of that range. Within a cell the fingerprints stand as vertical bit planes: one
bitwise operation takes 64 of them a bit further. Distances are counted by carry-save
counters, a block of comparisons is left as soon as all its distances exceed the radius. A
cell gives the links of a spanning star for each of its groups, never all pairs; the links of
all cells make the components.

The more fingerprints there are, the more of the ranges a key takes together (`key_ranges`).

Crowded cells are cut into parts, one task for every pair of parts, so the largest cell of a
crowd of m grows with the square root of m only.

Edge cases: null and empty texts have fingerprint zero, linked like any other. A text shorter
than a shingle is one shingle. Rows with a null id take part; a component without any id has
none. Repeated rows are copies of each other. Very long texts are read whole; an empty table gives an
empty result. Other columns may have any names: `keep_one` returns them as they are, `near_duplicates` leaves them out.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldergrid.llm.common import free_name, small_batches, texts_of
from foldergrid.llm.components import connected_components
from foldergrid.session import cut_lineage

BITS = 64
SHINGLE, RADIUS, SEED = 4, 4, 42
CELL_ROWS = 512      # rows of a cell on average
CROWD_ROWS = 1024    # rows from which a cell is cut into parts
_QUERIES = 64        # rows compared to a cell's planes at a time
_FIRST_CHECK = 24    # planes before a block is looked at
_HASHES = 1 << 17    # hashes whose bits are counted at a time


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a text."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z, and white space of ASCII
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[: n - shingle])).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    counts, total = np.zeros(BITS, np.int64), len(starts)
    for at in range(0, total, _HASHES):
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts[at : at + _HASHES], stops[at : at + _HASHES])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return sum(1 << i for i in np.flatnonzero(2 * counts > total).tolist())


def fingerprint_column(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """The fingerprint as the signed integer of the same bits."""

    @F.arrow_udf("bigint")
    def fingerprints(column: pa.Array) -> pa.Array:
        found = [fingerprint(text, shingle, seed) for text in texts_of(column)]
        return pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())

    return fingerprints(text)


def planes_of(prints: np.ndarray) -> np.ndarray:
    """Bit planes: row p holds bit p of every fingerprint, 64 of them to a word."""
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    padded = np.zeros((BITS, -(-len(prints) // 64) * 64), np.uint8)
    padded[:, : len(prints)] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def within(queries: np.ndarray, planes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, position) of every fingerprint behind `planes` within `radius` bits of a query.

    The counters of a position start so that they overflow at radius + 1: the carry out of the
    highest one marks a distance that is too large.
    """
    width = radius.bit_length()
    start = (1 << width) - 1 - radius
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    masks = np.where((queries[None, :] >> np.arange(BITS, dtype=np.uint64)[:, None]) & np.uint64(1), full, np.uint64(0))
    shape = (len(queries), planes.shape[1])
    counters = [np.full(shape, full if start >> k & 1 else np.uint64(0)) for k in range(width)]
    over = np.zeros(shape, np.uint64)

    def add(carry: np.ndarray) -> None:
        nonlocal over
        for k in range(width):
            held = counters[k]
            counters[k] = held ^ carry
            carry = held & carry
        over |= carry

    for p in range(_FIRST_CHECK):
        add(planes[p][None, :] ^ masks[p][:, None])
    row, word = np.nonzero(over != full)  # what is left of the block goes on, the rest is abandoned
    counters, over = [c[row, word] for c in counters], over[row, word]
    for p in range(_FIRST_CHECK, BITS):
        if not len(row):
            break
        add(planes[p][word] ^ masks[p][row])
        if p % 8 == 7:
            alive = over != full
            row, word, over, counters = row[alive], word[alive], over[alive], [c[alive] for c in counters]
    near = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(near)
    return row[at], word[at] * 64 + bit


def cell_groups(prints: np.ndarray, radius: int) -> np.ndarray:
    """For every fingerprint of a cell the position of the first one it is linked to, directly
    or through others of the cell."""
    n = len(prints)
    planes, group = planes_of(prints), np.arange(n)
    for at in range(0, n, _QUERIES):
        block = prints[at : at + _QUERIES]
        skip = at // 64  # earlier positions have been queries themselves
        query, place = within(block, planes[:, skip:], radius)
        place = place + 64 * skip
        query = query + at
        keep = (place < n) & (place != query)
        query, place = query[keep], place[keep]
        while len(query):
            a, b = group[query], group[place]
            low = np.minimum(a, b)
            differs = a != b
            if not differs.any():
                break
            np.minimum.at(group, np.maximum(a, b)[differs], low[differs])
            while True:
                upper = group[group]
                if (upper == group).all():
                    break
                group = upper
    return group


def key_ranges(count: int, radius: int) -> tuple[list[tuple[int, ...]], int, int]:
    """(the ranges of bits that each key is made of, leading bits taken of a range, number of ranges).

    With one range more than the radius, two linked fingerprints are equal in one of them at least; with m - 1
    more they are equal in m. Keys are made of as many ranges as it takes to keep cells at about
    CELL_ROWS fingerprints, so the work on a fingerprint does not grow with their number.
    """
    needed = int(count // CELL_ROWS).bit_length()
    m = 1
    while needed > m * (BITS // (radius + m)) and radius + m < BITS // 2:
        m += 1
    ranges = radius + m
    return list(combinations(range(ranges), m)), min(-(-needed // m), BITS // ranges), ranges


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) fingerprints: links whose components are those of all pairs within the radius.
    `prints` has one row per distinct `fingerprint`."""
    chosen, leading, ranges = key_ranges(prints.count(), radius)
    width = BITS // ranges
    bits = lambda i: F.shiftrightunsigned("fingerprint", BITS - width * i - leading).bitwiseAND(F.lit((1 << leading) - 1))
    keys = F.array(*[
        reduce(lambda key, i: F.shiftleft(key, leading).bitwiseOR(bits(i)), own[1:], bits(own[0])) for own in chosen
    ])
    rows = prints.select("fingerprint", F.posexplode(keys).alias("range", "key"))
    crowds = rows.groupBy("range", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD_ROWS)
    crowds = crowds.select(F.col("range").alias("_r"), F.col("key").alias("_k"), F.ceil(F.sqrt("n") / 8).cast("int").alias("parts"))
    parted = (
        rows.join(crowds, (F.col("range") == F.col("_r")) & (F.col("key") == F.col("_k")), "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
    )
    # every part meets every other part, and itself where it is the only one
    cells = parted.select(
        "fingerprint", "range", "key", "part",
        F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
            F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: other != F.col("part")))).alias("other"),
    ).select("fingerprint", "range", "key", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"))

    def stars(cell: pa.Table) -> pa.Table:
        own = np.sort(cell.column("fingerprint").to_numpy().astype(np.int64))  # rows in any order, one result
        first = cell_groups(own.view(np.uint64), radius)
        linked = np.flatnonzero(first != np.arange(len(own)))
        return pa.table({"a": own[linked], "b": own[first[linked]]})

    return cells.groupBy("range", "key", "x", "y").applyInArrow(stars, "a bigint, b bigint")


def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """`prints` (one row per distinct `fingerprint`) with `root`: the fingerprint that stands
    for the component."""
    found = connected_components(links(prints.select("fingerprint"), radius))
    named = found.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return prints.join(named, F.col("fingerprint") == F.col("_node"), "left").withColumn(
        "root", F.coalesce("_root", "fingerprint")
    ).drop("_node", "_root")


def least_of_components(rows: DataFrame, value: Column, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, least) for every distinct fingerprint of `rows`: the least `value` of all
    rows of its component.

    Copies are aggregated before anything is joined. What a join meets is a table, so both of
    its sides are plain shuffles, and adaptive execution splits a component or a fingerprint
    that holds a large share of the rows.
    """
    prints = cut_lineage(rows.groupBy("fingerprint").agg(F.min(value).alias("_own")))
    named = cut_lineage(classes(prints, radius))
    of_root = cut_lineage(named.groupBy("root").agg(F.min("_own").alias("least")))
    return cut_lineage(named.select("fingerprint", "root").join(of_root, "root").select("fingerprint", "least"))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
) -> DataFrame:
    """id, `fingerprint` (16 hexadecimal digits) and `component_id`, the smallest id that links
    of at most `radius` differing bits reach."""
    small_batches(docs.sparkSession)
    rows = cut_lineage(docs.select(F.col(id_column).alias("_id"), fingerprint_column(F.col(text), shingle).alias("fingerprint")))
    return rows.join(least_of_components(rows, F.col("_id"), radius), "fingerprint").select(
        F.col("_id").alias(id_column), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("least").alias("component_id"),
    )


def keep_one(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
) -> DataFrame:
    """One row of `docs` for each component: that of the smallest id (rows without an id come
    last, of equal ids the first one read). The rows are written with a number of their own, so
    that numbers mean the same rows in every later job."""
    small_batches(docs.sparkSession)
    number, print_ = free_name(docs, "row_number"), free_name(docs, "fingerprint")
    numbered = cut_lineage(docs.withColumns({
        number: F.monotonically_increasing_id(), print_: fingerprint_column(F.col(f"`{text}`"), shingle),
    }))
    rows = numbered.select(F.col(number).alias("_number"), F.col(f"`{id_column}`").alias("_id"), F.col(print_).alias("fingerprint"))
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_number")
    first = least_of_components(rows, order, radius).select(F.col("least._number").alias(number)).distinct()
    return numbered.join(first, number, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
