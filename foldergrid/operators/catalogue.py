"""Choosing files from a catalogue."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldergrid.functions.dates import named_range, parse_date_string
from foldergrid.model import FOLDER_MIME, NATIVE_MIMES, NATIVE_PREFIX, FileSourceOptions


def is_native(mime: Column | None = None) -> Column:
    """Whether a type is one of the service's own. A file without a type is not: its body is read as it is."""
    mime = F.col("mimeType") if mime is None else mime
    return mime.isNotNull() & mime.startswith(NATIVE_PREFIX)


def is_binary() -> Column:
    return F.col("mimeType").isNull() | ~F.col("mimeType").startswith(NATIVE_PREFIX)


def in_folder(folder: str) -> Column:
    return F.array_contains("parents", F.lit(folder))


def not_a_folder() -> Column:
    return F.col("mimeType").isNull() | (F.col("mimeType") != F.lit(FOLDER_MIME))


def of_types(types: tuple[str, ...] | list[str]) -> Column:
    """Any of the selected types; no selection keeps every type."""
    wanted = [
        is_binary() if kind == "binary" else F.col("mimeType") == F.lit(NATIVE_MIMES[kind])
        for kind in types
    ]
    return reduce(or_, wanted) if wanted else F.lit(True)


def user_filter(predicate: str | Column) -> Column:
    """A predicate of the caller's; text is Spark SQL and is parenthesised so that an `or`
    in it cannot reach around the other conditions."""
    return F.expr(f"({predicate})") if isinstance(predicate, str) else predicate


def modified_within(kind: str, now: Column, start: str | None = None, end: str | None = None) -> Column:
    """Modification time inside a named range, both ends included."""
    bounds = [None if text is None else parse_date_string(F.lit(text)) for text in (start, end)]
    first, last = named_range(kind, now, *bounds)
    condition = F.lit(True)
    if first is not None:
        condition = condition & (F.col("modifiedTime") >= first)
    if last is not None:
        condition = condition & (F.col("modifiedTime") <= last)
    return condition


def select_files(files: DataFrame, options: FileSourceOptions, now: Column | None = None) -> DataFrame:
    """The files a source run reads: one file by id, or a filtered folder."""
    if options.file_id is not None:
        return files.where(F.col("id") == F.lit(options.file_id))
    chosen = files.where(in_folder(options.folder)).where(not_a_folder()).where(of_types(options.file_types))
    if options.filter:
        chosen = chosen.where(user_filter(options.filter))
    return chosen.where(
        modified_within(
            options.date_range,
            F.current_timestamp() if now is None else now,
            options.start_date,
            options.end_date,
        )
    )


def first_files(files: DataFrame, n: int) -> DataFrame:
    """The first n files by name and id (a top-n, not a full sort)."""
    return files.orderBy("name", "id").limit(n)


def concat_listings(files: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """Binary files followed by native ones. The two groups are disjoint, so a single
    scan with one OR predicate gives the concatenation."""
    return files.where(of_types(types))
