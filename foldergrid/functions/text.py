"""Text helpers for bodies, names and option lists."""

from __future__ import annotations

import re
import secrets
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

RANDOM_NAME_LENGTH = 16
MAX_NAME_BYTES = 255   # of a file's name, in most stores
MAX_ENDING_BYTES = 50  # a longer ending is no ending


def utf8_text(body: Column) -> Column:
    """Bytes as text; a byte sequence that is not UTF-8 (for instance a character cut by a
    byte range) becomes U+FFFD instead of failing the task."""
    return F.make_valid_utf8(body.cast("string"))


def random_name(seed: int | None = None) -> Column:
    """Sixteen random letters and digits."""
    if seed is None:
        return F.randstr(F.lit(RANDOM_NAME_LENGTH))
    return F.randstr(F.lit(RANDOM_NAME_LENGTH), F.lit(seed))


def option_list(text: Column) -> Column:
    """A comma list as an array; empty and null give an empty array."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) > 0, F.split(text, ",")).otherwise(
        F.array().cast("array<string>")
    )


def clean_name(name: Column) -> Column:
    """The name a file can have: no separator or control character, neither empty nor a
    name that stands for a folder, and no longer than stores allow."""
    clean = F.regexp_replace(name, r"[/\x00-\x1f]", "_")
    return marked_name(F.when(clean.isin("", ".", ".."), F.concat(F.lit("unnamed"), clean)).otherwise(clean), F.lit(""))


def marked_name(name: Column, mark: Column) -> Column:
    """`name` with a mark before its ending. The ending stays last; of a name that gets too long the stem is cut,
    between characters."""
    found = F.regexp_extract(name, r"(?s)(?<=.)(\.[^.]*)\z", 1)
    ending = F.when(F.octet_length(found) > MAX_ENDING_BYTES, "").otherwise(found)
    stem = F.substring(name, F.lit(1), F.length(name) - F.length(ending))
    room = F.lit(MAX_NAME_BYTES) - F.octet_length(ending) - F.octet_length(mark)
    cut = F.regexp_replace(F.make_valid_utf8(F.substring(F.encode(stem, "UTF-8"), F.lit(1), room).cast("string")), "\ufffd+\\z", "")
    return F.concat(F.when(F.octet_length(stem) <= room, stem).otherwise(cut), mark, ending)


def fitting_name(name: str, mark: str = "") -> str:
    """The same for one name in a task: cleaned, marked, and cut."""
    clean = re.sub(r"[/\x00-\x1f]", "_", name)
    clean = "unnamed" + clean if clean in ("", ".", "..") else clean
    stem, dot, ending = clean.rpartition(".")
    if not stem or len(ending.encode()) + 1 > MAX_ENDING_BYTES:
        stem, dot, ending = clean, "", ""
    last = mark + dot + ending
    return stem.encode()[: MAX_NAME_BYTES - len(last.encode())].decode("utf-8", "ignore") + last


def new_name() -> str:
    """Sixteen random letters and digits."""
    return "".join(secrets.choice(string.ascii_letters + string.digits) for _ in range(RANDOM_NAME_LENGTH))
