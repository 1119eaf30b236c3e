"""Nested records -> grid rows.

Arrays multiply rows. With array lengths n1..nk (an empty or null array counts one), a
record has R = n1*…*nk rows and row r holds element floor(r / Sk) mod nk of array k, where
Sk is the product of the lengths after k. Nothing is looped: rows, cells and merged ranges
are all expressions of r.

Arrays that are exploded here are never empty, and `_outer` says so: for a plain explode
Spark adds a filter on the array's size, which would compute the array twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldergrid.functions.serial import date_to_serial, time_to_serial, timestamp_to_serial
from foldergrid.functions.text import utf8_text
from foldergrid.model import SheetSinkOptions
from foldergrid.session import shuffle_width

CELL_DDL = "struct<user_num: double, user_str: string, user_bool: boolean, num_format: string>"
CHUNK_ROWS = 10_000
TARGET = ["spreadsheet_name", "sheet_name"]

_NUMBERS = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType, T.FloatType)
_SIMPLE = (*_NUMBERS, T.StringType, T.BooleanType, T.BinaryType, T.NullType)
_LOGICAL = (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def _is_leaf(kind: T.DataType) -> bool:
    return isinstance(kind, _SIMPLE + _LOGICAL)


def schema_problems(schema: T.StructType, options: SheetSinkOptions) -> list[str]:
    """Everything about the input schema that the grid cannot hold."""
    problems = []
    for label, name in (("Spreadsheet name", options.spreadsheet_field), ("Sheet name", options.sheet_field)):
        if not name:
            continue
        if name not in schema.names:
            problems.append(f"{label}: there is no column '{name}' in the records.")
        elif not isinstance(schema[name].dataType, T.StringType):
            problems.append(
                f"{label}: column '{name}' holds {schema[name].dataType.simpleString()} and not text."
            )
    for field in schema.fields:
        kind = field.dataType
        if isinstance(kind, T.ArrayType):
            if not _is_leaf(kind.elementType):
                problems.append(
                    f"A cell cannot hold the elements of '{field.name}': {kind.elementType.simpleString()}."
                )
        elif isinstance(kind, T.StructType):
            problems += [
                f"A cell cannot hold '{field.name}.{sub.name}': {sub.dataType.simpleString()}."
                for sub in kind.fields
                if not _is_leaf(sub.dataType)
            ]
        elif not _is_leaf(kind):
            problems.append(f"A cell cannot hold '{field.name}': {kind.simpleString()}.")
    return problems


def check_schema(schema: T.StructType, options: SheetSinkOptions) -> None:
    problems = schema_problems(schema, options)
    if problems:
        raise ValueError("; ".join(problems))


def encode_cell(value: Column, kind: T.DataType, options: SheetSinkOptions, time_unit: str | None = None) -> Column:
    """A value as cell content and number format.

    A null date, time or decimal keeps its format; any other null is an empty cell.
    """
    number, text, flag, fmt = (F.lit(None).cast(t) for t in ("double", "string", "boolean", "string"))
    if time_unit:
        per_unit = 1000 if time_unit == "millis" else 1
        number = time_to_serial(value.cast("bigint") * F.lit(per_unit), options.day_micros)
        fmt = F.lit("TIME")
    elif isinstance(kind, T.DateType):
        number, fmt = date_to_serial(value), F.lit("DATE")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        number, fmt = timestamp_to_serial(value, options.day_micros), F.lit("DATE_TIME")
    elif isinstance(kind, T.DecimalType):
        number, fmt = value.cast("double"), F.lit("NUMBER")
    elif isinstance(kind, _NUMBERS):
        number = value.cast("double")
    elif isinstance(kind, T.StringType):
        text = value
    elif isinstance(kind, T.BinaryType):
        text = utf8_text(value)
    elif isinstance(kind, T.BooleanType):
        flag = value
    return F.struct(
        number.alias("user_num"), text.alias("user_str"), flag.alias("user_bool"), fmt.alias("num_format")
    ).cast(CELL_DDL)


def _encoder(kind: T.DataType, options: SheetSinkOptions, time_unit: str | None):
    return lambda element: encode_cell(element, kind, options, time_unit)


@dataclass(frozen=True)
class Leaf:
    """A grid column: where its value comes from and, for arrays, which array it is."""

    path: tuple[str, ...]
    kind: T.DataType
    array: int | None = None


def leaf_columns(schema: T.StructType, options: SheetSinkOptions) -> list[Leaf]:
    leaves, arrays = [], 0
    for field in written_schema(schema, options).fields:
        kind = field.dataType
        if isinstance(kind, T.ArrayType):
            leaves.append(Leaf((field.name,), kind.elementType, arrays))
            arrays += 1
        elif isinstance(kind, T.StructType):
            leaves += [Leaf((field.name, sub.name), sub.dataType) for sub in kind.fields]
        else:
            leaves.append(Leaf((field.name,), kind))
    return leaves


def written_schema(schema: T.StructType, options: SheetSinkOptions) -> T.StructType:
    """The schema without the name fields, if those are to be skipped."""
    names = {options.spreadsheet_field, options.sheet_field} if options.skip_name_fields else set()
    return T.StructType([f for f in schema.fields if f.name not in names])


def _named(path: tuple[str, ...]) -> Column:
    return F.col(".".join(f"`{part}`" for part in path))


def targets(options: SheetSinkOptions) -> tuple[Column, Column]:
    def target(name: str | None, default: str) -> Column:
        return F.coalesce(F.col(f"`{name}`"), F.lit(default)) if name else F.lit(default)

    return (
        target(options.spreadsheet_field, options.spreadsheet_name).alias("spreadsheet_name"),
        target(options.sheet_field, options.sheet_name).alias("sheet_name"),
    )


def route(records: DataFrame, options: SheetSinkOptions) -> DataFrame:
    """Target spreadsheet and sheet of each record: its own fields, else the defaults."""
    return records.select(*targets(options), *[F.col(f"`{c}`") for c in records.columns if c not in TARGET])


RECORD = "_record"
_RESERVED = {*TARGET, RECORD, "n_rows", "lengths", "columns", "first_row", "is_first", "batch_no", "row_in_record"}


def measure_records(records: DataFrame, options: SheetSinkOptions, keep: tuple[str, ...] = ()) -> DataFrame:
    """Target, `keep` columns, n_rows, and the record itself as one struct.

    This is the compact form for anything that shuffles records; cells are several times
    larger and are encoded afterwards (`encode_records`).
    """
    check_schema(records.schema, options)
    taken = _RESERVED.intersection(keep)
    if taken:
        raise ValueError(f"Rename the columns {sorted(taken)}: the grid uses these names itself.")
    n_rows = F.lit(1).cast("bigint")
    for leaf in leaf_columns(records.schema, options):
        if leaf.array is not None:
            n_rows = n_rows * _length(_named(leaf.path))
    record = F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias(RECORD)
    kept = [F.col(f"`{c}`") for c in keep]
    book, sheet = targets(options)
    return records.select(book, sheet, *kept, n_rows.alias("n_rows"), record)


def encode_records(measured: DataFrame, options: SheetSinkOptions) -> DataFrame:
    """The record struct replaced by the lengths of its arrays and, per grid column, its
    encoded cells (one, or one per array element)."""
    lengths, cells = [], []
    for leaf in leaf_columns(measured.schema[RECORD].dataType, options):
        value = _named((RECORD, *leaf.path))
        unit = options.time_fields.get(".".join(leaf.path))
        if leaf.array is None:
            cells.append(F.array(encode_cell(value, leaf.kind, options, unit)))
        else:
            elements = F.when(F.size(value) > 0, value).otherwise(F.array(F.lit(None).cast(leaf.kind)))
            lengths.append(_length(value))
            cells.append(F.transform(elements, _encoder(leaf.kind, options, unit)))
    return measured.select(
        *[c for c in measured.columns if c != RECORD],
        F.array(*lengths).cast("array<bigint>").alias("lengths"),
        F.array(*cells).cast(f"array<array<{CELL_DDL}>>").alias("columns"),
    )


def with_cells(records: DataFrame, options: SheetSinkOptions, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records reduced to what the grid needs: target, `keep` columns, n_rows and cells."""
    return encode_records(measure_records(records, options, keep), options)


def _length(array: Column) -> Column:
    """Rows an array makes: an empty or null one makes one."""
    return F.greatest(F.size(array), F.lit(1)).cast("bigint")


def _spans(leaves: list[Leaf]) -> dict[int, Column]:
    """S_k: how many consecutive rows an element of array k covers."""
    count = max((leaf.array + 1 for leaf in leaves if leaf.array is not None), default=0)
    spans, span = {}, F.lit(1).cast("bigint")
    for k in reversed(range(count)):
        spans[k] = span
        span = span * F.col("lengths")[k]
    return spans


def grid_rows(placed: DataFrame, leaves: list[Leaf], spread: bool = False) -> DataFrame:
    """One row per grid row: the record's other columns, `row_in_record` and its `cells`.

    Row numbers are expanded in chunks, so no array as long as the product of all array
    lengths is built; `spread` deals the chunks out for records that expand enormously.
    """
    spans = _spans(leaves)
    row = F.col("row_in_record")
    cells = []
    for index, leaf in enumerate(leaves):
        element = F.lit(0)
        if leaf.array is not None:
            element = (F.call_function("div", row, spans[leaf.array]) % F.col("lengths")[leaf.array]).cast("int")
        cells.append(F.get(F.get(F.col("columns"), F.lit(index)), element))
    others = [c for c in placed.columns if c not in ("lengths", "columns")]
    if not spans:  # without arrays a record is a row
        return placed.select(*others, F.lit(0).cast("bigint").alias("row_in_record"), F.array(*cells).alias("cells"))
    step = F.lit(CHUNK_ROWS).cast("bigint")
    chunks = placed.withColumn(
        "_from", F.explode_outer(F.sequence(F.lit(0).cast("bigint"), F.col("n_rows") - 1, step))
    )
    if spread:
        chunks = chunks.repartition(shuffle_width(placed.sparkSession))
    rows = chunks.withColumn(
        "row_in_record",
        F.explode_outer(F.sequence(F.col("_from"), F.least(F.col("_from") + step, F.col("n_rows")) - 1)),
    )
    return rows.select(*others, "row_in_record", F.array(*cells).alias("cells"))


def grid_cells(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Long form of grid rows; empty cells are dropped (null values that keep a format stay)."""
    cell = F.col("_cell")
    kept = (
        cell["user_num"].isNotNull() | cell["user_str"].isNotNull()
        | cell["user_bool"].isNotNull() | cell["num_format"].isNotNull()
    )
    return (
        rows.select(*keys, F.posexplode_outer("cells").alias("col_idx", "_cell"))
        .where(kept)
        .select(*keys, "col_idx", "_cell.*")
    )


def data_merges(placed: DataFrame, leaves: list[Leaf], start: Column | None = None) -> DataFrame:
    """Merged ranges that the flattening causes, half-open and 0-based.

    A plain value spans all rows of its record; element b of array k spans rows
    [b*Sk, (b+1)*Sk). Ranges of a single cell are dropped before they are expanded. `start`
    is the row at which the record's rows begin.
    """
    spans = _spans(leaves)
    ranges = []
    for index, leaf in enumerate(leaves):
        span = F.col("n_rows") if leaf.array is None else spans[leaf.array]
        ranges.append(
            F.struct(
                F.lit(index).alias("col"), span.alias("span"), F.call_function("div", F.col("n_rows"), span).alias("count")
            )
        )
    first = F.lit(0).cast("bigint") if start is None else start
    others = [c for c in placed.columns if c not in ("lengths", "columns")]
    step = F.lit(CHUNK_ROWS).cast("bigint")
    listed = (
        placed.select(*others, F.inline_outer(F.array(*ranges)))
        .where(F.col("span") > 1)
        .withColumn("_from", F.explode_outer(F.sequence(F.lit(0).cast("bigint"), F.col("count") - 1, step)))
        .withColumn("_b", F.explode_outer(F.sequence(F.col("_from"), F.least(F.col("_from") + step, F.col("count")) - 1)))
    )
    top = first + F.col("_b") * F.col("span")
    return listed.select(
        *others, top.alias("start_row"), (top + F.col("span")).alias("end_row"),
        F.col("col").alias("start_col"), (F.col("col") + 1).alias("end_col"),
    )


def non_trivial_merges(merges: DataFrame) -> DataFrame:
    """Ranges that join at least two cells."""
    height, width = F.col("end_row") - F.col("start_row"), F.col("end_col") - F.col("start_col")
    return merges.where((height > 0) & (width > 0) & ((height > 1) | (width > 1)))
