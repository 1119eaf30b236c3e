"""Running totals in a global order, and what is derived from them: row offsets of records
in their sheet, batch numbers in their spreadsheet, sizes of sheets.

A window over a whole sheet would put a sheet that holds a third of all rows into one task.
Instead the order is cut into ranges of about equal size:

1. a small uniform sample of the order keys gives the range boundaries;
2. every row of a group that spans ranges gets the number of its range, an expression of
   its own key (other groups are a range of their own);
3. totals per (range, group) are aggregated and summed up over the ranges: what each range
   starts from;
4. those starts join the rows as leading entries of their (range, group), and a window over
   (range, group) adds up both.

Boundaries only decide how the work is spread. They are literals by the time the plan runs,
so a recomputed task makes the same ranges, and the result is that of the single window.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from foldergrid.model import SheetSinkOptions
from foldergrid.operators.flatten import TARGET
from foldergrid.session import shuffle_width

SAMPLE_PER_RANGE = 10
RANGE_ROWS = 4_000_000  # rows of a range, where that makes more ranges than there are tasks


@dataclass(frozen=True)
class Running:
    """An exclusive running total: `name` = sum of `value` over the rows of the same `group`
    that come before, in the common order."""

    name: str
    group: tuple[str, ...]
    value: str | int  # a column, or a constant


def range_bounds(df: DataFrame, keys: list[str], n_ranges: int | None = None) -> list[str]:
    """Ascending keys, as JSON, that cut the rows into ranges of about equal size: n_ranges, or
    as many as the rows ask for.

    The rows are counted, then each task picks its share of the sample by itself. What the
    driver receives is the sample, about SAMPLE_PER_RANGE keys a range.
    """
    count = df.count()
    n_ranges = n_ranges or max(2 * shuffle_width(df.sparkSession), -(-count // RANGE_ROWS))
    share = min(1.0, 1.2 * SAMPLE_PER_RANGE * n_ranges / max(count, 1))
    picked = df.where(F.rand(17) < share) if share < 1 else df
    sample = picked.select(_key(keys).alias("key")).orderBy("key").select(F.to_json("key").alias("key")).collect()
    cuts = [sample[len(sample) * i // n_ranges]["key"] for i in range(1, n_ranges)] if sample else []
    return list(dict.fromkeys(cuts))


def _key(keys: list[str]) -> Column:
    """The key as a struct of nullable fields, the type of the parsed bounds: otherwise every
    comparison would first cast the struct."""
    return F.struct(*[F.when(F.lit(True), F.col(k)).alias(f"k{i}") for i, k in enumerate(keys)])


def with_range(df: DataFrame, keys: list[str], bounds: list[str]) -> DataFrame:
    """`df` with `_range`, the number of bounds at or below the row's key, found by bisection.

    Rows whose group has no bound inside it are in range 0: see `spans_ranges`. JSON may round
    a bound (times to milliseconds); any ascending bounds give a right result.

    Each step of the bisection is a projection of its own and stays in generated code; a
    higher-order function would be interpreted and costs several times as much.
    """
    if not bounds:
        return df.withColumn("_range", F.lit(0))
    kinds = ", ".join(f"k{i}: {df.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    # constant: parsed once while the plan is made
    table = F.from_json(F.lit(f"[{','.join(bounds)}]"), f"array<struct<{kinds}>>")
    large = spans_ranges(df, keys[0], bounds)
    ranged = df.withColumns({"_key": F.when(large, _key(keys)), "_range": F.lit(0)})
    for step in [1 << i for i in reversed(range(len(bounds).bit_length()))]:
        # past the end `get` is null, which is not <= key; neither is anything <= a null key
        passed = F.get(table, F.col("_range") + F.lit(step - 1)) <= F.col("_key")
        ranged = ranged.withColumn("_range", F.col("_range") + F.when(passed, F.lit(step)).otherwise(F.lit(0)))
    return ranged.drop("_key")


def spans_ranges(df: DataFrame, column: str, bounds: list[str]) -> Column:
    """Whether a row's group has a bound inside it, judged by the leading group column.

    The rows of every other group are in one range anyway: they need neither a bisection nor
    totals per range. Types other than text and whole numbers count every group.
    """
    kind = df.schema[column].dataType
    values = {json.loads(bound).get("k0") for bound in bounds}
    null = f"`{column}` IS NULL" if None in values else "false"
    values -= {None}
    if isinstance(kind, T.StringType):
        texts = ["'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in sorted(values)]
    elif isinstance(kind, (T.LongType, T.IntegerType)):
        texts = [str(v) for v in sorted(values)]
    else:
        return F.lit(True)
    return F.expr(f"{null} OR coalesce(`{column}` IN ({', '.join(texts)}), false)" if texts else null)


def running_totals(
    df: DataFrame, totals: list[Running], order_by: list[str], n_ranges: int | None = None, range_by: list[str] | None = None
) -> DataFrame:
    """`df` with one exclusive running total per entry of `totals`.

    The groups must be nested, the columns of a coarser one leading those of a finer, and
    `order_by` must be unique within the coarsest group, otherwise ties are in no order. One
    shuffle of the rows, on (range, coarsest group), serves every total. `range_by` names the leading
    columns of the order that ranges are cut by, where the others are too long to be sampled: sampled
    keys reach the driver and are literals of the plan.

    `df` is read three times: for the sample, for the totals and for the rows. If it is costly,
    or does not give the same rows each time, cut its lineage first.
    """
    if not order_by:
        raise ValueError("A running total needs an explicit order: name the columns in order_by.")
    own = {"_row", "_range", "_key", *[f"_v_{t.name}" for t in totals], *[t.name for t in totals]}.intersection(df.columns)
    if own:
        raise ValueError(f"Rename the columns {sorted(own)}: running totals use these names themselves.")
    totals = sorted(totals, key=lambda t: len(t.group))
    for coarse, fine in zip(totals, totals[1:]):
        if fine.group[: len(coarse.group)] != coarse.group:
            raise ValueError("The groups of the running totals must be nested, the coarser leading.")
    range_by = order_by if range_by is None else range_by
    if list(range_by) != list(order_by[: len(range_by)]):
        raise ValueError("Ranges are cut by the leading columns of the order.")
    keys = [*totals[0].group, *[c for c in range_by if c not in totals[0].group]]
    bounds = range_bounds(df, keys, n_ranges)
    ranged = with_range(df, keys, bounds).withColumns(
        {
            f"_v_{t.name}": (F.lit(t.value) if isinstance(t.value, int) else F.col(t.value)).cast("bigint")
            for t in totals
        }
    )

    # one pass over the groups that span ranges gives their totals per range
    finest = list(totals[-1].group)
    values = [f"_v_{t.name}" for t in totals]
    levels = sorted({t.group for t in totals}, key=len)
    sums = (
        ranged.where(spans_ranges(df, keys[0], bounds))
        .groupingSets([["_range", *group] for group in levels], "_range", *finest)
        .agg(F.grouping_id().alias("_level"), *[F.sum(v).alias(v) for v in values])
    )
    # what each range starts from: a window of at most one entry per range
    before = Window.partitionBy("_level", *finest).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    level_of = {group: (1 << (len(finest) - len(group))) - 1 for group in levels}
    starts = sums.select(
        "_range", *finest,
        *[
            F.when(F.col("_level") == level_of[t.group], F.sum(v).over(before)).alias(v)
            for t, v in zip(totals, values)
        ],
        F.lit(0).alias("_row"),
    )
    rows = ranged.withColumn("_row", F.lit(1)).unionByName(starts, allowMissingColumns=True)
    for total in totals:
        running = (
            Window.partitionBy("_range", *total.group).orderBy("_row", *order_by)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        rows = rows.withColumn(total.name, F.sum(f"_v_{total.name}").over(running))
    return rows.where("_row = 1").select(*df.columns, *[F.coalesce(t.name, F.lit(0)).alias(t.name) for t in totals])


def place_records(
    flattened: DataFrame,
    options: SheetSinkOptions,
    order_by: list[str],
    header_depth: int,
    n_ranges: int | None = None,
) -> DataFrame:
    """Where each record goes: `first_row` of its data rows in the sheet, whether it is the
    sheet's first record (which also carries the header rows), and its batch.

    `flattened` needs the target columns, `n_rows` and the `order_by` columns.
    """
    totals = [Running("_ordinal", ("spreadsheet_name",), 1), Running("_offset", tuple(TARGET), "n_rows")]
    head = header_depth if options.write_schema else 0
    return (
        running_totals(flattened, totals, order_by, n_ranges)
        .withColumn("is_first", F.col("_offset") == 0)
        .withColumn("first_row", F.col("_offset") + F.lit(head))
        .withColumn("batch_no", F.floor(F.col("_ordinal") / F.lit(options.max_buffer)))
        .drop("_ordinal", "_offset")
    )


def extension(needed: Column, current: int, minimum: int) -> Column:
    """How far to extend a dimension in one step; 0 if it is large enough."""
    missing = needed - F.lit(current)
    return F.when(missing > 0, F.greatest(missing, F.lit(minimum))).otherwise(F.lit(0)).cast("bigint")


def sheet_extents(
    flattened: DataFrame, options: SheetSinkOptions, header_depth: int, header_width: int
) -> DataFrame:
    """Rows, columns and extensions per target sheet: one map-side combined aggregation."""
    head = header_depth if options.write_schema else 0
    totals = flattened.groupBy(*TARGET).agg(
        F.count(F.lit(1)).alias("n_records"), (F.sum("n_rows") + F.lit(head)).cast("bigint").alias("rows_written")
    )
    return totals.select(
        *TARGET, "n_records", "rows_written", F.lit(header_width).alias("columns_written"),
        extension(F.col("rows_written"), options.initial_rows, options.min_extension).alias("rows_added"),
        extension(F.lit(header_width), options.initial_columns, 0).alias("columns_added"),
    )


def batch_sizes(placed: DataFrame) -> DataFrame:
    """Records per batch, the largest first."""
    return (
        placed.groupBy("spreadsheet_name", "batch_no").agg(F.count(F.lit(1)).alias("n_records"))
        .orderBy(F.desc("n_records"), "spreadsheet_name", "batch_no")
    )
