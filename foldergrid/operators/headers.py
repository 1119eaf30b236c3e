"""Column headers of sheets: one or two levels, types inferred from a sample row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldergrid.functions.addresses import column_letters
from foldergrid.model import COLUMN_TITLE, SHEET_KEY, SheetSourceOptions

@dataclass(frozen=True)
class Header:
    """A resolved column: a plain one, or a group of sub-columns."""

    col_index: int
    title: str
    kind: str | None
    subs: tuple[tuple[int, str, str], ...] = ()

    @property
    def columns(self) -> list[int]:
        return [col for col, _, _ in self.subs] if self.subs else [self.col_index]


def cell_type(formatting: str = "values_only") -> Column:
    """Spark type a sampled cell implies."""
    number = F.lit("double" if formatting == "values_only" else "string")
    dated = (
        F.when(F.col("num_format") == "DATE", F.lit("date"))
        .when(F.col("num_format") == "TIME", F.lit("bigint"))
        .when(F.col("num_format") == "DATE_TIME", F.lit("timestamp"))
        .otherwise(number)
    )
    return F.when(F.col("eff_num").isNotNull(), dated).when(F.col("eff_bool").isNotNull(), F.lit("boolean")).otherwise("string")


def usable_title(title: Column, column: Column) -> Column:
    """The title, or the column letters when it cannot name a field."""
    return F.when(title.rlike(COLUMN_TITLE), title).otherwise(column_letters(column + 1))


def header_merges(merges: DataFrame, options: SheetSourceOptions) -> DataFrame:
    """Ranges of the header row that span several columns; each makes a column group."""
    row = options.header_row - 1
    return merges.where(
        (F.col("start_row") == row) & (F.col("end_row") == row + 1) & (F.col("end_col") - F.col("start_col") > 1)
    )


def invalid_header_merges(merges: DataFrame, options: SheetSourceOptions) -> DataFrame:
    """Ranges that reach into the header row from above, which a readable sheet must not have."""
    row = options.header_row - 1
    return merges.where((F.col("start_row") < row) & (F.col("end_row") > row))


def resolve_headers(cells: DataFrame, merges: DataFrame, options: SheetSourceOptions) -> DataFrame:
    """Headers of every sheet at once.

    (sheet key, col_index, title, sub_index, sub_title, data_col, type); plain columns have
    null sub_index and sub_title. Reads at most four rows per sheet, once: title, sub-title
    and sample of a column and its place in a merge meet in one aggregation per (sheet,
    column). The windows after it hold the columns of one sheet.
    """
    row = options.header_row - 1
    # the first data row depends on whether the sheet has a second header row
    plain_row, nested_row = options.first_data_row(1) - 1, options.first_data_row(2) - 1
    text = F.when(F.length("formatted") > 0, F.col("formatted"))
    kind = cell_type(options.formatting)

    def at(index: int, value: Column) -> Column:
        return F.when(F.col("row_idx") == index, value)

    titles = cells.where(F.col("row_idx").isin(sorted({row, row + 1, plain_row, nested_row}))).select(
        *SHEET_KEY, "col_idx", at(row, text).alias("_title"), at(row + 1, text).alias("_sub"),
        at(plain_row, kind).alias("_plain"), at(nested_row, kind).alias("_nested"),
        F.lit(None).cast("int").alias("_start"),
    )
    none = F.lit(None).cast("string")
    members = header_merges(merges, options).select(
        *SHEET_KEY, F.explode(F.sequence("start_col", F.col("end_col") - 1)).alias("col_idx"),
        none.alias("_title"), none.alias("_sub"), none.alias("_plain"), none.alias("_nested"),
        F.col("start_col").alias("_start"),
    )
    parts = ["_title", "_sub", "_plain", "_nested", "_start"]
    columns = titles.unionByName(members).groupBy(*SHEET_KEY, "col_idx").agg(*[F.max(p).alias(p) for p in parts])

    head = F.coalesce("_start", "col_idx")
    group = Window.partitionBy(*SHEET_KEY, head)
    titled = columns.select(
        *SHEET_KEY, "col_idx", *parts, head.alias("col_index"),
        F.max(F.when(F.col("col_idx") == head, F.col("_title"))).over(group).alias("_head_title"),
    ).where(F.col("_head_title").isNotNull())
    if options.last_column:
        titled = titled.where(F.col("col_index") < options.last_column)
    is_group = F.col("_start").isNotNull()
    has_groups = F.max(is_group).over(Window.partitionBy(*SHEET_KEY))
    return titled.select(
        *SHEET_KEY, "col_index",
        usable_title(F.col("_head_title"), F.col("col_index")).alias("title"),
        F.when(is_group, F.col("col_idx") - F.col("_start")).alias("sub_index"),
        F.when(is_group, usable_title(F.coalesce("_sub", F.lit("")), F.col("col_idx"))).alias("sub_title"),
        F.col("col_idx").alias("data_col"),
        F.coalesce(F.when(has_groups, F.col("_nested")).otherwise(F.col("_plain")), F.lit("string")).alias("type"),
    )


def default_headers(cells: DataFrame, options: SheetSourceOptions, sheets: DataFrame | None = None) -> DataFrame:
    """Headers A, B, … of every sheet without column names: as wide as its first data row.

    A sheet of `sheets` whose first data row is empty has the configured number of columns.
    """
    first = options.first_data_row(0) - 1
    found = cells.where(F.col("row_idx") == first).select(*SHEET_KEY, "col_idx")
    if sheets is not None:
        found = found.unionByName(sheets.select(*SHEET_KEY, F.lit(None).cast("int").alias("col_idx")))
    width = F.max(F.col("col_idx") + 1)
    if options.last_column:
        width = F.least(width, F.lit(options.last_column))  # least passes over a null
    return (
        found.groupBy(*SHEET_KEY)
        .agg(width.alias("_width"))
        .where("_width > 0")
        .select(*SHEET_KEY, F.explode(F.sequence(F.lit(0), F.col("_width") - 1)).alias("col_index"))
        .select(
            *SHEET_KEY, "col_index", column_letters(F.col("col_index") + 1).alias("title"),
            F.lit(None).cast("int").alias("sub_index"), F.lit(None).cast("string").alias("sub_title"),
            F.col("col_index").alias("data_col"), F.lit("string").alias("type"),
        )
    )


def duplicate_titles(headers: DataFrame) -> DataFrame:
    """Titles used by more than one column of a sheet, and sub-titles repeated in a group."""
    top = (
        headers.where(F.coalesce("sub_index", F.lit(0)) == 0)
        .groupBy(*SHEET_KEY, "title").agg(F.count(F.lit(1)).alias("uses")).where("uses > 1")
        .withColumn("sub_title", F.lit(None).cast("string"))
    )
    sub = (
        headers.where(F.col("sub_index").isNotNull())
        .groupBy(*SHEET_KEY, "col_index", "title", "sub_title").agg(F.count(F.lit(1)).alias("uses"))
        .where("uses > 1").drop("col_index")
    )
    return top.unionByName(sub)


def schema_mismatches(headers: DataFrame) -> DataFrame:
    """Sheets of a spreadsheet whose columns differ from those of its lowest-numbered sheet.

    A sheet is reduced to one signature (its columns are bounded), so what is compared
    across sheets is one short row each; the lowest sheet is a min aggregate, not a sort.
    """
    column = F.concat_ws(
        ":", "data_col", "title", F.coalesce("sub_title", F.lit("")), "type"
    )
    signed = headers.groupBy(*SHEET_KEY).agg(
        F.sha2(F.concat_ws("|", F.array_sort(F.collect_list(column))), 256).alias("signature")
    )
    first = signed.groupBy("spreadsheet_id").agg(
        F.min(F.struct("sheet_id", "signature")).alias("_first")
    )
    return (
        signed.join(first, "spreadsheet_id")
        .where(F.col("signature") != F.col("_first.signature"))
        .select(*SHEET_KEY, F.col("_first.sheet_id").alias("expected_sheet_id"))
    )


def header_list(headers: DataFrame, sheet: dict) -> list[Header]:
    """The headers of one sheet on the driver: as many rows as the sheet has columns."""
    rows = (
        headers.where(
            (F.col("spreadsheet_id") == F.lit(sheet["spreadsheet_id"])) & (F.col("sheet_id") == F.lit(sheet["sheet_id"]))
        )
        .drop(*SHEET_KEY).orderBy("col_index", "sub_index").collect()
    )
    grouped: dict[int, list] = {}
    for row in rows:
        grouped.setdefault(row["col_index"], []).append(row)
    found = []
    for col, group in grouped.items():
        head = group[0]
        if head["sub_index"] is None:
            found.append(Header(col, head["title"], head["type"]))
        else:
            subs = tuple((r["data_col"], r["sub_title"], r["type"]) for r in group)
            found.append(Header(col, head["title"], None, subs))
    check_unique(found)
    return found


def check_unique(headers: list[Header]) -> None:
    problems, seen = [], set()
    for header in headers:
        if header.title in seen:
            problems.append(f"Two columns are called '{header.title}'.")
        seen.add(header.title)
        names = [name for _, name, _ in header.subs]
        problems += [f"Two parts of column '{header.title}' are called '{n}'." for n in sorted({n for n in names if names.count(n) > 1})]
    if problems:
        raise ValueError(" ".join(problems))


def first_sheet(sheets: DataFrame) -> dict | None:
    """The sheet whose header row gives the schema: first by spreadsheet, then by index."""
    row = (
        sheets.select("spreadsheet_name", *SHEET_KEY, "sheet_index")
        .orderBy("spreadsheet_name", "spreadsheet_id", "sheet_index").limit(1).collect()
    )
    return row[0].asDict() if row else None
