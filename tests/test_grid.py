import json
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from foldergrid.model import CELLS_DDL, MERGES_DDL, SHEETS_DDL, SheetSourceOptions
from foldergrid.operators import lookup
from foldergrid.operators.headers import (
    Header, check_unique, default_headers, duplicate_titles, header_list, invalid_header_merges, resolve_headers,
    schema_mismatches,
)
from foldergrid.operators.lookup import fits_broadcast, lookup_join
from foldergrid.operators.merges import BUCKET_ROWS, bucketed, clip_merges, fill_blocks, fill_merged_cells
from foldergrid.operators.rows import build_rows, rows_from_arrays
from foldergrid.operators.selection import missing_sheets, read_chunks, row_spine, sample_rows, select_sheets
from foldergrid.operators.sheetmeta import address_pairs, address_table, metadata_problems, pair_problems, sheet_metadata
from foldergrid.plans.sheet_source import infer_headers, read_sheets
from foldergrid.sources.large_documents import read_large_documents
from foldergrid.sources.documents import cells_of, merges_of, read_documents, row_arrays_of, sheets_of

SHEET = {"spreadsheet_id": "b", "sheet_id": 0}


def text(row, col, value, **more):
    cell = dict(spreadsheet_id="b", sheet_id=0, row_idx=row, col_idx=col, formatted=value, user_str=value, non_empty=True)
    return {**cell, **more}


def number(row, col, value, fmt=None, **more):
    return text(row, col, str(value), user_str=None, eff_num=float(value), user_num=float(value), num_format=fmt, **more)


def blank(row, col, **more):
    return text(row, col, None, user_str=None, non_empty=False, **more)


def cells_df(spark, cells):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(CELLS_DDL)
    return spark.createDataFrame([tuple(c.get(n) for n in schema.names) for c in cells], schema)


def merges_df(spark, *merges):
    return spark.createDataFrame([("b", 0, *m) for m in merges], MERGES_DDL)


def sheets_df(spark, rows=10, cols=5, n=1):
    return spark.createDataFrame([("b", "Book", i, i, f"t{i}", rows, cols) for i in range(n)], SHEETS_DDL)


def found(headers):
    return [(h.col_index, h.title, [(c, s) for c, s, _ in h.subs]) for h in headers]


def test_nested_header(spark):
    cells = cells_df(spark, [
        text(0, 0, "a"), text(0, 1, "b"), blank(0, 2), text(1, 0, "no header value"), text(1, 1, "c"), text(1, 2, "d"),
        number(2, 0, 1), number(2, 1, 43841, "DATE"), text(2, 2, "x")])
    headers = header_list(resolve_headers(cells, merges_df(spark, (0, 1, 1, 3)), SheetSourceOptions(last_column=3)), SHEET)
    assert headers == [Header(0, "a", "double"), Header(1, "b", None, ((1, "c", "date"), (2, "d", "string")))]


def test_column_cap(spark):
    cells = cells_df(spark, [text(0, i, t) for i, t in enumerate("abc")])
    headers = header_list(resolve_headers(cells, merges_df(spark), SheetSourceOptions(last_column=2)), SHEET)
    assert found(headers) == [(0, "a", []), (1, "b", [])]


def test_bad_titles(spark):
    cells = cells_df(spark, [
        text(0, 0, "a"), text(0, 1, "title with space"), blank(0, 2), text(1, 0, "no header value"),
        text(1, 1, "9titleWithFirstNumber"), text(1, 2, "d")])
    headers = header_list(resolve_headers(cells, merges_df(spark, (0, 1, 1, 3)), SheetSourceOptions()), SHEET)
    assert found(headers) == [(0, "a", []), (1, "B", [(1, "B"), (2, "d")])]


def test_column_after_a_group_and_adjacent_groups(spark):
    cells = cells_df(spark, [text(0, 0, "g"), text(0, 2, "h"), text(0, 5, "plain"), *[text(1, c, f"s{c}") for c in range(6)]])
    headers = header_list(resolve_headers(cells, merges_df(spark, (0, 1, 0, 2), (0, 1, 2, 5)), SheetSourceOptions()), SHEET)
    assert found(headers) == [(0, "g", [(0, "s0"), (1, "s1")]), (2, "h", [(2, "s2"), (3, "s3"), (4, "s4")]), (5, "plain", [])]


def test_sample_row_is_the_first_data_row(spark):
    # metadata rows lie between the titles and the data
    cells = cells_df(spark, [text(0, 0, "a"), text(1, 0, "meta"), text(2, 0, "meta"), number(3, 0, 5)])
    options = SheetSourceOptions(extract_metadata=True, first_header_row=2, last_header_row=3)
    assert header_list(resolve_headers(cells, merges_df(spark), options), SHEET) == [Header(0, "a", "double")]


def test_types(spark):
    cells = cells_df(spark, [
        *[text(0, i, f"c{i}") for i in range(7)], number(1, 0, 1, "DATE"), number(1, 1, 1, "TIME"), number(1, 2, 1, "DATE_TIME"),
        number(1, 3, 1, "NUMBER"), text(1, 4, "TRUE", eff_bool=True), text(1, 5, "x")])
    kinds = lambda o: [h.kind for h in header_list(resolve_headers(cells, merges_df(spark), o), SHEET)]
    assert kinds(SheetSourceOptions()) == ["date", "bigint", "timestamp", "double", "boolean", "string", "string"]
    assert kinds(SheetSourceOptions(formatting="formatted"))[3] == "string"


def test_invalid_and_duplicate_headers(spark):
    merges = merges_df(spark, (0, 2, 0, 1), (1, 2, 0, 2))
    options = SheetSourceOptions(column_names="custom_row", names_row=2)
    assert [r.start_row for r in invalid_header_merges(merges, options).collect()] == [0]
    cells = cells_df(spark, [text(0, 0, "a"), text(0, 1, "a"), text(0, 2, "g"), text(1, 2, "s"), text(1, 3, "s")])
    headers = resolve_headers(cells, merges_df(spark, (0, 1, 2, 4)), SheetSourceOptions())
    assert sorted((r.title, r.sub_title, r.uses) for r in duplicate_titles(headers).collect()) == [("a", None, 2), ("g", "s", 2)]
    with pytest.raises(ValueError, match="Two columns are called 'a'. Two parts of column '.*' are called 's'."):
        header_list(headers, SHEET)
    with pytest.raises(ValueError):
        infer_headers(sheets_df(spark), cells, merges, options)
    check_unique([Header(0, "a", "string"), Header(1, "b", "string")])


def test_default_headers(spark):
    cells = cells_df(spark, [text(0, i, "x") for i in range(28)])
    none = SheetSourceOptions(column_names="no_column_names")
    titles = [h.title for h in header_list(default_headers(cells, none), SHEET)]
    assert titles[:2] == ["A", "B"] and titles[-1] == "AB" and len(titles) == 28
    assert len(header_list(default_headers(cells, replace(none, last_column=3)), SHEET)) == 3
    # nothing in the first data row: as many columns as configured
    empty = cells_df(spark, [text(3, 0, "x")])
    assert [h.title for h in infer_headers(sheets_df(spark), empty, merges_df(spark), replace(none, last_column=2))] == ["A", "B"]
    with pytest.raises(ValueError, match="has no column names"):
        infer_headers(sheets_df(spark), empty, merges_df(spark), SheetSourceOptions())


def test_schema_mismatches(spark):
    cells = cells_df(spark, [text(0, 0, "a"), {**text(0, 0, "a"), "sheet_id": 1}, {**text(0, 0, "z"), "sheet_id": 2}])
    headers = resolve_headers(cells, merges_df(spark), SheetSourceOptions())
    assert [(r.sheet_id, r.expected_sheet_id) for r in schema_mismatches(headers).collect()] == [(2, 0)]


GROUPED = [Header(0, "h0", "string"), Header(1, "h1", None, ((1, "h10", "string"), (2, "h11", "string")))]


def test_rows_and_emptiness(spark):
    cells = cells_df(spark, [text(1, c, f"r0{c}") for c in range(3)] + [blank(2, c) for c in range(3)] + [text(3, c, f"r1{c}") for c in range(3)])
    options = SheetSourceOptions()
    rows = build_rows(cells, GROUPED, options, row_spine(sheets_df(spark, rows=5), options, 1)).orderBy("row_idx").collect()
    assert [(r.row_idx, r.h0, tuple(r.h1)) for r in rows] == [
        (1, "r00", ("r01", "r02")), (2, None, (None, None)), (3, "r10", ("r11", "r12")), (4, None, (None, None))]
    kept = build_rows(cells, GROUPED, replace(options, skip_empty=True)).collect()
    assert sorted(r.row_idx for r in kept) == [1, 3]


def test_typed_cells(spark):
    headers = [Header(0, "d", "date"), Header(1, "t", "bigint"), Header(2, "ts", "timestamp"), Header(3, "n", "double"),
               Header(4, "b", "boolean"), Header(5, "s", "string")]
    cells = cells_df(spark, [
        number(1, 0, 43841.9, "DATE"), number(1, 1, 0.5, "TIME"), number(1, 2, 43841.5, "DATE_TIME"), number(1, 3, 2.5),
        text(1, 4, "TRUE", eff_bool=True), number(1, 5, 7),
        # a formula has an effective value but no entered number; text in a number column has none either
        text(2, 0, "2020-01-01", user_str=None, eff_num=43831.0, user_formula="=TODAY()"), text(2, 3, "n/a"), text(2, 5, "x")])
    rows = build_rows(cells, headers, SheetSourceOptions()).withColumn("ts", F.col("ts").cast("string")).orderBy("row_idx").collect()
    assert [str(rows[0].d), rows[0].t, rows[0].ts, rows[0].n, rows[0].b, rows[0].s] == [
        "2020-01-11", 43_200_000, "2020-01-11 12:00:00", 2.5, True, "7"]
    assert [rows[1].d, rows[1].n, rows[1].s] == [None, None, "x"]


def brute_fill(cells, merges):
    grid = {(c["row_idx"], c["col_idx"]): c for c in cells}
    filled = dict(grid)
    for a, b, c, d in merges:
        head = grid.get((a, c))
        if head and head["non_empty"]:
            for r in range(a, b):
                for col in range(c, d):
                    filled[(r, col)] = head
    return {k: v["formatted"] for k, v in filled.items()}


def test_merge_fill(spark):
    cells = [text(0, 0, "A"), text(1, 1, "covered"), text(5, 0, "keep"), blank(7, 0), text(8, 0, "under empty head"), text(9, 3, "H")]
    merges = [(0, 3, 0, 2), (7, 9, 0, 1), (9, 10, 3, 6), (20, 22, 0, 2)]
    got = fill_merged_cells(cells_df(spark, cells), merges_df(spark, *merges)).collect()
    assert {(r.row_idx, r.col_idx): r.formatted for r in got} == brute_fill(cells, merges)
    assert len(got) == len(brute_fill(cells, merges))


def test_tall_merge_is_expanded_in_chunks(spark):
    got = fill_merged_cells(cells_df(spark, [text(0, 0, "A")]), merges_df(spark, (0, 25_001, 0, 1)))
    assert got.agg(F.count("*"), F.countDistinct("row_idx"), F.max("row_idx")).first()[:] == (25_001, 25_001, 25_000)


def test_a_merge_over_a_whole_column_is_shuffled_in_blocks(spark):
    rows, head = 3_000_000, text(0, 0, "A")
    merges = merges_df(spark, (0, rows, 0, 1))
    cells = cells_df(spark, [head, text(5, 1, "x"), text(rows - 1, 1, "y")])
    assert fill_blocks(cells, merges).count() == -(-rows // BUCKET_ROWS)
    headers = [Header(0, "a", "string"), Header(1, "b", "string")]
    built = build_rows(cells, headers, SheetSourceOptions(skip_empty=True), fills=fill_blocks(cells, merges))
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "_bucket" in plan
    assert built.agg(F.count("a"), F.count("b"), F.max("row_idx")).first()[:] == (rows, 2, rows - 1)
    # nothing but the block's own ranges is looked at for a cell
    kept = fill_merged_cells(cells, merges)
    assert kept.count() == rows + 2


def test_blocks_cover_what_ranges_cover(spark):
    ranges = merges_df(spark, (0, 1, 0, 1), (1023, 1025, 0, 2), (5000, 5_000_000, 3, 4), (1024, 2048, 7, 9))
    got = bucketed(ranges).groupBy("start_col").agg(F.min("start_row"), F.max("end_row"), F.sum(F.col("end_row") - F.col("start_row")), F.count("*")).collect()
    assert {tuple(r) for r in got} == {(0, 0, 1025, 3, 3), (3, 5000, 5_000_000, 4_995_000, 4879), (7, 1024, 2048, 1024, 1)}


def test_fill_from_a_head_above_the_data(spark):
    # the head stands in the title row; only data rows are filled, and fills outrank cells
    cells = cells_df(spark, [text(0, 0, "a"), text(0, 1, "b"), text(1, 1, "old"), text(2, 1, "y")])
    options = SheetSourceOptions(skip_empty=True)
    headers = [Header(0, "a", "string"), Header(1, "b", "string")]
    merges = merges_df(spark, (0, 2, 1, 2))
    rows = read_sheets(sheets_df(spark), cells, options, merges, headers, keep_keys=True).orderBy("row_idx").collect()
    assert [(r.row_idx, r.a, r.b) for r in rows] == [(1, None, "b"), (2, None, "y")]
    clipped = clip_merges(merges_df(spark, (0, 50, 0, 9)), replace(options, auto_detect=False, last_row=10, last_column=5), 1, [1, 2])
    assert clipped.select("start_row", "end_row", "start_col", "end_col", "head_row", "head_col").first()[:] == (1, 10, 1, 3, 0, 0)


def test_wide_path_equals_narrow_path(spark):
    cells = [text(r, c, f"{r}.{c}") for r in range(1, 6) for c in range(12) if (r + c) % 3]
    headers = [Header(c, f"c{c}", "string") for c in range(12)]
    merges, options = [(1, 4, 1, 3), (5, 6, 4, 8)], SheetSourceOptions(column_names="no_column_names")
    df = cells_df(spark, cells)
    from foldergrid.operators.merges import merge_fills

    fills = merge_fills(df, merges_df(spark, *merges))
    spine = row_spine(sheets_df(spark, rows=8), options, 0)
    narrow = build_rows(df, headers, options, spine, fills)
    wide = build_rows(df, headers, options, spine, fills, wide_above=0)
    key = lambda d: sorted(map(tuple, d.collect()), key=lambda r: r[2])
    assert key(narrow) == key(wide) and len(key(wide)) == 8


def test_sheets_and_chunks(spark):
    sheets = sheets_df(spark, rows=250, n=3)
    pick = lambda **o: sorted(r.sheet_index for r in select_sheets(sheets, SheetSourceOptions(**o)).collect())
    assert pick() == [0, 1, 2]
    assert pick(sheets_to_pull="numbers", sheet_identifiers=("0", "2")) == [0, 2]
    assert pick(sheets_to_pull="titles", sheet_identifiers=("t1", "zz")) == [1]
    lacking = missing_sheets(sheets, SheetSourceOptions(sheets_to_pull="numbers", sheet_identifiers=("1", "7"))).collect()
    assert [(r.spreadsheet_id, r.missing) for r in lacking] == [("b", ["7"])]
    chunks = read_chunks(sheets.limit(1), SheetSourceOptions(), 1).select("first_row", "n_rows").collect()
    assert sorted(map(tuple, chunks)) == [(2, 100), (102, 100), (202, 49)]
    # a sheet without data rows has no chunks and no rows
    assert read_chunks(sheets_df(spark, rows=1), SheetSourceOptions(), 1).count() == 0
    footer = SheetSourceOptions(extract_metadata=True, first_footer_row=200, last_footer_row=201)
    assert row_spine(sheets.limit(1), footer, 1).agg(F.min("row_idx"), F.max("row_idx")).first()[:] == (1, 198)
    cells = cells_df(spark, [text(0, 0, "a"), text(4, 0, "b"), text(5, 0, "c")])
    assert sorted(r.formatted for r in sample_rows(cells, SHEET, [1, 6]).collect()) == ["a", "c"]


# ---------------------------------------------------------------- metadata
def test_metadata_pairs(spark):
    assert address_pairs("A1:B1,A2:B2,A5:B3") == [("A1", "B1"), ("A2", "B2"), ("A5", "B3")]
    assert address_pairs("") == []
    options = spark.createDataFrame([("A1:B2,A2:B4,A5:B7,x",)], "metadata_cells string")
    got = address_table(options).select("key_row", "key_column", "value_row", "value_column").collect()
    assert sorted(map(tuple, got)) == [(1, 1, 2, 2), (2, 1, 4, 2), (5, 1, 7, 2)]


@pytest.mark.parametrize("cells, header, footer, bad", [
    ("A3:C3,Z3:AA3,B3:YU3", (3, 3), (0, 0), []),
    ("A2:C3,Z3:Z4,B3:YU3", (3, 3), (0, 0), ["A2", "Z4"]),
    ("A6:B7,Z7:U6,B8:A8", (0, 0), (6, 8), []),
    ("A6:B7,Z7:U6,B5:A8,B8:X9", (0, 0), (6, 8), ["B5", "X9"]),
    ("D3:A3,A6:B6,Z7:F3,B8:V6", (3, 3), (6, 8), []),
    ("A6:A3,Z7:B8,B5:C8,B8:X9", (3, 3), (6, 8), ["B5", "X9"]),
])
def test_metadata_cells(cells, header, footer, bad):
    options = SheetSourceOptions(
        extract_metadata=True, first_header_row=header[0], last_header_row=header[1],
        first_footer_row=footer[0], last_footer_row=footer[1], metadata_cells=cells)
    problems = pair_problems(options)
    assert len(problems) == len(bad) and all(f"Cell {b} " in p for b, p in zip(bad, problems))


@pytest.mark.parametrize("sections, message", [
    ((0, 0, 0, 0), "Metadata needs"), ((1, 0, 0, 0), "only one of its two"), ((3, 2, 0, 0), "before it starts"),
    ((2, 4, 5, 6), "No row is left"), ((1, 1, 0, 0), "column names"), ((2, 3, 0, 0), None), ((2, 3, 9, 9), None),
])
def test_metadata_sections(sections, message):
    a, b, c, d = sections
    problems = metadata_problems(SheetSourceOptions(
        extract_metadata=True, first_header_row=a, last_header_row=b, first_footer_row=c, last_footer_row=d))
    assert (not problems) if message is None else message in problems[0]


def test_metadata_values(spark):
    cells = cells_df(spark, [text(1, 0, "k"), text(9, 1, "footer value"), text(2, 0, "empty"), blank(1, 2), text(2, 3, "k2")])
    options = SheetSourceOptions(metadata_cells="A2:B10,A3:Z3,C2:A2,D3:A2")
    assert sheet_metadata(cells, options).first().metadata == {"k": "footer value", "empty": "", "k2": "k"}
    assert sheet_metadata(cells, SheetSourceOptions()).count() == 0


def test_read_with_names_metadata_and_progress(spark):
    from pyspark.sql import Observation

    cells = cells_df(spark, [
        text(0, 0, "owner"), text(0, 1, "ann"), text(1, 0, "id"), text(1, 1, "day"), number(2, 0, 1), number(2, 1, 43841, "DATE"),
        number(4, 0, 2), text(5, 0, "total")])
    options = SheetSourceOptions(
        column_names="custom_row", names_row=2, add_names=True, extract_metadata=True, first_header_row=1, last_header_row=1,
        first_footer_row=6, last_footer_row=6, metadata_cells="A1:B1")
    progress = Observation()
    df = read_sheets(sheets_df(spark, rows=6), cells, options, progress=progress)
    assert df.columns == ["spreadsheet", "sheet", "id", "day", "metadata"]
    rows = sorted(df.collect(), key=lambda r: str(r.id))
    assert [(r.spreadsheet, r.sheet, r.id, r.day and str(r.day), r.metadata) for r in rows] == [
        ("Book", "t0", 1.0, "2020-01-11", {"owner": "ann"}), ("Book", "t0", 2.0, None, {"owner": "ann"}),
        ("Book", "t0", None, None, {"owner": "ann"})]
    assert progress.get["rows"] == 3
    with pytest.raises(ValueError, match="would be called"):
        read_sheets(sheets_df(spark, rows=6), cells, replace(options, metadata_field="id"))


def test_salted_lookup_equals_broadcast(spark):
    big = spark.range(1000).select((F.col("id") % 5).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, v string")
    assert fits_broadcast(small) and not fits_broadcast(small, max_rows=1) and not fits_broadcast(small, max_bytes=5)
    for how in ("left", "inner", "left_semi"):
        near = lookup_join(big, small, ["k"], ["id"], how)
        far = lookup_join(big, small, ["k"], ["id"], how, max_rows=0)
        assert sorted(map(str, near.collect())) == sorted(map(str, far.collect()))


def test_lookup_beyond_the_bound_is_shuffled_and_only_busy_keys_are_copied(spark, monkeypatch):
    big = spark.range(400).selectExpr("CASE WHEN id < 300 THEN 1 WHEN id < 330 THEN null ELSE id END AS k", "id")
    small = spark.range(1000).selectExpr("nullif(id, 999) AS k", "'v' || id AS v")
    for busy_rows in (10_000, 50):  # one key has more than 50
        monkeypatch.setattr(lookup, "BUSY_ROWS", busy_rows)
        for how in ("left", "inner", "left_semi"):
            near, far = (lookup_join(big, small, ["k"], ["id"], how, **bound) for bound in ({}, {"max_rows": 0}))
            assert near.columns == far.columns and sorted(map(str, near.collect())) == sorted(map(str, far.collect()))
            # the lookup table is a small file, but broadcast are no more than the busy keys
            plan = far._jdf.queryExecution()
            assert plan.sparkPlan().toString().count("BroadcastHashJoin") == (0 if busy_rows == 10_000 else 2)
            # copies are made of the lookup rows of busy keys alone
            assert ("explode([0])" in plan.optimizedPlan().toString()) == (busy_rows == 10_000)


# ---------------------------------------------------------------- documents
DOCUMENT = {
    "spreadsheetId": "b", "properties": {"title": "Book"},
    "sheets": [{
        "properties": {"sheetId": 0, "title": "t", "index": 0, "gridProperties": {"rowCount": 9, "columnCount": 3}},
        "merges": [{"startRowIndex": 2, "endRowIndex": 4, "startColumnIndex": 1, "endColumnIndex": 2}],
        "data": [
            {"rowData": [{"values": [{"formattedValue": "a"}, {"formattedValue": "b"}]}, {}]},
            {"startRow": 2, "rowData": [
                {"values": [{"effectiveValue": {"numberValue": 1.5}, "userEnteredValue": {"numberValue": 1.5}, "formattedValue": "1.5"},
                            {"formattedValue": "x"}]},
                {"values": [{}, {"userEnteredFormat": {"numberFormat": {"type": "DATE"}}}]}]},
        ]}],
}


def test_documents(spark, tmp_path):
    path = tmp_path / "book.json"
    path.write_text(json.dumps(DOCUMENT))
    documents = read_documents(spark, str(path))
    assert sheets_of(documents).first()[:] == ("b", 0, "Book", 0, "t", 9, 3)
    assert merges_of(documents).first()[:] == ("b", 0, 2, 4, 1, 2)
    cells = cells_of(documents)
    got = {(r.row_idx, r.col_idx): (r.formatted, r.eff_num, r.num_format, r.non_empty) for r in cells.collect()}
    assert got == {(0, 0): ("a", None, None, True), (0, 1): ("b", None, None, True), (2, 0): ("1.5", 1.5, None, True),
                   (2, 1): ("x", None, None, True), (3, 0): (None, None, None, False), (3, 1): (None, None, "DATE", True)}
    path.write_text(json.dumps(DOCUMENT, indent=1))
    documents = read_documents(spark, str(path), whole_files=True)
    rows = read_sheets(sheets_of(documents), cells_of(documents), SheetSourceOptions(skip_empty=True), merges_of(documents),
                       [Header(0, "a", "double"), Header(1, "b", "string")], keep_keys=True).orderBy("row_idx").collect()
    assert [(r.row_idx, r.a, r.b) for r in rows] == [(2, 1.5, "x"), (3, None, "x")]


def test_documents_of_a_folder(spark, tmp_path):
    from foldergrid import FileSourceOptions, documents_in_folder, read_documents_rows

    path = tmp_path / "books.json"
    path.write_text("\n".join(json.dumps({**DOCUMENT, "spreadsheetId": i}) for i in ("a", "b", "c")))
    sheet = "application/vnd.google-apps.spreadsheet"
    files = spark.createDataFrame(
        [("a", sheet, ["f"], "x"), ("b", sheet, ["f"], "y"), ("c", sheet, ["g"], "x"), ("d", "text/csv", ["f"], "x")],
        "id string, mimeType string, parents array<string>, name string").withColumn("modifiedTime", F.current_timestamp())
    chosen = documents_in_folder(read_documents(spark, str(path)), files, FileSourceOptions(folder="f", filter="name = 'x'"))
    assert [r.spreadsheetId for r in chosen.collect()] == ["a"]
    # the first data row is blank, so both columns are text
    rows = read_documents_rows(chosen, SheetSourceOptions(skip_empty=True)).collect()
    assert sorted((r.a or "", r.b) for r in rows) == [("", "x"), ("1.5", "x")]


def test_rows_from_arrays_without_a_shuffle(spark, tmp_path):
    path = tmp_path / "book.json"
    [sheet] = DOCUMENT["sheets"]
    block = {"rowData": [row for part in sheet["data"] for row in part["rowData"]]}
    path.write_text(json.dumps({**DOCUMENT, "sheets": [{**sheet, "data": [block]}]}))
    documents = read_documents(spark, str(path))
    grid = row_arrays_of(documents, one_block=True).where("row_idx >= 2")
    headers = [Header(0, "a", "double"), Header(1, "b", "string")]
    direct = rows_from_arrays(grid, headers, SheetSourceOptions(skip_empty=True))
    assert "Exchange" not in direct._jdf.queryExecution().executedPlan().toString()
    assert [(r.row_idx, r.a, r.b) for r in direct.orderBy("row_idx").collect()] == [(2, 1.5, "x"), (3, None, None)]
    from foldergrid.operators.merges import merge_fills

    filled = rows_from_arrays(grid, headers, SheetSourceOptions(skip_empty=True), fills=merge_fills(cells_of(documents), merges_of(documents)))
    assert [(r.row_idx, r.a, r.b) for r in filled.orderBy("row_idx").collect()] == [(2, 1.5, "x"), (3, None, "x")]


def test_the_share_read(spark):
    from pyspark.sql import Observation

    from foldergrid.operators.selection import progress_share, read_progress

    cells = cells_df(spark, [text(0, 0, "a"), text(1, 0, "x"), text(3, 0, "y")])
    options = SheetSourceOptions(skip_empty=True)
    sheets, seen = sheets_df(spark, rows=5), Observation()
    rows = read_sheets(sheets, cells, options, headers=[Header(0, "a", "string")], keep_keys=True, progress=seen)
    assert [(r["rows"], r["total"], r["share"]) for r in read_progress(rows, sheets, options, 1).collect()] == [(2, 4, 0.5)]
    rows.collect()
    assert progress_share(seen.get["rows"], sheets, options, 1) == 0.5
    assert progress_share(0, sheets.limit(0), options, 1) == 1.0
    assert [r["share"] for r in read_progress(rows.limit(0), sheets, options, 1).collect()] == [0.0]


def large_book(rng, pretty):
    """A document with everything that may stand around rows, and its cells."""
    tricky = ['say "values"', "values", '\\"values\\":', "]},{", '"rowData":[{', "{}", "ä\u2028b", "", "}" * 5, "[" * 5]
    cell = lambda: {"formattedValue": rng.choice(tricky)} if rng.random() < 0.8 else {
        "formattedValue": "x", "dataValidation": {"condition": {"type": "ONE_OF_LIST", "values": [{"userEnteredValue": "a]},{"}, {}]}}}
    row = lambda: {} if rng.random() < 0.3 else {"values": [cell() for _ in range(rng.randrange(0, 4))]}
    block = lambda: {**({"startRow": rng.randrange(50)} if rng.random() < 0.5 else {}), "rowData": [row() for _ in range(rng.randrange(0, 12))],
                     **({"startColumn": 2} if rng.random() < 0.5 else {}), "rowMetadata": [{"pixelSize": 1}, {}]}
    sheets = [{"data": [block() for _ in range(rng.randrange(0, 4))], "properties": {"sheetId": i, "title": "a\"]},{"}, "merges": [{"endRowIndex": 2, "endColumnIndex": 2}],
               "conditionalFormats": [{"booleanRule": {"condition": {"type": "X", "values": [{"userEnteredValue": "1"}]}}}]} for i in range(rng.randrange(1, 4))]
    return json.dumps({"spreadsheetId": f"book{rng.random()}", "sheets": sheets, "properties": {"title": "t"}}, indent=rng.choice([1, 4]) if pretty else None, ensure_ascii=rng.random() < 0.5)


def test_blocks_of_large_documents_are_not_broadcast(spark, tmp_path, plans_of):
    """A document may have as many blocks as rows: what is known of each is joined by a shuffle."""
    (tmp_path / "a.json").write_text(json.dumps({"spreadsheetId": "b", "sheets": [{"data": [
        {"startRow": 3 * i, "rowData": [{"values": [{"formattedValue": str(i)}]}]} for i in range(50)]}]}))
    large, plans = plans_of(lambda: read_large_documents(spark, str(tmp_path)))
    joins = [plan for plan in plans if "_leading" in plan and "Join" in plan]
    assert joins and all("SortMergeJoin" in plan and "BroadcastHashJoin" not in plan for plan in joins)
    assert sorted((r["row_idx"], r["formatted"]) for r in large.cells().collect()) == [(3 * i, str(i)) for i in range(50)]


def test_large_documents_give_the_same_cells(spark, tmp_path):
    rng = random.Random(4)
    for i in range(24):
        (tmp_path / f"{i}.json").write_text(large_book(rng, i % 2), encoding="utf-8")
    (tmp_path / "none.json").write_text('{"spreadsheetId": "empty", "sheets": [{"properties": {"sheetId": 7}}]}')
    small = read_documents(spark, str(tmp_path), whole_files=True)
    compared = ["spreadsheet_id", "sheet_id", "row_idx", "col_idx", "formatted"]
    want = sorted(map(tuple, cells_of(small).select(*compared).collect()), key=str)
    bytes_ = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("128m", "700"):  # whole files, and files that many tasks read
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            large = read_large_documents(spark, str(tmp_path))
            assert sorted(map(tuple, large.cells().select(*compared).collect()), key=str) == want and len(want) > 300
            for part in (sheets_of, merges_of):
                assert sorted(map(str, part(large.documents).collect())) == sorted(map(str, part(small).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
