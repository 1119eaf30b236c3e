"""Inputs that once gave wrong results or lost data."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from foldergrid.functions import addresses, serial
from foldergrid.functions.addresses import parse_address
from foldergrid.model import NATIVE_MIMES, FileSourceOptions, SheetSinkOptions, SheetSourceOptions
from foldergrid.operators.bodies import plan_parts
from foldergrid.operators.headers import header_list, invalid_header_merges, resolve_headers, usable_title
from foldergrid.operators.layout import Running, range_bounds, running_totals, with_range
from foldergrid.operators.selection import read_chunks, sample_rows
from foldergrid.plans.file_source import read_files
from foldergrid.session import path_exists
from foldergrid.sinks.files import write_files
from foldergrid.sinks.sheets import Layout, place, update_documents
from foldergrid.sources.documents import cells_of, read_documents, row_arrays_of
from foldergrid.sources.folder import list_folder, mime_of


def test_names_lose_no_file(spark, tmp_path):
    folder = str(tmp_path / "out")
    names = ["a/b", "a_b", "", "..", ".", "_staging.txt", "_staging_notes.csv", "x.txt", ".hidden", "tab\tname"]
    rows = spark.createDataFrame([(n, None, n.encode()) for n in names], "name string, mimeType string, body binary")
    for runs in (1, 2):
        manifest = write_files(rows, folder).collect()
        listed = [r.name for r in list_folder(spark, folder).collect()]
        assert len(manifest) == len(names) and len(set(r.path for r in manifest)) == len(names)
        assert len(listed) == len(set(listed)) == runs * len(names)
    assert {"_staging.txt", "x.txt", ".hidden"} <= set(listed)
    assert [p.name for p in tmp_path.iterdir()] == ["out"]  # nothing is left behind
    assert all((tmp_path / "out" / r.path.rsplit("/", 1)[1]).read_bytes() == r.name.encode() for r in manifest)


def test_types_are_the_same_everywhere(spark):
    import mimetypes

    before = spark.createDataFrame([("a.csv",), ("b.md",), ("c",)], "n string").select(mime_of(F.col("n")).alias("m")).collect()
    mimetypes.add_type("text/odd", ".csv")
    assert spark.createDataFrame([("a.csv",), ("b.md",), ("c",)], "n string").select(mime_of(F.col("n")).alias("m")).collect() == before
    mimetypes.add_type("text/csv", ".csv")


def test_a_deep_tree_is_listed_whole(spark, tmp_path):
    want = set()
    for depth in range(5):
        folder = tmp_path.joinpath(*[f"d{i}" for i in range(depth)])
        folder.mkdir(exist_ok=True)
        for name in ("one.txt", "_two", ".three", "a\nb"):
            (folder / name).write_text("x" * depth)
            want.add((f"{folder}/{name}", depth))
    (tmp_path / "empty").mkdir()
    got = list_folder(spark, str(tmp_path), recursive=True).collect()
    assert {(r.id, r.size) for r in got} == want and len(got) == len(want)
    assert {r.name for r in got} == {"one.txt", "_two", ".three", "a\nb"}


def test_all_columns_have_headers(spark):
    width = 18_300
    cells = spark.range(width).select(
        F.lit("s").alias("spreadsheet_id"), F.lit(0).cast("bigint").alias("sheet_id"), F.lit(0).cast("bigint").alias("row_idx"),
        F.col("id").cast("int").alias("col_idx"), F.concat(F.lit("c"), "id").alias("formatted"), F.lit(None).cast("double").alias("eff_num"),
        F.lit(None).cast("boolean").alias("eff_bool"), F.lit(None).cast("string").alias("num_format"),
    )
    merges = spark.createDataFrame([], "spreadsheet_id string, sheet_id bigint, start_row bigint, end_row bigint, start_col int, end_col int")
    headers = resolve_headers(cells, merges, SheetSourceOptions())
    assert len(header_list(headers, {"spreadsheet_id": "s", "sheet_id": 0})) == width


def test_a_record_of_many_rows_is_one_document(spark):
    options = SheetSinkOptions(merge_data_cells=True)
    records = spark.range(1).select("id", F.sequence(F.lit(1), F.lit(450)).alias("a"))
    layout = Layout.of(records.schema, options)
    [only] = update_documents(place(records, options, ["id"]), layout, options).collect()
    assert (only.n_rows, only.n_merges, only.part_no) == (451, 1, 0)
    small = SheetSinkOptions(merge_data_cells=True, max_batch_rows=100)
    parts = update_documents(place(records, small, ["id"]), layout, small).orderBy("part_no").collect()
    assert [p.n_rows for p in parts] == [100, 100, 100, 100, 51]
    assert [p.n_merges for p in parts] == [0, 0, 0, 0, 1]  # after all contents


def test_one_rule_for_addresses(spark):
    for text, valid in (("A1", True), ("ZZZZZZ9", True), ("AAAAAAA1", False), ("A1\n", False)):
        got = spark.range(1).select(addresses.cell_column(F.lit(text)).alias("c"), addresses.cell_row(F.lit(text)).alias("r")).first()
        assert (got.c is not None and got.r is not None) == valid
        if valid:
            assert parse_address(text) == (got.r, got.c)
        else:
            with pytest.raises(ValueError):
                parse_address(text)


def test_null_groups_span_ranges(spark):
    df = spark.range(20_000).select(F.expr("CASE WHEN id % 2 = 0 THEN 'x' END").alias("g"), "id", F.lit(1).alias("v"))
    bounds = range_bounds(df, ["g", "id"], 8)
    spread = {r.g: r.n for r in with_range(df, ["g", "id"], bounds).groupBy("g").agg(F.count_distinct("_range").alias("n")).collect()}
    assert spread[None] >= 3 and spread["x"] >= 3
    got = running_totals(df, [Running("before", ("g",), "v")], ["id"], 8)
    assert got.where("before <> id div 2").count() == 0
    assert "TakeOrdered" not in df.where(F.rand(17) < 0.5)._jdf.queryExecution().executedPlan().toString()


def test_a_native_file_by_id_keeps_its_body(spark):
    files = spark.createDataFrame([("d", NATIVE_MIMES["documents"], None, ["f"], b"")], "id string, mimeType string, size bigint, parents array<string>, body binary")
    renditions = spark.createDataFrame([("d", "text/plain", b"text")], "id string, export_mime string, content binary")
    [row] = read_files(files, FileSourceOptions(file_id="d", file_types=("binary",)), renditions).collect()
    assert bytes(row.body) == b"text"


def test_blocks_keep_their_place(spark, tmp_path):
    values = lambda *texts: {"values": [{"formattedValue": t} for t in texts]}
    book = {"spreadsheetId": "s", "properties": {"title": "t"}, "sheets": [
        {"properties": {"sheetId": 1}, "data": [{"startColumn": 1, "rowData": [values("b", "c")]}]},
        {"properties": {"sheetId": 2}, "data": [{"startColumn": 3, "rowData": [values("d")]}, {"rowData": [values("a"), values("x")]}]},
    ]}
    (tmp_path / "b.json").write_text(json.dumps(book))
    documents = read_documents(spark, str(tmp_path / "b.json"))
    want = {(r.sheet_id, r.row_idx, r.col_idx): r.formatted for r in cells_of(documents).collect()}
    got = {
        (r.sheet_id, r.row_idx, i): json.loads(v)["formattedValue"]
        for r in row_arrays_of(documents).collect() for i, v in enumerate(r["values"]) if v is not None
    }
    assert got == want and len(want) == 5
    with pytest.raises(Exception, match="Several blocks"):
        row_arrays_of(documents, one_block=True).collect()


def test_a_banner_above_the_names_is_fine(spark):
    ddl = "spreadsheet_id string, sheet_id bigint, start_row bigint, end_row bigint, start_col int, end_col int"
    merges = spark.createDataFrame([("s", 0, 0, 1, 0, 5), ("s", 0, 0, 2, 0, 5), ("s", 1, 1, 3, 0, 1)], ddl)
    options = SheetSourceOptions(column_names="custom_row", names_row=3)
    assert [tuple(r)[1:4] for r in invalid_header_merges(merges, options).collect()] == [(1, 1, 3)]


def test_numbers_that_are_no_dates(spark):
    df = spark.createDataFrame([(1e12,), (-1e300,), (float("nan"),), (float("inf"),), (43000.5,), (None,)], "x double")
    x = F.col("x")
    rows = df.select(serial.serial_to_date(x).alias("d"), serial.serial_to_timestamp(x).alias("t"), serial.serial_to_timestamp(x, serial.COMPAT_DAY_MICROS).alias("u"), serial.serial_to_millis(x).alias("m")).collect()
    assert [r.d for r in rows] == [None, None, None, None, date(2017, 9, 22), None]
    assert [r.t is None and r.u is None for r in rows] == [True, True, True, True, False, True]
    assert rows[4].m == 43000.5 * 86_400_000


def test_titles_match_whole(spark):
    got = spark.createDataFrame([("a\n",), ("a",)], "t string").select(usable_title(F.col("t"), F.lit(0)).alias("u")).collect()
    assert [r.u for r in got] == ["A", "a"]


@pytest.mark.parametrize("start, end", [
    (None, None), ("2019-01-01", None), (None, "2019-01-01"), ("garbage", "2019-01-01"), ("2019-01-01", "2019-02-30"), ("2019-01-02", "2019-01-01"),
    ("2019-01-01T10:00:60Z", "2019-01-02"), ("2019-01-01T10:00:00|01:00", "2019-01-02"), ("2019-01-01T10:00:00-01:00", "2019-01-01T10:30:00Z"),
])
def test_custom_dates_are_checked(start, end):
    with pytest.raises(ValueError):
        FileSourceOptions(folder="f", date_range="custom", start_date=start, end_date=end)
    FileSourceOptions(file_id="f", date_range="custom", start_date=start, end_date=end)  # filters do not count


def test_plans_without_long_arrays(spark):
    files = spark.createDataFrame([("big", 1 << 40), ("small", 10), ("unknown", None)], "id string, size bigint")
    parts = plan_parts(files, 1024)
    assert parts.where("id = 'big' AND bytes_from < 1024 * 20001").count() == 20_001
    assert parts.where("id = 'big'").agg(F.max("bytes_to")).first()[0] == (1 << 40) - 1
    assert [tuple(r) for r in parts.where("id <> 'big'").select("id", "bytes_from", "is_partitioned").orderBy("id").collect()] == [("small", None, False), ("unknown", None, False)]
    sheets = spark.createDataFrame([("s", 0, 0, "t", 10_000_000, 5)], "spreadsheet_id string, sheet_id bigint, sheet_index int, sheet_title string, row_count bigint, col_count int")
    pages = read_chunks(sheets, SheetSourceOptions(), 1)
    assert pages.count() == 100_000 and pages.agg(F.sum("n_rows")).first()[0] == 9_999_999


def test_paths(spark, tmp_path):
    assert path_exists(spark, str(tmp_path)) and not path_exists(spark, str(tmp_path / "none"))


def test_single_rows(spark):
    cells = spark.createDataFrame([("s", 0, 0, 0), ("s", 0, 4, 1), ("s", 1, 0, 0), ("t", 0, 0, 0)], "spreadsheet_id string, sheet_id bigint, row_idx bigint, col_idx int")
    sheet = {"spreadsheet_id": "s", "sheet_id": 0}
    assert sorted(r.row_idx for r in sample_rows(cells, sheet, [1, 5, 9]).collect()) == [0, 4]
    for where, rows in ((sheet, []), (sheet, [0]), ({"spreadsheet_id": "s"}, [1]), ({"spreadsheet_id": "s", "sheet_id": None}, [1])):
        with pytest.raises(ValueError):
            sample_rows(cells, where, rows)
