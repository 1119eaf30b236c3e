import itertools
import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldergrid.model import FileSourceOptions, SheetSinkOptions
from foldergrid.operators.flatten import (
    data_merges, grid_cells, grid_rows, leaf_columns, non_trivial_merges, route, schema_problems, with_cells,
)
from foldergrid.operators.header_layout import depth, header_cells, header_ranges, width
from foldergrid.operators.layout import Running, batch_sizes, extension, place_records, range_bounds, running_totals, sheet_extents
from foldergrid.sinks.sheets import Layout, place, update_documents, write_sheets, write_update_documents
from foldergrid.streaming.flush import flush_sheets, write_flush
from foldergrid.streaming.ingest import ingest_new_files, stream_folder, stream_records


def schema(ddl):
    return T.StructType.fromDDL(ddl)


# ---------------------------------------------------------------- schema
def test_schema_contract(spark):
    good = schema("""r struct<string: string, boolean: boolean, double: double>, a array<string>, b boolean, s string, x binary,
                     i int, l bigint, d double, f float, v void""")
    assert schema_problems(good, SheetSinkOptions()) == []
    bad = schema("a struct<b: struct<c: string>>, b array<struct<c: string>>, c map<string, string>, d interval day to second, ok date")
    problems = schema_problems(bad, SheetSinkOptions())
    assert len(problems) == 4 and ["'a.b'" in problems[0], "'b'" in problems[1], "'c'" in problems[2]] == [True] * 3
    routed = schema_problems(schema("a int"), SheetSinkOptions(spreadsheet_field="x", sheet_field="a"))
    assert len(routed) == 2
    with pytest.raises(ValueError):
        with_cells(spark.createDataFrame([], "m map<string,string>"), SheetSinkOptions())


# ---------------------------------------------------------------- headers
def test_header_shapes():
    flat = schema("h0 string, h1 string, h2 string, h3 string")
    assert (depth(flat), width(flat), header_ranges(flat)) == (1, 4, [])
    group = schema("h struct<h0: string, h1: string, h2: string, h3: string>")
    assert (0, 1, 0, 4) in header_ranges(group)
    beside = schema("a string, h struct<x: string, y: string>")
    assert header_ranges(beside) == [(0, 2, 0, 1), (0, 1, 1, 3)]
    deep = schema("h struct<h0: string, h1: string, h2: struct<h20: string, h21: string>>")
    assert (depth(deep), width(deep)) == (3, 4)
    assert header_ranges(deep) == [(0, 1, 0, 4), (1, 3, 0, 1), (1, 3, 1, 2), (1, 2, 2, 4)]
    assert header_cells(deep) == [(0, 0, "h"), (1, 0, "h0"), (1, 1, "h1"), (1, 2, "h2"), (2, 2, "h20"), (2, 3, "h21")]


def test_merge_filter(spark):
    data = [(0, 1, 0, 1), (10, 11, 2, 3), (0, 0, 0, 10), (10, 10, 20, 30), (0, 4, 0, 1), (0, 1, 2, 4)]
    df = spark.createDataFrame(data, "start_row bigint, end_row bigint, start_col int, end_col int")
    kept = [(r.start_row + 66, r.end_row + 66, r.start_col, r.end_col) for r in non_trivial_merges(df).collect()]
    assert kept == [(66, 70, 0, 1), (66, 67, 2, 4)]


# ---------------------------------------------------------------- cells
def test_cell_encoding(spark):
    df = spark.sql("""SELECT DATE'2019-03-14' d, TIMESTAMP'2019-03-14 13:03:14' ts, 46994000 t, 46994000000L tu, 1.5BD dec,
        'x' s, X'c3a9' b, true f, 1.25F fl, CAST(NULL AS DATE) nd, CAST(NULL AS STRING) ns, NULL v""")
    options = SheetSinkOptions(time_fields={"t": "millis", "tu": "micros"})
    cells = grid_rows(with_cells(df, options), leaf_columns(df.schema, options)).first().cells
    serial = (13 * 3600 + 3 * 60 + 14) / 86400
    got = [(c.user_num, c.user_str, c.user_bool, c.num_format) for c in cells]
    assert got[0] == (43538.0, None, None, "DATE")
    assert abs(got[1][0] - 43538 - serial) < 1e-9 and got[1][3] == "DATE_TIME"
    assert all(abs(got[i][0] - serial) < 1e-11 and got[i][3] == "TIME" for i in (2, 3))
    assert got[4:9] == [(1.5, None, None, "NUMBER"), (None, "x", None, None), (None, "é", None, None), (None, None, True, None), (1.25, None, None, None)]
    # a null date keeps its format, a null string is an empty cell
    assert got[9:] == [(None, None, None, "DATE"), (None,) * 4, (None,) * 4]


def test_routing(spark):
    df = spark.createDataFrame([("spName", "title", "any string")], "spreadsheet string, sheet string, testString string")
    def target(**o):
        r = route(df, SheetSinkOptions(spreadsheet_name="generalName", sheet_name="generalTitle", **o)).first()
        return r.spreadsheet_name, r.sheet_name
    both = dict(spreadsheet_field="spreadsheet", sheet_field="sheet")
    assert target(**both) == ("spName", "title")
    assert target() == ("generalName", "generalTitle")
    assert target(spreadsheet_field="spreadsheet") == ("spName", "generalTitle")
    layout = Layout.of(df.schema, SheetSinkOptions(**both))
    assert (layout.width, layout.depth) == (3, 1)
    assert Layout.of(df.schema, SheetSinkOptions(**both, skip_name_fields=True)).width == 1


def nested_loop(record):
    """The model: fields in order; an array multiplies what is there, existing row outer."""
    rows, merges = [[]], []
    for value in record:
        if isinstance(value, list):
            items = value or [None]
            n = len(items)
            merges = [(a * n, b * n, c) for a, b, c in merges]
            merges += [(i + n * j, i + n * j + 1, len(rows[0])) for i in range(n) for j in range(len(rows))]
            rows = [row + [item] for row, item in itertools.product(rows, items)]
        else:
            merges.append((0, len(rows), len(rows[0])))
            rows = [row + [value] for row in rows]
    return rows, sorted(m for m in merges if m[1] - m[0] > 1)


def test_flatten_example(spark):
    df = spark.createDataFrame([("x", [1, 2], ["p", "q", "r"])], "s string, a array<int>, b array<string>")
    flattened = with_cells(df, SheetSinkOptions())
    rows = grid_rows(flattened, leaf_columns(df.schema, SheetSinkOptions())).orderBy("row_in_record").collect()
    assert ["".join(str(c.user_str or int(c.user_num)) for c in r.cells) for r in rows] == ["x1p", "x1q", "x1r", "x2p", "x2q", "x2r"]
    merges = data_merges(flattened, leaf_columns(df.schema, SheetSinkOptions())).collect()
    assert sorted((r.start_row, r.end_row, r.start_col, r.end_col) for r in merges) == [(0, 3, 1, 2), (0, 6, 0, 1), (3, 6, 1, 2)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.lists(st.integers(0, 99), max_size=3), st.integers(0, 99), st.lists(st.integers(0, 99), max_size=4),
                          st.lists(st.integers(0, 99), max_size=2), st.integers(0, 99)), min_size=1, max_size=25))
def test_flatten_equals_the_nested_loop(spark, records):
    data = [(i, *r) for i, r in enumerate(records)]
    df = spark.createDataFrame(data, "id int, a array<int>, x int, b array<int>, c array<int>, y int")
    options = SheetSinkOptions()
    flattened, leaves = with_cells(df, options, ("id",)), leaf_columns(df.schema, options)
    got = {}
    for r in grid_rows(flattened, leaves).orderBy("id", "row_in_record").collect():
        got.setdefault(r.id, []).append([None if c.user_num is None else int(c.user_num) for c in r.cells])
    merges = {}
    for r in data_merges(flattened, leaves).collect():
        merges.setdefault(r.id, []).append((r.start_row, r.end_row, r.start_col))
    for record in data:
        rows, ranges = nested_loop(record)
        assert got[record[0]] == rows
        assert sorted(merges.get(record[0], [])) == ranges


def test_a_record_with_more_rows_than_a_chunk(spark):
    df = spark.range(1).select(F.sequence(F.lit(1), F.lit(160)).alias("a"), F.sequence(F.lit(1), F.lit(160)).alias("b"))
    rows = grid_rows(with_cells(df, SheetSinkOptions()), leaf_columns(df.schema, SheetSinkOptions()), spread=True)
    assert rows.agg(F.count("*"), F.countDistinct("row_in_record"), F.max("row_in_record")).first()[:] == (25_600, 25_600, 25_599)


# ---------------------------------------------------------------- layout
def test_running_totals_equal_one_window(spark):
    rng = random.Random(5)
    # one sheet holds most rows; keys of several types, with nulls
    data = [(("it's \\ big" if rng.random() < 0.7 else rng.choice([None, *(f"s{i}" for i in range(9))])), rng.choice(["x", "y"]), rng.choice([None, "k", "l"]), i, rng.randrange(5))
            for i in range(3000)]
    df = spark.createDataFrame(data, "book string, sheet string, k string, i int, v bigint").withColumn(
        "t", F.timestamp_seconds(F.col("i") % 17))
    order = ["k", "t", "i"]
    got = running_totals(df, [Running("n", ("book",), 1), Running("total", ("book", "sheet"), "v")], order, n_ranges=13)
    df.createOrReplaceTempView("totals_in")
    want = spark.sql("""SELECT *, row_number() OVER (PARTITION BY book ORDER BY k, t, i) - 1L n,
        coalesce(sum(v) OVER (PARTITION BY book, sheet ORDER BY k, t, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) total
        FROM totals_in""")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError, match="order_by"):
        running_totals(df, [Running("n", ("book",), 1)], [])
    with pytest.raises(ValueError, match="nested"):
        running_totals(df, [Running("n", ("book",), 1), Running("m", ("sheet",), 1)], order)


def test_groups_of_other_types(spark):
    df = spark.range(2000).select((F.col("id") % 7 % 3).alias("i"), F.col("id").cast("string").alias("s")).withColumn(
        "d", F.date_add(F.lit("2020-01-01").cast("date"), F.col("i").cast("int")))
    for group in ("i", "d"):
        got = running_totals(df, [Running("n", (group,), 1)], ["s"], n_ranges=9)
        assert got.groupBy(group).agg(F.max("n").alias("m"), F.countDistinct("n").alias("c")).where("m + 1 <> c").count() == 0
        # in order: no row before a smaller key
        later = got.alias("a").join(got.alias("b"), (F.col(f"a.{group}") == F.col(f"b.{group}")) & (F.col("a.n") + 1 == F.col("b.n")))
        assert later.where("a.s >= b.s").count() == 0


def test_a_single_group_is_spread(spark):
    df = spark.range(20_000).select(F.lit("only").alias("g"), "id")
    bounds = range_bounds(df, ["g", "id"], 16)
    assert len(bounds) == 15
    placed = running_totals(df, [Running("n", ("g",), 1)], ["id"], n_ranges=16)
    assert placed.where("n <> id").count() == 0
    # the windows run inside ranges, never over the bare group
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "_row" in line]
    assert windows and all("_range" in line for line in windows)


def test_empty_input(spark):
    empty = spark.createDataFrame([], "g string, id bigint")
    assert running_totals(empty, [Running("n", ("g",), 1)], ["id"]).count() == 0


def test_placement_extents_and_batches(spark):
    df = spark.createDataFrame([(i, "b", "s0" if i % 3 else "s1", [0] * (i % 4)) for i in range(20)], "id int, book string, sheet string, a array<int>")
    options = SheetSinkOptions(spreadsheet_field="book", sheet_field="sheet", max_buffer=6, initial_rows=10, min_extension=7)
    placed = sorted(place(df, options, ["id"], 5).collect(), key=lambda r: r.id)
    shift = {"s0": 1, "s1": 1}
    for k, r in enumerate(placed):
        assert (r.first_row, r.is_first, r.batch_no) == (shift[r.sheet_name], shift[r.sheet_name] == 1, k // 6)
        shift[r.sheet_name] += max(1, r.id % 4)
    extents = {r.sheet_name: r for r in sheet_extents(with_cells(df, options), options, 1, 4).collect()}
    assert {k: r.rows_written for k, r in extents.items()} == shift
    assert extents["s0"].rows_added == max(7, shift["s0"] - 10) and extents["s0"].columns_added == 0
    sizes = [(r.batch_no, r.n_records) for r in batch_sizes(place(df, options, ["id"])).collect()]
    assert sizes == [(0, 6), (1, 6), (2, 6), (3, 2)]
    assert spark.range(1).select(extension(F.lit(30), 26, 0), extension(F.lit(20), 26, 0)).first()[:] == (4, 0)
    no_header = SheetSinkOptions(write_schema=False)
    flat = with_cells(df, no_header, ("id",))
    assert place_records(flat, no_header, ["id"], 1).agg(F.min("first_row")).first()[0] == 0


# ---------------------------------------------------------------- written tables and documents
def records(spark, n=120):
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") < n * 0.8, "hot").otherwise(F.concat(F.lit("b"), F.col("id") % 3)).alias("book"),
        F.struct(F.col("id").cast("string").alias("x"), F.lit(1).alias("y")).alias("g"),
        F.when(F.col("id") % 2 == 0, F.array(F.lit("p"), F.lit("q"))).alias("tags"))


OPTIONS = SheetSinkOptions(spreadsheet_field="book", skip_name_fields=True, merge_data_cells=True, max_buffer=10)


def test_write_sheets(spark, tmp_path):
    path = str(tmp_path / "out")
    write_sheets(records(spark), OPTIONS, ["id"], path)
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    sheets = {r.spreadsheet_name: r for r in read("grid_sheets").collect()}
    assert set(sheets) == {"hot", "b0", "b1", "b2"} and sheets["hot"].rows_written == 2 + 96 + 48
    cells = read("grid_cells")
    assert cells.where("row_idx < 2").groupBy("spreadsheet_name").count().select("count").distinct().collect()[0][0] == 5
    # every position once, and rows are dense
    assert cells.groupBy("spreadsheet_name", "row_idx", "col_idx").count().where("count > 1").count() == 0
    assert cells.where("spreadsheet_name = 'hot' and col_idx = 0").agg(F.countDistinct("row_idx")).first()[0] == 1 + 96 + 48
    merges = read("grid_merges").where("spreadsheet_name = 'hot'")
    assert merges.where("start_row < 2").count() == 3  # id and tags run down, g across
    assert merges.where("start_row >= 2").count() == 48 * 3


def test_update_documents(spark, tmp_path):
    df = records(spark)
    layout = Layout.of(df.schema, OPTIONS)
    placed = place(df, OPTIONS, ["id"])
    documents = update_documents(placed, layout, OPTIONS)
    got = {(r.spreadsheet_name, r.batch_no, r.part_no): json.loads(r.document) for r in documents.collect()}
    assert sorted(k[1] for k in got if k[0] == "hot") == list(range(10)) and all(k[2] == 0 for k in got)
    first = got[("hot", 0, 0)]
    assert [u["row_idx"] for u in first["updates"]] == list(range(2 + 15))
    assert first["updates"][0]["cells"][1] == {"user_str": "g"} and first["updates"][1]["cells"][2] == {"user_str": "y"}
    assert len(first["merges"]) == 3 + 5 * 3
    assert "merges" in got[("hot", 9, 0)]
    everything = sum(len(d["updates"]) for d in got.values())
    assert everything == 120 + 60 + 4 * 2
    # records of many rows: parts stay bounded, nothing is lost
    small = SheetSinkOptions(max_buffer=2, max_batch_rows=8)
    wide = spark.range(4).select("id", F.sequence(F.lit(1), F.lit(30)).alias("a"))
    parts = update_documents(place(wide, small, ["id"]), Layout.of(wide.schema, small), small).collect()
    assert all(r.n_rows <= 8 + 1 for r in parts) and sum(r.n_rows for r in parts) == 121
    path = str(tmp_path / "docs")
    write_update_documents(documents, path)
    assert spark.read.json(path).count() == len(got)


def test_a_page_of_a_clustered_sheet_is_a_small_read(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    from foldergrid.sinks import sheets as module

    monkeypatch.setattr(module, "CLUSTER_BYTES", 64 << 10)
    rows = spark.range(120_000).select("id", F.concat(F.lit("k"), F.col("id") % 3).alias("kind"), F.hash("id").alias("v"))
    options = SheetSinkOptions(sheet_field="kind", skip_name_fields=True)
    for clustered in (False, True):
        module.write_sheets(rows, options, ["id"], str(tmp_path / str(clustered)), clustered=clustered)
    cells = {c: spark.read.parquet(str(tmp_path / str(c) / "grid_cells")) for c in (False, True)}
    pages = {c: module.page_cells(df, "Spreadsheet", "k1", 20_001, 100) for c, df in cells.items()}
    assert sorted(pages[True].collect(), key=str) == sorted(pages[False].collect(), key=str) and pages[True].count() == 200
    assert "PushedFilters: [IsNotNull(" in pages[True]._jdf.queryExecution().executedPlan().toString()
    met = every = 0
    for file in (tmp_path / "True" / "grid_cells").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(at[c]).statistics for c in ("sheet_name", "row_idx")]
            every += 1
            met += stats[0].min <= "k1" <= stats[0].max and stats[1].min <= 20_099 and stats[1].max >= 20_000
    assert every >= 8 and met <= 4, (met, every)


# ---------------------------------------------------------------- streaming
def test_flushes_continue_where_the_last_one_ended(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = records(spark, 90)
    for i in range(3):
        df.where(f"id >= {i * 30} and id < {i * 30 + 30}").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = flush_sheets(stream, OPTIONS, ["id"], out, str(tmp_path / "cp"), available_now=True)
    assert query.awaitTermination(300)
    check_flushes(spark, out)
    # a repeated flush replaces itself
    last = spark.read.parquet(f"{out}/grid_records").where("flush_id = 2").select("id")
    write_flush(df.join(last, "id", "left_semi"), 2, OPTIONS, ["id"], out)
    check_flushes(spark, out)


def check_flushes(spark, out):
    cells = spark.read.parquet(f"{out}/grid_cells")
    assert cells.groupBy("spreadsheet_name", "row_idx", "col_idx").count().where("count > 1").count() == 0
    per_book = cells.where("col_idx = 0").groupBy("spreadsheet_name").agg(F.max("row_idx").alias("last"), F.countDistinct("row_idx").alias("n"))
    # the title of the only plain column stands in row 0, so row 1 of column 0 is empty
    assert all(r.last == r.n for r in per_book.collect())
    assert spark.read.parquet(f"{out}/grid_records").count() == 90
    assert spark.read.parquet(f"{out}/grid_records").where("is_first").groupBy("spreadsheet_name").count().where("count > 1").count() == 0


def test_ingest_reads_new_files_only(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a.txt").write_bytes(b"aaaa")
    (folder / "empty.txt").write_bytes(b"")
    options = FileSourceOptions(folder=str(folder), properties=("name", "size"), max_part_bytes=3)
    assert ingest_new_files(spark, str(folder), out, options) == 0
    (folder / "_b c.txt").write_bytes(b"bb")
    assert ingest_new_files(spark, str(folder), out, options) == 1
    got = sorted((r.run, r.name, r.offset, bytes(r.body)) for r in spark.read.parquet(f"{out}/records").collect())
    assert got == [(0, "a.txt", 0, b"aaa"), (0, "a.txt", 3, b"a"), (0, "empty.txt", 0, b""), (1, "_b c.txt", 0, b"bb")]


def test_stream_folder(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()
    options = FileSourceOptions(folder=str(folder), properties=("name",), max_part_bytes=3, body_format="string")
    for text in ("abcd", "ef"):
        (folder / f"{text}.txt").write_text(text)
        query = stream_records(stream_folder(spark, str(folder)), options, out, checkpoint)
        assert query.awaitTermination(120)
    assert sorted((r.name, r.body) for r in spark.read.parquet(out).collect()) == [("abcd.txt", "abc"), ("abcd.txt", "d"), ("ef.txt", "ef")]
