"""Runs of several tables that are cut short, repeated or missing; buffers by count and by time."""

import shutil
import time

import pytest
from pyspark.sql import functions as F

from foldergrid.model import FileSourceOptions, SheetSinkOptions
from foldergrid.streaming import flush, ingest
from foldergrid.streaming.buffer import Buffering
from foldergrid.streaming.flush import TABLES, flush_sheets, write_flush
from foldergrid.streaming.ingest import ingest_new_files, read_ingested, stream_versions
from foldergrid.streaming.runs import MissingRun, RunLog, read_runs

OPTIONS = SheetSinkOptions(sheet_field="kind", merge_data_cells=True)


def records(spark, low, high):
    return spark.range(low, high).select(
        "id", F.concat(F.lit("k"), F.col("id") % 3).alias("kind"), F.sequence(F.lit(1), F.col("id") % 4 + 1).alias("list"),
        F.struct(F.col("id").cast("string").alias("a"), (F.col("id") / 2).alias("x")).alias("nested"),
    )


def test_entries_decide(spark, tmp_path):
    log = RunLog(spark, str(tmp_path), "run")
    assert log.last() == -1 and log.start(0) and log.read("t", "a int").count() == 0
    with pytest.raises(MissingRun, match="run 2 cannot follow run -1"):
        log.start(2)
    spark.range(3).selectExpr("cast(id as int) AS a").write.parquet(log.folder("t", 0))
    assert log.read("t", "a int").count() == 0  # written, but it does not count yet
    log.end(0, ["t"])
    spark.range(5).selectExpr("cast(id as int) AS a").write.parquet(log.folder("t", 1))
    assert log.last() == 0 and not log.start(0) and log.start(1)
    assert {(r["a"], r["run"]) for r in log.read("t", "a int").collect()} == {(0, 0), (1, 0), (2, 0)}
    assert read_runs(spark, str(tmp_path), "t", "run").count() == 3
    log.end(1, ["t"])
    assert log.read("t", "a int").count() == 8 and log.read("t", "a int", upto=0).count() == 3


def contents(spark, path):
    return {t: sorted(map(str, read_runs(spark, path, t, kind="json" if t == "documents" else "parquet").drop("batch_no").collect())) for t in TABLES}


class Lost(Exception):
    pass


def fail_at(monkeypatch, module, step):
    """The step-th table that is saved is written half, and the run is lost."""
    left = [step]

    def save(df, target, *args, real=module.save):
        left[0] -= 1
        if left[0] < 0:
            if left[0] == -1:
                real(df.limit(1), target, *args)
            raise Lost
        return real(df, target, *args)

    monkeypatch.setattr(module, "save", save)


def test_a_flush_cut_short_anywhere(spark, tmp_path, monkeypatch):
    want = str(tmp_path / "want")
    for n, (low, high) in enumerate(((0, 20), (20, 50))):
        write_flush(records(spark, low, high), n, OPTIONS, ["id"], want)
    expected = contents(spark, want)
    first = str(tmp_path / "first")
    write_flush(records(spark, 0, 20), 0, OPTIONS, ["id"], first)
    for step in (0, 2, 4, len(TABLES) - 1):
        out = shutil.copytree(first, str(tmp_path / f"out{step}"))
        with monkeypatch.context() as patch, pytest.raises(Lost):
            fail_at(patch, flush, step)
            write_flush(records(spark, 20, 50), 1, OPTIONS, ["id"], out)
        assert read_runs(spark, out, "grid_records").count() == 20
        write_flush(records(spark, 20, 50), 1, OPTIONS, ["id"], out)
        assert contents(spark, out) == expected
    write_flush(records(spark, 20, 50), 1, OPTIONS, ["id"], out)  # done already
    write_flush(records(spark, 0, 0), 2, OPTIONS, ["id"], out)  # nothing to write
    write_flush(records(spark, 0, 0), 3, OPTIONS, ["id"], out)
    assert contents(spark, out) == expected and RunLog(spark, out, "flush_id").full(3) == 1
    write_flush(records(spark, 50, 60), 4, OPTIONS, ["id"], out)
    later = read_runs(spark, out, "grid_records")
    assert not later.where("id >= 50 AND is_first").count() and later.select("sheet_name", "first_row").distinct().count() == 60
    with pytest.raises(MissingRun):
        write_flush(records(spark, 60, 70), 6, OPTIONS, ["id"], out)
    assert read_runs(spark, out, "grid_records").count() == 60


def test_a_first_run_cut_short(spark, tmp_path, monkeypatch):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    for name in ("a", ".b", "c"):
        (folder / name).write_text(name * 3)
    options = FileSourceOptions(folder=str(folder), properties=("name",))
    for step in range(3):
        with monkeypatch.context() as patch, pytest.raises(Lost):
            fail_at(patch, ingest, step)
            ingest_new_files(spark, str(folder), out, options)
        with pytest.raises(ValueError, match="No run"):
            read_ingested(spark, out)
    assert ingest_new_files(spark, str(folder), out, options) == 0
    (folder / "d").write_text("ddd")
    with monkeypatch.context() as patch, pytest.raises(Lost):
        fail_at(patch, ingest, 2)
        ingest_new_files(spark, str(folder), out, options)
    assert sorted(r["name"] for r in read_ingested(spark, out).collect()) == [".b", "a", "c"]
    assert ingest_new_files(spark, str(folder), out, options) == 1
    assert ingest_new_files(spark, str(folder), out, options) == 2  # nothing new, counted
    assert sorted((r["name"], r["run"]) for r in read_ingested(spark, out).collect()) == [(".b", 0), ("a", 0), ("c", 0), ("d", 1)]


def test_versions_of_a_tree(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "sub" / ".x").write_text("abcde")
    (tmp_path / "in" / "empty").touch()
    stream = stream_versions(spark, str(tmp_path / "in"), recursive=True, max_part_bytes=2, settle_ms=0)
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    got = sorted((r["name"], r["offset"], bytes(r["body"])) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(".x", 0, b"ab"), (".x", 2, b"cd"), (".x", 4, b"e"), ("empty", 0, b"")]


def wait_for(query, done, seconds=90):
    end = time.time() + seconds
    try:
        while not done():
            if query.exception() is not None:
                raise query.exception()
            assert time.time() < end, "the records did not come"
            time.sleep(0.5)
    finally:
        while query.isActive and query.status["isTriggerActive"]:
            time.sleep(0.05)
        query.stop()


def test_both_triggers_and_a_restart(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    records(spark, 0, 100).coalesce(1).write.parquet(source)

    def start(seconds):
        stream = spark.readStream.schema(records(spark, 0, 1).schema).parquet(source)
        return flush_sheets(stream, OPTIONS, ["id"], out, checkpoint, interval_seconds=seconds, max_records=7, lane=F.lit(0))

    def written():
        log = RunLog(spark, out, "flush_id")
        return read_runs(spark, out, "grid_records").count() if log.full(log.last()) >= 0 else 0

    # 34, 33 and 33 records of three sheets: full buffers come at once, the rest would wait for an hour
    wait_for(start(3600), lambda: written() == 28 + 28 + 28)
    reasons = read_runs(spark, out, "grid_flushes")
    assert {(r["sheet_name"], r["reason"], r["records"]) for r in reasons.collect()} == {(f"k{i}", "count", 28) for i in range(3)}
    # a restart goes on with the buffers: one record more fills none, three more fill the first
    records(spark, 100, 103).coalesce(1).write.mode("append").parquet(source)
    wait_for(start(3600), lambda: written() == 84 + 7)
    got = read_runs(spark, out, "grid_records")
    assert got.groupBy("id").count().where("count > 1").count() == 0
    for sheet in ("k0", "k1", "k2"):  # one after the other, without a hole or a row for two
        rows = got.where(F.col("sheet_name") == sheet).orderBy("first_row").select("first_row", "n_rows", "is_first").collect()
        assert [r["is_first"] for r in rows] == [True] + [False] * (len(rows) - 1)
        assert all(b["first_row"] == a["first_row"] + a["n_rows"] for a, b in zip(rows, rows[1:]))


def test_a_record_waits_no_longer(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    records(spark, 0, 10).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(records(spark, 0, 1).schema).parquet(source)
    query = flush_sheets(stream, OPTIONS, ["id"], out, str(tmp_path / "cp"), interval_seconds=2, max_records=1000)
    log = RunLog(spark, out, "flush_id")
    wait_for(query, lambda: log.full(log.last()) >= 0 and read_runs(spark, out, "grid_records").count() == 10)
    assert {r["reason"] for r in read_runs(spark, out, "grid_flushes").collect()} == {"time"}
    assert sorted(r["id"] for r in read_runs(spark, out, "grid_records").collect()) == list(range(10))


def test_counted_flushes_end_when_no_batch_leaves_a_pause(spark, tmp_path, monkeypatch):
    """Batches without records that take as long as the trigger follow each other: none of them keeps the query from ending."""
    from pyspark.sql.streaming import StreamingQuery

    from workload import folder_queries

    spark.sql("""SELECT id AS p_partkey, 'a b' AS p_name, 'x#y' AS p_brand, if(id % 2 = 0, 'SMALL', 'LARGE') AS p_type,
                        CAST(9 AS int) AS p_size, 1.0D AS p_retailprice FROM range(330)""").write.parquet(f"{tmp_path}/part.parquet")
    end = time.time() + 150

    def status(query):
        assert time.time() < end, "the query does not end"
        return {"isTriggerActive": True}

    monkeypatch.setattr(StreamingQuery, "status", property(status))
    got = folder_queries.counted_flushes(spark, str(tmp_path)).collect()
    # two lanes a sheet, of 82 or 83 records each
    assert {(r["sheet_name"], r["reason"], r["records"], r["n_rows"], r["rows_end"]) for r in got} == {
        ("SMALL", "count", 160, 165 * 2, 331), ("SMALL", "time", 5, 165 * 2, 331),
        ("LARGE", "count", 160, 165 * 4, 661), ("LARGE", "time", 5, 165 * 4, 661)}


def test_buffers_are_checked(spark, tmp_path):
    for bad in ((0, 1), (1, 0)):
        with pytest.raises(ValueError):
            Buffering(*bad)
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="unwritten"):
        flush_sheets(stream, SheetSinkOptions(), ["value"], str(tmp_path / "o"), str(tmp_path / "c"), available_now=True, max_records=5)


def test_records_come_out_as_they_went_in(spark, tmp_path):
    """What the state holds of a record gives the same record, whatever its types."""
    from foldergrid.streaming.buffer import FORMATS

    frame = spark.sql("""
        SELECT * FROM VALUES
          (1, 'a"\\n', timestamp'2020-01-01 00:00:00.123456', date'0001-01-01', double('NaN'), 0.1f, X'00FF', 12345678901234567890.123456789BD, array(1, null), named_struct('x', array('é', null), 'y', true)),
          (null, '', null, null, double('-Infinity'), null, X'', null, array(), named_struct('x', null, 'y', null)),
          (-9223372036854775808, '\u0001', timestamp'9999-12-31 23:59:59.999999', date'9999-12-31', 5e-324, 3.4e38f, null, -0.000000001BD, null, null)
        AS t(l, s, t, d, x, f, b, n, a, st)""")
    again = frame.select(F.from_json(F.to_json(F.struct("*"), FORMATS), frame.schema, FORMATS).alias("r")).select("r.*")
    assert again.dtypes == frame.dtypes and sorted(map(str, again.collect())) == sorted(map(str, frame.collect()))
