"""The folder_files data source: reading, pushed filters, streams, and the sink's commit."""

import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, Not, StringEndsWith, StringStartsWith
from pyspark.sql.types import StructType

from foldergrid.functions.text import clean_name, fitting_name, marked_name
from foldergrid.sinks.files import write_files
from foldergrid.sources import folder_files, listing
from foldergrid.sources.folder import list_folder, read_parts
from foldergrid.sources.folder_files import FORMAT, Parts, Reading, SelectingReader, Share, read_folder, resume_writes, use_folder_files


@pytest.fixture(scope="module")
def files(spark):
    return use_folder_files(spark)


def make(folder, names, size=lambda i: i):
    folder.mkdir(parents=True, exist_ok=True)
    for i, name in enumerate(names):
        (folder / name).write_bytes(bytes([i % 256]) * size(i))


def reader(folder, ddl=None, **options):
    return SelectingReader(str(folder), StructType.fromDDL(ddl) if ddl else folder_files.SCHEMA, Reading.of({k: str(v) for k, v in options.items()}))


def rows_of(source):
    return [row for part in source.partitions() for batch in source.read(part) for row in batch.to_pylist()]


def test_equal_to_the_listing(files, tmp_path):
    make(tmp_path, ["a.txt", ".hidden", "_under.csv", "noending", "b.HTML", "emp ty%20.txt"], lambda i: 1000 * i)
    (tmp_path / "below").mkdir()
    make(tmp_path / "below", ["deep.txt"], lambda i: 7)
    for recursive in (False, True):
        got = files.read.format(FORMAT).option("recursive", recursive).option("maxPartBytes", 700).load(str(tmp_path))
        listed = list_folder(files, str(tmp_path), recursive)
        want = read_parts(listed, 700, tasks=2).select(*got.columns)
        key = lambda r: (r.id, r.offset)
        assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


CONDITIONS = (
    "size <> 10", "NOT name LIKE 'a%'", "name IN ('a1.txt', 'zz')", "id LIKE '%csv'", "size IS NULL", "name > 'a2'",
    "size BETWEEN 10 AND 20", "name = 'a1.txt' OR size = 30", "array_contains(parents, 'x')", "offset = 0", "name <=> 'b1.txt'", "name IS NOT NULL",
)


def test_filters_are_pushed_down(files, tmp_path):
    make(tmp_path, ["a1.txt", "a2.csv", "b1.txt", "b2.csv"], lambda i: 10 * i)
    cutoff = F.lit("2020-01-01").cast("timestamp")
    chosen = read_folder(files, str(tmp_path), (F.col("size") > 5) & F.col("name").startswith("b") & (F.col("mimeType") == "text/csv") & (F.col("modifiedTime") > cutoff), ["name"])
    execution = chosen._jdf.queryExecution()
    assert "StringStartsWith(name,b)" in execution.explainString(files._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert ") Filter " not in execution.executedPlan().toString() and "body" not in execution.executedPlan().toString()
    assert chosen.columns == ["name"] and [r["name"] for r in chosen.collect()] == ["b2.csv"]
    plain = list_folder(files, str(tmp_path)).withColumn("offset", F.lit(0))
    for condition in CONDITIONS:
        pushed = read_folder(files, str(tmp_path), condition, ["id"])
        assert sorted(r["id"] for r in pushed.collect()) == sorted(r["id"] for r in plain.where(condition).collect()), condition


def test_a_selection_may_be_used_in_many_ways(files, tmp_path):
    make(tmp_path, ["a1.txt", "a2.csv", "b1.txt", "b2.csv"], lambda i: 10 * i)
    some, every = read_folder(files, str(tmp_path), "size > 0"), files.read.format(FORMAT).load(str(tmp_path))
    names = lambda df: sorted(r["name"] for r in df.collect())
    for _ in range(2):
        assert names(some.where("size = 30")) == ["b2.csv"] and names(some) == ["a2.csv", "b1.txt", "b2.csv"]
        assert names(some.where("size = 30").union(some.where("name LIKE 'a%'"))) == ["a2.csv", "b2.csv"]
        assert some.where("size = 30").join(some.select("name"), "name").count() == 1
        assert names(every.where("size = 30")) == ["b2.csv"] and len(names(every)) == 4
        assert names(every.where("size = 30").union(every)) == ["a1.txt", "a2.csv", "b1.txt", "b2.csv", "b2.csv"]


def test_what_is_pushed_is_not_looked_at(tmp_path, monkeypatch):
    make(tmp_path, [f"f{i}" for i in range(20)])
    looked = []
    real = listing._local_entry
    monkeypatch.setattr(listing, "_local_entry", lambda entry: looked.append(entry.name) or real(entry))
    monkeypatch.setattr(folder_files, "read_part", lambda *a: pytest.fail("a file was opened"))
    names = reader(tmp_path, "name string, size bigint")
    assert list(names.pushFilters([StringStartsWith(("name",), "f1"), Not(StringEndsWith(("name",), "0")), GreaterThan(("offset",), 3), IsNotNull(("parents",))])) == [
        GreaterThan(("offset",), 3), IsNotNull(("parents",))]
    assert sorted(r["name"] for r in rows_of(names)) == ["f1", *[f"f1{i}" for i in range(1, 10)]]
    assert set(looked) == {"f1", *[f"f1{i}" for i in range(1, 10)]}  # a read of names opens no file
    monkeypatch.setattr(listing, "walk", lambda *a, **k: pytest.fail("the folder was listed"))
    one = reader(tmp_path, "name string")
    assert list(one.pushFilters([In(("id",), (f"{tmp_path}/f3", f"{tmp_path}/none", "/etc/hosts")), EqualTo(("name",), "f3")])) == []
    assert [r["name"] for r in rows_of(one)] == ["f3"]


def test_parts_and_shares_read_the_same(tmp_path):
    make(tmp_path, [f"n{i}" for i in range(57)], lambda i: 37 * i)
    key = lambda r: (r["id"], r["offset"])
    planned, shared = reader(tmp_path, tasks=5, maxPartBytes=500), reader(tmp_path, tasks=5, maxPartBytes=500, planFiles=10)
    assert all(isinstance(p, Parts) for p in planned.partitions()) and len(planned.partitions()) <= 6
    assert [type(p) for p in shared.partitions()] == [Share] * 5
    rows = sorted(rows_of(planned), key=key)
    assert rows == sorted(rows_of(shared), key=key)
    assert sum(len(r["body"]) for r in rows) == sum(37 * i for i in range(57)) and max(len(r["body"]) for r in rows) == 500
    sizes = [sum(length or entry[1] for _, entry, _, length in p.value) for p in planned.partitions()]
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_links_and_lists_in_shares(files, tmp_path, monkeypatch):
    inner = tmp_path / "in"
    make(inner, ["real.txt"], lambda i: 5)
    os.symlink(inner / "real.txt", inner / "link.txt")
    os.symlink(inner / "gone", inner / "dangling")
    os.symlink(tmp_path, inner / "up")
    want = {("real.txt", 5), ("link.txt", 5)}
    assert {(r["name"], r["size"]) for r in list_folder(files, str(tmp_path), recursive=True).collect()} == want
    assert {(r["name"], r["size"]) for r in files.read.format(FORMAT).option("recursive", "true").load(str(tmp_path)).collect()} == want


def test_a_large_folder_is_listed_by_several_tasks(files, tmp_path):
    # one name more than a task looks at alone
    many = tmp_path / "many"
    many.mkdir()
    for i in range(listing.PAGE + 1):
        (many / f"f{i}").touch()
    (many / "sub").mkdir()
    (many / "sub" / "x").write_text("1")
    flat = list_folder(files, str(many))
    assert flat.select(F.spark_partition_id().alias("p")).distinct().count() > 8
    names = [r["name"] for r in flat.collect()]
    assert len(names) == len(set(names)) == listing.PAGE + 1
    for root, extra in ((many, 1), (tmp_path, 1)):  # large at the root, and below it
        tree = [r["id"] for r in list_folder(files, str(root), recursive=True).collect()]
        assert len(tree) == len(set(tree)) == listing.PAGE + 1 + extra


def test_wrong_columns_and_options(files, tmp_path):
    with pytest.raises(Exception, match="no column"):
        files.read.format(FORMAT).schema("nme string").load(str(tmp_path)).collect()
    with pytest.raises(Exception, match="path of a folder"):
        files.read.format(FORMAT).load().collect()
    with pytest.raises(Exception, match="append"):
        files.range(1).selectExpr("cast('x' as binary) AS body").write.format(FORMAT).mode("overwrite").save(str(tmp_path / "o"))
    with pytest.raises(Exception, match="binary column"):
        files.range(1).write.format(FORMAT).mode("append").save(str(tmp_path / "o"))


# ------------------------------------------------------------- names
NAMES = ["a.txt", "a/b", "", "..", "tab\tx", "é" * 200, "x" * 300 + ".csv", "n" * 254 + "é", ".bashrc", "e." + "z" * 80, "日" * 120 + ".html"]


def test_one_rule_for_names(spark):
    mark = " (0123456789abcdef0123456789abcdef-12)"
    frame = spark.createDataFrame([(n,) for n in NAMES], "n string").select(
        "n", clean_name(F.col("n")).alias("c"), marked_name(clean_name(F.col("n")), F.lit(mark)).alias("m"))
    for r in frame.collect():
        assert (r["c"], r["m"]) == (fitting_name(r["n"]), fitting_name(fitting_name(r["n"]), mark))
        assert max(len(r["c"].encode()), len(r["m"].encode())) <= 255
    assert fitting_name("x" * 300 + ".csv", mark).endswith(mark + ".csv") and fitting_name(".bashrc", "!") == ".bashrc!"


def test_long_names_are_written(spark, tmp_path):
    rows = spark.createDataFrame([(n, None, n.encode()) for n in NAMES * 2], "name string, mimeType string, body binary")
    manifest = write_files(rows, str(tmp_path / "out")).collect()
    assert len({r["path"] for r in manifest}) == 2 * len(NAMES)
    assert sorted((tmp_path / "out" / r["path"].rpartition("/")[2]).read_bytes() for r in manifest) == sorted(n.encode() for n in NAMES * 2)


# ------------------------------------------------------------- writing
def bodies(folder):
    return sorted(p.read_bytes() for p in Path(folder).iterdir())


def test_every_record_is_a_file(files, tmp_path):
    rows = files.createDataFrame([(n, n.encode(), i) for i, n in enumerate([*NAMES, "a.txt", "a.txt"])] + [(None, b"none", 0), ("null", None, 1)], "name string, body binary, extra int").repartition(3)
    for runs in (1, 2):
        rows.write.format(FORMAT).mode("append").save(str(tmp_path / "out"))
        assert bodies(tmp_path / "out") == sorted((r["body"] or b"") for _ in range(runs) for r in rows.collect())
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    rows.select("body").limit(0).write.format(FORMAT).mode("append").save(str(tmp_path / "none"))
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_a_failed_job_leaves_nothing(files, tmp_path):
    rows = files.range(40, numPartitions=4).select(
        F.concat(F.lit("f"), "id").alias("name"),
        F.when(F.col("id") == 33, F.raise_error(F.lit("broken record")).cast("binary")).otherwise(F.lit(b"x")).alias("body"))
    for sink in (lambda: rows.write.format(FORMAT).mode("append").save(str(tmp_path / "out")),
                 lambda: write_files(rows.withColumn("mimeType", F.lit(None).cast("string")), str(tmp_path / "out"))):
        with pytest.raises(Exception, match="broken record"):
            sink()
        assert list(tmp_path.iterdir()) == []


def test_files_of_lost_attempts_are_not_published(tmp_path):
    from pyspark.sql.types import BinaryType, StringType

    import pyarrow as pa

    schema = StructType().add("name", StringType()).add("body", BinaryType())
    writer = folder_files.FolderWriter(str(tmp_path / "out"), schema)
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "a"]), pa.array([b"1", b"2"])], names=["name", "body"])
    with pytest.raises(RuntimeError):
        writer.write(iter(raising_after(batch)))  # this attempt is lost
    kept = writer.write(iter([batch]))
    writer.write(iter([batch]))  # one that ended but does not count
    writer.commit([kept, None])
    assert bodies(tmp_path / "out") == [b"1", b"2"] and [p.name for p in tmp_path.iterdir()] == ["out"]


def raising_after(batch):
    yield batch
    raise RuntimeError("lost")


RETRIED = """
import os, sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
sys.path.insert(0, {root!r})
from foldergrid.sources.folder_files import FORMAT, use_folder_files
spark = use_folder_files(SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate())
def bodies(batches):
    for batch in batches:
        yield batch
    context = TaskContext.get()
    if context.partitionId() == 1 and context.attemptNumber() < 2:
        os._exit(1) if context.attemptNumber() else (_ for _ in ()).throw(RuntimeError("lost"))
rows = spark.range(0, 60, 1, 3).select(F.concat(F.lit("f"), F.col("id") % 7).alias("name"), F.col("id").cast("string").cast("binary").alias("body"))
rows.mapInArrow(bodies, "name string, body binary").write.format(FORMAT).mode("append").save({folder!r})
"""


def test_lost_tasks_lose_no_file(tmp_path):
    """One task fails, then its worker dies, then it goes through: every record is one file, nothing else is left."""
    import subprocess
    import sys

    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", RETRIED.format(root=root, folder=str(tmp_path / "out"))], capture_output=True, text=True, timeout=300, check=False)
    assert done.returncode == 0, done.stderr[-2000:]
    assert bodies(tmp_path / "out") == sorted(str(i).encode() for i in range(60))
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


@pytest.mark.parametrize("moves", [0, 1, 3])
def test_a_commit_cut_short_is_resumed(tmp_path, monkeypatch, moves):
    from pyspark.sql.types import BinaryType, StringType

    import pyarrow as pa

    schema = StructType().add("name", StringType()).add("body", BinaryType())
    writer = folder_files.FolderWriter(str(tmp_path / "out"), schema)
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b", "a", "c"]), pa.array([b"1", b"2", b"3", b"4"])], names=["name", "body"])
    message = writer.write(iter([batch]))
    left = [moves]

    def move(*args, real=listing.move_new):
        if not left[0]:
            raise KeyboardInterrupt  # the driver is gone
        left[0] -= 1
        return real(*args)

    monkeypatch.setattr(folder_files, "MOVERS", 1)
    monkeypatch.setattr(listing, "move_new", move)
    with pytest.raises(KeyboardInterrupt):
        writer.commit([message])
    writer.abort([message])  # what Spark calls next must not throw committed files away
    monkeypatch.undo()
    moved = len(bodies(tmp_path / "out"))
    assert moved <= moves and resume_writes(str(tmp_path / "out")) == 4 - moved
    assert bodies(tmp_path / "out") == [b"1", b"2", b"3", b"4"] and [p.name for p in tmp_path.iterdir()] == ["out"]
    assert resume_writes(str(tmp_path / "out")) == 0


def test_a_move_between_link_and_unlink(tmp_path):
    from pyarrow import fs

    (tmp_path / "s").write_text("x")
    os.link(tmp_path / "s", tmp_path / "t")  # the mover was lost here
    assert listing.move_new(fs.LocalFileSystem(), str(tmp_path / "s"), str(tmp_path / "t")) and not (tmp_path / "s").exists()
    (tmp_path / "u").write_text("y")
    assert not listing.move_new(fs.LocalFileSystem(), str(tmp_path / "u"), str(tmp_path / "t")) and (tmp_path / "t").read_text() == "x"


# ------------------------------------------------------------- streams
def run_once(spark, folder, out, checkpoint):
    stream = spark.readStream.format(FORMAT).option("settleMillis", 0).load(str(folder))
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start(str(out))
    query.awaitTermination()
    assert query.exception() is None


def test_a_stream_gives_every_version_once(files, tmp_path):
    folder, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    make(folder, ["a", ".hidden", "empty"], lambda i: 2 - i)
    run_once(files, folder, out, checkpoint)
    time.sleep(0.05)
    (folder / "a").write_text("changed")
    make(folder, ["_new"], lambda i: 4)
    run_once(files, folder, out, checkpoint)
    run_once(files, folder, out, checkpoint)  # nothing is new
    got = sorted((r["name"], r["size"], len(r["body"])) for r in files.read.parquet(str(out)).collect())
    assert got == [(".hidden", 1, 1), ("_new", 4, 4), ("a", 2, 2), ("a", 7, 7), ("empty", 0, 0)]


def test_a_batch_in_the_middle_is_repeated(files, tmp_path):
    """The sink fails after the offsets are written down; the restart reads the same batch."""
    folder, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    make(folder, ["a", "b"], lambda i: 3)
    seen = []

    def failing(df, batch):
        seen.append(sorted(r["name"] for r in df.collect()))
        if len(seen) == 1:
            raise RuntimeError("lost")
        df.write.mode("append").parquet(str(out))

    for attempt in range(3):
        stream = files.readStream.format(FORMAT).option("settleMillis", 0).load(str(folder))
        query = stream.writeStream.foreachBatch(failing).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except Exception:
            assert attempt == 0
        if attempt == 0:
            time.sleep(0.05)
            make(folder, ["later"], lambda i: 1)
    assert seen[0] == seen[1] == ["a", "b"]
    assert sorted(r["name"] for r in files.read.parquet(str(out)).collect()) == ["a", "b", "later"]


def test_young_files_wait(tmp_path):
    make(tmp_path, ["a"], lambda i: 1)
    stream = folder_files.FolderStreamReader(str(tmp_path), StructType.fromDDL("name string"), Reading.of({"settleMillis": "60000"}))
    assert stream.initialOffset() == stream.latestOffset() == {"modified_ms": -1}
    assert stream.partitions(stream.initialOffset(), stream.latestOffset()) == []
    os.utime(tmp_path / "a", (1, 1))
    assert stream.latestOffset() == {"modified_ms": 1000}
    assert [r["name"] for p in stream.partitions({"modified_ms": -1}, {"modified_ms": 1000}) for b in stream.read(p) for r in b.to_pylist()] == ["a"]
    assert stream.partitions({"modified_ms": 1000}, {"modified_ms": 1000}) == []
    few = folder_files.FolderStreamReader(str(tmp_path), StructType.fromDDL("name string"), Reading.of({"planFiles": "0", "tasks": "3"}))
    assert [r["name"] for p in few.partitions({"modified_ms": 5}, {"modified_ms": 1000}) for b in few.read(p) for r in b.to_pylist()] == ["a"]
    assert [r["name"] for p in few.partitions({"modified_ms": 1000}, {"modified_ms": 2000}) for b in few.read(p) for r in b.to_pylist()] == []
