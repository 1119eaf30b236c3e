import pytest
from pyspark.sql import functions as F

from foldergrid.model import FOLDER_MIME, NATIVE_MIMES, FileSourceOptions
from foldergrid.operators.bodies import cut_bodies, plan_parts, read_bodies, with_renditions
from foldergrid.operators.catalogue import select_files
from foldergrid.operators.metadata import project_metadata
from foldergrid.plans.file_source import read_files
from foldergrid.sinks.files import file_rows, file_schema_problems, write_files
from foldergrid.sources.folder import list_folder, read_parts


def test_split_planning(spark):
    files = spark.createDataFrame([("a", 51), ("b", 50), ("c", None)], "id string, size bigint")
    def parts(maximum):
        return sorted(
            (r.id, r.bytes_from, r.bytes_to, r.is_partitioned) for r in plan_parts(files, maximum).collect()
        )
    whole = [(i, None, None, False) for i in "abc"]
    assert parts(0) == whole
    assert parts(50) == sorted([("a", 0, 49, True), ("a", 50, 50, True), *whole[1:]])


def test_native_files_are_not_split(spark):
    files = spark.createDataFrame([("a", 500, NATIVE_MIMES["documents"])], "id string, size bigint, mimeType string")
    assert [r.is_partitioned for r in plan_parts(files, 50).collect()] == [False]


def test_parts_add_up_to_the_body(spark):
    bodies = [("a", bytes(range(256)) * 5), ("b", b""), ("c", b"x" * 100), ("d", b"y" * 101)]
    df = spark.createDataFrame(bodies, "id string, body binary")
    got = {}
    for r in cut_bodies(df, 100).orderBy("offset").collect():
        assert len(got.get(r.id, b"")) == r.offset
        got[r.id] = got.get(r.id, b"") + bytes(r.body)
        assert len(r.body) <= 100
    assert got == dict(bodies)


FILE_DDL = """id string, properties map<string,string>, parents array<string>, createdTime timestamp,
trashedTime timestamp, body binary, offset bigint,
imageMediaMetadata struct<width: int, height: int, location: struct<latitude: double, longitude: double>>,
videoMediaMetadata struct<width: int, durationMillis: bigint>"""


def test_file_record(spark):
    body = bytes.fromhex("FA4365BFF7")
    files = spark.createDataFrame(
        [("FDGtewSvftr5r", {"p0": "v0", "p1": "v1", "p2": "v2"}, ["435435fe", "ergfvreg"], None, None, body, 34,
          (640, 1, (0.567, 1.0)), (2, 640))], FILE_DDL
    ).withColumn("createdTime", F.timestamp_millis(F.lit(42)))
    fields = ["id", "properties", "imageMediaMetadata.width", "imageMediaMetadata.location.latitude",
              "videoMediaMetadata.durationMillis", "parents", "createdTime"]
    df = project_metadata(files, fields)
    assert df.columns == ["id", "properties", "parents", "createdTime", "body", "offset", "imageMediaMetadata", "videoMediaMetadata"]
    row = df.withColumn("ms", F.unix_millis("createdTime")).first()
    assert (bytes(row.body), row.offset, row.id, row.ms) == (body, 34, "FDGtewSvftr5r", 42)
    assert row.properties == {"p0": "v0", "p1": "v1", "p2": "v2"} and row.parents == ["435435fe", "ergfvreg"]
    assert row.imageMediaMetadata.asDict(True) == {"width": 640, "location": {"latitude": 0.567}}
    assert row.videoMediaMetadata.asDict() == {"durationMillis": 640}


def test_metadata_schema(spark):
    empty = spark.createDataFrame([], """id string, body binary, offset bigint, imageMediaMetadata struct<width: int,
        cameraModel: string, aperture: float, flashUsed: boolean, location: struct<latitude: double, longitude: double>>,
        videoMediaMetadata struct<width: int, height: int, durationMillis: bigint>""")
    image = ["imageMediaMetadata." + f for f in ("location.latitude", "width", "cameraModel", "aperture", "flashUsed", "location.longitude")]
    schema = project_metadata(empty, image).schema
    assert schema.names == ["body", "offset", "imageMediaMetadata"]
    kinds = schema["imageMediaMetadata"].dataType
    assert kinds.names == ["width", "cameraModel", "aperture", "flashUsed", "location"]
    assert [f.dataType.simpleString() for f in kinds.fields] == [
        "int", "string", "float", "boolean", "struct<latitude:double,longitude:double>"]
    video = ["videoMediaMetadata." + f for f in ("width", "height", "durationMillis")]
    assert [f.dataType.simpleString() for f in project_metadata(empty, video).schema["videoMediaMetadata"].dataType.fields] == ["int", "int", "bigint"]
    mixed = project_metadata(empty, ["id", "imageMediaMetadata.width", "imageMediaMetadata.location.latitude", "videoMediaMetadata.height"])
    assert mixed.columns == ["id", "body", "offset", "imageMediaMetadata", "videoMediaMetadata"]
    assert [f.dataType.simpleString() for f in project_metadata(empty, [], "String").schema.fields] == ["string", "bigint"]
    for wrong in ("nope", "imageMediaMetadata.nope", "imageMediaMetadata.location.nope", "videoMediaMetadata.nope"):
        with pytest.raises(ValueError):
            project_metadata(empty, [wrong])


def test_null_structs_and_missing_times_stay_null(spark):
    files = spark.createDataFrame([("a", None, None, None, None, b"", 0, None, (None, 5))], FILE_DDL)
    row = project_metadata(files, ["trashedTime", "driveId", "imageMediaMetadata.width", "videoMediaMetadata.durationMillis"]).first()
    assert row.trashedTime is None and row.driveId is None and row.imageMediaMetadata is None
    assert row.videoMediaMetadata.durationMillis == 5


CATALOGUE = [
    ("t", "text/plain", ["f"], "2019-09-18 10:00:00"), ("d", NATIVE_MIMES["documents"], ["f", "g"], "2019-09-18 23:59:59.999"),
    ("s", NATIVE_MIMES["spreadsheets"], ["f"], "2019-09-19 00:00:00"), ("folder", FOLDER_MIME, ["f"], "2019-09-18 10:00:00"),
    ("other", "text/csv", ["g"], "2019-09-18 10:00:00"),
]


def test_catalogue_filters(spark):
    files = spark.createDataFrame(CATALOGUE, "id string, mimeType string, parents array<string>, m string").withColumn(
        "modifiedTime", F.col("m").cast("timestamp"))
    now = F.lit("2019-09-19 19:52:13.456").cast("timestamp")
    def ids(**options):
        return sorted(r.id for r in select_files(files, FileSourceOptions(**options), now).collect())
    assert ids(folder="f") == ["d", "s", "t"]
    assert ids(folder="g") == ["d", "other"]
    assert ids(folder="f", file_types=("binary",)) == ["t"]
    assert ids(folder="f", file_types=("binary", "spreadsheets")) == ["s", "t"]
    assert ids(folder="f", date_range="yesterday") == ["d", "t"]
    assert ids(folder="f", date_range="today") == ["s"]
    # an `or` in the caller's filter does not reach around the folder
    assert ids(folder="f", filter="mimeType = 'text/plain' or mimeType = 'text/csv'") == ["t"]
    assert ids(folder="f", date_range="custom", start_date="2019-09-18T23:59:59.999Z", end_date="2019-09-19") == ["d", "s"]
    # by id, nothing else counts, and the file comes once
    assert ids(file_id="folder", file_types=("binary", "documents"), filter="false", date_range="today") == ["folder"]
    with pytest.raises(ValueError):
        FileSourceOptions(folder="f", file_types=("Binary",))
    with pytest.raises(ValueError):
        FileSourceOptions(folder="f", export_formats={"documents": "image/png"})
    with pytest.raises(ValueError):
        FileSourceOptions()


def test_renditions(spark):
    form = "application/vnd.google-apps.form"
    files = spark.createDataFrame(
        [("b", "text/plain", 3, b"abc"), ("d", NATIVE_MIMES["documents"], None, None), ("j", NATIVE_MIMES["appsScripts"], None, None),
         ("x", form, None, None)], "id string, mimeType string, size bigint, body binary")
    renditions = spark.createDataFrame(
        [("d", "text/plain", b"plain"), ("d", "text/html", b"<p>"), ("j", NATIVE_MIMES["appsScripts"] + "+json", b"{}")],
        "id string, export_mime string, content binary")
    got = {(r.id, r.offset): (r.mimeType, r.size, bytes(r.body)) for r in read_bodies(files, 2, renditions, {"documents": "text/html"}).collect()}
    assert got == {
        ("b", 0): ("text/plain", 3, b"ab"), ("b", 2): ("text/plain", 3, b"c"), ("d", 0): ("text/html", 3, b"<p>"),
        ("j", 0): (NATIVE_MIMES["appsScripts"] + "+json", 2, b"{}"), ("x", 0): (form, None, b""),
    }
    with pytest.raises(Exception, match="No rendition"):
        read_bodies(files, 0, renditions, {"documents": "application/pdf"}).collect()


def test_contents_are_not_broadcast(spark):
    files = spark.createDataFrame([("d", NATIVE_MIMES["documents"], None, ["f"])], "id string, mimeType string, size bigint, parents array<string>")
    renditions = spark.createDataFrame([("d", "text/plain", b"text")], "id string, export_mime string, content binary")
    plan = with_renditions(files, renditions)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    for line in plan.splitlines():
        assert "BroadcastExchange" not in line or "content" not in line


def test_files_without_a_type_are_binary(spark):
    files = spark.createDataFrame(
        [("a", None, 3, ["f"], b"abc"), ("b", "text/plain", 2, ["f"], b"de"), ("d", NATIVE_MIMES["documents"], None, ["f"], None)],
        "id string, mimeType string, size bigint, parents array<string>, body binary")
    renditions = spark.createDataFrame([("d", "text/plain", b"text")], "id string, export_mime string, content binary")
    read = lambda **o: sorted((r["id"], r["offset"], bytes(r["body"])) for r in read_files(files, FileSourceOptions(properties=("id",), max_part_bytes=2, **o), renditions).select("id", "offset", "body").collect())
    assert read(folder="f") == [("a", 0, b"ab"), ("a", 2, b"c"), ("b", 0, b"de"), ("d", 0, b"text")]
    assert read(folder="f", file_types=("binary",)) == [("a", 0, b"ab"), ("a", 2, b"c"), ("b", 0, b"de")]
    assert read(file_id="a") == [("a", 0, b"ab"), ("a", 2, b"c")]


def test_file_sink_rows(spark):
    df = spark.createDataFrame([(b"abc", None, None), (None, None, None), (b"abc", "testName", "text/plane")],
                               "body binary, name string, mimeType string")
    rows = file_rows(df, seed=3).collect()
    assert [len(r.name) for r in rows] == [16, 16, 8] and rows[2].name == "testName"
    assert [bytes(r.body) for r in rows] == [b"abc", b"", b"abc"]
    assert [r.mimeType for r in rows] == [None, None, "text/plane"]
    only_body = file_rows(df.select("body")).collect()
    assert all(len(r.name) == 16 and r.mimeType is None for r in only_body)


def test_file_sink_schema(spark):
    schema = spark.createDataFrame([], "body string, name int").schema
    assert len(file_schema_problems(schema, "body", "name", "mime")) == 3
    assert file_schema_problems(spark.createDataFrame([], "b binary, n string").schema, "b", "n") == []


def test_write_list_and_read_a_folder(spark, tmp_path):
    folder = str(tmp_path / "out")
    big = bytes(range(256)) * 40
    rows = file_rows(
        spark.createDataFrame([(big, "big.bin"), (b"hello", "note.txt"), (b"one", "same.csv"), (b"two", "same.csv"), (b"", None)],
                              "body binary, name string"))
    manifest = write_files(rows, folder)
    assert manifest.count() == 5
    listing = list_folder(spark, folder)
    names = [r.name for r in listing.collect()]
    assert len(names) == 5 and {"big.bin", "note.txt"} <= set(names)
    assert sum(n.startswith("same (") and n.endswith(").csv") for n in names) == 2
    assert {r.name: r.mimeType for r in listing.collect()}["note.txt"] == "text/plain"

    parts = read_parts(listing, 1000, tasks=4)
    assert parts.where("size is null").count() == 0
    bodies = {}
    for r in parts.orderBy("offset").collect():
        bodies[r.name] = bodies.get(r.name, b"") + bytes(r.body)
    assert bodies["big.bin"] == big and bodies["note.txt"] == b"hello"
    assert sorted(b for n, b in bodies.items() if n.startswith("same")) == [b"one", b"two"]
    assert parts.where("name = 'big.bin'").count() == 11


def test_catalogue_plan_is_narrow_and_pushed_down(spark, sf_dir):
    files = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("id"), F.encode("text", "UTF-8").alias("body"), F.array("lang").alias("parents"),
        F.lit("text/plain").alias("mimeType"), F.timestamp_seconds(F.col("n_chars")).alias("modifiedTime"), "n_chars")
    options = FileSourceOptions(folder="en", file_types=("binary",), filter="n_chars > 100", properties=("id",), max_part_bytes=100)
    plan = read_files(files, options)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "GreaterThan(n_chars,100)" in plan and "source" not in plan
