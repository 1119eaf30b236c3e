"""Folders as a Python data source: `spark.read.format("folder_files").load(folder)`, the same with
`readStream`, and `df.write.format("folder_files").mode("append").save(folder)`.

    use_folder_files(spark)   # registers the format
    read_folder(spark, folder, where="name LIKE 'a%' AND size > 10")

A row is a part of a file: `offset` and `body` of at most `maxPartBytes` bytes, or the whole file
where that is not set. Options:

* `recursive` (false): files of all folders below too.
* `maxPartBytes` (0: never cut).
* `tasks` (32): how many tasks read.
* `planFiles` (10,000): up to so many selected files are planned as byte ranges, evenly by bytes.
  A larger folder is not held by the driver: every task lists the names itself and looks at, and
  reads, only those its share of the name's hash falls to.
* `settleMillis` (1000), streams only: files younger than this wait for the next batch.

`read_folder` pushes filters on id, name, mimeType, size and modifiedTime down: on names they decide before a file
is looked at, on the others before it is opened, and an equality on the id (or on the name in one folder) looks at
that file without listing. `.schema("name string, size long")` reads those columns alone; without
`body` no file is opened.

Spark 4.1 keeps pushed filters with the loaded table and not with the query, so that one DataFrame filtered in two ways
gets the rows of either. The format above therefore pushes nothing. `read_folder` loads a table of its own by
a second format that does, and puts a step behind its filter that no later filter passes, so what it returns
may be used any number of times.

A stream's offset is a modification time, kept in its checkpoint: a batch holds the versions
modified after the last offset and not after its own, so every version comes once, also empty files, hidden names and changed
files, also when a batch is repeated. A version that is replaced before its batch was read comes as what replaced it,
later. Times are the store's: files that arrive with an older time than the offset (moved there with their times kept) are not seen.
"""

from __future__ import annotations

import json
import mimetypes
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from itertools import batched, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualNullSafe, EqualTo, Filter, GreaterThan,
    GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith,
    StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType, TimestampType

from foldergrid.functions.text import fitting_name, new_name
from foldergrid.operators.catalogue import user_filter
from foldergrid.sources import listing

FORMAT = "folder_files"
SCHEMA = (
    StructType().add("id", StringType()).add("name", StringType()).add("mimeType", StringType()).add("size", LongType())
    .add("parents", ArrayType(StringType())).add("modifiedTime", TimestampType()).add("offset", LongType()).add("body", BinaryType())
)
KNOWN = ("id", "name", "mimeType", "size", "modifiedTime")  # columns that can be tested without opening a file
_TYPES = mimetypes.MimeTypes(filenames=()).types_map[True]
SELECTING = "folder_files_selected"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def use_folder_files(spark: SparkSession) -> SparkSession:
    """Register the format with a session."""
    spark.dataSource.register(FolderFiles)
    spark.dataSource.register(SelectedFolderFiles)
    spark.conf.set(PUSHDOWN, "true")
    return spark


def read_folder(
    spark: SparkSession, folder: str, where: str | Column | None = None, columns: list[str] | None = None,
    recursive: bool = False, max_part_bytes: int = 0, tasks: int | None = None,
) -> DataFrame:
    """The files of a folder that a condition selects, whole or in parts; `columns` may leave out
    those that need not be read. The condition may name any column, also one that is not asked for."""
    use_folder_files(spark)
    columns = SCHEMA.names if columns is None else columns
    reader = spark.read.format(FORMAT if where is None else SELECTING).option("recursive", recursive).option("maxPartBytes", max_part_bytes)
    if tasks is not None:
        reader = reader.option("tasks", tasks)
    if where is None:
        return reader.schema(_chosen(columns)).load(folder)
    condition = user_filter(where)
    whole = reader.schema(_chosen([*columns, *_named_in(spark, condition, columns)])).load(folder)
    # no filter is pushed through a sample, not even through one of all rows
    return whole.where(condition).sample(fraction=1.0).select(*columns)


def _chosen(columns: list[str]) -> StructType:
    unknown = [c for c in columns if c not in SCHEMA.names]
    if unknown:
        raise ValueError(f"Folders have no columns {unknown}; they have {SCHEMA.names}.")
    return StructType([SCHEMA[c] for c in columns])


def _named_in(spark: SparkSession, condition: Column, columns: list[str]) -> list[str]:
    """Columns that a condition names and that are not among `columns`."""
    plan = spark.createDataFrame([], SCHEMA).where(condition)._jdf.queryExecution().analyzed()
    named = {a.name() for a in _java_list(plan.condition().references().toSeq())}
    return [c for c in SCHEMA.names if c in named and c not in columns]


def _java_list(found) -> list:
    return [found.apply(i) for i in range(found.size())]


class FolderFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return SCHEMA

    def _folder(self) -> str:
        folder = self.options.get("path")
        if not folder:
            raise ValueError("folder_files needs the path of a folder.")
        return folder.rstrip("/") or "/"

    def reader(self, schema: StructType) -> FolderReader:
        return FolderReader(self._folder(), schema, Reading.of(self.options))

    def streamReader(self, schema: StructType) -> FolderStreamReader:
        return FolderStreamReader(self._folder(), schema, Reading.of(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> FolderWriter:
        if overwrite:
            raise ValueError("Files are only added to a folder: use mode('append').")
        return FolderWriter(self._folder(), schema)


class SelectedFolderFiles(FolderFiles):
    """The same with pushed filters, for one use of what is loaded."""

    @classmethod
    def name(cls) -> str:
        return SELECTING

    def reader(self, schema: StructType) -> SelectingReader:
        return SelectingReader(self._folder(), schema, Reading.of(self.options))


class Reading:
    """The options of a read."""

    def __init__(self, recursive: bool, part_bytes: int, tasks: int, plan_files: int, settle_ms: int):
        if min(part_bytes, settle_ms, plan_files) < 0 or tasks < 1:
            raise ValueError("Options of folder_files must not be negative, and tasks is one at least.")
        self.recursive, self.part_bytes, self.tasks, self.plan_files, self.settle_ms = recursive, part_bytes, tasks, plan_files, settle_ms

    @classmethod
    def of(cls, options) -> Reading:
        number = lambda name, default: int(options.get(name, default))
        return cls(
            options.get("recursive", "false").lower() == "true", number("maxPartBytes", 0), number("tasks", 32),
            number("planFiles", 10_000), number("settleMillis", 1000),
        )


class File:
    """A listed file."""

    __slots__ = ("folder", "name", "size", "modified_ms")

    def __init__(self, folder: str, entry: listing.Entry):
        self.folder = folder
        self.name, self.size, self.modified_ms, _ = entry

    @property
    def path(self) -> str:
        return f"{self.folder}/{self.name}"

    def value(self, column: str):
        if column == "id":
            return self.path
        if column == "mimeType":
            return mime_of_name(self.name)
        if column == "modifiedTime":
            return datetime.fromtimestamp(self.modified_ms / 1000, UTC)
        return getattr(self, column)

    def ranges(self, part_bytes: int) -> Iterator[tuple[int, int | None]]:
        """(first byte, number of bytes); the whole of a file that is not cut."""
        if 0 < part_bytes < self.size:
            for start in range(0, self.size, part_bytes):
                yield start, min(part_bytes, self.size - start)
        else:
            yield 0, None


def mime_of_name(name: str) -> str:
    _, dot, ending = name.rpartition(".")
    return _TYPES.get(f".{ending}".lower(), "application/octet-stream") if dot and ending else "application/octet-stream"


_COMPARED = {
    EqualTo: lambda a, b: a == b, EqualNullSafe: lambda a, b: a == b,
    GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b,
    StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: str.__contains__,
    In: lambda a, b: a in b,
}


def test_of(condition: Filter) -> tuple[str, Callable] | None:
    """(column, test of its value) of a filter that listing can decide. No column here is ever
    null, so a test is true or false."""
    if isinstance(condition, Not):
        inner = test_of(condition.child)
        return inner and (inner[0], lambda value, test=inner[1]: not test(value))
    if len(condition.attribute) != 1 or condition.attribute[0] not in KNOWN:
        return None
    column = condition.attribute[0]
    if isinstance(condition, IsNull | IsNotNull):
        there = isinstance(condition, IsNotNull)
        return column, lambda value: there
    compared = _COMPARED.get(type(condition))
    if compared is None or condition.value is None or isinstance(condition, In) and None in condition.value:
        return None
    return column, lambda value, wanted=condition.value: compared(value, wanted)


class Selection:
    """The pushed filters, by what they need to know of a file."""

    def __init__(self):
        self.of_name: list = []
        self.of_file: list = []
        self.paths: set[str] | None = None  # the only files that can be meant

    def take(self, condition: Filter, folder: str, recursive: bool) -> bool:
        found = test_of(condition)
        if found is None:
            return False
        column, test = found
        if column in ("name", "mimeType"):
            self.of_name.append((column, test))
        else:
            self.of_file.append((column, test))
        if isinstance(condition, EqualTo | EqualNullSafe | In) and (column == "id" or column == "name" and not recursive):
            values = condition.value if isinstance(condition, In) else [condition.value]
            paths = {v if column == "id" else f"{folder}/{v}" for v in values}
            self.paths = paths if self.paths is None else self.paths & paths
        return True

    def name_wanted(self, name: str) -> bool:
        return all(test(mime_of_name(name) if column == "mimeType" else name) for column, test in self.of_name)

    def files(self, folder: str, reading: Reading, share: int = 0, shares: int = 1) -> Iterator[File]:
        for file in self._candidates(folder, reading, share, shares):
            if all(test(file.value(column)) for column, test in self.of_file):
                yield file

    def _candidates(self, folder: str, reading: Reading, share: int, shares: int) -> Iterator[File]:
        if self.paths is None:
            for at, entry in listing.walk(folder, reading.recursive, share, shares, self.name_wanted):
                yield File(at, entry)
            return
        for path in sorted(self.paths):
            at, _, name = path.rpartition("/")
            inside = at == folder or reading.recursive and at.startswith(folder + "/")
            if inside and name not in ("", ".", "..") and "/../" not in path and self.name_wanted(name):
                entry = listing.one_entry(path)
                if entry is not None and listing.in_share(name, share, shares):
                    yield File(at, entry)


class Parts(InputPartition):
    """Planned byte ranges: (folder, entry, first byte, number of bytes)."""


class Share(InputPartition):
    """(share, shares) of a folder that its tasks list themselves."""


def planned(files: Iterator[File], reading: Reading) -> list[InputPartition]:
    """Byte ranges dealt evenly by bytes; shares where there are more files than may be planned."""
    held = list(islice(files, reading.plan_files + 1))
    if len(held) > reading.plan_files:
        return [Share((i, reading.tasks)) for i in range(reading.tasks)]
    total = sum(file.size for file in held) + len(held)
    size, dealt, bytes_ = max(-(-total // reading.tasks), 1), [[]], 0
    for file in sorted(held, key=lambda f: f.path):
        for start, length in file.ranges(reading.part_bytes):
            own = (file.size if length is None else length) + 1  # an empty file is work too
            if dealt[-1] and bytes_ + own > size:
                dealt.append([])
                bytes_ = 0
            dealt[-1].append((file.folder, (file.name, file.size, file.modified_ms, False), start, length))
            bytes_ += own
    return [Parts(tuple(part)) for part in dealt if part]


def read_part(path: str, start: int, length: int | None) -> bytes:
    system, inner = listing.located(path)
    with system.open_input_file(inner) as source:
        source.seek(start)
        return source.read(length)


def record_batches(parts: Iterator[tuple[File, int, int | None]], schema: StructType) -> Iterator[pa.RecordBatch]:
    """Rows of the wanted columns: one at a time where bodies are read, else a page."""
    arrow = to_arrow_schema(schema)
    with_body = "body" in schema.names
    for page in batched(parts, 1 if with_body else listing.PAGE):
        columns = []
        for field in arrow:
            if field.name == "body":
                values = [read_part(file.path, start, length) for file, start, length in page]
            elif field.name == "offset":
                values = [start for _, start, _ in page]
            elif field.name == "parents":
                values = [[file.folder] for file, *_ in page]
            else:
                values = [file.value(field.name) for file, *_ in page]
            columns.append(pa.array(values, field.type))
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)


def checked_schema(schema: StructType) -> StructType:
    for field in schema.fields:
        if field.name not in SCHEMA.names or SCHEMA[field.name].dataType != field.dataType:
            raise ValueError(f"folder_files has no column {field.name} of type {field.dataType.simpleString()}; it has {SCHEMA.simpleString()}.")
    return schema


class FolderReader(DataSourceReader):
    def __init__(self, folder: str, schema: StructType, reading: Reading):
        self.folder, self.schema, self.reading = folder, checked_schema(schema), reading
        self.selection = Selection()

    def partitions(self) -> list[InputPartition]:
        return planned(self.selection.files(self.folder, self.reading), self.reading)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return record_batches(_parts(partition, self.folder, self.selection, self.reading), self.schema)


class SelectingReader(FolderReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for condition in filters:
            if not self.selection.take(condition, self.folder, self.reading.recursive):
                yield condition


def _parts(partition: InputPartition, folder: str, selection: Selection, reading: Reading) -> Iterator[tuple[File, int, int | None]]:
    if isinstance(partition, Parts):
        for at, entry, start, length in partition.value:
            yield File(at, entry), start, length
    elif isinstance(partition, Share):
        for file in selection.files(folder, reading, *partition.value[:2]):
            for start, length in file.ranges(reading.part_bytes):
                yield file, start, length


class FolderStreamReader(DataSourceStreamReader):
    def __init__(self, folder: str, schema: StructType, reading: Reading):
        self.folder, self.schema, self.reading = folder, checked_schema(schema), reading

    def initialOffset(self) -> dict:
        return {"modified_ms": -1}

    def latestOffset(self) -> dict:
        """The time of the newest version that has settled: one pass that keeps one number."""
        settled = int(time.time() * 1000) - self.reading.settle_ms
        times = (entry[2] for _, entry in listing.walk(self.folder, self.reading.recursive))
        return {"modified_ms": max((t for t in times if t <= settled), default=-1)}

    def _versions(self, start: int, end: int) -> Selection:
        selection = Selection()
        low, high = (datetime.fromtimestamp(t / 1000, UTC) for t in (start, end))
        selection.of_file.append(("modifiedTime", lambda value: low < value <= high))
        return selection

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        bounds = start["modified_ms"], end["modified_ms"]
        if bounds[0] >= bounds[1]:
            return []
        found = planned(self._versions(*bounds).files(self.folder, self.reading), self.reading)
        return [Share((*p.value, *bounds)) if isinstance(p, Share) else p for p in found]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        selection = self._versions(*partition.value[2:]) if isinstance(partition, Share) else Selection()
        return record_batches(_parts(partition, self.folder, selection, self.reading), self.schema)


# ---------------------------------------------------------------- writing
COMMITTED = "_committed"
MANIFEST = "_manifest"
MOVERS = 16


class Written(WriterCommitMessage):
    """The folder that one task attempt has staged its files in, and how many."""

    def __init__(self, attempt: str, files: int):
        self.attempt, self.files = attempt, files


class FolderWriter(DataSourceArrowWriter):
    """Every record becomes a new file.

    Each task attempt writes to a folder of its own beside the target, with a manifest written last. The commit
    first writes down which attempts count, by one rename, then moves their files; both steps may be
    repeated, so a driver lost in between loses nothing (`resume_writes`). Files of attempts that do not count are never
    moved. An aborted job leaves nothing behind. Messages name attempts, not files.
    """

    def __init__(self, folder: str, schema: StructType):
        names = schema.names
        if "body" not in names or not isinstance(schema["body"].dataType, BinaryType):
            raise ValueError("Files need a binary column 'body'.")
        if "name" in names and not isinstance(schema["name"].dataType, StringType):
            raise ValueError("Column 'name' must be a string.")
        self.folder = folder
        self.staging = f"{folder}.staging-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        attempt = uuid.uuid4().hex
        system, base = listing.located(f"{self.staging}/{attempt}")
        system.create_dir(base, recursive=True)
        n = 0
        with system.open_output_stream(f"{base}/{MANIFEST}.open") as manifest:
            for batch in batches:
                names = batch.column("name") if "name" in batch.schema.names else [None] * len(batch)
                for name, body in zip(names, batch.column("body")):
                    with system.open_output_stream(f"{base}/{n}") as out:
                        if body.is_valid:
                            out.write(body.as_buffer())
                    wanted = name.as_py() if name is not None else None
                    manifest.write(json.dumps([n, fitting_name(wanted) if wanted is not None else new_name()]).encode() + b"\n")
                    n += 1
        system.move(f"{base}/{MANIFEST}.open", f"{base}/{MANIFEST}")
        return Written(attempt, n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        attempts = [m.attempt for m in messages if m is not None and m.files]
        system, base = listing.located(self.staging)
        if attempts:
            with system.open_output_stream(f"{base}/{COMMITTED}.open") as out:
                out.write(json.dumps(attempts).encode())
            system.move(f"{base}/{COMMITTED}.open", f"{base}/{COMMITTED}")
            publish(self.staging, self.folder)
        remove(self.staging)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        # after the commit point what is left is published by `resume_writes`, not thrown away
        if not _there(f"{self.staging}/{COMMITTED}"):
            remove(self.staging)


def _there(path: str) -> bool:
    return listing.there(*listing.located(path))


def remove(folder: str) -> None:
    if _there(folder):
        system, base = listing.located(folder)
        system.delete_dir(base)


def publish(staging: str, folder: str) -> int:
    """Move the files of the attempts that count into the folder; returns how many were moved now.

    A file whose name is taken gets its attempt and number before the ending. A file already moved is no
    longer in the staging folder and is passed over, so this may be repeated.
    """
    system, base = listing.located(staging)
    target = listing.located(folder)[1]
    system.create_dir(target, recursive=True)
    with system.open_input_stream(f"{base}/{COMMITTED}") as source:
        attempts = json.loads(source.read())
    moved = 0
    with ThreadPoolExecutor(MOVERS) as pool:
        for attempt in attempts:
            with system.open_input_stream(f"{base}/{attempt}/{MANIFEST}") as source:
                for page in batched(_lines(source), listing.PAGE):
                    # equal names of a page must not be looked up side by side
                    first = {}
                    for number, name in page:
                        first.setdefault(name, []).append(number)
                    moves = pool.map(lambda item: [_move(system, f"{base}/{attempt}", number, target, item[0]) for number in item[1]], first.items())  # noqa: B023
                    moved += sum(map(sum, moves))
    return moved


def _lines(source) -> Iterator[tuple[int, str]]:
    rest = b""
    while block := source.read(1 << 20):
        *whole, rest = (rest + block).split(b"\n")
        yield from (tuple(json.loads(line)) for line in whole if line)


def _move(system, attempt: str, number: int, target: str, name: str) -> int:
    staged = f"{attempt}/{number}"
    if not listing.there(system, staged):
        return 0
    if not listing.move_new(system, staged, f"{target}/{name}"):
        spare = f"{target}/{fitting_name(name, f' ({attempt[-32:]}-{number})')}"
        if not listing.move_new(system, staged, spare):
            raise FileExistsError(f"{spare} is there already.")
    return 1


def resume_writes(folder: str) -> int:
    """Publish what jobs have committed but not moved, because their driver was lost; returns the number of
    files moved. Staging folders without a commit may belong to running jobs and are left alone."""
    folder = folder.rstrip("/")
    above, _, name = folder.rpartition("/")
    moved = 0
    for found in list(listing.names_in(above or "/")):
        staging = f"{above}/{found}"
        if found.startswith(f"{name}.staging-") and _there(f"{staging}/{COMMITTED}"):
            moved += publish(staging, folder)
            remove(staging)
    return moved
