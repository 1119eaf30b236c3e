"""Numbered runs that write several tables, each run counting once and whole.

A run writes its own folder of every table (`<table>/<key>=<number>`), and last one small entry, by a rename.
What has no entry does not count: readers and later runs go by the entries alone, and a run cut
short is repeated under its number and overwrites what it left. Entries have no gaps.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingRun(ValueError):
    """A run that does not follow the last one."""


class RunLog:
    """The entries of the runs under one path. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self._folder = self._path(f"{self.path}/_{key}s")
        self._store = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def last(self) -> int:
        """The number of the last run that counts, -1 without any."""
        if not self._store.exists(self._folder):
            return -1
        names = [status.getPath().getName() for status in self._store.listStatus(self._folder)]
        return max((int(name) for name in names if name.isdigit()), default=-1)

    def start(self, number: int) -> bool:
        """Whether the run is still to be done; a run that would leave a gap raises."""
        last = self.last()
        if number > last + 1:
            raise MissingRun(f"{self.key} {number} cannot follow {self.key} {last}: those between were never written to {self.path}.")
        return number == last + 1

    def full(self, upto: int) -> int:
        """The last run up to a number that has written tables, -1 without any. A run that had nothing to write is an entry only."""
        return self._entry(upto)["full"] if upto >= 0 else -1

    def _entry(self, number: int) -> dict:
        source = self._store.open(self._path(f"{self._folder}/{number:012d}"))
        try:
            return json.loads(bytes(source.readAllBytes()))
        finally:
            source.close()

    def end(self, number: int, tables: list[str]) -> None:
        """Let the run count. Until here nothing of it does."""
        full = number if tables else self.full(number - 1)
        entry = self._path(f"{self._folder}/{number:012d}")
        draft = self._path(f"{self._folder}/.{number}-{uuid.uuid4().hex}")
        out = self._store.create(draft, True)
        out.write(bytearray(json.dumps({self.key: number, "tables": tables, "full": full}).encode()))
        out.close()
        if not self._store.rename(draft, entry):
            raise OSError(f"The entry {entry} could not be written.")

    def folder(self, table: str, number: int) -> str:
        return f"{self.path}/{table}/{self.key}={number}"

    def read(self, table: str, schema: str | T.StructType, upto: int | None = None) -> DataFrame:
        """A table of all runs that count (up to a number), with the run's number as a column."""
        last = self.last() if upto is None else min(upto, self.last())
        whole = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if self.key not in whole.names:
            whole = T.StructType([*whole.fields, T.StructField(self.key, T.IntegerType())])
        if self.full(last) < 0:
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).parquet(f"{self.path}/{table}").where(F.col(self.key) <= last)


def read_runs(spark: SparkSession, path: str, table: str, key: str = "flush_id", kind: str = "parquet") -> DataFrame:
    """A table as all runs that count have left it."""
    log = RunLog(spark, path, key)
    last = log.last()
    full = log.full(last)
    if full < 0:
        raise ValueError(f"No {key} has been written to {path}.")
    schema = spark.read.format(kind).load(log.folder(table, full)).schema
    whole = T.StructType([*schema.fields, T.StructField(key, T.IntegerType())])
    return spark.read.format(kind).schema(whole).load(f"{path}/{table}").where(F.col(key) <= last)
