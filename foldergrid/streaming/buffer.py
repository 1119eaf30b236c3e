"""Buffers of records per sheet that are given out when full, or when their first record has waited long enough."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from foldergrid.model import SheetSinkOptions
from foldergrid.operators.flatten import RECORD, TARGET, targets

REASON, LANE = "_flush_reason", "_lane"
COUNT, TIME = "count", "time"
LANES = 8
# records wait as JSON, to the microsecond
FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "allowNonNumericNumbers": "true", "mode": "FAILFAST",
}
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Buffering:
    """Records that a buffer holds at most, and seconds that a record waits at most."""

    max_records: int = 500
    max_seconds: int = 10

    def __post_init__(self):
        if self.max_records < 1 or self.max_seconds < 1:
            raise ValueError("A buffer holds one record at least, for one second at least.")


class Buffers(StatefulProcessor):
    """One buffer per key. It never holds more than `max_records`: as many are given out at once.

    The records of a buffer are a list of texts in the state, and when it is due is a value beside it, so a restart
    goes on with the buffers as the last batch left them.
    """

    def __init__(self, buffering: Buffering):
        self.buffering = buffering

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getListState("records", "record string")
        self.due = handle.getValueState("due", "at long")

    def _given(self, key: tuple, records: list[tuple], reason: str) -> Iterator[Row]:
        for record in records:
            yield Row(**{TARGET[0]: key[0], TARGET[1]: key[1], RECORD: record[0], REASON: reason})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        records = [tuple(row) for row in self.held.get()] if self.held.exists() else []
        waiting = bool(records)
        for row in rows:
            records.append((row[RECORD],))
            if len(records) >= self.buffering.max_records:
                yield from self._given(key, records, COUNT)
                records, waiting = [], False
        if records:
            self.held.put(records)
        else:
            self.held.clear()
        if not waiting:
            self._wait(timerValues.getCurrentProcessingTimeInMs() if records else None)

    def _wait(self, now: int | None) -> None:
        """The timer of the first record held; none for an empty buffer."""
        if self.due.exists():
            self.handle.deleteTimer(self.due.get()[0])
            self.due.clear()
        if now is not None:
            at = now + 1000 * self.buffering.max_seconds
            self.due.update((at,))
            self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        records = [tuple(row) for row in self.held.get()] if self.held.exists() else []
        self.held.clear()
        self.due.clear()
        yield from self._given(key, records, TIME)

    def close(self) -> None:
        pass


def buffered(
    records: DataFrame, options: SheetSinkOptions, buffering: Buffering, order_by: list[str], lane: Column | None = None
) -> DataFrame:
    """The records of a stream when their buffer is flushed: target, the record as one struct, and the reason
    ('count' or 'time'). A sheet's records are dealt over LANES buffers by a hash of `order_by` unless `lane` says otherwise."""
    spark = records.sparkSession
    if spark.conf.get(STATE_STORE, "") != ROCKSDB:
        spark.conf.set(STATE_STORE, ROCKSDB)  # the only store that keeps lists and timers
    lane = F.pmod(F.xxhash64(*[f"`{c}`" for c in order_by]), F.lit(LANES)) if lane is None else lane
    record = F.struct(*[F.col(f"`{c}`") for c in records.columns])
    routed = records.select(*targets(options), lane.cast("bigint").alias(LANE), F.to_json(record, FORMATS).alias(RECORD))
    given = routed.groupBy(*TARGET, LANE).transformWithState(
        Buffers(buffering), ", ".join(f"{name} string" for name in (*TARGET, RECORD, REASON)), "Append", "ProcessingTime"
    )
    return given.withColumn(RECORD, F.from_json(RECORD, records.schema, FORMATS))
