"""Writing a stream of records to sheets at an interval, or when enough records have come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foldergrid.model import SheetSinkOptions
from foldergrid.operators.flatten import RECORD, TARGET
from foldergrid.operators.lookup import lookup_join
from foldergrid.session import cut_lineage, forget
from foldergrid.sinks.sheets import Layout, all_cells, all_merges, place, update_documents
from foldergrid.streaming.buffer import REASON, Buffering, buffered
from foldergrid.streaming.runs import RunLog

FLUSH = "flush_id"
TABLES = ("grid_records", "grid_sheets", "grid_totals", "grid_cells", "grid_merges", "documents", "grid_flushes")
TOTALS_DDL = "spreadsheet_name string, sheet_name string, _before bigint"
FLUSHES_DDL = "spreadsheet_name string, sheet_name string, reason string, records bigint"


def save(df: DataFrame, target: str, kind: str = "parquet") -> str:
    df.write.mode("overwrite").format(kind).save(target)
    return target


def write_flush(
    records: DataFrame, flush_id: int, options: SheetSinkOptions, order_by: list[str], path: str, reasons: DataFrame | None = None
) -> None:
    """Place one flush after everything earlier flushes wrote.

    Every table is written to a folder of the flush's own and the flush counts once its entry is written
    (`RunLog`, read with `read_runs`): a flush that was cut short is repeated and overwrites what it left, one that has its entry is
    not written again, and one that does not follow the last raises, since the rows before it are not known.
    A flush without records is an entry only. `reasons` (target, reason, records) says why buffers were flushed.
    """
    spark = records.sparkSession
    log = RunLog(spark, path, FLUSH)
    if not log.start(flush_id):
        return
    put = lambda df, table, kind="parquet": save(df, log.folder(table, flush_id), kind)
    layout = Layout.of(records.schema, options)
    placed = place(records, options, order_by)
    # the totals that the last flush with records left
    last = log.full(flush_id - 1)
    before = spark.read.parquet(log.folder("grid_totals", last)) if last >= 0 else None
    if before is not None:
        shift = F.coalesce("_before", F.lit(0).cast("bigint"))
        placed = (
            lookup_join(placed, before, TARGET, order_by)
            .withColumns({"first_row": F.col("first_row") + shift, "is_first": F.col("is_first") & (shift == 0)})
            .drop("_before")
        )
    placed = spark.read.parquet(put(placed, "grid_records"))
    if placed.isEmpty():
        log.end(flush_id, [])
        return
    added = spark.read.parquet(put(placed.groupBy(*TARGET).agg(F.sum("n_rows").alias("rows_written")), "grid_sheets"))
    totals = added.withColumnRenamed("rows_written", "_before")
    if before is not None:
        totals = totals.unionByName(before).groupBy(*TARGET).agg(F.sum("_before").alias("_before"))
    put(totals, "grid_totals")
    new_sheets = placed.where("is_first").select(*TARGET)
    put(all_cells(placed, layout, options, new_sheets), "grid_cells")
    put(all_merges(placed, layout, options, new_sheets), "grid_merges")
    put(update_documents(placed, layout, options), "documents", "json")
    put(spark.createDataFrame([], FLUSHES_DDL) if reasons is None else reasons, "grid_flushes")
    log.end(flush_id, list(TABLES))


def flush_sheets(
    records: DataFrame,
    options: SheetSinkOptions,
    order_by: list[str],
    path: str,
    checkpoint: str,
    interval_seconds: int = 10,
    available_now: bool = False,
    max_records: int | None = None,
    lane: Column | None = None,
) -> StreamingQuery:
    """Flush a stream to sheets.

    Without `max_records` everything that has come is flushed every `interval_seconds`. With it
    records wait in buffers of their sheet, and a buffer is flushed when it has `max_records`, or `interval_seconds`
    after its first record; a sheet has several buffers (`lane`), so that one sheet of most records is no single task.
    """
    if max_records is None:
        trigger = {"availableNow": True} if available_now else {"processingTime": f"{interval_seconds} seconds"}
        flush = lambda batch, flush_id: write_flush(batch, flush_id, options, order_by, path)
    else:
        if available_now:
            raise ValueError("Buffers wait for more records: a run that stops by itself would leave them unwritten.")
        records = buffered(records, options, Buffering(max_records, interval_seconds), order_by, lane)
        trigger = {"processingTime": f"{max(interval_seconds // 4, 1)} seconds"}  # how exactly the interval is kept

        def flush(batch: DataFrame, flush_id: int) -> None:
            # the buffers are read once, whatever is done with what they gave out
            given = cut_lineage(batch)
            if given.isEmpty():
                log = RunLog(given.sparkSession, path, FLUSH)
                if log.start(flush_id):
                    log.end(flush_id, [])
                forget(given)
                return
            reasons = given.groupBy(*TARGET, F.col(REASON).alias("reason")).agg(F.count(F.lit(1)).alias("records"))
            write_flush(given.select(f"{RECORD}.*"), flush_id, options, order_by, path, reasons)
            forget(given)

    return records.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint).trigger(**trigger).start()
