"""Rates of running and finished queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from docstream.operators.metrics import BLOCK, running_total
from docstream.streaming.store import CollectionStore

PROGRESS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("at", T.StringType()),
        T.StructField("n_records", T.LongType()),
        T.StructField("input_per_second", T.DoubleType()),
        T.StructField("processed_per_second", T.DoubleType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)


def _row(progress) -> tuple:
    return (
        progress.name,
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        progress.inputRowsPerSecond,
        progress.processedRowsPerSecond,
        progress.batchDuration,
    )


class RateLog(StreamingQueryListener):
    """Prints one line of rates per batch."""

    def __init__(self, write=print) -> None:
        self.write = write

    def onQueryStarted(self, event) -> None:
        self.write(f"{event.name}: started")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.write(f"{p.name}: batch {p.batchId}, {p.numInputRows} records, {p.processedRowsPerSecond:.1f} per second")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.write("stopped" if event.exception is None else "failed")


def batch_metrics(store: CollectionStore) -> DataFrame | None:
    """Per complete batch: documents, running total, elapsed time, average per document (A10)."""
    batches = store.batches()
    if batches is None:
        return None
    start = batches.agg(F.min("started_at")).scalar()
    elapsed = F.unix_millis("finished_at") - F.unix_millis(start)
    block = F.floor(F.col("batch_id") / BLOCK)
    return running_total(batches, "batch_id", "n_ok", block, "total_docs").select(
        "batch_id",
        F.col("n_ok").alias("n_docs"),
        "total_docs",
        elapsed.alias("elapsed_ms"),
        F.try_divide(elapsed, F.col("total_docs")).alias("avg_ms_per_doc"),
        ((F.unix_millis("finished_at") - F.unix_millis("started_at")) / 1000).alias("busy_seconds"),
    )
