"""Throughput of a log as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


# Intervals or batches per block of a running total.
BLOCK = 4096


def _millis_between(start: Column, end: Column) -> Column:
    """Whole milliseconds between two moments."""
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / 1000)


def running_total(df: DataFrame, order: str, value: str, block: Column, name: str) -> DataFrame:
    """Add the running total of ``value`` by ``order``.

    Rows are summed within blocks, which ``block`` numbers along the order; only the block totals,
    one row each, are summed up in a single sequence.
    """
    cut = df.withColumn("_block", block)
    blocks = cut.groupBy("_block").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carried"))
    within = Window.partitionBy("_block").orderBy(order)
    return (
        cut.withColumn("_within", F.sum(value).over(within))
        .join(carried, "_block")
        .withColumn(name, F.col("_carried") + F.col("_within"))
        .drop("_block", "_within", "_carried")
    )


def interval_metrics(log: DataFrame, seconds: int) -> DataFrame:
    """Per commit interval of ``seconds``: documents, running total, elapsed and average time (A10)."""
    per = log.groupBy(F.window("timestamp", f"{seconds} seconds")["start"].alias("interval_start")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.min("timestamp").alias("first_at"),
        F.max("timestamp").alias("last_at"),
    )
    block = F.floor(F.unix_seconds("interval_start") / (seconds * BLOCK))
    start = log.agg(F.min("timestamp")).scalar()
    elapsed = _millis_between(start, F.col("last_at"))
    return running_total(per, "interval_start", "n_docs", block, "total_docs").select(
        "interval_start",
        "n_docs",
        "total_docs",
        elapsed.alias("elapsed_ms"),
        (elapsed / F.col("total_docs")).alias("avg_ms_per_doc"),
        (_millis_between(F.col("first_at"), F.col("last_at")) / 1000).alias("busy_seconds"),
    )


def throughput(log: DataFrame, *by: str) -> DataFrame:
    """Records per second between the first and the last record (A11); null for a single instant."""
    seconds = _millis_between(F.min("timestamp"), F.max("timestamp")) / 1000
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        seconds.alias("seconds"),
        F.try_divide(F.count(F.lit(1)), seconds).alias("docs_per_second"),
    )


def send_rate(log: DataFrame, seq: str, every: int = 10_000) -> DataFrame:
    """Running send rate after each ``every`` sends, from a send number that starts at 0."""
    start = log.agg(F.min("timestamp")).scalar()
    elapsed = _millis_between(start, F.max("timestamp"))
    sent = F.max(seq) + 1
    return log.groupBy(F.floor(F.col(seq) / every).alias("chunk")).agg(
        F.count(F.lit(1)).alias("n_sent"),
        sent.alias("total_sent"),
        elapsed.alias("elapsed_ms"),
        F.try_divide(1000.0 * sent, elapsed).alias("docs_per_second"),
    )
