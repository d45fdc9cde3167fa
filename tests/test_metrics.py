"""Rates over a log."""

from helpers import rows
from pyspark.sql import functions as F

from docstream.operators import metrics


def log(spark, *millis):
    data = [(i, ms) for i, ms in enumerate(millis)]
    return spark.createDataFrame(data, "offset bigint, ms bigint").select(
        "offset", F.timestamp_millis("ms").alias("timestamp")
    )


def test_intervals(spark):
    found = metrics.interval_metrics(log(spark, 0, 1000, 4000, 9000), 5).orderBy("interval_start")
    assert [tuple(r)[1:] for r in found.collect()] == [(3, 3, 4000, 4000 / 3, 4.0), (1, 4, 9000, 2250.0, 0.0)]


def test_throughput(spark):
    assert rows(metrics.throughput(log(spark, 0, 500, 2000))) == [(3, 2.0, 1.5)]


def test_throughput_of_one_instant_is_null(spark):
    assert rows(metrics.throughput(log(spark, 5))) == [(1, 0.0, None)]


def test_send_rate(spark):
    found = metrics.send_rate(log(spark, *range(0, 2500, 100)), "offset", every=10).orderBy("chunk")
    assert [tuple(r) for r in found.collect()] == [
        (0, 10, 10, 900, 1000 * 10 / 900),
        (1, 10, 20, 1900, 1000 * 20 / 1900),
        (2, 5, 25, 2400, 1000 * 25 / 2400),
    ]


def test_running_total_across_blocks(spark):
    df = spark.range(100).select("id", (F.col("id") * 3 % 7).alias("v"))
    found = metrics.running_total(df, "id", "v", F.floor(F.col("id") / 8), "total").orderBy("id").collect()
    total = 0
    for row in found:
        total += row["v"]
        assert row["total"] == total
