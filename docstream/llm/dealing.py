"""Hashed values dealt to buckets as packed arrays: one row carries many values through a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from docstream.session import scratch_dir


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many strokes behind it as it takes to differ from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bucket_bits(spark: SparkSession) -> int:
    """Bits of a hash that name its bucket: some eight buckets for each shuffle partition."""
    return max(8, (8 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length() - 1)


def dealt(hashes: np.ndarray, bits: int, *others: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """(bucket, hashes, others) for sorted ``hashes``, cut by their first ``bits`` bits."""
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    cuts = np.append(np.searchsorted(hashes, edges), len(hashes))
    for bucket in np.flatnonzero(np.diff(cuts)).tolist():
        a, b = cuts[bucket], cuts[bucket + 1]
        yield bucket, hashes[a:b], [x[a:b] for x in others]


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and the sum of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order].astype(np.int64)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def by_bucket(batches: Iterator[pa.RecordBatch], columns: int) -> dict[tuple, list[list[bytes]]]:
    """Packed arrays of a partition by its first ``columns`` columns (bucket and the like)."""
    found: dict[tuple, list[list[bytes]]] = {}
    for batch in batches:
        told = [c.to_pylist() for c in batch.columns]
        for row in zip(*told, strict=True):
            parts = found.setdefault(row[:columns], [[] for _ in row[columns:]])
            for part, value in zip(parts, row[columns:], strict=True):
                part.append(value)
    return found


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: lineage ends there, and no executor is needed for it."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, path: str) -> None:
    """Removes a folder of the scratch space that no later step reads."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
