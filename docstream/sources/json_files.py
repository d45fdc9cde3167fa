"""Documents in JSON files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Documents of JSON files, each one array of objects or, not ``multi_line``, a line per object.

    An array file is read by one task; give large inputs as many files, or one object per line.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def write_documents(docs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Documents as JSON lines, one file per task."""
    docs.write.mode(mode).json(path)


def as_records(
    docs: DataFrame, topic: str, id_field: str = "id", keep: Sequence[str] = ()
) -> DataFrame:
    """Documents as keyed records: the key is the document id.

    Columns named in ``keep`` are not part of the document and stay beside the record.
    """
    return docs.select(
        *keep,
        F.lit(topic).alias("topic"),
        F.col(id_field).cast("string").alias("key"),
        F.to_json(F.struct(*[c for c in docs.columns if c not in keep])).alias("value"),
    )
