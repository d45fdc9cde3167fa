"""Test documents derived row by row from a number column.

Every value is a function of (seed, number): a task that runs again makes the same documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docstream.constants import SAMPLE_TITLE
from docstream.functions.names import base64_text, date_text, sample_id, stable_uuid

_INT_RANGE = 1 << 32
_HALF_RANGE = 1 << 31


def numbers(spark: SparkSession, n: int) -> DataFrame:
    """Document numbers 0 .. n-1."""
    return spark.range(n).withColumnRenamed("id", "number")


def _draw(seed: int, number: Column, purpose: str, hex_digits: int = 8) -> Column:
    """Evenly spread whole number below 16**hex_digits."""
    digest = F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.lit(purpose), number.cast("string")))
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("bigint")


def digits_text(start: Column, length: Column) -> Column:
    """Base64 of the digits of ``length`` 32-bit integers drawn from ``start`` on."""
    # Multiplicative hashing of consecutive numbers; the multiplier is 2**32 over the golden ratio.
    digits = F.transform(
        F.when(length > 0, F.sequence(F.lit(1), length)).otherwise(F.array().cast("array<int>")),
        lambda i: (
            F.pmod((start + i) * F.lit(2654435761), F.lit(_INT_RANGE)) - F.lit(_HALF_RANGE)
        ).cast("string"),
    )
    return base64_text(F.array_join(digits, ""))


def random_documents(
    numbered: DataFrame, size: int, seed: int = 0, number: str = "number", keep: Sequence[str] = ()
) -> DataFrame:
    """One random document per row of ``numbered``; the text has 0 .. size-1 integers (G1).

    Columns named in ``keep`` stay beside the document's own.
    """
    n = F.col(number)
    drawn = F.struct(
        F.pmod(_draw(seed, n, "start"), F.lit(_HALF_RANGE)).alias("start"),
        F.pmod(_draw(seed, n, "length"), F.lit(size)).cast("int").alias("length"),
    )
    # A generator's output is computed once per row, not once per integer of the text.
    return numbered.select("*", F.explode(F.array(drawn)).alias("_drawn")).select(
        *keep,
        stable_uuid(F.lit(seed), n).alias("id"),
        digits_text(F.col("_drawn.start"), F.col("_drawn.length")).alias("text"),
        (_draw(seed, n, "int") - F.lit(_HALF_RANGE)).cast("int").alias("doc_number"),
        (_draw(seed, n, "double", 13) / F.lit(float(1 << 52))).alias("doc_double"),
        (F.pmod(_draw(seed, n, "flag"), F.lit(2)) == 1).alias("some_flag"),
    )


def sample_documents(
    numbered: DataFrame,
    moment: Column,
    seed: int = 0,
    number: str = "number",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Small documents of id, title and date text."""
    return numbered.select(
        *keep,
        sample_id(F.lit(seed), F.col(number)).alias("id"),
        F.lit(SAMPLE_TITLE).alias("title"),
        date_text(moment).alias("date"),
    )


def probe_documents(spark: SparkSession, moment: Column) -> DataFrame:
    """Two documents whose ids are the same in every run, to show which shard a key goes to."""
    return sample_documents(numbers(spark, 2), moment)


def paced_documents(spark: SparkSession, per_second: int, size: int, seed: int = 0) -> DataFrame:
    """Endless stream of random documents at a fixed pace."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return random_documents(ticks, size, seed, number="value")
