"""A corpus made ready for training: judged, deduplicated, decontaminated, pseudonymised and packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstream.llm import decontamination, jaccard_join, packing, pii, quality
from docstream.llm.dealing import saved, unused
from docstream.llm.queries import PII_KEY, table
from docstream.llm.tokenizing import tokenizer_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base check nor a rule rejects."""
    return quality.keep(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are similar to 0.8 or more."""
    return jaccard_join.one_of_each(docs, size=5, percent=80)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pseudonymous_documents(spark: SparkSession, docs: DataFrame, sf_dir: str, key: str = PII_KEY) -> DataFrame:
    """Documents with personal numbers and dates replaced; their lengths follow."""
    counted = unused(docs, "n_found")
    found = pii.pseudonymise(docs, key, counted=counted)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.col(counted) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", good_documents),
    ("near_duplicates", distinct_documents),
    ("decontamination", clean_documents),
    ("pii", pseudonymous_documents),
    ("packing", packed_documents),
]

#: The pseudonyms and the packing can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, pii_key: str = PII_KEY) -> DataFrame:
    """All stages over the whole table; each is written before the next reads it. ``pii_key`` keys the pseudonyms."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        own = {"key": pii_key} if stage is pseudonymous_documents else {}
        docs = saved(stage(spark, docs, sf_dir, **own), f"stage-{name}")
    return docs
