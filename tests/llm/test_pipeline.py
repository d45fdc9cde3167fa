"""The stages against what each of them has to do."""

import zlib

import corpus_pipeline
from pyspark.sql import functions as F

from docstream.llm import jaccard_join, pii, quality
from docstream.llm.queries import table

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = table(spark, SF, "documents")
    before = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, kept[name] = docs, stage(spark, docs, SF)
        if name != "packing":
            assert kept[name].columns == before.columns
            docs = corpus_pipeline.saved(kept[name], name)
    good = quality.judge(table(spark, SF, "documents")).filter("kept").select("doc_id")
    assert kept["quality_rules"].select("doc_id").exceptAll(good).count() == 0
    components = jaccard_join.jaccard_components(kept["quality_rules"])
    assert kept["near_duplicates"].count() == components.select("component_id").distinct().count() < components.count()
    ids = {r[0] for r in kept["near_duplicates"].select("doc_id").collect()}
    assert {r[0] for r in kept["decontamination"].select("doc_id").collect()} < ids
    assert kept["pii"].count() == kept["decontamination"].count()
    assert kept["pii"].filter(F.col("text").rlike(pii.CARD)).count() == kept["decontamination"].filter(F.col("text").rlike(pii.CARD)).count()
    assert kept["pii"].exceptAll(kept["decontamination"]).count() > 0
    pieces = kept["packing"]
    assert pieces.groupBy("doc_id").agg((F.sum("length") == F.first("doc_tokens")).alias("whole")).filter("NOT whole").count() == 0
    found = corpus_pipeline.run(spark, SF)
    assert found.select("doc_id", "doc_tokens").distinct().exceptAll(pieces.select("doc_id", "doc_tokens").distinct()).count() == 0
    assert found.count() == pieces.count() and zlib.crc32(b"") == 0


def test_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        assert found.count() == 0
