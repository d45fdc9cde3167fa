"""Bounds on what a task holds, and numbers of tasks."""

import random
import tracemalloc

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import functions as F

from docstream.llm import components, decontamination, jaccard_join, packing, quality, warc
from docstream.llm.tokenizing import tokenizer_path


def test_pools_are_packed_when_full(spark):
    docs = spark.range(4000, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("one two three four five six seven").alias("text"))
    short = lambda pool: packing.pack(docs, tokenizer_path("word_bpe_49k.json"), pool_tokens=pool).groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n < 2000").count()
    assert short(3_000) > 2 * short(10**9)


def test_items_in_blocks_find_the_same(frame):
    items = [(k, " ".join(f"w{k}x{j}" for j in range(30))) for k in range(6)]
    docs = [(k, f"before {text} after") for k, text in items] + [(99, "nothing of it"), (100, None)]
    df, benchmark = frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")
    whole = decontamination.find_items(df, benchmark).collect()
    assert sorted(decontamination.find_items(df, benchmark, block_words=50).collect()) == sorted(whole)
    assert sum(len(r["matches"]) for r in whole) == 6


def test_archives_are_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "TASK_BYTES", 2_000)
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.lit("http://a/").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("html"))
    index = warc.write_archives(warc.with_types(pages, "page_id", "url", "html"), str(tmp_path))
    found = warc.read_records(index)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert found.select(F.spark_partition_id()).distinct().count() > 5
    assert found.count() == 300


def test_a_batch_of_texts_is_packed_within_bounds(spark, monkeypatch):
    rng = random.Random(5)
    texts = pa.array([" ".join(str(rng.randrange(10**6)) for _ in range(400)) for _ in range(4000)])
    tasks = []
    docs = spark.createDataFrame([("",)], "text string")
    in_arrow = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, work, schema: (tasks.append(work), in_arrow(self, work, schema))[1])
    jaccard_join.sieve(docs, jaccard_join.Rule(80), 5, 4)
    batches = [pa.record_batch([texts.slice(k, 500)], names=["text"]) for k in range(0, len(texts), 500)]
    tracemalloc.start()
    try:
        packed = sum(sum(map(len, b.column(1).drop_null().to_pylist())) for b in tasks[0](iter(batches)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    firsts = sum(len(s[: 396 - 317 + 1 + 80 // 4 - 1]) for s in jaccard_join.sets_of(texts, 5))
    assert packed == 8 * firsts
    assert peak < 36 << 20, peak


def test_workers_of_the_join_get_small_batches(spark, frame, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(name), []
    save = jaccard_join.saved
    monkeypatch.setattr(jaccard_join, "saved", lambda df, purpose: (seen.append(int(spark.conf.get(name))), save(df, purpose))[1])
    docs = frame([(k, f"one two three four five six {k % 3}") for k in range(9)], "doc_id long, text string")
    assert jaccard_join.one_of_each(docs).count() == 3
    assert len(seen) >= 4 and max(seen) <= 1000 and spark.conf.get(name) == before


def test_links_are_written_in_few_files(spark, frame, monkeypatch):
    saved, files = components.saved, []

    def counted(df, purpose):
        found = saved(df, purpose)
        files.append(len(found.inputFiles()))
        return found

    monkeypatch.setattr(components, "saved", counted)
    names = {"spark.sql.shuffle.partitions": "96", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        found = components.components(frame([(k, k // 2) for k in range(1, 2000)], "a long, b long"))
        assert {r.root for r in found.collect()} == {0} and found.count() == 1999
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(files) > 2 and max(files) <= max(12, spark.sparkContext.defaultParallelism)


def test_the_sample_of_rules_starts_no_python(spark, frame, monkeypatch):
    docs = frame([(k, f"a few words of text {k}") for k in range(20)] + [(20, None)], "doc_id long, text string").coalesce(1)

    def never(*_, **__):
        raise AssertionError("rows go through Python workers")

    monkeypatch.setattr(SparkContext, "parallelize", never)
    rules = quality.default_rules()
    assert set(quality.measure(docs, rules)) == {r.name for r in rules}
    assert set(quality.measure(docs.limit(0), rules)) == {r.name for r in rules}
