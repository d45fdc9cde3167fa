"""Columns of a user's own that have names the operators use inside stay as they are."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from docstream.llm import jaccard_join, pii, quality
from docstream.llm.queries import table

SF = "/root/testdata/sf0.001"
NAMES = "lines words windows _held row kept rejected_by base_failed n_words _at n_found found _head _row key mark group matches held_out pool".split()


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns(spark, name, stage):
    docs = table(spark, SF, "documents")
    own = docs.select("*", *(F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in NAMES))
    found = stage(spark, own, SF)
    assert found.columns == own.columns
    plain = stage(spark, docs, SF)
    assert sorted(r[0] for r in found.select("doc_id").collect()) == sorted(r[0] for r in plain.select("doc_id").collect())
    wrong = F.lit(False)
    for c in NAMES:
        wrong |= ~F.col(c).eqNullSafe(F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")))
    assert found.filter(wrong).count() == 0


def test_head_of_a_group_keeps_its_own_column(frame):
    rows = [(1, "one two three four five six", 7), (2, "one two three four five six", 8)]
    assert jaccard_join.one_of_each(frame(rows, "doc_id long, text string, _head int")).collect()[0]["_head"] == 7


def test_one_line_rejects_no_clean_text(frame):
    words = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(80))
    eight = "\n".join([words[i * 60 : i * 60 + 60] for i in range(7)] + ["We wrote it in JavaScript once"])
    rows = [(1, words + "..."), (2, "- " + words), (3, eight)]
    assert {r["doc_id"] for r in quality.keep(frame(rows, "doc_id long, text string")).collect()} == {1, 2, 3}
    many = "\n".join(f"{words[k * 40 : k * 40 + 40]}..." for k in range(14))
    assert quality.judge(frame([(1, many)], "doc_id long, text string")).first()["rejected_by"] == "ellipsis_lines"


def test_no_secret_in_the_plan(frame):
    found = pii.pseudonymise(frame([(1, "call 415 555 1234")], "doc_id long, text string"), "very-secret-key")
    assert "very-secret" not in found._jdf.queryExecution().toString()
    assert pii.working_key("a") != pii.working_key("b")
