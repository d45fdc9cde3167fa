"""Preference formatting and quality rules."""

import re
from collections import Counter

from pyspark.sql import functions as F

from docstream.llm import chat, quality

PAIR = "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prefix_masks_and_edges(frame):
    a, b, c = ("user", "hi é"), ("assistant", "yo"), ("assistant", "no way")
    rows = [
        (1, [a, b, a, b], [a, b, a, c], "clash"),
        (2, [a, b], [a, b], None),
        (3, [a], [a, c, a, c], None),
        (4, None, [a, c], None),
        (5, [(None, None), b], [("", ""), c], None),
        (None, [b], [c], None),
    ]
    found = {r["pair_id"]: r for r in chat.format_preferences(frame(rows, PAIR), "pair_id").collect()}

    def text(*turns):
        return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)

    def spans(row, side):
        return [row[side][s["start"] : s["end"]] for s in row[f"{side}_spans"]]

    one = found[1]
    assert (one["n_prompt_turns"], one["prompt"]) == (3, text(a, b, a))
    assert (one["chosen"], one["rejected"]) == (text(b), text(c))
    assert spans(one, "chosen") == ["yo<|im_end|>\n"] and spans(one, "rejected") == ["no way<|im_end|>\n"]
    assert (found[2]["n_prompt_turns"], found[2]["chosen"], found[2]["chosen_spans"]) == (2, "", [])
    assert (found[3]["chosen"], spans(found[3], "rejected")) == ("", ["no way<|im_end|>\n"] * 2)
    assert (found[4]["prompt"], found[4]["chosen"], found[4]["rejected"]) == ("", "", text(a, c))
    assert found[5]["n_prompt_turns"] == 1 and found[5]["prompt"] == text(("", ""))
    assert found[None]["n_prompt_turns"] == 0
    df = chat.format_preferences(frame(rows, PAIR), "pair_id")
    assert not re.search("Python|Arrow|Pandas", plan(df))
    assert chat.format_preferences(frame([], PAIR), "pair_id").count() == 0


def test_pairs_of_a_table(frame):
    turns = [(2, 1, "assistant", "x"), (2, 0, "user", "q"), (2, 2, "user", "more"), (3, 0, "user", "r"), (3, 1, "assistant", None), (4, 0, "user", "lonely"), (5, 0, "assistant", "z"), (None, 0, "assistant", "n")]
    table = frame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, turns string")
    found = {r["conv_id"]: (r["chosen"], r["rejected"]) for r in chat.reply_pairs(table).collect()}
    assert {k: ([tuple(t) for t in c], [tuple(t) for t in r]) for k, (c, r) in found.items()} == {
        2: ([("user", "q"), ("assistant", "x")], [("user", "q"), ("assistant", "")]),
        3: ([("user", "r"), ("assistant", "")], [("user", "r"), ("assistant", "x")]),
    }
    assert chat.reply_pairs(table.limit(0)).count() == 0


def statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = list(zip(words, words[1:], words[2:]))
    counts, covered = Counter(grams), set()
    for k, gram in enumerate(grams):
        if counts[gram] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_statistics(frame, documents):
    odd = ["", None, " \x0b\f\r\n", "a b c a b c", "a a a a a", "x\n\nx\ny \n x", "é# 😀|<>", "b " * 60_000]
    docs = documents.select("doc_id", "text").unionByName(frame([(None, t) for t in odd] * 2, "doc_id long, text string")).withColumn("n_words", F.lit("clash"))
    for row in quality.with_statistics(docs).select("text", *quality.STATISTICS).collect():
        assert tuple(row)[1:] == statistics(row["text"])


def test_order_never_changes_the_verdict(frame, documents):
    rules = quality.default_rules()
    judged = [quality.held(quality.with_statistics(documents), base_failed=quality.base_failed()).select("doc_id", quality.rejected_by(r).isNull().alias("kept")) for r in (rules, rules[::-1])]
    assert judged[0].exceptAll(judged[1]).count() == 0
    measured = {r.name: (1.0 + k, 0.1 * (k % 3)) for k, r in enumerate(rules)}
    order = [measured[r.name][1] / measured[r.name][0] for r in quality.ordered(rules, measured)]
    assert order == sorted(order, reverse=True)
    found = quality.judge(documents)
    assert not re.search("Python|Arrow|Pandas", plan(found))
    assert found.filter("base_failed AND kept").count() == 0
    assert quality.judge(frame([], "doc_id long, text string")).count() == 0


def test_clean_texts_stay_and_junk_goes(documents):
    found = quality.judge(documents).join(documents.sparkSession.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    kept = {(r["quality"], r["kept"]): r["count"] for r in found.filter("NOT base_failed").groupBy("quality", "kept").count().collect()}
    assert kept.get((1, False), 0) <= 0.01 * kept[1, True]
    assert kept.get((0, True), 0) <= 0.05 * kept.get((0, False), 1)
