"""Licence notices against an edit distance over all runs of words."""

import random
import re

import pytest
from pyspark.sql import functions as F

from docstream.llm import licenses, queries
from docstream.llm.licenses import NOTICES, PHRASES, Finder, Notice, notice, phrase, pieces


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def least(words, said):
    """Fewest edits from any run of words to the notice, if within its budget and with its names."""
    found = [
        d
        for i in range(len(words))
        for j in range(i + 1, len(words) + 1)
        if abs(len(" ".join(words[i:j])) - len(said.text)) <= said.edits and set(said.names) <= set(words[i:j]) and (d := distance(" ".join(words[i:j]), said.text)) <= said.edits
    ]
    return min(found, default=None)


def damaged(rng, text, edits):
    letters = list(text)
    for _ in range(edits):
        k = rng.randrange(len(letters))
        what = rng.choice("put drop swap".split())
        if what == "put":
            letters.insert(k, rng.choice("abc"))
        elif what == "drop":
            del letters[k]
        else:
            letters[k] = rng.choice("xyz")
    return "".join(letters)


def test_pieces_cover_the_notice():
    for said in NOTICES + PHRASES:
        found = pieces(said)
        assert len(found) == said.edits + 1
        assert "".join(p for _, p in found) == said.text
        assert all(said.text[k : k + len(p)] == p and p for k, p in found)
        assert plain_words(said.text) == said.text.split(" ")


@pytest.mark.parametrize("said", NOTICES, ids=lambda n: f"{n.label}-{len(n.text)}")
def test_damaged_notices_against_brute_force(said):
    rng = random.Random(len(said.text))
    finder = Finder([said])
    for k in range(25):
        inside = damaged(rng, said.text, rng.randint(0, said.edits + 3))
        text = " ".join(["other words", inside, rng.choice(["", "and more", said.text[:20]])])
        n, found = finder.places(text)
        words = plain_words(text)
        assert n == len(words)
        best = least(words, said)
        # Without names the nearest run decides; with names the nearest run must hold them.
        if best is None or not said.names:
            assert min((p["edits"] for p in found), default=None) == best
        for p in found:
            assert distance(" ".join(words[p["first_word"] : p["last_word"] + 1]), said.text) == p["edits"] <= said.edits


def test_spans_point_into_the_text():
    text = "Ünï code…\n\nReleased   under the\tMIT  Licence!! (c) me"
    n, found = Finder(PHRASES + NOTICES).places(text)
    assert n == len(plain_words(text))
    assert [(p["label"], p["edits"], text[p["start"] : p["end"]]) for p in found] == [("mit", 1, "Released   under the\tMIT  Licence")]


def test_names_and_nearer_notices_decide():
    labels = lambda text: sorted({p["label"] for p in Finder(NOTICES).places(text)[1]})
    assert labels("Licensed under the BSD License.") == ["bsd"]
    assert labels("Licensed under the XYZ License.") == []
    assert labels("Licensed under CC BY-NC 4.0.") == ["cc-by-nc"]
    assert labels("Licenced under CC BY 4.0") == ["cc-by"]
    assert labels("modify it under the terms of the GNU Lesser General Public License") == ["lgpl"]
    assert labels("redistribute it and/or modify it under the terms of the GNU General Public License") == ["gpl"]
    assert labels("We met under the old tree and were granted a licence to sing.") == []


def test_phrases_count_every_place():
    finder = Finder([phrase("x", "a b a"), notice("y", "seven words that say one thing twice")])
    assert [p["first_word"] for p in finder.places("a b a b a")[1]] == [0, 2]
    assert finder.places("a bb a b ab a")[1] == []
    twice = "seven words that say one thing twice " * 50
    assert [p["first_word"] for p in finder.places(twice)[1]] == [7 * k for k in range(50)]


def test_rows(spark, frame):
    long = "word " * 50_000 + "MIT License " + "x" * 100_000
    df = frame([(1, None), (2, ""), (3, "..."), (None, "mit license"), (4, long), (5, "mit license"), (5, "mit license")], "doc_id long, text string")
    df = df.withColumn("key", F.lit(1)).withColumn("places", F.lit(1)).withColumn("n_words", F.lit(1))
    found = sorted([(r[0], r[1], [p["first_word"] for p in r[2]]) for r in licenses.scan(df).collect()], key=repr)
    assert found == sorted([(1, 0, []), (2, 0, []), (3, 0, []), (None, 2, [0]), (4, 50_003, [50_000]), (5, 2, [0]), (5, 2, [0])], key=repr)
    assert licenses.scan(df.limit(0)).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = {r["doc_id"]: r for r in queries.op13_licenses(spark, sf_dir).collect()}
    docs = queries.table(spark, sf_dir, "documents").collect()
    assert len(found) == len(docs)
    for doc in docs:
        words = plain_words(doc["text"])
        places = [(k, n.label) for n in PHRASES for k in range(len(words)) if words[k : k + len(n.text.split())] == n.text.split()]
        row = found[doc["doc_id"]]
        starts = [k for k, _ in places]
        base = sorted({label for _, label in places})
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"]) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(base)
        mine = row["labels"].split(",") if row["labels"] else []
        assert set(base) <= set(mine) and mine == sorted(set(mine))
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == bool(mine)
