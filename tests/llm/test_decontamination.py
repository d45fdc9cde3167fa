"""Edit matching against dynamic programming."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from docstream.llm import decontamination as D
from docstream.llm.words import blocks


def edit_row(pattern, text):
    """Least distance of the pattern with a run of text that ends at each place."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        old, row = row, [i] + [0] * len(text)
        for j, b in enumerate(text, 1):
            row[j] = min(old[j - 1] + (a != b), old[j] + 1, row[j - 1] + 1)
    return row


def test_myers():
    rng = random.Random(5)
    for _ in range(2000):
        pattern = [rng.randrange(4) for _ in range(rng.randint(1, 80 if _ % 50 == 0 else 10))]
        text = [rng.randrange(4) for _ in range(rng.randint(1, 25))]
        row = edit_row(pattern, text)[1:]
        budget = rng.randrange(6)
        best = min(row)
        assert D.myers(pattern, text, budget) == ((best, row.index(best) + 1) if best <= budget else None)


@pytest.mark.parametrize("n,budget", [(1, 20), (4, 20), (5, 20), (59, 20), (7, 0), (10, 100)])
def test_pieces(n, budget):
    pieces = D.pieces_of(n, budget)
    assert len(pieces) == n * budget // 100 + 1 or n == len(pieces)
    assert [p[0] for p in pieces] == [sum(x[1] for x in pieces[:k]) for k in range(len(pieces))]
    assert sum(p[1] for p in pieces) == n


def words(text):
    return [w.lower() for w in re.findall(r"[a-z0-9é]+", (text or "").lower())]


def test_against_brute_force(frame):
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(60)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([1, 3, 5, 12, 25])))) for k in range(12)] + [(90, None), (91, "  ,. "), (92, "same words here"), (93, "Same, WORDS here")]
    docs = []
    for k in range(150):
        text = [word() for _ in range(rng.randrange(60))]
        if rng.random() < 0.6:
            leak = words(rng.choice(items[:12])[1])
            for _ in range(rng.randrange(5)):
                at = rng.randrange(len(leak) + 1)
                leak[at : at + rng.randrange(2)] = [word()] * rng.randrange(2)
            text[len(text) // 2 : len(text) // 2] = leak
        docs.append((k, ", ".join(text), "clash"))
    docs += [(200, None, None), (201, "", None), (None, "x same words here", None), (202, "same words here " * 30_000, None)]
    table = frame(docs, "doc_id long, text string, item_id string").repartition(3)
    benchmark = frame(items, "item_id long, text string")
    found = D.find_items(table, benchmark).collect()
    assert len(found) == len(docs)
    for row in found:
        if row["doc_id"] == 202:
            assert {m["item_id"] for m in row["matches"]} >= {92, 93}
            continue
        text, expected = words(row["text"]), {}
        for key, item in items:
            own = words(item)
            if own and text:
                best = min(edit_row(own, text)[1:])
                if best <= len(own) * 20 // 100:
                    expected[key] = best
        got = {}
        for m in row["matches"]:
            got[m["item_id"]] = min(got.get(m["item_id"], 99), m["distance"])
            item = words(dict(items)[m["item_id"]])
            assert edit_row(item, text[m["start"] : m["end"]])[-1] == m["distance"]
        assert got == expected, row
    clean = D.decontaminate(table, benchmark)
    assert clean.columns == table.columns
    assert clean.count() == sum(not r["matches"] for r in found)


def test_blocks_of_items_and_empty_tables(frame, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_WORDS", 4)
    items = frame([(k, f"alpha beta gamma {k}") for k in range(5)], "item_id long, text string")
    docs = frame([(1, "x alpha beta gamma 3 y"), (2, "alpha beta")], "doc_id long, text string")
    found = {r["doc_id"]: [m["item_id"] for m in r["matches"]] for r in D.find_items(docs, items, budget=0).collect()}
    assert found == {1: [3], 2: []}
    assert D.find_items(docs.limit(0), items).count() == 0
    assert D.find_items(docs, items.limit(0)).filter(D.contaminated()).count() == 0


def test_hits_do_not_cross_texts():
    ((_, _, found),) = blocks(pa.array(["one two", "three four"]), D.SEPARATORS)
    ((_, _, item),) = blocks(pa.array(["two three"]), D.SEPARATORS)
    assert not D.Items([(1, item.hash)], 0).search(found.hash, found.bounds)
    assert isinstance(item.hash, np.ndarray)
