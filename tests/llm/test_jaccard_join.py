"""Components of similar texts against brute force, and what the method promises."""

import random
import re

import pytest

from docstream.llm.components import components
from docstream.llm import jaccard_join as J

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, size, percent):
    """component by (key, text), by comparing all pairs."""
    sets = {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        own = frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)] if words else [])
        sets[key, text] = own
    group = {k: {k} for k in sets}
    items = list(sets.items())
    for i, (a, sa) in enumerate(items):
        for b, sb in items[:i]:
            if sa and sb and 100 * len(sa & sb) >= percent * len(sa | sb) and group[a] is not group[b]:
                group[a] |= group[b]
                for k in group[b]:
                    group[k] = group[a]
    return {k: (len(sets[k]), min(x[0] for x in group[k])) for k in sets}


def corpus(seed, n):
    """Originals, copies, chains of edits, shared passages, a hot group of near copies, short texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(40)]
    texts = []
    hot = [word() for _ in range(60)]
    for _ in range(n):
        kind = rng.random()
        if kind < 0.3 and texts:
            words = rng.choice(texts).split()
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                if words:
                    words[rng.randrange(len(words))] = word()
            texts.append(" ".join(words))
        elif kind < 0.6:
            words = list(hot)
            for _ in range(rng.randrange(5)):
                words[rng.randrange(len(words))] = word()
            texts.append(" ".join(words))
        elif kind < 0.75:
            texts.append(" ".join([*passage, *[word() for _ in range(rng.randrange(30))]]))
        else:
            texts.append(" ".join(word() for _ in range(rng.choice([0, 1, 3, 4, 6, 30, 80]))))
    return [*enumerate(texts), (n, None), (n + 1, ""), (n + 2, "Word"), (n + 3, "wORD")]


@pytest.mark.parametrize("seed,size,percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_against_brute_force(frame, monkeypatch, seed, size, percent):
    monkeypatch.setattr(J, "GROUP", 16)
    monkeypatch.setattr(J, "ASKERS", 8)
    monkeypatch.setattr(J, "CHUNK", 2000)
    rows = corpus(seed, 260)
    docs = frame([(k, t, "x", 5) for k, t in rows], "doc_id long, text string, cls string, n int").repartition(3)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(docs, size, percent).collect()}
    expected = {k[0]: v for k, v in brute(rows, size, percent).items()}
    assert found == expected
    assert len({c for _, c in expected.values()}) < len(rows) - 50


def test_repeated_rows_null_keys_and_one_of_each(frame):
    long_ = " ".join(f"a{k}" for k in range(60))
    rows = [(5, long_), (5, long_), (9, long_ + " b"), (None, long_ + " b"), (None, "alone here"), (5, "other text of this key"), (7, None)]
    docs = frame([(k, t, "s") for k, t in rows], "doc_id long, text string, root string")
    found = sorted(((r[0], r[1], r[2]) for r in J.jaccard_components(docs).collect()), key=repr)
    assert found == sorted([(5, 56, 5), (5, 56, 5), (9, 57, 5), (None, 57, 5), (None, 1, None), (5, 1, 5), (7, 0, 7)], key=repr)
    kept = J.one_of_each(docs)
    assert kept.columns == docs.columns
    # Equal keys are told apart by their texts.
    expected = [(5, long_), (5, "other text of this key"), (7, None), (None, "alone here")]
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=repr) == sorted(expected, key=repr)


def test_empty_table(frame):
    docs = frame([], "doc_id long, text string")
    assert J.jaccard_components(docs).count() == 0 and J.one_of_each(docs).count() == 0


def test_components(frame):
    rng = random.Random(4)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)] + [(None, 1), (7, 7)]
    found = dict(components(frame(pairs, "a long, b long")).collect())
    group = {k: {k} for p in pairs for k in p if k is not None}
    for a, b in pairs:
        if a is not None and group[a] is not group[b]:
            merged = group[a] | group[b]
            for k in merged:
                group[k] = merged
    assert found == {k: min(g) for k, g in group.items() if k != min(g)}
