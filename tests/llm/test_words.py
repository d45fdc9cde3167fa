"""Hashed words against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from docstream.llm.words import PUNCTUATION, SPACES, blocks, shingles

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
TEXT = st.text(st.sampled_from("ab AB\n\t\x0b.é😀-"), max_size=40)


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(LOWER))


@settings(deadline=None, max_examples=60)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_and_shingles(texts):
    known, seen = {}, {}
    for first, last, found in blocks(pa.array(texts, pa.string())):
        grams, bounds = shingles(found, 3)
        for k in range(first, last):
            own = found.hash[found.bounds[k - first] : found.bounds[k - first + 1]].tolist()
            expected = words(texts[k])
            assert len(own) == len(expected)
            for value, word in zip(own, expected):
                assert known.setdefault(word, value) == value
            want = [tuple(expected[i : i + 3]) for i in range(len(expected) - 2)] or ([tuple(expected)] if expected else [])
            got = grams[bounds[k - first] : bounds[k - first + 1]].tolist()
            assert len(got) == len(want)
            for value, gram in zip(got, want):
                assert seen.setdefault(gram, value) == value
    assert len(set(known.values())) == len(known) and len(set(seen.values())) == len(seen)


def test_punctuation_and_heads():
    ((_, _, found),) = blocks(pa.array(["Idiot, idiotic!", None]), SPACES + PUNCTUATION)
    assert found.bounds.tolist() == [0, 2, 2]
    heads = found.heads(5)
    assert heads[0] == heads[1] == found.hash[0] != found.hash[1]


def test_many_blocks_and_long_texts(monkeypatch):
    from docstream.llm import words as module

    texts = ["a b c", "d " * 5000, "", "a b c"] * 3
    whole = [f.hash[f.bounds[k] : f.bounds[k + 1]] for _, _, f in blocks(pa.array(texts)) for k in range(len(f.bounds) - 1)]
    monkeypatch.setattr(module, "BLOCK_BYTES", 16)
    parts = [f.hash[f.bounds[k] : f.bounds[k + 1]] for _, _, f in blocks(pa.array(texts)) for k in range(len(f.bounds) - 1)]
    assert len(parts) == len(texts) and all(np.array_equal(a, b) for a, b in zip(whole, parts))
    assert list(blocks(pa.array([], pa.string()))) == []
