"""Packing and token counts against the library and brute force."""

import itertools
import random
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from docstream.llm import packing, token_counts
from docstream.llm.tokenizing import Memory, load, tokenizer_file, tokenizer_path

ODD = ["", "  a", " \n a\tb  ", "don't  WON'T\n\n x", "a   b  c", "<|endoftext|> x<|endoftext|>", "<|ENDOFTEXT|> A", "\x1c a", "é́a ñ  ", "١٢ ۳", "日本語 テスト", "   x", "a\r\n\r\nb", "   ", "😀😀 !!!'s 're", "x" * 5000, "Σας ΟΔΟΣ. ΟΔΟΣ", "a.b, c., d.\n", " x 　 y"]
TEXT = st.text(st.sampled_from("aB é\n\t.,'<|>s1٣ \x1c日"), max_size=30)


def test_closest_fill():
    rng = random.Random(1)
    for _ in range(400):
        counts = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(4)}
        capacity = rng.randint(1, 30)
        got = packing.closest(counts, sorted(counts, reverse=True), capacity)
        assert all(n <= counts[length] for length, n in got.items())
        sums = (sum(a * n for a, n in zip(counts, taken)) for taken in itertools.product(*[range(n + 1) for n in counts.values()]))
        assert sum(a * n for a, n in got.items()) == max(x for x in sums if x <= capacity)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 100), max_size=60), st.sampled_from([1, 8, 32, 64]))
def test_windows(lengths, capacity):
    pieces = {k: [] for k in range(len(lengths))}
    short = 0
    for window in packing.windows(lengths, capacity):
        total = sum(length for _, _, length in window)
        assert total == capacity or total & (total - 1) == 0
        short += total < capacity
        for item, start, length in window:
            pieces[item].append((start, length))
    assert short <= capacity.bit_length()
    for item, found in pieces.items():
        ends = [0, *itertools.accumulate(length for _, length in sorted(found))]
        assert [s for s, _ in sorted(found)] == ends[:-1] and ends[-1] == lengths[item]


def test_packed_rows(frame, documents):
    path = tokenizer_path("word_bpe_49k.json")
    odd = frame([(None if k == 3 else 10_000 + k, t) for k, t in enumerate([*ODD, None, "same", "same"])], "doc_id long, text string")
    docs = documents.select("doc_id", "text").limit(150).unionByName(odd)
    found = packing.pack(docs, path, capacity=256, with_ids=True, pool_tokens=3000).collect()
    tokenizer = load(tokenizer_file(path))
    expected = sorted(((i, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in docs.collect()), key=repr)
    groups, sequences = {}, {}
    for row in found:
        ids = row["ids"]
        assert row["length"] == len(ids) and row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        sequences.setdefault(row["sequence_id"], []).append(row)
        groups.setdefault(row["doc_id"], []).append(row)
    for rows in sequences.values():
        rows.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rows] == [0, *itertools.accumulate(r["length"] for r in rows)][:-1]
        total = sum(r["length"] for r in rows)
        assert total == 256 or total < 256 and total & (total - 1) == 0
    whole = []
    for key, rows in groups.items():
        ids = [x for r in sorted(rows, key=lambda r: r["start"]) for x in r["ids"]]
        assert all(r["doc_tokens"] == len(ids) for r in rows)
        whole.append((key, ids))
    assert sorted(whole, key=repr) == expected
    assert packing.pack(docs.limit(0), path).count() == 0


@settings(deadline=None, max_examples=80)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_counts_and_ids_are_the_librarys(texts):
    words = tokenizer_file(tokenizer_path("word_bpe_49k.json"))
    ids = _ids.setdefault("ids", None) or _ids.update(ids=packing.Ids(words)) or _ids["ids"]
    counter = _ids.setdefault("counter", None) or _ids.update(counter=_counter()) or _ids["counter"]
    for own in (texts, ODD):
        whole = ids.tokenizer.encode_batch(own, add_special_tokens=False)
        assert ids.of([t.encode() for t in own], b"") == [np.array(x.ids, "<u4").tobytes() for x in whole]
        whole = counter.tokenizer.encode_batch(own, add_special_tokens=False)
        assert counter.count(own) == [len(x.ids) for x in whole]


_ids: dict = {}


def _counter():
    text = tokenizer_file(tokenizer_path("byte_bpe_50k.json"))
    return token_counts.Counter(text, token_counts.whole_tokens(text))


def test_whole_tokens_are_proven():
    text = tokenizer_file(tokenizer_path("byte_bpe_50k.json"))
    whole, tokenizer = token_counts.whole_tokens(text), load(text)
    assert " the" in whole and len(whole) <= tokenizer.get_vocab_size()
    assert all(len(tokenizer.encode(x, add_special_tokens=False).ids) == 1 for x in random.Random(0).sample(sorted(whole), 500))


def test_counted_rows(frame):
    docs = frame([(1, "a é", 5), (None, None, 5), (1, "a é", 5), (2, "", None)], "doc_id long, text string, n_tokens int")
    found = token_counts.count_tokens(docs, tokenizer_path("byte_bpe_50k.json"))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([(1, 4, 2), (1, 4, 2), (2, 0, 0), (None, 0, 0)], key=repr)
    assert token_counts.count_tokens(docs.limit(0), tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_memory_forgets_the_older_half():
    asked = []
    memory = Memory(lambda words: asked.extend(words) or [w * 2 for w in words], size=3)
    for start in range(0, 12, 2):
        words = set(range(start, start + 4))
        known = memory.ready(words)
        assert all(known[w] == 2 * w for w in words)
    assert len(memory.new) + len(memory.old) <= 10
