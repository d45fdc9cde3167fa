"""Alignment against plain loops over the libraries' tokens."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from docstream.llm import alignment, queries
from docstream.llm.token_counts import byte_letters
from docstream.llm.tokenizing import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(both, text):
    """(id, bytes) of A and of B, or none."""
    a, b = both
    if not text:
        return [], []
    letters = byte_letters()
    got_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    got_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        got_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (got_a, got_b) if b"".join(x for _, x in got_a) == whole == b"".join(x for _, x in got_b) else ([], [])


def ends(got):
    found, at = [], 0
    for _, said in got:
        at += len(said)
        found.append(at)
    return found


def brute(both, rows):
    told, count = [], Counter()
    for key, text in rows:
        a, b = tokens(both, text)
        ends_a, ends_b = ends(a), ends(b)
        place = {e: k for k, e in enumerate(ends_b)}
        links = [(i, place[e]) for i, e in enumerate(ends_a) if e in place]
        groups, i, j = [], 0, 0
        for x, y in links:
            groups.append(",".join(str(n) for n, _ in a[i : x + 1]) + "|" + ",".join(str(n) for n, _ in b[j : y + 1]))
            i, j = x + 1, y + 1
        pairs = [(a[x][0], b[y][0]) for x, y in links]
        count.update(pairs)
        told.append((key, len(a), len(b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(key, n_a, n_b, n, len(p), sum(count[x] == most[x[1]] for x in p), sum(count[x] for x in p), digest) for key, n_a, n_b, n, p, digest in told]


def check(both, found, rows):
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(brute(both, rows), key=repr)
    assert found.columns == ["doc_id", *alignment.NAMES[1:]]


@pytest.mark.parametrize("n,m", [(0, 0), (1, 1), (5, 900), (700, 700), (3000, 10), (1, 5000), (2000, 2500)])
def test_gallop_and_overlaps(n, m):
    rng = np.random.default_rng(n + m)
    last = 6000
    one, two = (np.sort(np.append(rng.choice(last - 1, max(0, k - 1), replace=False) + 1, [last] * (k > 0))) for k in (n, m))
    assert alignment.gallop(one, two).tolist() == np.searchsorted(two, one).tolist()
    for x, y in ((one, two), (two, one)):
        found = alignment.align(x, y)
        assert x[found.a].tolist() == y[found.b].tolist() == sorted(set(x.tolist()) & set(y.tolist()))
        begin = np.append(0, x[:-1]) if len(x) else x
        begin_y = np.append(0, y[:-1]) if len(y) else y
        for k in range(len(x)):
            over = np.flatnonzero((begin_y < x[k]) & (y > begin[k]))
            assert (found.first[k], found.last[k]) == (over[0], over[-1])


ODD = [
    (1, None), (2, ""), (3, " "), (4, "▁ not given back"), (5, "<|endoftext|> <s> </s> <unk> <0x41>"), (6, "naïve 漢字 🙂 \x00\t\n  two  blanks "),
    (None, "null key"), (7, "the same text"), (7, "the same text"), (8, "word " * 30_000), (9, "x" * 20_000), (10, " é́"),
]


def test_rows(spark, frame, both, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_LINKS", 50)
    df = frame(ODD, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS chunk", "'x' AS n_a")
    check(both, alignment.linked(df, A, B), ODD)
    assert alignment.linked(df.limit(0), A, B).count() == 0
    check(both, alignment.linked(df.filter("doc_id < 3"), A, B), ODD[:2])


def test_alignments(spark, frame, both):
    found = alignment.alignments(frame(ODD, "doc_id long, text string"), A, B).collect()
    assert len(found) == len(ODD)
    texts = {k: t for k, t in ODD}
    for row in found:
        a, b = tokens(both, texts[row["doc_id"]])
        assert (row["a_ids"], row["b_ids"]) == ([i for i, _ in a], [i for i, _ in b])
        ends_a, ends_b = [0, *ends(a)], [0, *ends(b)]
        assert [ends_a[k] for k in row["a_ends"]] == [ends_b[k] for k in row["b_ends"]] == sorted(set(ends_a[1:]) & set(ends_b[1:]))
        if len(a) < 500:
            for k, (x, y) in enumerate(zip(row["first_b"], row["last_b"], strict=True)):
                over = [j for j in range(len(b)) if ends_b[j] < ends_a[k + 1] and ends_b[j + 1] > ends_a[k]]
                assert (x, y) == (over[0], over[-1])


def test_query(spark, both):
    sf_dir = "/root/testdata/sf0.001"
    check(both, queries.op11_alignment(spark, sf_dir), [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()])
