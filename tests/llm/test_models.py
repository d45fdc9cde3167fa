"""Language-model scores against exact counts; toxicity on held-out rows."""

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docstream.llm import lm, toxicity
from docstream.llm.queries import fold

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


@pytest.mark.parametrize("head", [1 << 18, 50])
def test_base_scores_are_exact(frame, documents, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD_WORDS", head)
    odd = frame([(None, "odd words Only"), (5_000_001, None), (5_000_002, ""), (5_000_003, "The unseenword"), (5_000_003, "The unseenword")], "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(odd).withColumn("score", F.lit("clash"))
    found = lm.score(docs, fold(7) == 2).collect()
    rows = docs.collect()
    counts = Counter()
    held = lambda key: key is not None and zlib.crc32(str(key).encode()) % 7 == 2
    for row in rows:
        if not held(row["doc_id"]):
            counts.update(tokens(row["text"]))
    total = sum(counts.values())
    size = math.log10(total + len(counts) + 1)
    expected = sorted(((r["doc_id"], held(r["doc_id"]), len(t := tokens(r["text"])), sum(counts[w] > 0 for w in t), round(sum(math.log10(counts[w] + 1) - size for w in t), 6)) for r in rows), key=repr)
    assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in found), key=repr) == expected
    assert {r["train_tokens"] for r in found} == {total}
    held_out = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held_out) > sum(r["base_score"] for r in held_out)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)


def test_filter_never_undercounts(frame):
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    counts = np.floor(1 / rng.random(5000)).astype(np.int64)
    held = lm.CountFilter(8, 0, {1: 1, 2: 2})
    held.part_bits = 64 * (-(-int(lm.level(counts).sum()) * lm.ENTRY_BITS // 256 // 64) + 1)
    held.parts = np.zeros(256 * held.part_bits // 8, np.uint8)
    rows = held.parts.reshape(256, -1)
    for bucket in range(256):
        own = (hashes >> np.uint64(56)) == bucket
        rows[bucket] = held.part(1, hashes[own], counts[own])
    found = held.levels(1, hashes)
    assert (found >= lm.level(counts)).all() and (found == lm.level(counts)).mean() > 0.97
    other = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    assert (held.levels(1, other) > 0).mean() < 0.03
    assert lm.typical(np.array([0, 1, 2, 3])).tolist() == [0, 1, 2.5, 5.5]


def test_frequent_words_are_whole_bins(frame, monkeypatch):
    words = frame([(k, 1 + 4000 // (k + 1)) for k in range(500)] + [(900 + k, 10**7) for k in range(3)], "word long, c long")
    monkeypatch.setattr(lm, "HEAD_WORDS", 60)
    head = lm.frequent_words(words).collect()
    assert 40 < len(head) <= 60 and min(r["c"] for r in head) > max(r["c"] for r in words.collect() if r not in head)
    monkeypatch.setattr(lm, "HEAD_WORDS", 2)
    assert lm.frequent_words(words).count() == 0
    assert lm.frequent_words(words.limit(0)).count() == 0


def test_empty_tables(spark, frame, documents):
    docs = documents.select("doc_id", "text")
    none = lm.score(docs.limit(0), F.lit(False))
    assert none.count() == 0
    untrained = lm.score(docs.limit(3), F.lit(True)).collect()
    assert [r["train_tokens"] for r in untrained] == [0, 0, 0] and all(r["n_known"] == 0 for r in untrained)


def test_no_pair_is_left_out_for_size(frame, documents, monkeypatch):
    """Scores don't change with the number of chunks."""
    docs = documents.select("doc_id", "text").limit(100).unionByName(frame([(7_000_000 + k, "one two " * 40) for k in range(8)], "doc_id long, text string"))
    scores = lambda: {r["doc_id"]: round(r["score"], 9) for r in lm.score(docs, F.lit(False)).collect()}
    whole = scores()
    monkeypatch.setattr(lm, "CHUNK_BYTES", 1 << 12)
    assert scores() == whole


def test_scores_are_the_same_for_any_number_of_blocks(documents):
    docs = documents.select("doc_id", "text").limit(60)
    chunks = lm.chunked(docs.selectExpr("doc_id AS key", "false AS held_out", "text"))
    bits = lm.hash_bits(chunks)
    counts = lm.count_grams(chunks, bits)
    assert lm.buckets_a_block(counts, bits, lm.BLOCK_BYTES) == 1 << bits
    small = sum(r[1] for r in counts.groupBy("n").agg(F.max(F.length("part"))).collect()) * (1 << bits) // 20
    assert (1 << bits) // lm.buckets_a_block(counts, bits, small) >= 15
    with pytest.raises(ValueError, match="more shuffle partitions"):
        lm.buckets_a_block(counts, bits, 8)
    scores = lambda **bound: sorted(lm.score(docs, fold(7) == 2, **bound).collect())
    assert scores(block_bytes=small) == scores()


def test_scores_from_exact_counts(documents):
    """The model's score, worked out by hand from exact counts, up to the filter's rare errors."""
    docs = documents.select("doc_id", "text").limit(150)
    rows = {r["doc_id"]: tokens(r["text"]) for r in docs.collect()}
    trained = [t for key, t in rows.items() if zlib.crc32(str(key).encode()) % 7 != 2]
    words, pairs = Counter(), Counter()
    for text in trained:
        words.update(text)
        pairs.update(zip([None, *text], text))
    size = sum(words.values()) + len(words) + 1
    lev = lambda c: int(math.log2(c)) + 1 if c else 0
    mid = lambda c: 1.5 * 2 ** (lev(c) - 1) - 0.5 if c else 0.0

    def parts(text, out):
        for before, word in zip([None, *text], text):
            around, both, single = mid(words[before]) - out, max(mid(pairs[before, word]) - out, 0), max(mid(words[word]) - out, 0)
            yield lev(words[before]), min(both / max(around, 1), 1) if around > 0 else 0, (single + 1) / size

    told, seen = Counter(), Counter()
    for text in trained:
        for at, share, single in parts(text, 1):
            told[at] += 0.2 * share / (0.2 * share + 0.8 * single)
            seen[at] += 1
    weight = {at: (told[at] + 0.01) / (seen[at] + 1) for at in range(lm.LEVELS)}
    found = {r["doc_id"]: r["score"] for r in lm.score(docs, fold(7) == 2).collect()}
    off = {key: found[key] - sum(math.log10(weight[at] * share + (1 - weight[at]) * single) for at, share, single in parts(text, 0)) for key, text in rows.items()}
    n_tokens = sum(map(len, rows.values()))
    # A probe errs for about one n-gram in a hundred, which moves a token by a few orders: rare, so short texts are mostly exact.
    assert len(found) == len(rows) and sum(map(abs, off.values())) < 0.02 * n_tokens
    assert all(abs(off[key]) < 6 * (2 + 0.03 * len(text)) for key, text in rows.items())


def test_pairs_seen_once_are_in_the_model(frame):
    """A passage that occurs once in training scores above the same words in another order."""
    trained = [(k, " ".join(f"w{(k * 7 + j * (k % 5 + 1)) % 50}" for j in range(50))) for k in range(20)]
    passage = trained[3][1].split()
    docs = frame([*trained, (100, " ".join(passage)), (101, " ".join(passage[::-1]))], "doc_id long, text string")
    chunks = lm.chunked(docs.filter("doc_id < 20").selectExpr("doc_id AS key", "false AS held_out", "text"))
    bits = lm.hash_bits(chunks)
    grams = lm.read_levels(chunks, lm.count_grams(chunks, bits), bits)
    once = [np.frombuffer(r["levels"], np.uint8) for r in grams.filter("n = 2").collect()]
    assert (np.concatenate(once) >= 1).all() and (np.concatenate(once) == 1).any()
    found = {r["doc_id"]: r["score"] for r in lm.score(docs, F.col("doc_id") >= 100).collect()}
    assert found[100] > found[101]


def leveled(rng, lengths, top=lm.LEVELS):
    """Rows of word and pair levels; as the table of scores has them."""
    return pa.record_batch([pa.array([rng.integers(0, top, n, dtype=np.uint8).tobytes() for n in lengths], pa.binary()) for _ in range(2)], names=["word_levels", "pair_levels"])


def test_tokens_by_their_triples_of_levels(monkeypatch):
    """Scores and the expectation step, token by token from the formula; texts of one token, and a text longer than what is looked at at once."""
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 50)
    rng = np.random.default_rng(2)
    batches = [leveled(rng, [1, 7, 200, 1, 30]), leveled(rng, [3, 1], 3)]
    model = lm.Model(10**6, 10**5)
    model.weights = rng.random(lm.LEVELS) * 0.9 + 0.05
    mid = lm.typical(np.arange(lm.LEVELS)).tolist()
    scores, told, seen = [], np.zeros(lm.LEVELS), np.zeros(lm.LEVELS)
    for batch in batches:
        for words, pairs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            score = 0.0
            for around, word, both in zip([words[-1], *words], words, pairs):
                weight = model.weights[around]
                share = min(mid[both] / max(mid[around], 1), 1) if mid[around] > 0 else 0
                score += math.log10(weight * share + (1 - weight) * (mid[word] + 1) / model.size)
                share = min(max(mid[both] - 1, 0) / max(mid[around] - 1, 1), 1) if mid[around] > 1 else 0
                told[around] += weight * share / (weight * share + (1 - weight) * (max(mid[word] - 1, 0) + 1) / model.size)
                seen[around] += 1
            scores.append(score)
    found = [x for _, part in lm.text_scores(iter(batches), model) for x in part.to_pylist()]
    assert found == pytest.approx(scores, rel=1e-12)
    counts = lm.level_counts(iter(batches))
    assert counts.reshape(lm.LEVELS, -1).sum(axis=1).tolist() == seen.tolist()
    assert (counts * model.explained()).reshape(lm.LEVELS, -1).sum(axis=1) == pytest.approx(told, rel=1e-12)


def test_a_worker_holds_little_for_a_token():
    """Four million tokens in one batch, in texts of usual length or in one: what a task needs beside them."""
    rng = np.random.default_rng(4)
    for lengths, most in (([1000] * 4000, 40e6), ([4_000_000], 100e6)):
        batch = leveled(rng, lengths)
        for work in (lm.level_counts, lambda batches: list(lm.text_scores(batches, lm.Model(10**6, 10**5)))):
            tracemalloc.start()
            work(iter([batch]))
            peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            assert peak < most


def test_distinct_grams_of_a_chunk():
    """Words and pairs of a chunk as a plain count has them; their levels come back to each token; memory of a few copies."""
    rng = np.random.default_rng(5)
    texts = pa.array([None, "", *(" ".join(f"w{x}" for x in rng.zipf(1.3, 2000) % 9000) for _ in range(500))])
    cut = list(lm.grams_of(texts))
    assert len(cut) > 2
    for n, hashes, counts in lm.distinct_grams(texts):
        expected, place, times = np.unique(np.concatenate([x[n + 1] for x in cut]), return_inverse=True, return_counts=True)
        assert np.array_equal(hashes, expected) and np.array_equal(counts, times)
        assert np.array_equal(np.concatenate(list(lm.ranks([x[n + 1] for x in cut], hashes))), place)
    assert list(lm.distinct_grams(texts[:0])) == []
    blocks = [x[3] for x in cut]
    tracemalloc.start()
    for _ in lm.ranks(blocks, lm.distinct(np.concatenate(blocks))[0]):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * sum(x.nbytes for x in blocks)


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    machine = toxicity.train(docs.filter(fold(3) != 1).join(labels, "doc_id"))
    found = toxicity.score(docs, machine).join(labels, "doc_id").filter(fold(3) == 1).select("toxic", "score").toPandas()
    toxic, clean = found[found.toxic == 1].score.to_numpy(), found[found.toxic == 0].score.to_numpy()
    assert (toxic[:, None] > clean[None, :]).mean() > 0.96
    assert (clean >= 0.7).mean() < 0.01 and (toxic >= 0.7).mean() > 0.7


def test_pairs_of_terms_are_learnt():
    """A label that only the meeting of two terms tells."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for k in range(3000):
        a, b = rng.random(2) < 0.5
        rows.append(np.array(sorted([1] * int(a) + [2] * int(b) + [10 + int(rng.integers(5))])))
        labels.append(float(a and b))
    machine = toxicity.fit(rows, np.array(labels))
    where = np.repeat(np.arange(3000), [len(r) for r in rows])
    found = machine.sums(where, np.concatenate(rows), 3000) > 0
    assert (found == (np.array(labels) == 1)).mean() > 0.97
    assert np.abs(machine.factors).max() > 0.05


def meetings():
    """Texts with words for a group (toxic as often as any other text), an insult (toxic only beside the group) and a slur."""
    rng = np.random.default_rng(1)
    order = rng.permutation(4000)
    group, insult, toxic = (np.zeros(4000, bool) for _ in range(3))
    group[order[:30]] = insult[order[:30]] = toxic[order[:30]] = True
    insult[order[30:100]] = True
    group[order[100:1270]] = True
    toxic[order[100:200]] = toxic[order[1270:1572]] = True
    texts = []
    for k in range(4000):
        words = [f"w{x}" for x in rng.integers(0, 3000, 60)]
        words += ["groupname"] * int(group[k]) + ["insulting"] * int(insult[k]) + ["slurred"] * int(toxic[k] and not insult[k])
        texts.append(" ".join(rng.permutation(words)))
    assert abs(toxic[group].mean() - toxic.mean()) < 0.002
    return texts, toxic.astype(int)


def test_a_pair_of_neutral_words_is_toxic(frame):
    """Neither the group nor the insult tells a toxic text; both together do. Sums over all pairs equal the scores."""
    texts, toxic = meetings()
    docs = frame([(k, x, int(y)) for k, (x, y) in enumerate(zip(texts, toxic, strict=True))], "doc_id long, text string, toxic int")
    machine = toxicity.train(docs)
    probes = ["the groupname here", "an insulting word", "groupname and insulting", "slurred", "plain", "", texts[3]]
    found = [r["score"] for r in toxicity.score(frame(list(enumerate(probes)), "doc_id long, text string"), machine).orderBy("doc_id").collect()]
    alone, insult, both, slur, plain = found[:5]
    assert both > 0.7 and slur > 0.7 and max(alone, insult, plain) < 0.7
    for value, terms in zip(found, toxicity.terms_of(pa.array(probes)), strict=True):
        pairs = sum(float(machine.factors[a] @ machine.factors[b]) for k, a in enumerate(terms) for b in terms[k + 1 :])
        total = machine.bias + float(machine.weights[terms].sum()) + pairs
        assert value == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)


def test_sample_is_the_same_in_any_order(frame):
    """Bounds of rows and of terms hold, and partitions in another order give the same machine."""
    docs = frame([(k, f"common {'bad' if k % 3 == 0 else 'good'} " + " ".join(f"x{k}y{j}" for j in range(k % 40)), int(k % 3 == 0)) for k in range(600)], "doc_id long, text string, toxic int")
    docs = docs.unionByName(frame([(9999, "copy of a row", 0)] * 300, "doc_id long, text string, toxic int"))
    for bounds in ((200, 10**6), (10**6, 4000)):
        one = toxicity.train(docs.repartition(3), sample_rows=bounds[0], sample_terms=bounds[1])
        other = toxicity.train(docs.orderBy("toxic", F.desc("doc_id")), sample_rows=bounds[0], sample_terms=bounds[1])
        assert one.told().any() and np.array_equal(one.weights, other.weights) and np.array_equal(one.factors, other.factors)
    known = docs.selectExpr("pmod(xxhash64(doc_id), 1073741824) AS place", "CAST(length(text) AS double) AS n_terms").cache()
    for bounds in ((200, 10**6), (10**6, 4000)):
        rows, terms = toxicity.sampled(known, *bounds).selectExpr("count(*)", "sum(n_terms)").first()
        assert 0 < rows <= bounds[0] and terms <= bounds[1]


def test_odd_rows_and_few_labels(frame):
    docs = frame([(1, "an idiot", 1, "x"), (None, None, 0, None), (2, "", None, None), (3, "w " * 50_000, 0, None)], "doc_id long, text string, toxic int, score string")
    machine = toxicity.train(docs)
    found = toxicity.score(docs, machine).collect()
    assert len(found) == 4 and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.score(docs, toxicity.train(docs.limit(0))).filter("score > 1e-6").count() == 0
    assert toxicity.score(docs.limit(0), machine).count() == 0
