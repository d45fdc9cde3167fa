"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its distinct words and the beginnings of its words, hashed into 2**bits places. The score is
sigmoid(bias + sum of weights + sum over pairs of terms of the dot product of their factor vectors), so a pair such
as an insult and the mention of a group can weigh more, or less, than its parts. Every term of ``LEAST_TEXTS`` texts
is learnt, also one that by itself tells nothing. Weights and factor vectors that stay small are set to zero, each by a
soft threshold of its own (that of the factors after ``WARM`` epochs), so ordinary prose has little say in long texts.

Learning takes a sample of the labelled rows, bounded by ``SAMPLE_ROWS`` and ``SAMPLE_TERMS``: those whose hash lies in
a range, which is made narrower until both bounds hold. So it depends neither on the order of rows nor on where they
lie. Scoring is one pass over all rows and whole texts without a shuffle; the broadcast model has a fixed size.

A null or empty text has no terms and gets the score of the bias; repeated rows get equal scores; rows with a null
label aren't learnt from; without labelled rows of both kinds all scores are the share of toxic rows (0 without
any); an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstream.llm.dealing import saved
from docstream.llm.shipping import ship
from docstream.llm.words import PUNCTUATION, SPACES, Words, blocks

SEPARATORS = SPACES + PUNCTUATION
BITS, RANK = 20, 4
#: Bytes of the beginnings of words that are terms.
HEADS = (4, 5, 6)
#: Most labelled rows, and most terms of them, that are learnt from.
SAMPLE_ROWS, SAMPLE_TERMS = 20_000, 20_000_000
PARTS = 1 << 30
#: Hash ranges that the sample is made of.
RANGES = 1024
#: Terms in fewer sampled texts are not learnt.
LEAST_TEXTS = 5
#: Epochs: as many as make ``STEPS`` steps of ``BATCH`` rows, between both bounds; epochs before factors shrink.
BATCH, STEPS, EPOCHS, WARM = 256, 600, (12, 45), 2


def places(words: Words, bits: int = BITS) -> list[np.ndarray]:
    """Place of each word and of its beginnings, as arrays along the words."""
    shift = np.uint64(64 - bits)
    salt = np.uint64(0x9E3779B97F4A7C15)
    return [(words.hash >> shift).astype(np.int64)] + [((words.heads(n) * (salt + np.uint64(2 * n))) >> shift).astype(np.int64) for n in HEADS]


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def told(self) -> np.ndarray:
        """Which places have a weight or a factor vector."""
        return (self.weights != 0) | self.factors.any(axis=1)

    def scores(self, words: Words) -> np.ndarray:
        """Score of each text of a block."""
        n = len(words.bounds) - 1
        text = np.repeat(np.arange(n), np.diff(words.bounds))
        told, keys = self.told(), []
        for place in places(words):
            heavy = np.flatnonzero(told[place])
            keys.append(text[heavy] << BITS | place[heavy])
        keys = np.unique(np.concatenate(keys))
        return 1 / (1 + np.exp(-self.sums(keys >> BITS, keys & (1 << BITS) - 1, n)))

    def sums(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        total = self.bias + np.bincount(rows, self.weights[terms], n)
        for factor in self.factors.T:
            v = factor[terms]
            total += 0.5 * (np.bincount(rows, v, n) ** 2 - np.bincount(rows, v * v, n))
        return np.clip(total, -30, 30)


def terms_of(texts: pa.Array) -> list[np.ndarray]:
    """Distinct places of each text."""
    found = []
    for first, last, words in blocks(texts, SEPARATORS):
        own = places(words)
        for row in range(last - first):
            a, b = words.bounds[row], words.bounds[row + 1]
            found.append(np.unique(np.concatenate([p[a:b] for p in own])))
    return found


def fit(rows: list[np.ndarray], labels: np.ndarray, rate: float = 0.1, factor_rate: float = 0.05, threshold: float = 1.5e-3, shrinkage: float = 5e-3, most: float = 4.0, seed: int = 7) -> Machine:
    """A machine learnt from the distinct places of texts and their labels, by adaptive gradient steps."""
    size, rng = 1 << BITS, np.random.default_rng(seed)
    share = float(labels.mean()) if len(labels) else 0.0
    edge = lambda p: float(np.log(max(p, 1e-9) / max(1 - p, 1e-9)))
    whole = Machine(edge(share), np.zeros(size), np.zeros((size, RANK)))
    if not 0 < share < 1:
        return whole
    counts = np.zeros(size, np.int64)
    for r in rows:
        counts[r] += 1
    told = np.flatnonzero(counts >= LEAST_TEXTS)
    # Learnt terms are numbered without holes, so that steps need no search for the terms they touch.
    number = np.full(size, -1, np.int32)
    number[told] = np.arange(len(told))
    rows = [(own := number[r])[own >= 0] for r in rows]
    model = Machine(whole.bias, np.zeros(len(told)), rng.normal(0, 0.005, (len(told), RANK)))
    weight_steps, factor_steps, bias_steps = np.full(len(told), 1e-6), np.full((len(told), RANK), 1e-6), 1e-6
    # Both kinds count alike, so that the rare kind is learnt too.
    importance = np.where(labels == 1, min(0.5 / share, most), 1.0)
    epochs = min(max(STEPS * BATCH // len(rows), EPOCHS[0]), EPOCHS[1])
    # The mean of the last third of all epochs, as single steps still sway it at their end.
    settled, sums = epochs // 3, [0.0, 0.0, 0.0]
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            terms = np.concatenate([rows[k] for k in chosen])
            where = np.repeat(np.arange(len(chosen)), [len(rows[k]) for k in chosen])
            p = 1 / (1 + np.exp(-model.sums(where, terms, len(chosen))))
            slope = (p - labels[chosen]) * importance[chosen] / len(chosen)
            touched = np.bincount(terms, minlength=len(told)) > 0
            grad = np.bincount(terms, slope[where], len(told))
            weight_steps += grad * grad
            step = rate / np.sqrt(weight_steps)
            moved = model.weights - step * grad
            shrunk = np.sign(moved) * np.maximum(np.abs(moved) - threshold * step, 0)
            grads = np.empty_like(model.factors)
            for f, factor in enumerate(model.factors.T):
                v = factor[terms]
                grads[:, f] = np.bincount(terms, slope[where] * (np.bincount(where, v, len(chosen))[where] - v), len(told))
            factor_steps += grads * grads
            step = factor_rate / np.sqrt(factor_steps)
            moved = model.factors - step * grads
            if epoch >= WARM:
                norm = np.maximum(np.sqrt((moved * moved).sum(axis=1, keepdims=True)), 1e-12)
                moved *= np.maximum(1 - shrinkage * step.mean(axis=1, keepdims=True) / norm, 0)
            model.weights = np.where(touched, shrunk, model.weights)
            model.factors = np.where(touched[:, None], moved, model.factors)
            bias_steps += float(slope.sum()) ** 2
            model.bias -= rate * float(slope.sum()) / np.sqrt(bias_steps)
        if epoch >= epochs - settled:
            sums = [a + b / settled for a, b in zip(sums, (model.bias, model.weights, model.factors), strict=True)]
    whole.bias, whole.weights[told], whole.factors[told] = sums
    return whole


def sampled(rows: DataFrame, sample_rows: int, sample_terms: int) -> DataFrame:
    """Rows (place, n_terms) of consecutive hash ranges, as many as hold at most so many rows and terms.

    Ranges come in the order of their hashes; one that is over a bound by itself (rows of a key have equal hashes) is
    passed over. Null keys share one. The driver gets two numbers for each of ``RANGES`` ranges.
    """
    width = int(rows.agg(F.max("place")).first()[0] or 0) // RANGES + 1
    at = F.floor(F.col("place") / width)
    held = [0, 0]
    first = last = 0
    for r, n, terms in sorted(rows.groupBy(at.alias("range")).agg(F.count("*"), F.sum("n_terms")).collect()):
        if n > sample_rows or terms > sample_terms:
            if not held[0]:
                first = last = r + 1
                continue
            break
        if held[0] + n > sample_rows or held[1] + terms > sample_terms:
            break
        held, last = [held[0] + n, held[1] + terms], r + 1
    return rows.filter((at >= first) & (at < last))


def train(labelled: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS, sample_terms: int = SAMPLE_TERMS) -> Machine:
    """A machine learnt from at most ``sample_rows`` rows with a label 0 or 1, of at most ``sample_terms`` terms.

    Where there are more, those are taken whose hash of ``key`` lies in a range, a filter that also holds below a join
    by it; they are turned into
    terms where they lie, and only the terms of the sample come to the driver.
    """
    ship(labelled.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [t.astype(np.int32).tobytes() for t in terms_of(batch.column(0))]
            yield pa.record_batch([pa.array(terms, pa.binary()), batch.column(1), batch.column(2)], names=["terms", "label", "place"])

    rows = labelled.select(F.col(text).cast("string").alias("text"), F.col(label).cast("int").alias("label"), F.col(key).alias("key")).filter(F.col("label").isin(0, 1))
    rows = rows.select("text", "label", F.pmod(F.xxhash64("key"), F.lit(PARTS)).alias("place"))
    total = rows.select("label").count()
    # A little more than the share, as hashes don't fall evenly; the ranges then keep to the bounds.
    near = rows.filter(F.col("place") < int(min(PARTS, PARTS * 1.1 * sample_rows / max(total, 1))))
    known = saved(near.mapInArrow(work, "terms binary, label int, place long"), "toxicity-terms").withColumn("n_terms", F.length("terms") / 4)
    taken = sorted((place, label, bytes(terms)) for terms, label, place in sampled(known, sample_rows, sample_terms).select("terms", "label", "place").toLocalIterator())
    return fit([np.frombuffer(terms, np.int32) for _, _, terms in taken], np.array([y for _, y, _ in taken], np.float64))


def score(docs: DataFrame, machine: Machine, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and ``score`` of each row: the probability of label 1."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.scores(words) for _, _, words in blocks(batch.column(1), SEPARATORS)]
            yield pa.record_batch([batch.column(0), pa.array(np.concatenate(found) if found else [], pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, score double").withColumnRenamed("doc_id", key)
