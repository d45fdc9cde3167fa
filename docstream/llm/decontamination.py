"""Benchmark decontamination by pigeonhole edit matching.

Texts are read as words (runs of bytes other than white space and ASCII punctuation, A-Z lowered). A test item of
m words may differ from a passage by k = m * budget // 100 words put in, left out or replaced. The item is split
into k + 1 pieces: in any passage within the budget at least one piece is untouched, so exact hits of pieces find
all candidates. Each candidate place is verified with Myers' bit-parallel edit distance over words, in which the
passage may begin and end anywhere in the place.

The items are a query set: they are gathered in blocks of bounded size, and each block is held against all rows.

An item or text that is null or has no words matches nothing. Items with equal words are each reported. Repeated
documents are each looked at; null ids pass through; an empty table or query set gives no matches; texts are
searched whole; other columns pass, but those named as results are replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstream.llm.dealing import saved, unused
from docstream.llm.shipping import ship
from docstream.llm.words import PUNCTUATION, SPACES, blocks

SEPARATORS = SPACES + PUNCTUATION
#: Percent of an item's words that may differ.
BUDGET = 20
#: Words of items that are gathered and broadcast together: some 64 bytes each.
BLOCK_WORDS = 500_000
MATCHES = "array<struct<item_id:bigint,distance:int,start:bigint,end:bigint>>"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def pieces_of(n_words: int, budget: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of an item: error budget plus one, nearly equal."""
    n = n_words * budget // 100 + 1
    cuts = [n_words * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: list[int], text: list[int], budget: int) -> tuple[int, int] | None:
    """(distance, end) of the best match of ``pattern`` with a run of ``text`` that ends before ``end``.

    The earliest end wins a tie; None if the distance is over ``budget``. Bit k of the vectors stands for word k.
    """
    m = len(pattern)
    where: dict[int, int] = defaultdict(int)
    for k, word in enumerate(pattern):
        where[word] |= 1 << k
    full, top = (1 << m) - 1, 1 << m - 1
    up, down, score, best = full, 0, m, None
    for at, word in enumerate(text):
        equal = where.get(word, 0)
        across = ((equal & up) + up ^ up | equal) & full
        diagonal = equal | down
        plus, minus = down | ~(across | up) & full, up & across
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | ~(diagonal | plus) & full, plus & diagonal
        if score <= budget and (best is None or score < best[0]):
            best = (score, at + 1)
    return best


class Items:
    """A block of test items, ready for searching."""

    def __init__(self, items: list[tuple[int, np.ndarray]], budget: int):
        self.items, self.budget = items, budget
        found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for k, (_, words) in enumerate(items):
            for start, length in pieces_of(len(words), budget):
                value = 0
                for word in words[start : start + length].tolist():
                    value = (value * int(_FACTOR) + word) & 0xFFFFFFFFFFFFFFFF
                found[length].append((value, k, start))
        self.by_length = {}
        for length, rows in sorted(found.items()):
            rows.sort()
            keys = np.array([r[0] for r in rows], dtype=np.uint64)
            low = np.zeros(1 << 16, dtype=bool)
            low[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.by_length[length] = (keys, np.array([r[1:] for r in rows], dtype=np.int64), low)

    def search(self, words: np.ndarray, bounds: np.ndarray) -> dict[int, list[dict]]:
        """Matches by text (by its number in the block)."""
        places: dict[tuple[int, int], set[int]] = defaultdict(set)
        value = np.zeros(len(words), dtype=np.uint64)
        done = 0
        for length, (keys, rows, low) in self.by_length.items():
            for k in range(done, min(length, len(words))):
                moved = np.zeros_like(value)
                moved[: len(words) - k] = words[k:]
                value = value * _FACTOR + moved
            done = length
            if length > len(words):
                break
            own = value[: len(words) - length + 1]
            at = np.flatnonzero(low[(own & np.uint64(0xFFFF)).astype(np.int64)])
            left, right = np.searchsorted(keys, own[at]), np.searchsorted(keys, own[at], side="right")
            hit = right > left
            texts = np.searchsorted(bounds, at, side="right") - 1
            hit &= at + length <= bounds[np.minimum(texts + 1, len(bounds) - 1)]
            for place, text, a, b in zip(at[hit].tolist(), texts[hit].tolist(), left[hit].tolist(), right[hit].tolist(), strict=True):
                for item, start in rows[a:b].tolist():
                    places[text, item].add(place - start)
        found: dict[int, list[dict]] = defaultdict(list)
        for (text, item), starts in places.items():
            found[text] += self._verified(words, int(bounds[text]), int(bounds[text + 1]), item, sorted(starts))
        return found

    def _verified(self, words: np.ndarray, first: int, last: int, item: int, starts: list[int]) -> list[dict]:
        """The best match of an item in each stretch of candidate places that touch."""
        key, pattern = self.items[item]
        own = pattern.tolist()
        budget = len(own) * self.budget // 100
        stretches: list[list[int]] = []
        for start in starts:
            a, b = max(first, start - budget), min(last, start + len(own) + budget)
            if stretches and a <= stretches[-1][1]:
                stretches[-1][1] = max(stretches[-1][1], b)
            else:
                stretches.append([a, b])
        found = []
        for a, b in stretches:
            text = words[a:b].tolist()
            if best := myers(own, text, budget):
                distance, end = best
                backwards = myers(own[::-1], text[:end][::-1], distance)
                start = end - (backwards[1] if backwards else len(own))
                found.append({"item_id": key, "distance": distance, "start": a + start - first, "end": a + end - first})
        return found


def item_blocks(benchmark: DataFrame, key: str, text: str, budget: int, block_words: int = BLOCK_WORDS) -> Iterator[Items]:
    """The query set in blocks of about ``block_words`` words, one at a time on the driver."""
    ship(benchmark.sparkSession)
    block: list[tuple[int, np.ndarray]] = []
    held = 0
    for row in benchmark.select(F.col(key).cast("long"), F.col(text).cast("string")).filter(F.col(text).isNotNull()).toLocalIterator():
        for _, _, words in blocks(pa.array([row[1]]), SEPARATORS):
            if len(words.hash):
                block.append((row[0], words.hash))
                held += len(words.hash)
        if held >= block_words:
            yield Items(block, budget)
            block, held = [], 0
    if block:
        yield Items(block, budget)


def _found_in(docs: DataFrame, items: Items, text: str, to: str) -> DataFrame:
    """``docs`` with the matches of one block of items appended to the array ``to``."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    names = docs.columns
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    at, into = names.index(text), names.index(to)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matches = batch.column(into).to_pylist()
            for first, _, words in blocks(batch.column(at), SEPARATORS):
                for row, found in shared.value.search(words.hash, words.bounds).items():
                    matches[first + row] = [*(matches[first + row] or []), *found]
            columns = [pa.array(matches, kind) if k == into else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(work, docs.schema)


def find_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", budget: int = BUDGET, block_words: int = BLOCK_WORDS, to: str = "matches") -> DataFrame:
    """``docs`` with ``to``: (item_id, distance, start, end) of passages within the budget, places in words.

    Items come in blocks of about ``block_words`` words, a pass over the texts each; what a pass finds is saved before
    the next, so a worker holds one block at a time.
    """
    ship(docs.sparkSession)
    df = docs.drop(to).withColumn(to, F.array().cast(MATCHES))
    for number, items in enumerate(item_blocks(benchmark, item_key, item_text, budget, block_words)):
        df = _found_in(saved(df, "searched") if number else df, items, text, to)
    return df.withColumn(to, F.array_sort(to))


def contaminated(to: str = "matches") -> Column:
    return F.size(to) > 0


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs`` without those in which a test item is found."""
    to = unused(docs, "matches")
    return find_items(docs, benchmark, text, to=to, **how).filter(~contaminated(to)).select(*docs.columns)
