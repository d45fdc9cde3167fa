"""Packing of tokenised documents by minimum bin slack.

Each task packs what it reads, in pools of a bounded number of tokens; no row is shuffled. A document's full
windows are cut off first; what remains of each document goes into the pool's multiset of lengths. A window
opens with the longest length left; a bitset subset-sum over the other lengths (bit s: sum s can be made) finds
the multiset that fills it closest to capacity, and backtracking gives the count taken of each length. The same
multiset is used again as long as the counts allow. If no multiset fills the window, the next document is cut
to close it. What is left at the end of a pool goes into windows of powers of two, which need no padding.

Null texts count as empty: their only id is the end id. Repeated rows are packed each for itself, null ids pass
through, an empty table gives no pieces, texts of any length are packed whole, other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstream.llm.shipping import ship
from docstream.llm.tokenizing import Memory, load, once, tokenizer_file

#: Tokens that are packed together at least; bounds a task's memory.
POOL_TOKENS = 2_000_000
TEXT_BYTES = 1 << 22
FIELDS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def closest(counts: dict[int, int], order: list[int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, as {length: count}, whose sum is the largest up to ``capacity``.

    ``order`` holds lengths with their counts in ``counts``, longest first. Stops at an exact fill.
    """
    full, mask = 1 << capacity, (2 << capacity) - 1
    reach, steps = 1, []
    for length in order:
        if reach & full:
            break
        if length > capacity or not counts.get(length):
            continue
        steps.append((length, reach))
        left, size = min(counts[length], capacity // length), 1
        while left:
            size = min(size, left)
            reach |= reach << (size * length) & mask
            left, size = left - size, 2 * size
    total, taken = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        used = 0
        while not before >> total & 1:
            total, used = total - length, used + 1
        if used:
            taken[length] = used
    return taken


def windows(lengths: list[int], capacity: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (item, start, length); every token of every item lies in exactly one."""
    held: dict[int, list[tuple[int, int]]] = {}
    left = 0
    for item, length in enumerate(lengths):
        whole = length - length % capacity
        yield from ([(item, start, capacity)] for start in range(0, whole, capacity))
        if length > whole:
            held.setdefault(length - whole, []).append((item, whole))
            left += length - whole
    counts = {length: len(items) for length, items in held.items()}
    order = sorted(counts, reverse=True)
    longest = [-length for length in order]
    heapify(longest)

    def add(length: int, piece: tuple[int, int]) -> None:
        if length not in held:
            held[length] = []
            at = int(np.searchsorted(-np.array(order), -length)) if order else 0
            order.insert(at, length)
        if not counts.get(length):
            heappush(longest, -length)
        held[length].append(piece)
        counts[length] = counts.get(length, 0) + 1

    def take(length: int) -> tuple[int, int]:
        counts[length] -= 1
        return held[length].pop()

    def first() -> int:
        while not counts[-longest[0]]:
            heappop(longest)
        return -longest[0]

    while left:
        if len(order) > 64 and sum(map(bool, counts.values())) < len(order) // 2:
            order = [x for x in order if counts[x]]
        room = capacity if left >= capacity else 1 << left.bit_length() - 1
        head = first()
        if head > room:
            item, start = take(head)
            add(head - room, (item, start + room))
            left -= room
            yield [(item, start, room)]
            continue
        counts[head] -= 1
        chosen = closest(counts, order, room - head)
        counts[head] += 1
        chosen[head] = chosen.get(head, 0) + 1
        slack = room - sum(length * n for length, n in chosen.items())
        times = 1 if slack or room < capacity else min(counts[length] // n for length, n in chosen.items())
        for _ in range(times):
            pieces = [(*take(length), length) for length, n in chosen.items() for _ in range(n)]
            left -= room
            if slack:
                length = first()
                item, start = take(length)
                pieces.append((item, start, slack))
                add(length - slack, (item, start + slack))
            yield pieces


class Ids:
    """Token ids of texts in a worker, by distinct word.

    The tokenizer drops white space and never looks across it, so the ids of a text are those of its words. It
    lowers case, and a stop after a letter is a token of its own, so both may be done before words are cut,
    unless a special string may be in the text.
    """

    STOP = re.compile(rb"(?<=[a-z])[.,;:!?](?=[ \n]|$)")
    TOGETHER = 1000

    def __init__(self, json_text: str):
        self.tokenizer = load(json_text)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[n for token, n in vocabulary.items() if token.endswith("</w>")]] = True
        self.memory = Memory(self._words)

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word. Words of letters only are encoded many at once: each gives one end of word."""
        texts = [w.decode() for w in words]
        found: list[bytes] = [b""] * len(words)
        plain = [k for k, text in enumerate(texts) if text.isalpha()]
        single = [k for k, text in enumerate(texts) if not text.isalpha()]
        groups = [plain[k : k + self.TOGETHER] for k in range(0, len(plain), self.TOGETHER)]
        joined = self.tokenizer.encode_batch_fast([" ".join([texts[k] for k in g]) for g in groups], add_special_tokens=False)
        for group, got in zip(groups, joined, strict=True):
            ids = np.array(got.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(group):
                single += group
                continue
            data, at = ids.tobytes(), 0
            for k, end in zip(group, (4 * ends).tolist(), strict=True):
                found[k], at = data[at:end], end
        alone = self.tokenizer.encode_batch_fast([texts[k] for k in single], add_special_tokens=False)
        for k, got in zip(single, alone, strict=True):
            found[k] = np.array(got.ids, dtype="<u4").tobytes()
        return found

    def of(self, texts: list[bytes], end: bytes) -> list[bytes]:
        """Little-endian 32-bit ids of each text, with the end id."""
        cut = [(t if b"<|" in t else self.STOP.sub(rb" \g<0>", t.lower())).split() for t in texts]
        known = self.memory.ready(set(chain.from_iterable(cut)))
        return [b"".join(map(known.__getitem__, words)) + end for words in cut]


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 1,
    with_ids: bool = False,
    text: str = "text",
    key: str = "doc_id",
    pool_tokens: int = POOL_TOKENS,
) -> DataFrame:
    """One row per piece of a document in a sequence; with ``with_ids`` also its ids as an array.

    ``tokenizer`` is a file of a word-bound tokenizer: one that drops white space. Sequence ids are unique over
    the table: the task's partition, then a running number.
    """
    ship(docs.sparkSession)
    json_text = tokenizer_file(tokenizer)
    shared = docs.sparkSession.sparkContext.broadcast(json_text)
    mark = zlib.crc32(json_text.encode())
    end = np.array([end_id], dtype="<u4").tobytes()
    names = [x.split()[0] for x in FIELDS.split(", ")] + ["ids"] * with_ids

    def packed(pool: list[tuple[int | None, bytes]], sequence: int) -> tuple[pa.RecordBatch, int]:
        rows = []
        for pieces in windows([len(ids) // 4 for _, ids in pool], capacity):
            offset = 0
            for item, start, length in pieces:
                doc, ids = pool[item]
                own = ids[4 * start : 4 * (start + length)]
                row = (doc, start, length, zlib.crc32(own), len(ids) // 4, sequence, offset)
                rows.append((*row, np.frombuffer(own, dtype="<u4").tolist()) if with_ids else row)
                offset += length
            sequence += 1
        kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names), sequence

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = once(("ids", mark), lambda: Ids(shared.value))
        sequence = TaskContext.get().partitionId() << 40
        pool: list[tuple[int | None, bytes]] = []
        held = 0

        def add(keys: list, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
            nonlocal held, sequence
            for doc, own in zip(keys, ids.of(texts, end), strict=True):
                pool.append((doc, own))
                held += len(own) // 4
                if held >= pool_tokens:
                    found, sequence = packed(pool, sequence)
                    yield found
                    pool.clear()
                    held = 0

        for batch in batches:
            keys, texts, size = [], [], 0
            for doc, text_ in zip(batch.column(0), batch.column(1), strict=True):
                value = (text_.as_py() or "").encode()
                keys.append(doc.as_py())
                texts.append(value)
                size += len(value)
                if size >= TEXT_BYTES:
                    yield from add(keys, texts)
                    keys, texts, size = [], [], 0
            if keys:
                yield from add(keys, texts)
        if pool:
            yield packed(pool, sequence)[0]

    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(work, FIELDS + ", ids array<int>" * with_ids).withColumnRenamed("doc_id", key)
