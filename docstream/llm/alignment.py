"""Alignment of two tokenizers' tokens over the same bytes, and counts of linked pairs over the corpus.

Tokenizer A is given a blank and the text, tokenizer B the text (it puts a blank in front itself). The bytes of either's
tokens, joined, must be those of blank and text; a text for which they aren't has no tokens, nor has a null or empty one.

*Galloping intersection*: the ends of tokens, as byte offsets, are two rising lists. The shorter one drives: each of
its ends is looked for in the longer one by steps that double and then by halving. Ends found in both cut the tokens
into groups; the ranks of ends in the other list, and their differences, say which tokens of A and B overlap. A block
of texts is one pair of lists, and all ends of a block take their steps together.

Tokens of A and B that end together are *linked*. How often a pair of ids is linked in all texts comes from two
shuffles: tasks write their distinct pairs, packed by bucket of the pair's hash, and get the totals of each bucket
back; links themselves don't move but for one join of packed rows. The largest total of each id of B goes to all
tasks: as many numbers as B has entries.

Repeated rows count each; null keys pass; very long texts are worked on whole; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstream.llm.dealing import bucket_bits, by_bucket, dealt, saved, summed
from docstream.llm.shipping import ship
from docstream.llm.token_counts import OTHER_SPACE, PIECES, byte_letters
from docstream.llm.tokenizing import Memory, load, once, tokenizer_file
from docstream.llm.words import mix

#: Bytes of text that are tokenised together, links that a packed row holds, ends for each that starts a lane.
BLOCK_BYTES, CHUNK_LINKS, LANE = 1 << 20, 200_000, 8
#: Pieces of text whose ids a worker remembers.
REMEMBERED = 300_000


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of ``short``, how many of ``long`` are smaller; both rise.

    Every ``LANE``-th is found first, and the others of its lane start from where it was found.
    """
    low = np.zeros(len(short), np.int64)
    if len(short) > LANE:
        low = np.repeat(gallop(short[::LANE], long), LANE)[: len(short)]
    step, last = np.ones(len(short), np.int64), len(long)
    going = np.arange(len(short)) if last else np.zeros(0, np.int64)
    while len(going):
        probe = low[going] + step[going]
        behind = (probe < last) & (long[np.minimum(probe, last - 1)] < short[going])
        going = going[behind]
        low[going] = probe[behind]
        step[going] *= 2
    high = np.minimum(low + step, last)
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) >> 1
        less = long[middle] < short[going]
        low[going[less]] = middle[less] + 1
        high[going[~less]] = middle[~less]
        going = going[low[going] < high[going]]
    return low


@dataclass(frozen=True)
class Alignment:
    """Two lists of ends against each other."""

    #: Places in A and in B of ends that both have.
    a: np.ndarray
    b: np.ndarray
    #: For each token of A the first and the last token of B that it overlaps.
    first: np.ndarray
    last: np.ndarray


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> Alignment:
    """``ends_a`` and ``ends_b`` rise and have the same last value."""
    turned = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if turned else (ends_a, ends_b)
    rank = gallop(short, long)
    same = rank < len(long)
    same[same] = long[rank[same]] == short[same]
    own, other = np.flatnonzero(same), rank[same]
    if turned:
        # Ends of B that lie before an end of A: those whose next end of A is not beyond it.
        before = np.cumsum(np.bincount(rank + same, minlength=len(ends_a) + 1))[: len(ends_a)]
        own, other = other, own
    else:
        before = rank
    up_to = before.copy()
    up_to[own] += 1
    first = np.append(0, up_to[:-1]) if len(up_to) else up_to
    return Alignment(own, other, first, before)


class Pair:
    """Both tokenizers in a worker, with the bytes of their entries."""

    def __init__(self, json_text: str, model: bytes):
        import sentencepiece

        self.a, letters = load(json_text), byte_letters()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_a = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, number in self.a.get_vocab(with_added_tokens=True).items():
            known = all(c in letters for c in token)
            self.bytes_a[number] = bytes(letters[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in own], np.int64) for own in (self.bytes_a, self.bytes_b))
        width = len(str(max(len(pieces), len(self.bytes_a))))
        self.digits = np.zeros((max(len(pieces), len(self.bytes_a)), width), np.uint8)
        for k in range(len(self.digits)):
            self.digits[k, width - len(str(k)) :] = np.frombuffer(str(k).encode(), np.uint8)
        self.n_digits = (self.digits > 0).sum(axis=1)
        self.memory = Memory(self._encoded, REMEMBERED)

    def _encoded(self, texts: list[str]) -> list[bytes | None]:
        """Ids of A, packed, of each text; null for one whose bytes they don't give."""
        found = []
        for text, told in zip(texts, self.a.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            same = b"".join([self.bytes_a[i] for i in told.ids]) == text.encode()
            found.append(np.array(told.ids, "<u4").tobytes() if same else None)
        return found

    def ids_a(self, texts: list[str]) -> list[bytes | None]:
        """Pieces cut at ASCII white space give the ids that they give within the text; other white space goes the long way."""
        cut = [None if OTHER_SPACE.search(text) else PIECES.findall(text) for text in texts]
        known = self.memory.ready(set().union(*(pieces for pieces in cut if pieces)))
        whole = iter(self._encoded([text for text, pieces in zip(texts, cut, strict=True) if pieces is None]))
        found = [next(whole) if pieces is None else [known[piece] for piece in pieces] for pieces in cut]
        return [x if not isinstance(x, list) else None if None in x else b"".join(x) for x in found]

    def ids(self, texts: list[str | None]) -> tuple[list[bytes], list[list[int]]]:
        """Ids of A, packed, and of B; none for a text whose bytes they don't give."""
        found_a: list[bytes] = [b""] * len(texts)
        found_b: list[list[int]] = [[] for _ in texts]
        some = [k for k, text in enumerate(texts) if text]
        got_a = self.ids_a([" " + texts[k] for k in some])
        got_b = self.b.encode([texts[k] for k in some], num_threads=1) if some else []
        for k, a, b in zip(some, got_a, got_b, strict=True):
            whole = b" " + texts[k].encode()
            if a is not None and whole == b"".join([self.bytes_b[i] for i in b]):
                found_a[k], found_b[k] = a, b
        return found_a, found_b

    def block(self, texts: list[str | None]) -> Block:
        return Block(self, *self.ids(texts))


class Block:
    """The tokens of some texts, aligned."""

    def __init__(self, pair: Pair, ids_a: list[bytes], ids_b: list[list[int]]):
        self.pair = pair
        self.n_a = np.array([len(x) // 4 for x in ids_a], np.int64)
        self.n_b = np.array([len(x) for x in ids_b], np.int64)
        self.a = np.frombuffer(b"".join(ids_a), "<u4").astype(np.int64)
        self.b = np.fromiter(chain.from_iterable(ids_b), np.int64, self.n_b.sum())
        self.bounds_a, self.bounds_b = (np.append(0, np.cumsum(n)) for n in (self.n_a, self.n_b))
        # The bytes of a text are as many for A as for B, so texts in a row stay aligned.
        self.found = align(np.cumsum(pair.size_a[self.a]), np.cumsum(pair.size_b[self.b]))
        self.bounds = np.searchsorted(self.found.a, self.bounds_a)

    def links(self) -> np.ndarray:
        """Pairs of ids that end together, B's in the upper half."""
        return self.b[self.found.b] << 32 | self.a[self.found.a]

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of each text: ids of the groups in order."""
        # Tokens of a side that lie before each token's group on the other side, or up to its end.
        ends_a, ends_b = (np.zeros(len(own), np.int64) for own in (self.a, self.b))
        ends_a[self.found.a], ends_b[self.found.b] = 1, 1
        before = np.append(0, self.found.b + 1)[np.cumsum(ends_a) - ends_a]
        up_to = (self.found.a + 1)[np.cumsum(ends_b) - ends_b] if len(self.b) else self.b
        width = self.pair.digits.shape[1]
        said = np.empty((len(self.a) + len(self.b), width + 1), np.uint8)
        size = np.empty(len(said), np.int64)
        for ids, place, ends, stop in ((self.a, before, ends_a, b"|"), (self.b, up_to, ends_b, b";")):
            place = place + np.arange(len(ids))
            said[place, :width] = self.pair.digits[ids]
            said[place, width] = np.where(ends, ord(stop), ord(","))
            size[place] = self.pair.n_digits[ids] + 1
        bounds = self.bounds_a + self.bounds_b
        flat = said[said > 0].tobytes()
        cuts = np.append(0, np.cumsum(size))[bounds].tolist()
        return [flat[x : max(x, y - 1)] for x, y in zip(cuts, cuts[1:], strict=False)]


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``BLOCK_BYTES``."""
    first, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text or "")
        if held >= BLOCK_BYTES:
            yield first, k + 1
            first, held = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _shared(spark: SparkSession, file_a: str, file_b: str):
    """Both vocabulary files, whose size doesn't depend on the corpus, and a function that makes the pair of them."""
    ship(spark)
    shared = spark.sparkContext.broadcast((tokenizer_file(file_a), Path(file_b).read_bytes()))
    mark = (zlib.crc32(shared.value[0].encode()), zlib.crc32(shared.value[1]))
    return lambda: once(("aligned", mark), lambda: Pair(*shared.value))


def _texts(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))


def alignments(docs: DataFrame, file_a: str, file_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ids, groups and overlaps of each row.

    ``a_ends`` and ``b_ends`` say for each group how many tokens lie up to its end; ``first_b`` and ``last_b`` say for
    each token of A which tokens of B it overlaps, from 0.
    """
    pair = _shared(docs.sparkSession, file_a, file_b)
    names = ("a_ids", "b_ids", "a_ends", "b_ends", "first_b", "last_b")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, last in _blocks(texts):
                block = pair().block(texts[first:last])
                found = block.found
                lists = [[] for _ in names]
                for k in range(last - first):
                    a, a_end = block.bounds_a[k : k + 2]
                    b, b_end = block.bounds_b[k : k + 2]
                    g, g_end = block.bounds[k : k + 2]
                    own = (block.a[a:a_end], block.b[b:b_end], found.a[g:g_end] + 1 - a, found.b[g:g_end] + 1 - b, found.first[a:a_end] - b, found.last[a:a_end] - b)
                    for held, values in zip(lists, own, strict=True):
                        held.append(values)
                yield pa.record_batch([batch.column(0).slice(first, last - first), *(pa.array(x, pa.list_(pa.int32())) for x in lists)], names=["key", *names])

    schema = "key long, " + ", ".join(f"{name} array<int>" for name in names)
    return _texts(docs, text, key).mapInArrow(work, schema).withColumnRenamed("key", key)


_CHUNK = pa.schema(
    [("chunk", pa.int64()), ("keys", pa.list_(pa.int64())), *((n, pa.list_(pa.int64())) for n in ("n_a", "n_b", "n_links")), ("digests", pa.list_(pa.string()))]
    + [(n, pa.binary()) for n in ("which", "pairs", "counts")]
)
_CHUNK_SQL = "chunk long, keys array<long>, n_a array<long>, n_b array<long>, n_links array<long>, digests array<string>, which binary, pairs binary, counts binary"


def _chunks(rows: DataFrame, pair) -> DataFrame:
    """Texts in packed rows: figures of each, the distinct linked pairs, and which of them each link is; saved."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        number = TaskContext.get().partitionId() << 32

        def packed() -> pa.RecordBatch:
            keys, n_a, n_b, n_links, digests = ([x for part in held for x in part[k]] for k in range(5))
            pairs, which, counts = np.unique(np.concatenate([part[5] for part in held]), return_inverse=True, return_counts=True)
            row = (number, keys, n_a, n_b, n_links, digests, which.astype(np.uint16 if len(pairs) <= 1 << 16 else np.uint32).tobytes(), pairs.tobytes(), counts.astype(np.int64).tobytes())
            return pa.record_batch([pa.array([x], f.type) for x, f in zip(row, _CHUNK, strict=True)], schema=_CHUNK)

        size = 0
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, last in _blocks(texts):
                block = pair().block(texts[first:last])
                digests = [hashlib.sha256(said).hexdigest() if said else "" for said in block.groups()]
                links = block.links()
                held.append((keys[first:last], block.n_a.tolist(), block.n_b.tolist(), np.diff(block.bounds).tolist(), digests, links))
                size += len(links)
                if size >= CHUNK_LINKS:
                    yield packed()
                    held.clear()
                    size, number = 0, number + 1
        if held:
            yield packed()

    return saved(rows.mapInArrow(work, _CHUNK_SQL), "aligned")


def _totals(chunks: DataFrame) -> DataFrame:
    """(chunk, bucket, totals): how often each pair of a chunk is linked anywhere; without a chunk: (ids of B, most). Saved."""
    bits = bucket_bits(chunks.sparkSession)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, pairs, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own, n = np.frombuffer(pairs, np.int64), np.frombuffer(counts, np.int64)
                hashes = mix(own.astype(np.uint64))
                order = np.argsort(hashes, kind="stable")
                found = [(bucket, chunk, x.tobytes(), y.tobytes()) for bucket, _, (x, y) in dealt(hashes[order], bits, own[order], n[order])]
                if found:
                    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=["bucket", "chunk", "pairs", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = by_bucket(batches, 1)
        names = ["chunk", "bucket", "totals", "ids", "most"]
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        for (bucket,) in list(found):
            chunk, pairs, counts = found.pop((bucket,))
            own = [np.frombuffer(x, np.int64) for x in pairs]
            all_pairs, total = summed(own, [np.frombuffer(x, np.int64) for x in counts])
            ids, first = np.unique(all_pairs >> 32, return_index=True)
            rows = [(c, bucket, total[np.searchsorted(all_pairs, x)].tobytes(), None, None) for c, x in zip(chunk, own, strict=True)]
            rows.append((None, bucket, None, ids.tobytes(), np.maximum.reduceat(total, first).tobytes()))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    packed = chunks.select("chunk", "pairs", "counts").mapInArrow(deal, "bucket int, chunk long, pairs binary, counts binary")
    return saved(packed.repartition("bucket").mapInArrow(add, "chunk long, bucket int, totals binary, ids binary, most binary"), "totals")


def _most(totals: DataFrame, n_ids: int) -> np.ndarray:
    """The largest total of each id of B: one number for each of its entries comes to the driver."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, most in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pa.record_batch([pa.array(np.frombuffer(ids, np.int64)), pa.array(np.frombuffer(most, np.int64))], names=["id", "most"])

    found = totals.filter("chunk is null").select("ids", "most").mapInArrow(unpack, "id long, most long").groupBy("id").agg(F.max("most").alias("most")).toPandas()
    whole = np.zeros(n_ids, np.int64)
    whole[found["id"].to_numpy(np.int64)] = found["most"].to_numpy(np.int64)
    return whole


def linked(docs: DataFrame, file_a: str, file_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each row.

    A link's count is how often its pair of ids is linked in all rows; it is a best one if no other pair with its id of
    B has a larger count.
    """
    spark = docs.sparkSession
    pair = _shared(spark, file_a, file_b)
    chunks = _chunks(_texts(docs, text, key), pair)
    totals = _totals(chunks)
    most = spark.sparkContext.broadcast(_most(totals, pair().b.vocab_size()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n_a, n_b, n_links, digests, which, pairs, told in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(pairs, np.int64)
                count = np.zeros(len(own), np.int64)
                if len(own):
                    # Buckets in order are the pairs by their hash.
                    order = np.argsort(mix(own.astype(np.uint64)), kind="stable")
                    count[order] = np.concatenate([np.frombuffer(x["totals"], np.int64) for x in sorted(told, key=lambda x: x["bucket"])])
                best = (count == most.value[own >> 32]).astype(np.int64)
                at, bounds = np.frombuffer(which, np.uint16 if len(own) <= 1 << 16 else np.uint32), np.append(0, np.cumsum(n_links)).astype(np.int64)
                sums = [np.append(0, np.cumsum(values[at]))[bounds] for values in (best, count)]
                figures = [keys, n_a, n_b, n_links, n_links, *(np.diff(x) for x in sums)]
                yield pa.record_batch([*(pa.array(x, pa.int64()) for x in figures), pa.array(digests, pa.string())], names=NAMES)

    # The same plan at every size: a broadcast of the totals would grow with the corpus.
    back = totals.filter("chunk is not null").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "totals")).alias("told"))
    rows = chunks.drop("counts").join(back.hint("merge"), "chunk", "left").select("keys", "n_a", "n_b", "n_links", "digests", "which", "pairs", "told")
    schema = ", ".join(f"{name} {'string' if name == 'groups_sha256' else 'long'}" for name in NAMES)
    return rows.mapInArrow(work, schema).withColumnRenamed("key", key)


NAMES = ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
