"""Language-model scores from a log-frequency Bloom filter.

Words and pairs of neighbouring words of the training rows, those seen once too, are counted exactly by a shuffle. A count c is quantised
to the level 1 + floor(log2 c), and the filter holds (n-gram, j) for every level j up to its own; a count is read back
by probing j = 1, 2, ... until a probe fails.

The filter is broadcast to the workers, block by block: a block is the part of it for a range of hashes, at most
``BLOCK_BYTES``, so what a worker holds doesn't grow with the corpus; only the number of blocks does. Chunks of rows
write the distinct n-grams they ask for once, in a folder for each block. Each pass broadcasts a block, probes it for
the n-grams of its folder alone and writes their levels; then the block is given up. So an n-gram is asked once,
whatever the number of blocks, none is left out for size, and the exact counts of pairs aren't kept.

    P(w | h) = weight[level of h] * count(h w) / count(h)  +  (1 - weight[level of h]) * (count(w) + 1) / (N + V + 1)

The weights come from one expectation step over all training rows, each token left out of its own counts.

The *base* score beside it is exact: the most frequent words (at most ``HEAD_WORDS``) are broadcast with
their counts; every other word of every row meets its count in a join.

A null or empty text is one end token; repeated rows are scored and counted each for itself; a null key is scored
and trained on; without training rows all counts are 0; an empty table gives an empty result; texts are scored
whole; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstream.llm.dealing import bucket_bits, by_bucket, dealt, forget, saved, summed
from docstream.llm.shipping import ship
from docstream.llm.words import Words, blocks, mix
from docstream.session import scratch_dir

#: Word that stands for the end of a text, before its first word and after its last.
END = np.uint64(0x5EED0FE4D0000001)
#: Tokens whose levels a task looks at at once (a longer text is looked at whole); bytes of text in a chunk of rows (a longer text is a chunk of its own); words
#: whose counts are broadcast, at most.
CHUNK_TOKENS, CHUNK_BYTES, HEAD_WORDS = 500_000, 8 << 20, 1 << 18
#: Bytes of the filter that are broadcast at once, at most.
BLOCK_BYTES = 16 << 20
#: By how many bits of a hash, after those of its bucket, the filter knows an n-gram. A bucket has the n-grams of a few
#: chunks, so that two of them are equal in these far more rarely than the filter errs.
KEY_BITS = 32
#: Steps of a doubling in which counts are binned to choose those words.
STEPS = 16
#: Bits of the filter for each (n-gram, level) it holds, and probes for each.
ENTRY_BITS, PROBES = 10, 5
LEVELS = 64
_PAIR = np.uint64(0xD6E8FEB86659FD93)


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, word before it, bounds by text) of all tokens of a block, ends included."""
    n = len(words.bounds) - 1
    bounds = words.bounds + np.arange(n + 1)
    word = np.full(bounds[-1], END, dtype=np.uint64)
    inner = np.ones(bounds[-1], dtype=bool)
    inner[bounds[1:] - 1] = False
    word[inner] = words.hash
    before = np.full(bounds[-1], END, dtype=np.uint64)
    before[1:] = word[:-1]
    before[bounds[:-1]] = END
    return word, before, bounds


def pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * _PAIR ^ word)


def level(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1


def typical(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level; 0 for level 0."""
    return np.where(levels > 0, (1.5 * 2.0 ** (levels - 1)) - 0.5, 0.0)


def word_counts(grams: DataFrame) -> DataFrame:
    """(word, c) of all training words, as rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pa.record_batch([pa.array(np.frombuffer(hashes, np.int64)), pa.array(np.frombuffer(counts, np.int64))], names=["word", "c"])

    return grams.filter("n = 1").select("hashes", "counts").mapInArrow(work, "word long, c long")


def frequent_words(vocabulary: DataFrame) -> DataFrame:
    """The rows of ``vocabulary`` with the largest counts, whole bins of them, at most ``HEAD_WORDS`` in all.

    What comes to the driver to choose them is one number for each bin of counts, whatever the corpus.
    """
    size = F.floor(F.log2(F.col("c").cast("double")) * STEPS)
    held, least = 0, LEVELS * STEPS
    for at, n in sorted(vocabulary.groupBy(size.alias("bin")).count().collect(), reverse=True):
        if held + n > HEAD_WORDS:
            break
        held, least = held + n, at
    return vocabulary.filter(size >= least)


class CountFilter:
    """Quantised counts by membership probes; one part for each bucket of hashes."""

    def __init__(self, bits: int, part_bits: int, least: dict[int, int]):
        self.bits, self.part_bits, self.least = bits, part_bits, least
        self.parts = np.zeros(((1 << bits) * part_bits) // 8, dtype=np.uint8)

    def places(self, hashes: np.ndarray, j: int, probe: int) -> np.ndarray:
        """Bit of each hash for level j, within its part."""
        value = mix(hashes * np.uint64(2 * (j * PROBES + probe) + 1) + np.uint64(j * PROBES + probe))
        return ((value >> np.uint64(32)) * np.uint64(self.part_bits) >> np.uint64(32)).astype(np.int64)

    def part(self, n: int, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The bits of one bucket that these n-grams set."""
        found = np.zeros(self.part_bits, dtype=bool)
        levels = level(counts)
        for j in range(self.least[n], int(levels.max(initial=0)) + 1):
            own = hashes[levels >= j]
            for probe in range(PROBES):
                found[self.places(own, j, probe)] = True
        return np.packbits(found)

    @classmethod
    def of_bucket(cls, n: int, hashes: np.ndarray, counts: np.ndarray) -> CountFilter:
        """A filter of one part that holds all these n-grams of one bucket."""
        made = cls(0, -(-int(level(counts).sum()) * ENTRY_BITS // 64) * 64, {n: 1})
        made.parts = made.part(n, hashes, counts)
        return made

    @classmethod
    def of_bytes(cls, n: int, part: bytes) -> CountFilter:
        """The filter of one part that has these bytes."""
        made = cls(0, 8 * len(part), {n: 1})
        made.parts = np.frombuffer(part, np.uint8)
        return made

    def levels(self, n: int, hashes: np.ndarray) -> np.ndarray:
        """The level that each n-gram has in the filter; 0 if it is not there."""
        found = np.zeros(len(hashes), dtype=np.int64)
        if self.part_bits == 0:
            return found
        alive = np.arange(len(hashes))
        start = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) * self.part_bits if self.bits else np.zeros(len(hashes), np.int64)
        for j in range(self.least[n], LEVELS):
            for probe in range(PROBES):
                bit = start[alive] + self.places(hashes[alive], j, probe)
                alive = alive[(self.parts[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1]
            if not len(alive):
                break
            found[alive] = j
        return found


def chunked(rows: DataFrame) -> DataFrame:
    """Saved ``rows`` (key, held_out, text), about ``CHUNK_BYTES`` of text packed into each: (chunk, rows).

    ``rows`` is one compressed Arrow stream, which is what is kept and shuffled of a chunk's texts.
    """

    def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            for part in parts:
                stream.write_batch(part)
        return pa.record_batch([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["rows"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
            first = 0
            for row, length in enumerate(lengths.tolist()):
                if size and size + length > CHUNK_BYTES:
                    if row > first:
                        parts.append(batch.slice(first, row - first))
                    yield packed(parts)
                    parts, size, first = [], 0, row
                size += length + 8
            if len(lengths) > first:
                parts.append(batch.slice(first))
        if parts:
            yield packed(parts)

    found = rows.mapInArrow(work, "rows binary")
    return saved(found.withColumn("chunk", F.monotonically_increasing_id()), "lm-chunks")


def rows_of(packed: pa.BinaryScalar) -> pa.Table:
    """The rows (key, held_out, text) of a chunk."""
    with pa.ipc.open_stream(packed.as_buffer()) as stream:
        return stream.read_all().combine_chunks()


def training_texts(packed: pa.BinaryScalar) -> pa.Array:
    """The texts of a chunk's training rows."""
    own = rows_of(packed)
    return pc.filter(column_of(own, "text"), pc.invert(column_of(own, "held_out")))


def column_of(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column if isinstance(column, pa.Array) else column.chunk(0)


def grams_of(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, one past the last, words, pairs, bounds by text) of a block of texts at a time."""
    for first, last, words in blocks(texts):
        word, before, bounds = tokens(words)
        yield first, last, word, pair(before, word), bounds


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes and how often each occurs; ``values`` are sorted in place."""
    values.sort()
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[first], np.diff(np.append(first, len(values)))


def distinct_grams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, hashes, counts) of the distinct words, then of the distinct pairs of a chunk; nothing without texts."""
    cut = {1: [], 2: []}
    for _, _, word, both, _ in grams_of(texts):
        cut[1].append(word)
        cut[2].append(both)
    del texts
    for n in (1, 2):
        if cut[n]:
            yield n, *distinct(np.concatenate(cut.pop(n)))


def ranks(cut: list[np.ndarray], hashes: np.ndarray) -> Iterator[np.ndarray]:
    """Where each hash of a block stands in the sorted ``hashes``, which hold it, block by block."""
    for block in cut:
        order = np.argsort(block)
        found = np.empty(len(block), np.int32)
        found[order] = np.searchsorted(hashes, block[order])
        yield found


def short_keys(hashes: np.ndarray, bits: int) -> np.ndarray:
    """What the filter knows of a hash within its bucket; sorted as the hashes of a bucket are."""
    return ((hashes << np.uint64(bits)) >> np.uint64(64 - KEY_BITS)).astype(np.uint32)


def hash_bits(chunks: DataFrame) -> int:
    """Bits of a hash that name its bucket: also so many that a bucket has the n-grams of four chunks at most."""
    return max(bucket_bits(chunks.sparkSession), chunks.count().bit_length() - 2)


def count_grams(chunks: DataFrame, bits: int) -> DataFrame:
    """Saved (bucket, n, part, hashes, counts) of the training rows: the filter's part of each bucket, and the exact counts of words.

    Counts are added up within a chunk before they are shuffled. Pairs are shuffled by what the filter knows of them.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(0):
                for n, hashes, counts in distinct_grams(training_texts(packed)):
                    known = hashes if n == 1 else short_keys(hashes, bits)
                    rows = [(b, n, k.tobytes(), c.tobytes()) for b, _, (k, c) in dealt(hashes, bits, known, counts.astype(np.uint32))]
                    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "n", "hashes", "counts"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, n), (hashes, counts) in by_bucket(batches, 2).items():
            own, total = summed([np.frombuffer(x, np.uint64 if n == 1 else np.uint32) for x in hashes], [np.frombuffer(x, np.uint32) for x in counts])
            keys = short_keys(own, bits) if n == 1 else own
            part = CountFilter.of_bucket(n, keys.astype(np.uint64), total).parts.tobytes()
            words = (own.tobytes(), total.tobytes()) if n == 1 else (None, None)
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.record_batch([pa.array([x], k) for x, k in zip((bucket, n, part, *words), kinds, strict=True)], names=["bucket", "n", "part", "hashes", "counts"])

    found = chunks.select("rows").mapInArrow(partial, "bucket int, n int, hashes binary, counts binary")
    return saved(found.repartition("bucket").mapInArrow(merged, "bucket int, n int, part binary, hashes binary, counts binary"), "gram-counts")


def buckets_a_block(counts: DataFrame, bits: int, block_bytes: int) -> int:
    """How many buckets next to each other make a block of at most ``block_bytes``, measured by the largest parts."""
    largest = sum(size for _, size in counts.groupBy("n").agg(F.max(F.length("part"))).collect())
    if largest > block_bytes:
        raise ValueError(f"a bucket's part of the filter has {largest} bytes, more than the {block_bytes} of a block: more shuffle partitions make smaller buckets")
    return min(block_bytes // max(largest, 1), 1 << bits)


def asked(chunks: DataFrame, bits: int, buckets: int, path: str) -> DataFrame:
    """(chunk, bucket, n, keys, block) saved at ``path``: the distinct n-grams of each chunk, in a folder for each block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for n, hashes, _ in distinct_grams(column_of(rows_of(packed), "text")):
                    rows = [(chunk, b, n, k.tobytes(), b // buckets) for b, _, (k,) in dealt(hashes, bits, short_keys(hashes, bits))]
                    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32())
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["chunk", "bucket", "n", "keys", "block"])

    schema = "chunk long, bucket int, n int, keys binary, block int"
    chunks.select("chunk", "rows").mapInArrow(work, schema).write.partitionBy("block").parquet(path)
    return chunks.sparkSession.read.schema(schema).parquet(path)


def read_levels(chunks: DataFrame, counts: DataFrame, bits: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Saved (chunk, bucket, n, levels): what the filter says of the distinct n-grams of each chunk, in the order of their hashes."""
    spark = chunks.sparkSession
    buckets = buckets_a_block(counts, bits, block_bytes)
    asked_at, path, schema = scratch_dir(spark, "lm-asked"), scratch_dir(spark, "gram-levels"), "chunk long, bucket int, n int, levels binary"
    questions = asked(chunks, bits, buckets, asked_at)
    for block in range(-(-(1 << bits) // buckets)):
        own = counts.filter(F.col("bucket").between(block * buckets, (block + 1) * buckets - 1))
        shared = spark.sparkContext.broadcast({(b, n): part for b, n, part in own.select("bucket", "n", "part").toArrow().to_pandas().itertuples(index=False)})

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                levels = []
                for bucket, n, keys in zip(*(batch.column(c).to_pylist() for c in ("bucket", "n", "keys")), strict=True):
                    part = CountFilter.of_bytes(n, shared.value.get((bucket, n), b""))
                    levels.append(part.levels(n, np.frombuffer(keys, np.uint32).astype(np.uint64)).astype(np.uint8).tobytes())
                yield pa.record_batch([*(batch.column(c) for c in ("chunk", "bucket", "n")), pa.array(levels, pa.binary())], names=["chunk", "bucket", "n", "levels"])

        answers = questions.filter(F.col("block") == block).select("chunk", "bucket", "n", "keys").mapInArrow(work, schema)
        answers.write.mode("append").parquet(path)
        shared.destroy()
        # The levels are written, so no lost executor brings these questions back.
        forget(spark, f"{asked_at}/block={block}")
    return spark.read.schema(schema).parquet(path)


def triples(words: np.ndarray, pairs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Levels of the context, the word and the pair of each token as one number.

    ``words`` and ``pairs`` are levels, bytes; the last token of a text is its end, which also stands before its first.
    """
    context = np.empty_like(words)
    context[1:] = words[:-1]
    context[bounds[:-1]] = words[bounds[1:] - 1]
    found = context.astype(np.int32)
    for levels in (words, pairs):
        found *= LEVELS
        found += levels
    return found


class Model:
    """Smoothed probabilities of tokens from the levels of their n-grams.

    All it knows of a token are three levels, so it works them out for every triple of levels and looks tokens up there:
    what a worker holds for a token is a place in that table and a number, whatever the formula.
    """

    def __init__(self, total: int, distinct: int):
        self.size = total + distinct + 1
        self.weights = np.full(LEVELS, 0.2)

    def mixed(self, left_out: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(part by the pair in its context, part by the word alone) of the probability for each context, word and pair level."""
        around, single, both = np.meshgrid(*[typical(np.arange(LEVELS))] * 3, indexing="ij", sparse=True)
        if left_out:
            both, around, single = np.maximum(both - 1, 0), around - 1, np.maximum(single - 1, 0)
        share = np.minimum(np.where(around > 0, both / np.maximum(around, 1), 0), 1)
        weight = self.weights[:, None, None]
        return weight * share, (1 - weight) * ((single + 1) / self.size)

    def logs(self) -> np.ndarray:
        """log10 of the probability of a token by its triple of levels."""
        return np.log10(sum(self.mixed())).ravel()

    def explained(self) -> np.ndarray:
        """The share of a training token that its pair, not the word alone, explains, by its triple of levels."""
        by_pair, alone = self.mixed(left_out=True)
        return (by_pair / (by_pair + alone)).ravel()


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, one past the last, word levels, pair levels, bounds) of some rows at a time."""
    words, pairs = (batch.column(batch.schema.get_field_index(c)) for c in ("word_levels", "pair_levels"))
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False))])
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + CHUNK_TOKENS, side="right")) - 1)
        told = [np.frombuffer(b"".join(x.slice(first, last - first).to_pylist()), np.uint8) for x in (words, pairs)]
        yield first, last, *told, ends[first : last + 1] - ends[first]
        first = last


def level_counts(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    """How many tokens of these rows have each triple of levels."""
    seen = np.zeros(LEVELS**3, dtype=np.int64)
    for batch in batches:
        for _, _, words, pairs, bounds in unpacked(batch):
            seen += np.bincount(triples(words, pairs, bounds), minlength=LEVELS**3)
    return seen


def text_scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """(rows, log10 of the probability of their texts), some rows at a time."""
    logs = model.logs()
    for batch in batches:
        for first, last, words, pairs, bounds in unpacked(batch):
            yield batch.slice(first, last - first), pa.array(np.add.reduceat(logs[triples(words, pairs, bounds)], bounds[:-1]))


def fit_weights(model: Model, train: DataFrame) -> None:
    """One expectation step over all training rows: how often the pair, not the word alone, explains a token."""
    shared = train.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = level_counts(batches)
        told = (seen * shared.value.explained()).reshape(LEVELS, -1).sum(axis=1)
        yield pa.record_batch([pa.array(range(LEVELS), pa.int32()), pa.array(told), pa.array(seen.reshape(LEVELS, -1).sum(axis=1).astype(float))], names=["level", "told", "seen"])

    found = train.select("word_levels", "pair_levels").mapInArrow(work, "level int, told double, seen double")
    for at, told, seen in found.groupBy("level").agg(F.sum("told"), F.sum("seen")).collect():
        model.weights[at] = (told + 0.01) / (seen + 1)


def score(docs: DataFrame, held_out: Column, text: str = "text", key: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of each row.

    ``block_bytes`` bounds what is broadcast of the filter at once; scores don't depend on it.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).cast("string").alias("text"))
    chunks = chunked(rows)
    bits = hash_bits(chunks)
    grams = count_grams(chunks, bits)
    answered = read_levels(chunks, grams, bits, block_bytes)
    vocabulary = word_counts(grams.filter("n = 1"))
    total, n_distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    head = frequent_words(vocabulary).toPandas().sort_values("word")
    shared = spark.sparkContext.broadcast((head["word"].to_numpy(np.int64), head["c"].to_numpy(np.int64)))
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int32()))
    names = ["key", "held_out", "n_tokens", "n_known", "logs", "words", "times", "word_levels", "pair_levels"]

    def work(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        own = rows_of(chunk.column("rows")[0])
        frequent, counts = shared.value
        logs = np.log10(counts + 1.0)
        told: dict[int, list[tuple[int, bytes]]] = {1: [], 2: []}
        for bucket, n, levels in zip(*(answers.column(c).to_pylist() for c in ("bucket", "n", "levels")), strict=True):
            told[n].append((bucket, levels))
        spans, grams, made, levels = [], {1: [], 2: []}, [], {}
        for first, last, word, both, bounds in grams_of(column_of(own, "text")):
            spans.append((first, last, bounds))
            grams[1].append(word)
            grams[2].append(both)
        own = own.drop_columns(["text"])
        for n in (2, 1):
            hashes, _ = distinct(np.concatenate(grams[n]))
            # The hashes of a bucket are next to each other, so levels by bucket are levels by hash.
            found = np.frombuffer(b"".join(x for _, x in sorted(told.pop(n))), np.uint8)
            if len(found) != len(hashes):
                raise ValueError(f"levels of {len(found)} of {len(hashes)} n-grams came back")
            levels[n] = [found[rank] for rank in ranks(grams[n], hashes)]
            if n == 2:
                del grams[n]
        for (first, last, bounds), word, *by_n in zip(spans, grams[1], levels[1], levels[2], strict=True):
            word = word.view(np.int64)
            at = np.searchsorted(frequent, word)
            at[at == len(frequent)] = 0
            known = frequent[at] == word if len(frequent) else np.zeros(len(word), bool)
            sums = np.add.reduceat(np.where(known, logs[at] if len(frequent) else 0.0, 0.0), bounds[:-1])
            n_known = np.add.reduceat(known.astype(np.int64), bounds[:-1])
            rest, times = [], []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                rare, n = np.unique(word[a:b][~known[a:b]], return_counts=True)
                rest.append(rare)
                times.append(n)
            columns = [pa.array(list(c), k) for c, k in zip((np.diff(bounds), n_known, sums, rest, times), kinds, strict=True)]
            columns += [pa.array([x[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()) for x in by_n]
            part = own.slice(first, last - first)
            made.append(pa.table([part.column("key"), part.column("held_out"), *columns], names=names))
        return pa.concat_tables(made)

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, held_out boolean, n_tokens long, n_known long, logs double, words array<long>, times array<int>, word_levels binary, pair_levels binary"
    found = chunks.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(work, schema)
    table = saved(found.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    model = Model(total, n_distinct)
    fit_weights(model, table.filter(~F.col("held_out")))
    fitted = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, score in text_scores(batches, fitted.value):
            rest = rows.select(["row", "key", "held_out", "n_tokens", "n_known", "logs"])
            yield pa.record_batch([*rest.columns, score], names=[*rest.schema.names, "score"])

    told = table.drop("words", "times").mapInArrow(scored, f"row long, key {kind}, held_out boolean, n_tokens long, n_known long, logs double, score double")
    rare = table.select("row", F.explode(F.arrays_zip("words", "times")).alias("t")).select("row", F.col("t.words").alias("word"), F.col("t.times").alias("n"))
    met = rare.join(vocabulary, "word").groupBy("row").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_logs"))
    size = float(np.log10(total + n_distinct + 1))
    return told.join(met, "row", "left").select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * size).alias("base_score"),
        "score",
    )
