"""Word n-gram Jaccard join by a token-group matrix.

The set of a text is its distinct shingles of ``size`` words (A-Z lowered; with fewer words, all of them as one; without
words, empty). Two sets link when 100 * |both| >= percent * |either|. All links between different sets are found:

1. Rows with equal sets are one *class*; copies are never paired.
2. A sieve: a class needs so many shingles that another class has too, among the first of its shingles in a common
   order. Most texts have none and are done. (Counted by a shuffle of packed hashes.)
3. The shingles of what is left are ordered by rising frequency. Classes with the same smallest hash are similar; each is
   compared with the most typical one of them, and those that link are its *core*. The typical ones and those that
   didn't link do the same by other hashes, ``PASSES`` times, so that a large group of near copies is nearly one core.
4. Groups are the cores, and the classes without a core by their smallest hash. They make up the matrix: one row for
   each pair of a shingle and a group whose union has it among its members' first shingles. Each core, and each class
   without one, asks the matrix once for all its members; a bound on the overlap by sizes and positions says which
   other groups may hold a link. Of two groups, the smaller asks.
5. A group that qualifies is opened, in parts of about ``GROUP`` classes: |set and union of the part| bounds the overlap
   again, then members are counted. A part whose members are known to be joined to the asking class stays closed.
6. Components of the links are made by star steps.

Shingles are 64-bit hashes, classes 64-bit hashes of sets. Many askers of one group are dealt to several tasks. A null
or empty text has the empty set and links with nothing; repeated rows get a row each; a null key is larger than any
other and names a component only as null; an empty table gives an empty result; texts are read whole; other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docstream.llm.components import components
from docstream.llm.dealing import bucket_bits, dealt, saved, unused
from docstream.llm.shipping import ship
from docstream.llm.words import blocks, shingles
from docstream.session import batch_rows

#: Classes of a group, askers of a group in one task, shingles that a task packs together.
GROUP, ASKERS, CHUNK = 128, 512, 250_000
#: Rows that a worker gets at a time: texts, or pairs of sets, of some megabytes together.
BATCH_ROWS = 1000
#: Smallest hashes by which cores are looked for.
PASSES = 4
NO_KEY = (1 << 63) - 1


class Rule:
    """Integer forms of the threshold, for numbers and for columns alike."""

    def __init__(self, percent: int):
        self.percent = percent

    def need(self, n: int) -> int:
        """Shingles that a set of n must share with any partner."""
        return -(-self.percent * n // 100)

    def first(self, n: int) -> int:
        """So many first shingles of a set of n hold one of any partner's first."""
        return n - self.need(n) + 1

    def more(self, n: int, parts: int) -> int:
        """Shared shingles asked for in a longer beginning: a ``parts``-th of ``first``."""
        return max(1, self.first(n) // parts)

    def linked(self, both: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        return (100 + self.percent) * both >= self.percent * (n + m)

    def c_need(self, n: Column) -> Column:
        return F.ceil(n * self.percent / F.lit(100.0) - 1e-9).cast("long")

    def c_overlap(self, n: Column, m: Column) -> Column:
        return F.ceil((n + m) * self.percent / F.lit(100.0 + self.percent) - 1e-9).cast("long")


def sets_of(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted set of each text."""
    for first, last, words in blocks(texts):
        found, bounds = shingles(words, size)
        for row in range(last - first):
            yield np.unique(found[bounds[row] : bounds[row + 1]])


def class_of(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def members(docs: DataFrame, size: int) -> DataFrame:
    """(key, mark, n, cls) of each row, saved; ``cls`` is null for the empty set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = list(sets_of(batch.column(1), size))
            n, cls = [len(s) for s in own], [class_of(s) if len(s) else None for s in own]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(cls, pa.int64())], names=["key", "mark", "n", "cls"])

    return saved(docs.withColumn("mark", F.xxhash64("text")).mapInArrow(work, "key long, mark long, n long, cls long"), "members")


def sieve(rows: DataFrame, rule: Rule, size: int, parts: int) -> DataFrame:
    """(cls, hits): shingles among the first of a class that other classes have among their first.

    ``rows`` has one column: texts, or sets as binary. The shingles of a task are packed by bucket of their hash. One
    that several classes of a task have is counted there, and only two of them go on for it, so a shingle that a third
    of all texts have weighs as one that each task has.
    """
    bits = bucket_bits(rows.sparkSession)
    packed = rows.schema.fields[0].dataType.typeName() == "binary"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: dict[int, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            if not chunk:
                return
            hashes = np.concatenate(list(chunk.values()))
            cls = np.repeat(np.fromiter(chunk, np.int64, len(chunk)), [len(x) for x in chunk.values()])
            order = np.argsort(hashes, kind="stable")
            hashes, cls = hashes[order], cls[order]
            run = np.cumsum(np.append(True, hashes[1:] != hashes[:-1])) - 1
            begin = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            many = np.bincount(run)[run] > 2
            told, hits = np.unique(cls[many], return_counts=True)
            kept = ~many | (np.arange(len(run)) - begin[run] < 2)
            found = [(b, h.tobytes(), c.tobytes(), None) for b, h, (c,) in dealt(hashes[kept], bits, cls[kept])]
            if len(told):
                found.append((int(told[0]) & (1 << bits) - 1, None, told.tobytes(), hits.tobytes()))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "hashes", "cls", "hits"])
            chunk.clear()

        held = 0
        for batch in batches:
            own = (np.frombuffer(x, np.uint64) for x in batch.column(0).to_pylist()) if packed else sets_of(batch.column(0), size)
            for s in own:
                if len(s):
                    part = s[: rule.first(len(s)) + rule.more(len(s), parts) - 1]
                    chunk[class_of(s)] = part.copy()
                    held += len(part)
                    if held >= CHUNK:
                        yield from flush()
                        held = 0
        yield from flush()

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple[bytes, bytes]]] = {}
        for batch in batches:
            for bucket, hashes, cls, hits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if hits is not None:
                    yield pa.record_batch([pa.array(np.frombuffer(cls, np.int64)), pa.array(np.frombuffer(hits, np.int64))], names=["cls", "hits"])
                else:
                    found.setdefault(bucket, []).append((hashes, cls))
        for bucket in list(found):
            parts_ = found.pop(bucket)
            hashes = np.concatenate([np.frombuffer(h, np.uint64) for h, _ in parts_])
            cls = np.concatenate([np.frombuffer(c, np.int64) for _, c in parts_])
            order = np.lexsort((cls, hashes))
            hashes, cls = hashes[order], cls[order]
            new = np.append(True, (hashes[1:] != hashes[:-1]) | (cls[1:] != cls[:-1]))
            hashes, cls = hashes[new], cls[new]
            run = np.cumsum(np.append(True, hashes[1:] != hashes[:-1])) - 1
            told, hits = np.unique(cls[np.bincount(run)[run] > 1], return_counts=True)
            if len(told):
                yield pa.record_batch([pa.array(told), pa.array(hits)], names=["cls", "hits"])

    dealt_ = rows.mapInArrow(partial, "bucket int, hashes binary, cls binary, hits binary").repartition("bucket")
    return dealt_.mapInArrow(shared, "cls long, hits long").groupBy("cls").agg(F.sum("hits").alias("hits"))


def sieved(classes: DataFrame, hits: DataFrame, rule: Rule, parts: int) -> DataFrame:
    """Classes that hold as many shared shingles as the least partner of theirs shows for certain."""
    least = rule.c_need(F.col("n"))
    asked = F.greatest(F.lit(1), F.floor((least - rule.c_need(least) + 1) / parts))
    return classes.join(hits, "cls").filter(F.col("hits") >= asked).drop("hits")


def sets_for(docs: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """(cls, n, own) of the classes of ``chosen`` (cls, key), saved: their sets as packed sorted hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(c, len(s), s.tobytes()) for c, s in zip(batch.column(1).to_pylist(), sets_of(batch.column(0), size), strict=True) if class_of(s) == c]
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["cls", "n", "own"])

    rows = docs.join(chosen.select("key", "cls"), "key").select("text", "cls")
    return saved(rows.mapInArrow(work, "cls long, n long, own binary"), "sets")


def ordered_sets(sets: DataFrame, rule: Rule) -> DataFrame:
    """(cls, n, low, shared, typical): shingles that other classes have, the rarest first; classes without enough go."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cls, n, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = np.frombuffer(own, np.int64)
                yield pa.record_batch([pa.array(np.full(len(hashes), cls)), pa.array(np.full(len(hashes), n)), pa.array(hashes)], names=["cls", "n", "h"])

    tokens = sets.mapInArrow(work, "cls long, n long, h long")
    often = tokens.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    found = tokens.join(often, "h").groupBy("cls", "n").agg(F.sort_array(F.collect_set(F.struct("df", "h"))).alias("t"))
    rows = found.filter(F.size("t") >= rule.c_need(F.col("n")))
    low = F.array_min(F.transform("t", lambda x: x["h"]))
    often = F.aggregate("t", F.lit(0).cast("long"), lambda a, x: a + x["df"])
    return saved(rows.select("cls", "n", low.alias("low"), F.transform("t", lambda x: x["h"]).alias("shared"), often.alias("often")), "ordered")


def cores(sets: DataFrame, rule: Rule) -> DataFrame:
    """``sets`` with ``home``: the typical class that a class has come to by its links, else the class itself."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = []
            for _, n, own, _, m, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                both = len(np.intersect1d(np.array(own), np.array(other), assume_unique=True))
                yes.append(bool(rule.linked(both, n, m)))
            yes = np.array(yes, bool)
            yield pa.record_batch([c.filter(pa.array(yes)) for c in (batch.column(0), batch.column(3))], names=["cls", "to"])

    home = sets.select("cls", F.col("cls").alias("home"))
    left = sets
    for turn in range(PASSES):
        by = F.col("low") if turn == 0 else F.array_min(F.transform("shared", lambda h, k=turn: F.xxhash64(h, F.lit(k))))
        named = left.select("cls", "n", "often", "shared", by.alias("by"))
        sizes = named.groupBy("by").agg(F.count("*").alias("size")).filter("size > 1")
        # What most of a group have counts for a class, what few have against it.
        typical = F.col("often") - F.col("n") * F.col("size") / 2
        heads = named.select("by", "cls", "n", "often").join(sizes, "by").groupBy("by").agg(F.max(F.struct(typical.alias("typical"), "cls")).alias("top"))
        heads = heads.select(F.col("top.cls").alias("head"), "by").join(left.select(F.col("cls").alias("head"), F.col("n").alias("m"), F.col("shared").alias("other")), "head")
        compared = named.join(heads, "by").filter("cls <> head").select("cls", "n", "shared", "head", "m", "other")
        moved = saved(compared.mapInArrow(work, "cls long, to long"), "moved")
        home = home.join(moved.withColumnRenamed("cls", "home"), "home", "left").select("cls", F.coalesce("to", "home").alias("home"))
        left = left.join(moved, "cls", "left_anti")
    return sets.join(home, "cls")


def grouped(sets: DataFrame) -> DataFrame:
    """``sets`` with ``kind``, its group, and ``grp``, its part of about ``GROUP`` classes; saved."""
    crowd = sets.groupBy("home").agg((F.count("*") > 1).alias("many"))
    kind = F.when(F.col("many"), F.xxhash64(F.lit("core"), "home")).otherwise(F.xxhash64(F.lit("rest"), "low"))
    rows = sets.join(crowd, "home").withColumn("kind", kind).drop("many")
    parts = rows.groupBy("kind").agg(F.count("*").alias("size"))
    part = F.pmod(F.xxhash64("cls"), F.ceil(F.col("size") / GROUP).cast("long"))
    return saved(rows.join(parts, "kind").withColumn("grp", F.xxhash64("kind", part)), "grouped")


def qualifying(rows: DataFrame, rule: Rule) -> DataFrame:
    """(cls, grp): the parts of groups that each class must open."""
    n = F.col("n")
    lone = n - F.size("shared")
    firsts = F.slice("shared", F.lit(1), F.greatest(F.lit(0), (n - rule.c_need(n) + 1 - lone)).cast("int"))
    posts = rows.select("n", "home", "kind", "size", F.posexplode(firsts).alias("k", "h"), lone.alias("lone"))
    posts = posts.withColumn("rest", n - F.col("lone") - F.col("k"))
    bounds = (F.max("rest").alias("rest"), F.min("n").alias("least"), F.max("n").alias("most"))
    asking = posts.groupBy("h", "home", "kind", "size").agg(*bounds)
    matrix = posts.groupBy("h", "kind", "size").agg(*bounds).toDF("h", "g", "g_size", "g_rest", "g_least", "g_most")
    # A class of n may link with sizes from need(n) on; both sides give the overlap that the smallest pair asks for.
    may = (rule.c_need(F.col("g_least")) <= F.col("most")) & (rule.c_need(F.col("least")) <= F.col("g_most"))
    low = F.greatest("least", rule.c_need(F.col("g_least")))
    g_low = F.greatest("g_least", rule.c_need(F.col("least")))
    may &= F.least("rest", "g_rest") >= rule.c_overlap(low, g_low)
    other = (F.col("size") < F.col("g_size")) | ((F.col("size") == F.col("g_size")) & (F.col("kind") < F.col("g")))
    # A core doesn't ask itself; classes without a core ask their own group, unless they are alone in it.
    own = (F.col("kind") == F.col("g")) & (F.col("kind") != F.xxhash64(F.lit("core"), "home")) & (F.col("size") > 1)
    asks = asking.join(matrix, "h").filter(may & (own | other)).select("home", "g").distinct()
    groups = rows.select(F.col("kind").alias("g"), "grp").distinct()
    return rows.select("cls", "home").join(asks.join(groups, "g").select("home", "grp"), "home").select("cls", "grp")


def opened(rows: DataFrame, asks: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) between cores, found by asking classes among the members of the groups they open.

    A link of two classes joins their cores, so cores stand for their classes here. Of the links that a task finds in
    a group, those between cores that others have joined already say nothing new and are left out.
    """

    def work(askers: pa.Table, group: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        roots: dict[int, int] = {}

        def root(node: int) -> int:
            while (above := roots.get(node, node)) != node:
                roots[node] = roots.get(above, above)
                node = above
            return node

        if askers.num_rows and group.num_rows:
            own = [np.array(x, np.int64) for x in group["shared"].to_pylist()]
            cls, home, sizes = (group[c].to_numpy() for c in ("cls", "home", "n"))
            union, place = np.unique(np.concatenate(own), return_inverse=True)
            one_home = int(home[0]) if len(set(home.tolist())) == 1 else None
            who = np.repeat(np.arange(len(own)), [len(x) for x in own])[np.argsort(place, kind="stable")]
            bounds = np.append(0, np.cumsum(np.bincount(place, minlength=len(union))))
            for c, n, h, shared in zip(*(askers[x].to_pylist() for x in ("cls", "n", "home", "shared")), strict=True):
                if one_home is not None and root(h) == root(one_home):
                    continue
                asked = np.array(shared, np.int64)
                at = np.searchsorted(union, asked)
                at[at == len(union)] = 0
                at = at[union[at] == asked]
                if len(at) < rule.need(n):
                    continue
                lengths = bounds[at + 1] - bounds[at]
                where = np.repeat(bounds[at] - np.append(0, np.cumsum(lengths)[:-1]), lengths) + np.arange(lengths.sum())
                both = np.bincount(who[where], minlength=len(own))
                link = rule.linked(both, n, sizes) & (home != h) & (cls != c)
                for b in np.unique(home[link]).tolist():
                    one, other = root(h), root(b)
                    if one != other:
                        roots[max(one, other)] = min(one, other)
                        found.append((h, b))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    parts = asks.groupBy("grp").agg(F.ceil(F.count("*") / ASKERS).cast("int").alias("parts"))
    left = asks.join(parts, "grp").withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts").cast("long")).cast("int")).select("grp", "part", "cls")
    left = left.join(rows.select("cls", "n", "home", "shared"), "cls").groupBy("grp", "part")
    other = rows.toDF(*rows.columns)
    right = other.join(parts.toDF("grp", "parts"), "grp").select("grp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "cls", "n", "home", "shared").groupBy("grp", "part")
    return left.cogroup(right).applyInArrow(work, "a long, b long")


def links(docs: DataFrame, classes: DataFrame, size: int, rule: Rule) -> DataFrame:
    """Links (a, b) between classes that connect all classes that are linked at all."""
    hits = sieve(docs.select("text"), rule, size, 4)
    sets = sets_for(docs, sieved(classes, hits, rule, 4), size)
    left = sieved(sets, sieve(sets.select("own"), rule, size, 1), rule, 1)
    rows = grouped(cores(ordered_sets(left, rule), rule))
    found = opened(rows, qualifying(rows, rule), rule)
    return found.unionByName(rows.filter("home <> cls").select(F.col("cls").alias("a"), F.col("home").alias("b")))


def labelled(docs: DataFrame, size: int, percent: int, text: str, key: str) -> DataFrame:
    """(key, mark, n, group, component) of each row: its group, and the smallest key in it.

    ``mark`` is a hash of the text. A row with the empty set is a group with those that repeat it.
    """
    ship(docs.sparkSession)
    rule = Rule(percent)
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("key"), F.col(text).cast("string").alias("text"))
    # All that runs in Python is saved in here.
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        own = members(rows, size)
        classes = own.filter("cls is not null").groupBy("cls").agg(F.min("key").alias("key"), F.first("n").alias("n"))
        found = components(links(rows, classes, size, rule))
    named = classes.join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = named.groupBy("root").agg(F.min("key").alias("component"))
    named = named.join(least, "root").select("cls", "root", "component")
    group = F.coalesce("root", F.xxhash64(F.lit("empty"), "key", "mark"))
    return own.join(named, "cls", "left").select("key", "mark", "n", group.alias("group"), F.coalesce("component", "key").alias("component"))


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id``, the smallest key that links reach, for each row."""
    real = lambda c: F.nullif(F.col(c), F.lit(NO_KEY))
    return labelled(docs, size, percent, text, key).select(real("key").alias(key), F.col("n").alias("n_shingles"), real("component").alias("component_id"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest key, of equal keys that of one text."""
    groups = labelled(docs, size, percent, text, key)
    head = unused(docs, "_head")
    row = unused(docs, "_row")
    heads = groups.groupBy("group").agg(F.min(F.struct("key", "mark")).alias(head)).select(head).distinct()
    own = F.struct(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("key"), F.xxhash64(F.col(text).cast("string")).alias("mark"))
    kept = docs.withColumn(head, own).join(heads, head, "left_semi")
    repeat = F.row_number().over(Window.partitionBy(head).orderBy(F.xxhash64(*docs.columns)))
    return kept.withColumn(row, repeat).filter(F.col(row) == 1).select(*docs.columns)
