"""Manifest trees against a tree built in memory."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from docstream.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def said(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, place):
    """The top of ``nodes`` and the siblings on the way from ``place``."""
    beside = []
    while len(nodes) > 1:
        first = place - place % 3
        beside += [n for k, n in enumerate(nodes[first : first + 3], first) if k != place]
        nodes, place = [sha("".join(nodes[k : k + 3])) for k in range(0, len(nodes), 3)], place // 3
    return nodes[0], beside


def brute(rows):
    """(key, leaf, subroot, root, proof) by (group, key, leaf) of rows (group, key, leaf)."""
    groups = {}
    for g, key, leaf in rows:
        groups.setdefault(g, []).append((key is not None, key or 0, leaf, key))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops = [climb([x[2] for x in sorted(groups[g])], 0)[0] for g in names]
    found = []
    for at, g in enumerate(names):
        members = sorted(groups[g], key=lambda x: x[:3])
        for place, (_, _, leaf, key) in enumerate(members):
            top, beside = climb([x[2] for x in members], place)
            root, more = climb(tops, at)
            found.append((key, leaf, top, root, sha("".join(beside + more))))
    return found


COLUMNS = ("key", "leaf", "subroot", "root", "proof_sha256")


def check(frame, rows):
    df = frame(rows, "source string, doc_id long, text string").withColumn("g", F.lit(7)).withColumn("rank", F.lit("x")).withColumn("n", F.lit(None))
    found = merkle.manifest(df, "source", "doc_id", merkle.leaf(["doc_id", "text"])).collect()
    leaves = [(g, key, said(key, text)) for g, key, text in rows]
    assert sorted((tuple(r[c] for c in COLUMNS) for r in found), key=repr) == sorted(brute(leaves), key=repr)
    assert all(r["folded_root"] == r["root"] for r in found)


def test_sizes_groups_nulls_ties_and_repeats(spark, frame):
    rows = [("hot", k, f"text {k}") for k in range(2300)]
    rows += [(g, k, None) for n, g in ((1, "one"), (2, "two"), (3, None), (4, ""), (28, "é")) for k in range(n)]
    rows += [("tie", 5, t) for t in ("b", "a", "a", "", None)] + [("tie", None, "x"), ("tie", None, "x"), ("tie", -3, "long " * 20_000)]
    random.Random(1).shuffle(rows)
    check(frame, rows)


@pytest.mark.parametrize("rows", [[("a", 1, "x")], [(None, None, None)], [("a", 1, "x"), ("b", 1, "x")], [("a", 1, "same")] * 40])
def test_small_trees(spark, frame, rows):
    check(frame, rows)


def test_many_groups_make_a_tree_of_their_own(spark, frame):
    check(frame, [(f"s{k}", 0, "x") for k in range(900)])


def test_empty_table(spark, frame):
    assert merkle.manifest(frame([], "source string, doc_id long, text string"), "source", "doc_id", merkle.leaf(["text"])).count() == 0


def test_another_leaf_is_folded_up(spark, frame):
    rows = [("a", k, f"t{k}") for k in range(800)]
    df = frame(rows, "source string, doc_id long, text string")
    other = F.when(F.col("doc_id") == 737, merkle.leaf(["doc_id", F.lit("new")]))
    found = {r["key"]: r for r in merkle.manifest(df, "source", "doc_id", merkle.leaf(["doc_id", "text"]), other).collect()}
    changed = [said(k, "new" if k == 737 else f"t{k}") for k in range(800)]
    assert found[737]["folded_root"] == climb(changed, 0)[0] != found[737]["root"]
    assert all(r["folded_root"] == r["root"] for k, r in found.items() if k != 737)


def test_states_are_kept_before_each_child():
    nodes = [sha(str(k)) for k in range(20)]
    part = merkle.Part(nodes, merkle.levels_of(20))
    assert part.top() == climb(nodes, 0)[0]
    for place in range(20):
        swapped = [*nodes[:place], "other", *nodes[place + 1 :]]
        assert part.fold(place, b"other").decode() == climb(swapped, 0)[0]
    for level, states in enumerate(part.states):
        for parent, before in enumerate(states):
            children = part.tiers[level][parent * 3 : parent * 3 + 3]
            assert [s.hexdigest() for s in before] == [hashlib.sha256(b"".join(children[:k])).hexdigest() for k in range(len(children))]
