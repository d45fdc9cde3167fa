"""Quality rules as a short-circuit cascade.

A rule says which rows it rejects. On a sample, the time each rule takes alone and the share of rows it rejects
are measured; the cascade then asks the rules in the order of rejection per cost, and stops at the first that
rejects. Every rule reads the same row, so the order changes the cost, never the verdict.

Words are runs of characters other than white space (blank, tab to carriage return); lines end at a line feed.
A null or empty text has no words and fails the base check; repeated rows are judged each for itself; an empty
table gives an empty result; texts of any length are read whole. ``keep`` returns other columns as they are, whatever
their names; ``judge`` adds its columns and replaces those of the same names.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
WINDOW = 3
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Words of place holders and of pages that were not rendered.
FILLER = r"(?i)lorem ipsum|(enable|activate|turn on|requires) javascript|javascript is (disabled|required)"
#: Lines that a rule on lines asks for at least.
SEVERAL = 3
#: Rows on which costs and rejections are measured; they decide the order of the rules only.
SAMPLE_ROWS = 500


@dataclass(frozen=True)
class Rule:
    """``rejects`` reads the statistics and the columns ``text``, ``words`` and ``lines``."""

    name: str
    rejects: Column


def share(part: Column, whole: Column, percent: int) -> Column:
    """Whether ``part`` is more than so many percent of ``whole``."""
    return F.lit(100) * part > F.lit(percent) * whole


def several(part: Column, whole: Column, percent: int) -> Column:
    """Whether ``part`` is at least ``SEVERAL`` and more than so many percent of ``whole``."""
    return (part >= SEVERAL) & share(part, whole, percent)


def matching(items: Column, pattern: str) -> Column:
    return F.size(F.filter(items, lambda x: x.rlike(pattern)))


def default_rules() -> list[Rule]:
    """Public rules of thumb for web text, none of them bound to a language."""
    words, lines, n = F.col("words"), F.col("lines"), F.col("n_words")
    chars = F.col("word_chars")
    return [
        Rule("short_words", chars < 3 * n),
        Rule("long_words", chars > 10 * n),
        Rule("symbols", share(F.col("n_symbols"), n, 10)),
        # One repeated line among three says little.
        Rule("repeated_lines", (F.col("n_dup_lines") > 1) & share(F.col("n_dup_lines"), F.size(lines), 30)),
        Rule("few_letters", share(matching(words, r"^[^\p{L}]+$"), n, 20)),
        # A line or two say little in short texts, or in those of few long lines.
        Rule("ellipsis_lines", several(matching(lines, r"(\.\.\.|…)\s*$"), F.size(lines), 30)),
        Rule("bullet_lines", several(matching(lines, r"^\s*[-*•●]"), F.size(lines), 90)),
        Rule("filler", several(matching(lines, FILLER), F.size(lines), 10)),
    ]


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are worked out once, however often they are used."""
    made = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    rest = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*rest, F.explode(made).alias("_held")).select(*rest, *[F.col(f"_held.{n}").alias(n) for n in columns])


def _covered(starts: Column) -> Column:
    """Positions that windows starting at these rising positions cover."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    step = lambda a, x: F.struct((a["n"] + x + WINDOW - F.greatest(a["end"], x)).alias("n"), (x + WINDOW).alias("end"))
    return F.aggregate(starts, zero, step, lambda a: a["n"])


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``words``, ``lines`` and the base statistics of its whole texts."""
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = held(
        docs,
        words=F.filter(F.split(own, f"{SPACE}+"), lambda x: x != ""),
        lines=F.filter(F.split(own, "\n"), lambda x: x.rlike(WORD)),
    )
    words, n = F.col("words"), F.size("words")
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    df = held(df, windows=F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window)).otherwise(F.array().cast("array<bigint>")))
    windows = F.col("windows")
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = held(df, windows=F.when(F.size(F.array_distinct(windows)) < F.size(windows), placed))
    windows = F.col("windows")
    again = lambda x, k: F.when((F.get(windows, k - 1)["h"] == x["h"]) | (F.get(windows, k + 1)["h"] == x["h"]), x["i"])
    starts = F.sort_array(F.array_compact(F.transform(windows, again)))
    df = held(
        df,
        n_words=n.cast("long"),
        word_chars=F.length(F.array_join(words, "")).cast("long"),
        n_symbols=F.regexp_count(own, F.lit("[#*$%&|<>]")).cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        n_repeat_words=F.coalesce(_covered(starts), F.lit(0)).cast("long"),
    )
    return df.drop("windows")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def measure(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS, text: str = "text") -> dict[str, tuple[float, float]]:
    """(seconds a row, share of rows rejected) of each rule, alone, on ``sample_rows`` rows of ``docs``.

    The rows are the first that a few tasks find, so the rest of the table isn't read for them.
    """
    taken = docs.select(F.col(text).cast("string").alias("text")).head(sample_rows)
    # From Arrow, since a list of rows would start Python workers on every executor.
    rows = pa.table({"text": pa.array([row[0] for row in taken], pa.string())})
    sample = with_statistics(docs.sparkSession.createDataFrame(rows)).persist()
    try:
        total = max(sample.count(), 1)

        def timed(what: Column) -> tuple[float, int]:
            started = time.perf_counter()
            n = sample.select(F.count_if(what)).first()[0]
            return time.perf_counter() - started, n

        timed(F.lit(False))
        floor = timed(F.lit(False))[0]
        found = {}
        for rule in rules:
            seconds, n = timed(rule.rejects)
            found[rule.name] = (max(seconds - floor, 1e-4) / total, n / total)
        return found
    finally:
        sample.unpersist()


def ordered(rules: Sequence[Rule], measured: dict[str, tuple[float, float]]) -> list[Rule]:
    """Rules by rejection per cost, the best first."""
    return sorted(rules, key=lambda r: -measured[r.name][1] / measured[r.name][0])


def rejected_by(rules: Sequence[Rule]) -> Column:
    """Name of the first rule, in this order, that rejects a row; null if none does. Later rules are not asked."""
    first, *rest = rules
    case = F.when(first.rejects, F.lit(first.name))
    for rule in rest:
        case = case.when(rule.rejects, F.lit(rule.name))
    return case


def _judged(docs: DataFrame, rules: Sequence[Rule] | None, sample_rows: int, text: str) -> DataFrame:
    """``row``, a row of ``docs`` whole, beside what is worked out for it."""
    rules = list(default_rules() if rules is None else rules)
    rules = ordered(rules, measure(docs, rules, sample_rows, text)) if len(rules) > 1 else rules
    df = with_statistics(docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text")))
    df = held(df, base_failed=base_failed())
    verdict = F.when(F.col("base_failed"), F.lit("base")).otherwise(rejected_by(rules)) if rules else F.when(F.col("base_failed"), F.lit("base"))
    return held(df, rejected_by=verdict).withColumn("kept", F.col("rejected_by").isNull())


def judge(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS, text: str = "text") -> DataFrame:
    """``docs`` with the base statistics, ``base_failed``, ``rejected_by`` and ``kept``."""
    made = (*STATISTICS, "base_failed", "rejected_by", "kept")
    rest = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in made]
    return _judged(docs, rules, sample_rows, text).select(*rest, *made)


def keep(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that neither the base check nor a rule rejects."""
    return _judged(docs, rules, sample_rows, text).filter("kept").select("row.*")
