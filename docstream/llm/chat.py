"""Preference formatting of conversations.

A chosen and a rejected conversation share their first turns. The longest common prefix of turns is rendered
once as the prompt; each remainder is rendered as a completion with the spans of characters that count in the
loss: what the assistant says after the prompt, with its end mark. All of it is built from array functions.

A turn is (role, text). A null role or text counts as empty; equal turns are equal in both. If one conversation
is a prefix of the other, its completion is empty and has no spans. A pair with a null conversation has an empty
one. Repeated pairs are formatted each for itself; an empty table gives an empty result; other columns are
dropped, so names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SPLIT, END = "<|im_start|>", "\n", "<|im_end|>\n"
TURNS = "array<struct<role:string,text:string>>"


def turns_of(table: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation: ``key`` and ``turns``, ordered by turn, then role and text. Null keys are no conversation."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = table.filter(F.col(key).isNotNull()).select(key, turn.alias("_turn"))
    kept = F.transform(F.array_sort(F.collect_list("_turn")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return rows.groupBy(key).agg(kept.cast(TURNS).alias("turns"))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of first turns that are equal in both."""
    differs = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))
    return F.coalesce(F.nullif(F.array_position(differs, True), F.lit(0)) - 1, F.size(differs)).cast("int")


def rendered(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.concat(F.lit(START), t["role"], F.lit(SPLIT), t["text"], F.lit(END)))


def rest_of(turns: Column, n: Column) -> Column:
    return F.slice(turns, n + 1, F.greatest(F.size(turns) - n, F.lit(0)))


def loss_spans(turns: Column, role: str = "assistant") -> Column:
    """Character spans (start, end) of what ``role`` says in the rendered turns, end marks included."""
    head = lambda t: F.length(t["role"]) + F.lit(len(START) + len(SPLIT))
    body = lambda t: F.length(t["text"]) + F.lit(len(END))
    spans = "array<struct<start:int,end:int>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("spans"))

    def step(a: Column, t: Column) -> Column:
        start = a["at"] + head(t)
        own = F.array(F.struct(start.alias("start"), (start + body(t)).alias("end")))
        return F.struct((start + body(t)).alias("at"), F.when(t["role"] == role, F.concat(a["spans"], own)).otherwise(a["spans"]).alias("spans"))

    return F.aggregate(turns, zero, step, lambda a: a["spans"])


def format_preferences(pairs: DataFrame, key: str, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``key``, ``n_prompt_turns``, ``prompt``, and for both sides the completion and its loss spans."""
    clean = lambda c: F.transform(F.coalesce(F.col(c).cast(TURNS), F.array().cast(TURNS)), lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    df = pairs.select(F.col(key), clean(chosen).alias("_chosen"), clean(rejected).alias("_rejected"))
    df = df.withColumn("n_prompt_turns", common_prefix(F.col("_chosen"), F.col("_rejected")))
    n = F.col("n_prompt_turns")
    df = df.select(key, "n_prompt_turns", F.slice("_chosen", 1, n).alias("_prompt"), rest_of(F.col("_chosen"), n).alias("_chosen"), rest_of(F.col("_rejected"), n).alias("_rejected"))
    text = lambda c: F.array_join(rendered(F.col(c)), "")
    return df.select(
        key,
        "n_prompt_turns",
        text("_prompt").alias("prompt"),
        text("_chosen").alias("chosen"),
        loss_spans(F.col("_chosen")).alias("chosen_spans"),
        text("_rejected").alias("rejected"),
        loss_spans(F.col("_rejected")).alias("rejected_spans"),
    )


def reply_pairs(table: DataFrame) -> DataFrame:
    """Pairs (``conv_id``, ``chosen``, ``rejected``) made of a table of conversations.

    Chosen is the conversation up to its last assistant turn; rejected is the same with that turn replaced by the
    last assistant turn of its neighbour, conv_id xor 1. No pair where either has none. One join by an id, so a
    first turn that many conversations share weighs on no task.
    """
    turns = F.col("turns")
    last = F.size(turns) - F.array_position(F.reverse(F.transform(turns, lambda t: t["role"] == "assistant")), True).cast("int") + 1
    rows = turns_of(table).withColumn("_last", F.when(F.exists(turns, lambda t: t["role"] == "assistant"), last)).filter(F.col("_last").isNotNull())
    rows = rows.select("conv_id", F.slice("turns", 1, F.col("_last")).alias("chosen"))
    other = rows.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.element_at("chosen", -1).alias("_reply"))
    kept = F.slice("chosen", 1, F.size("chosen") - 1)
    return rows.join(other, "conv_id").select("conv_id", "chosen", F.concat(kept, F.array("_reply")).alias("rejected"))
