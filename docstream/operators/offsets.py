"""Offsets, commits and consumer lag as tables (A1-A4, J1, P12-P19, ST3, ST5, ST11, T1, W1-W3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from docstream.constants import DEFAULT_COMMIT_INTERVAL_MS
from docstream.functions.names import end_key, is_importer_group, lag_key
from docstream.operators.documents import is_accepted
from docstream.schema import LOG_POSITION

POSITION = list(LOG_POSITION)

# Offsets per block when a partition is cut for the gap search.
GAP_BLOCK = 1 << 20


def next_offset() -> Column:
    """Offset to read next once everything seen is done."""
    return F.max("offset") + F.lit(1)


def in_topics(topics: Sequence[str]) -> Column:
    return F.col("topic").isin(list(topics))


def end_offsets(log: DataFrame, topics: Sequence[str] | None = None) -> DataFrame:
    """End offset per (topic, partition) (A2)."""
    wanted = log if topics is None else log.filter(in_topics(topics))
    return wanted.groupBy(*POSITION).agg(next_offset().alias("end_offset"))


def end_offsets_by_name(log: DataFrame, topic: str) -> DataFrame:
    """End offsets of one topic under their rendered key."""
    return end_offsets(log, [topic]).select(
        end_key(F.col("topic"), F.col("partition")).alias("end_key"), "end_offset"
    )


def next_offsets(classified: DataFrame) -> DataFrame:
    """Next offset per (topic, partition) over accepted records (A1).

    A rejected record in the middle is passed over by the next accepted one of its partition.
    """
    return (
        classified.filter(is_accepted())
        .groupBy(*POSITION)
        .agg(next_offset().alias("next_offset"))
    )


def commit_ledger(
    classified: DataFrame, group_id: Column | str, seconds: int = DEFAULT_COMMIT_INTERVAL_MS // 1000
) -> DataFrame:
    """Commit rounds of a group: offsets become durable one round late (ST3, W2).

    A round is a window of ``seconds``. It closes at its end, and is published when the following
    round closes. A round without an accepted record commits nothing.
    """
    group = F.lit(group_id) if isinstance(group_id, str) else group_id
    ok = is_accepted()
    rounds = classified.groupBy(F.window("timestamp", f"{seconds} seconds").alias("w"), *POSITION).agg(
        (F.max(F.when(ok, F.col("offset"))) + 1).alias("next_offset"),
        F.count_if(ok).alias("n_ok"),
        F.count_if(~ok).alias("n_bad"),
    )
    return rounds.filter(F.col("next_offset").isNotNull()).select(
        group.alias("group_id"),
        F.col("w.start").alias("round"),
        *POSITION,
        "next_offset",
        (F.col("w.start") + F.make_dt_interval(secs=F.lit(2 * seconds))).alias("commit_at"),
        "n_ok",
        "n_bad",
    )


def committed_as_of(ledger: DataFrame, moment: Column) -> DataFrame:
    """Committed offset per (group, topic, partition) at a moment (ST3)."""
    return (
        ledger.filter(F.col("commit_at") <= moment)
        .groupBy("group_id", *POSITION)
        .agg(F.max("next_offset").alias("committed_offset"))
    )


def lag_report(
    committed: DataFrame,
    ends: DataFrame,
    topics: Sequence[str] | None = None,
    collection: str | None = None,
    include_uncommitted: bool = False,
) -> DataFrame:
    """Lag per (group, topic, partition) of every importer group (J1, ST11).

    Partitions a group has committed nothing for have no row, unless ``include_uncommitted``: then
    those of the topics it reads count from offset 0. Lag is kept raw and may be negative.
    """
    groups = committed.filter(is_importer_group(F.col("group_id")))
    if collection is not None:
        groups = groups.filter(F.split("group_id", ":")[1] == collection)
    if topics is not None:
        groups, ends = groups.filter(in_topics(topics)), ends.filter(in_topics(topics))
    if include_uncommitted:
        # Every group has to see every partition of the topics it reads.
        reads = groups.select("group_id", "topic").distinct()
        joined = (
            ends.join(reads, "topic")
            .join(groups, ["group_id", *POSITION], "left")
            .withColumn("committed_offset", F.coalesce("committed_offset", F.lit(0).cast("bigint")))
        )
    else:
        joined = groups.join(ends, POSITION)
    return joined.select(
        "group_id",
        *POSITION,
        "end_offset",
        "committed_offset",
        (F.col("end_offset") - F.col("committed_offset")).alias("lag"),
        lag_key(F.col("topic"), F.col("partition"), F.col("group_id")).alias("lag_key"),
    )


def lag_summary(lag: DataFrame) -> DataFrame:
    """One row: total lag, largest lag and the partition that has it (A3, A4).

    Equal lags are told apart by the later (topic, partition, group).
    """
    return lag.agg(
        F.coalesce(F.sum("lag"), F.lit(0).cast("bigint")).alias("total_lag"),
        F.max("lag").alias("max_partition_lag"),
        F.max_by("lag_key", F.struct("lag", *POSITION, "group_id")).alias("most_behind_partition"),
    )


def top_laggards(lag: DataFrame, k: int) -> DataFrame:
    """The k partitions furthest behind."""
    return lag.orderBy(F.desc("lag"), *POSITION, "group_id").limit(k)


def lag_history(log: DataFrame, ledger: DataFrame, seconds: int) -> DataFrame:
    """Total positive lag per (group, poll), polls every ``seconds``.

    The log is first brought down to one end offset per (topic, partition, poll interval). Running
    maxima go over the polls at which a partition moved; the changes of its lag are added up per
    group and poll, and only these sums are spread over all polls.
    """
    step = F.make_dt_interval(secs=F.lit(seconds))

    def poll_after(column: str) -> Column:
        # A record or commit shows at the first poll after it.
        return F.window(column, f"{seconds} seconds")["end"].alias("poll")

    ends = log.groupBy(*POSITION, poll_after("timestamp")).agg(next_offset().alias("end_step"))
    # A commit made exactly at a poll is seen by it, so its window is the one that ends there.
    commits = (
        ledger.withColumn("_at", F.col("commit_at") - F.expr("interval 1 microsecond"))
        .groupBy("group_id", *POSITION, poll_after("_at"))
        .agg(F.max("next_offset").alias("commit_step"))
    )
    readers = commits.select("group_id", *POSITION).distinct()
    moves = (
        ends.join(readers, POSITION)
        .unionByName(commits, allowMissingColumns=True)
        .groupBy("group_id", *POSITION, "poll")
        .agg(F.max("end_step").alias("end_step"), F.max("commit_step").alias("commit_step"))
    )
    so_far = Window.partitionBy("group_id", *POSITION).orderBy("poll")
    lag = F.greatest(F.max("end_step").over(so_far) - F.max("commit_step").over(so_far), F.lit(0))
    known = moves.withColumn("_lag", F.when(
        F.max("end_step").over(so_far).isNotNull() & F.max("commit_step").over(so_far).isNotNull(), lag
    )).filter(F.col("_lag").isNotNull())
    changes = known.select(
        "group_id", "poll", (F.col("_lag") - F.coalesce(F.lag("_lag").over(so_far), F.lit(0))).alias("change")
    ).groupBy("group_id", "poll").agg(F.sum("change").alias("change"))
    last = ends.agg(F.max("poll")).scalar()
    changes = changes.filter(F.col("poll") <= last)
    spread = changes.groupBy("group_id").agg(F.min("poll").alias("_first"))
    polls = spread.select("group_id", F.explode(F.sequence("_first", last, step)).alias("poll"))
    total = Window.partitionBy("group_id").orderBy("poll")
    return polls.join(changes, ["group_id", "poll"], "left").select(
        "group_id", "poll", F.sum(F.coalesce("change", F.lit(0))).over(total).alias("total_lag")
    )


def stall_count(history: DataFrame, expected: int, limit: int = 10, order: str = "poll") -> DataFrame:
    """Polls per group whose positive total lag did not move, and whether that is too many.

    The first poll is compared with ``expected``, the number of records sent. A poll without any
    lag entry (null total) counts as standing still and is passed over by the next comparison.
    """
    by_poll = Window.partitionBy("group_id").orderBy(order)
    before = by_poll.rowsBetween(Window.unboundedPreceding, -1)
    previous = F.coalesce(F.last("total_lag", ignorenulls=True).over(before), F.lit(expected))
    still = F.col("total_lag").isNull() | (
        (F.col("total_lag") > 0) & (F.col("total_lag") == previous)
    )
    # Polling ends at the first poll that has caught up.
    caught_up = F.coalesce(F.max(F.col("total_lag") <= 0).over(before), F.lit(False))
    return (
        history.select("group_id", order, "total_lag", still.alias("still"), caught_up.alias("over"))
        .groupBy("group_id")
        .agg(
            F.count_if(~F.col("over")).alias("n_polls"),
            F.count_if(F.col("still") & ~F.col("over")).alias("n_still"),
            (F.count_if(F.col("still") & ~F.col("over")) > limit).alias("stalled"),
        )
    )


def replay_window(log: DataFrame, committed: DataFrame) -> DataFrame:
    """Records read again after a crash: those at or above the committed offset (ST5, U2).

    A partition without a commit starts over. The join is planned from the sizes seen at its
    shuffle; nothing is kept between calls.
    """
    start = committed.select(*POSITION, "committed_offset")
    return (
        log.join(start, POSITION, "left")
        .filter(F.col("offset") >= F.coalesce("committed_offset", F.lit(0)))
        .drop("committed_offset")
    )


def offset_gaps(log: DataFrame, block: int = GAP_BLOCK) -> DataFrame:
    """Runs of missing offsets.

    The log is read once and brought down to words of 64 bits, one bit per offset seen; a record
    delivered twice sets its bit once. Gaps inside a word come from its bits, gaps between words
    from the next word of the same block of ``block`` offsets, gaps between blocks from their edges.
    Windows go over the words of a block and over blocks, never over the records of a partition.
    """
    key = [*POSITION, "_block"]
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("offset", F.lit(64)).cast("int"))
    words = (
        log.select(*POSITION, "offset", F.floor(F.col("offset") / block).alias("_block"))
        .groupBy(*key, F.shiftright("offset", 6).alias("_word"))
        .agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.bit_or(bit).alias("bits"))
    )
    pair = lambda a, b: F.struct(a.alias("offset"), b.alias("next_offset"))
    seen = F.filter(
        F.sequence("first", "last"), lambda o: F.getbit("bits", F.pmod(o, F.lit(64)).cast("int")) == 1
    )
    inside = F.when(
        F.bit_count("bits") <= F.col("last") - F.col("first"),
        F.zip_with(F.slice(seen, 1, F.size(seen) - 1), F.slice(seen, 2, F.size(seen)), pair),
    ).otherwise(F.array())
    within = Window.partitionBy(*key).orderBy("_word")
    after = F.array(pair(F.col("last"), F.lead("first").over(within)))
    of_words = words.select(*POSITION, F.concat(inside, after).alias("_pairs"))
    edges = words.groupBy(*key).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    along = Window.partitionBy(*POSITION).orderBy("_block")
    of_blocks = edges.select(
        *POSITION, F.array(pair(F.col("last"), F.lead("first").over(along))).alias("_pairs")
    )
    missing = F.col("next_offset") - F.col("offset") - 1
    return (
        of_words.unionByName(of_blocks)
        .select(*POSITION, F.inline("_pairs"))
        .filter(missing > 0)
        .withColumn("n_missing", missing)
    )


def seen_runs(log: DataFrame) -> DataFrame:
    """Runs of offsets without a gap, (first_offset, last_offset), per (topic, partition)."""
    gaps = offset_gaps(log).select(*POSITION, "offset", "next_offset")
    edges = log.groupBy(*POSITION).agg(F.min("offset").alias("least"), F.max("offset").alias("offset"))
    ends = gaps.unionByName(edges.drop("least").withColumn("next_offset", F.lit(None).cast("bigint")))
    along = Window.partitionBy(*POSITION).orderBy("offset")
    begun = ends.withColumn("begun", F.lag("next_offset").over(along))
    # Logs hold few topics and partitions beside their records.
    return begun.join(edges.drop("offset"), POSITION).select(
        *POSITION, F.coalesce("begun", "least").alias("first_offset"), F.col("offset").alias("last_offset")
    )


def merge_runs(runs: DataFrame) -> DataFrame:
    """Runs that touch or overlap as one, so replayed and late offsets count once.

    The window goes over the runs of a partition, of which there are as many as gaps and batches.
    """
    order = Window.partitionBy(*POSITION).orderBy("first_offset", "last_offset")
    reached = F.max("last_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first_offset") > reached + 1, F.lit(True))
    numbered = runs.withColumn("_opens", opens.cast("int")).withColumn("_run", F.sum("_opens").over(order))
    return numbered.groupBy(*POSITION, "_run").agg(
        F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset")
    ).drop("_run")


def gaps_between(runs: DataFrame) -> DataFrame:
    """Runs of missing offsets between runs of seen ones, as ``offset_gaps`` gives them of a log."""
    along = Window.partitionBy(*POSITION).orderBy("first_offset")
    ends = merge_runs(runs).select(*POSITION, F.col("last_offset").alias("offset"), F.lead("first_offset").over(along).alias("next_offset"))
    return ends.filter(F.col("next_offset").isNotNull()).withColumn("n_missing", F.col("next_offset") - F.col("offset") - 1)


def gap_totals(log: DataFrame) -> DataFrame:
    """Missing offsets per (topic, partition), from counts alone."""
    return log.groupBy(*POSITION).agg(
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count(F.lit(1)).alias("n_records"),
        (F.max("offset") - F.min("offset") + 1 - F.count(F.lit(1))).alias("n_missing"),
    )
