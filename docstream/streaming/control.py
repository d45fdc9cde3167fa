"""Start, stop and status of an ingest job (ST6, ST8-ST10)."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from docstream.config import IngestConfig
from docstream.constants import (
    NOT_INITIALIZED,
    RUNNING,
    STARTED_MESSAGE,
    STOPPED,
    STOPPING_MESSAGE,
    UNKNOWN_MESSAGE,
)
from docstream.functions.names import group_name
from docstream.operators.offsets import end_offsets, in_topics, lag_report, replay_window
from docstream.operators.routing import check_mode, is_eligible
from docstream.sources.record_log import read_log
from docstream.sources.zone_map import ZoneMap
from docstream.streaming.ingest import Transform, drain, start_query, store_of
from docstream.streaming.store import CollectionStore


def ingest_status(
    lag: DataFrame,
    status: Column | str,
    core: str | None = None,
    should_run: bool = False,
    leader: bool = True,
    eligible: bool = True,
) -> DataFrame:
    """One row: state of the job, lag of every partition and the furthest behind (ST10)."""
    state = F.lit(status) if isinstance(status, str) else status
    entries = F.array_sort(F.collect_list(F.struct("lag_key", "lag")))
    return lag.agg(
        F.map_from_entries(entries).alias("consumer_group_lag"),
        F.coalesce(F.sum("lag"), F.lit(0).cast("bigint")).alias("total_lag"),
        F.max("lag").alias("max_partition_lag"),
        F.max_by("lag_key", F.struct("lag", "topic", "partition", "group_id")).alias(
            "most_behind_partition"
        ),
    ).select(
        F.lit(core).cast("string").alias("current_core"),
        state.alias("status"),
        "consumer_group_lag",
        "total_lag",
        "max_partition_lag",
        "most_behind_partition",
        F.lit(should_run).alias("should_run"),
        F.lit(leader).alias("leader"),
        F.lit(eligible).alias("eligible"),
    )


def reported_ends(spark: SparkSession, latest: str) -> DataFrame:
    """End offsets out of a progress report, ``{"topic": {"partition": offset}}`` (A2)."""
    report = spark.createDataFrame([(latest,)], "latest string").select(
        F.from_json("latest", "map<string,map<string,bigint>>").alias("topics")
    )
    return report.select(F.explode("topics").alias("topic", "ends")).select(
        "topic", F.explode("ends").alias("partition", "end_offset")
    ).withColumn("partition", F.col("partition").cast("int"))


@dataclass(frozen=True)
class DrainReport:
    """Why a watched drain ended, and the total lag at each of its polls."""

    reason: str
    polls: list[tuple[int, int]]
    n_still: int
    collection: str

    def history(self, spark: SparkSession) -> DataFrame:
        """The polls, by group, as ``stall_count`` takes them."""
        rows = spark.createDataFrame(self.polls, "poll bigint, total_lag bigint")
        return rows.select(group_name(F.lit(self.collection)).alias("group_id"), "poll", "total_lag")


class Ingest:
    """Handle of one collection's ingest job."""

    def __init__(
        self,
        spark: SparkSession,
        config: IngestConfig,
        targets: DataFrame | None = None,
        transform: Transform | None = None,
        stream: DataFrame | None = None,
        log: DataFrame | None = None,
    ) -> None:
        """``stream`` and ``log`` replace the configured source by other record-log columns."""
        self.spark = spark
        self.config = config
        self.targets = targets
        self.transform = transform
        self.stream = stream
        self.log = log

    @property
    def store(self) -> CollectionStore:
        return store_of(self.spark, self.config)

    def query(self) -> StreamingQuery | None:
        """The running query of this collection, if any (ST9)."""
        for query in self.spark.streams.active:
            if query.name == self.config.collection:
                return query
        return None

    def state(self) -> str:
        if self.query() is not None:
            return RUNNING
        return NOT_INITIALIZED if self.store.run_state() == NOT_INITIALIZED else STOPPED

    def start(self) -> StreamingQuery:
        """Start the job, or return the one that runs already.

        A job of the same collection in another session is fenced off: its next batch fails.
        """
        if self.targets is not None:
            check_mode(self.targets, self.config.collection, self.config.all_shards)
        running = self.query()
        if running is not None:
            return running
        self.store.set_run_state(RUNNING)
        epoch = self.store.claim_epoch()
        return start_query(self.spark, self.config, self.transform, self.stream, epoch)

    def stop(self) -> None:
        """Stop the job; nothing happens when it does not run."""
        self.store.set_run_state(STOPPED)
        running = self.query()
        if running is not None:
            running.stop()

    def resume(self) -> StreamingQuery | None:
        """After a restart: go on if the job was last asked to run (ST6)."""
        return self.start() if self.store.run_state() == RUNNING else None

    def run_to_end(self) -> None:
        """Work off everything the source holds now, then stop (ST7).

        After a failure the job still counts as running, so ``resume`` takes it up again.
        """
        once = self.config.with_options(available_now=True)
        query = Ingest(self.spark, once, self.targets, self.transform, self.stream).start()
        query.awaitTermination()
        self.store.set_run_state(STOPPED)

    def drain(self) -> None:
        running = self.query()
        if running is not None:
            drain(running)

    def drain_watched(self, limit: int = 10, poll_seconds: float | None = None, expected: int = 0) -> DrainReport:
        """Poll the job's lag until it has caught up or stands still (W1, ST7).

        A poll stands still if the total lag is positive and that of the poll before, the first one
        ``expected``. More than ``limit`` such polls in all end the drain; the job is left as it is.
        Polls are ``poll_seconds`` apart, by default the commit interval. The report holds the polls
        in the form that ``stall_count`` takes.
        """
        pause = self.config.commit_interval_ms / 1000 if poll_seconds is None else poll_seconds
        polls: list[tuple[int, int]] = []
        previous, still = expected, 0
        while True:
            total = self.lag().agg(F.coalesce(F.sum(F.greatest("lag", F.lit(0))), F.lit(0))).first()[0]
            polls.append((len(polls), total))
            still += total > 0 and total == previous
            previous = total
            if total <= 0:
                return DrainReport("caught up", polls, still, self.config.collection)
            if still > limit:
                return DrainReport("stalled", polls, still, self.config.collection)
            running = self.query()
            if running is None or running.exception() is not None:
                return DrainReport("not running", polls, still, self.config.collection)
            time.sleep(pause)

    def lag(self, include_uncommitted: bool = True) -> DataFrame:
        """Lag of the collection's group against the end of its log (ST11)."""
        committed = self.store.committed()
        if committed is None:
            committed = self.spark.createDataFrame(
                [], "group_id string, topic string, partition int, committed_offset bigint"
            )
        ends = self.end_offsets(committed)
        if include_uncommitted:
            # The job's own group reads every partition of its topics, from the first record on.
            core = F.lit(self.config.core) if self.config.core else None
            group = group_name(F.lit(self.config.collection), core, self.config.all_shards)
            committed = (
                committed.unionByName(
                    ends.select(
                        group.alias("group_id"),
                        "topic",
                        "partition",
                        F.lit(0).cast("bigint").alias("committed_offset"),
                    )
                )
                .groupBy("group_id", "topic", "partition")
                .agg(F.max("committed_offset").alias("committed_offset"))
            )
        return lag_report(committed, ends, self.config.topics)

    def end_offsets(self, committed: DataFrame) -> DataFrame:
        """Ends of the log (A2).

        From Kafka they are what the running query was last told, else the log is read from the
        committed offsets on, never from its start. A parquet log has a zone map in the store: the
        offsets of a file are read once, when it is new.
        """
        if self.log is not None:
            return end_offsets(self.log, self.config.topics)
        if self.config.source_kind == "parquet":
            return self.zone_map().extend().end_offsets(self.config.topics)
        running = self.query()
        if running is not None and running.lastProgress is not None:
            return reported_ends(self.spark, running.lastProgress.sources[0].latestOffset)
        rest = end_offsets(read_log(self.spark, self.config, committed), self.config.topics)
        known = committed.groupBy("topic", "partition").agg(
            F.max("committed_offset").alias("end_offset")
        )
        return rest.unionByName(known).groupBy("topic", "partition").agg(
            F.max("end_offset").alias("end_offset")
        )

    def zone_map(self) -> ZoneMap:
        """Offsets by file of the configured parquet log."""
        return ZoneMap(self.spark, self.config.source, f"{self.config.store}/zone_map")

    def replay(self) -> DataFrame:
        """Records that would be read again after a crash, from the files that hold some (ST5)."""
        committed = self.store.committed()
        if committed is None:
            return read_log(self.spark, self.config)
        if self.config.source_kind != "parquet":
            return replay_window(read_log(self.spark, self.config, committed), committed)
        return self.zone_map().extend().replay(committed).filter(in_topics(self.config.topics))

    def _core_flag(self, flag: Column, default: bool) -> bool:
        if self.targets is None or self.config.core is None:
            return default
        mine = self.targets.filter(F.col("core") == self.config.core).select(flag).first()
        return default if mine is None else bool(mine[0])

    def status(self) -> DataFrame:
        return ingest_status(
            self.lag(),
            self.state(),
            self.config.core,
            self.store.run_state() == RUNNING,
            self._core_flag(F.col("is_leader"), True),
            self._core_flag(is_eligible(self.config.all_shards, self.config.clustered), True),
        )

    def act(self, action: str | None = None) -> dict:
        """Carry out an action by name; without one, ``status`` if the job should run, else ``start``."""
        if action is None:
            action = "status" if self.store.run_state() == RUNNING else "start"
        name = action.lower()
        if name == "start":
            self.start()
            return {"message": STARTED_MESSAGE, "running": True}
        if name == "stop":
            self.stop()
            return {"message": STOPPING_MESSAGE, "running": False}
        if name == "status":
            return self.status().first().asDict(recursive=True)
        return {"message": UNKNOWN_MESSAGE}


def lag_of_groups(jobs: Sequence[Ingest]) -> DataFrame:
    """Lag of the importer groups of several collections in one report (ST11)."""
    return reduce(DataFrame.unionByName, [job.lag() for job in jobs])
