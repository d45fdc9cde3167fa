"""Settings of an ingest job, checked before anything runs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from docstream.constants import DEFAULT_COMMIT_INTERVAL_MS, DEFAULT_POLL_INTERVAL_MS
from docstream.functions.codecs import check_format

# Defaults of ``max_per_trigger``: bounds of one micro-batch, so that a backlog of any size is worked off in steps.
MAX_OFFSETS_PER_TRIGGER = 50_000_000
MAX_FILES_PER_TRIGGER = 2_000


def parse_topics(topics: str | list[str] | tuple[str, ...]) -> tuple[str, ...]:
    """Topic list from a comma list or a sequence; blanks are trimmed, empties dropped."""
    names = topics.split(",") if isinstance(topics, str) else topics
    return tuple(dict.fromkeys(name.strip() for name in names if name and name.strip()))


@dataclass(frozen=True)
class IngestConfig:
    """One ingest job: where records come from and which collection they update."""

    collection: str
    topics: tuple[str, ...]
    source: str
    store: str
    source_kind: str = "parquet"
    format: str = "json"
    schema: T.StructType | str | None = None
    routing: str = "hash"
    num_shards: int = 1
    clustered: bool = True
    core: str | None = None
    starting_offsets: str = "earliest"
    max_per_trigger: int | None = None
    commit_interval_ms: int = DEFAULT_COMMIT_INTERVAL_MS
    poll_interval_ms: int = DEFAULT_POLL_INTERVAL_MS
    available_now: bool = False
    # Field of a document that holds its id; without one, or where it is empty, the record key is the id.
    id_field: str | None = None
    # Keep which offsets every batch held, so that gaps are told without reading the log.
    track_offsets: bool = False
    # Buckets of the first snapshot, by default one per shard; ``compact`` can be told a new number.
    buckets: int | None = None
    kafka_options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        object.__setattr__(self, "topics", parse_topics(self.topics))
        if not self.collection:
            raise ValueError("a collection name is required")
        if not self.topics:
            raise ValueError("at least one topic is required")
        if not self.source:
            raise ValueError("a source (bootstrap servers or log path) is required")
        if not self.store:
            raise ValueError("a store path is required")
        if self.source_kind not in ("parquet", "kafka"):
            raise ValueError(f"Unknown source kind: {self.source_kind}")
        if self.routing not in ("hash", "all"):
            raise ValueError(f"Unknown routing: {self.routing}")
        if self.routing == "all" and not self.clustered:
            raise ValueError("all-shard routing needs a clustered collection")
        if self.starting_offsets not in ("earliest", "latest"):
            raise ValueError(f"Unknown starting offsets: {self.starting_offsets}")
        object.__setattr__(self, "format", check_format(self.format))
        for name in ("num_shards", "commit_interval_ms", "poll_interval_ms", "buckets", "max_per_trigger"):
            if getattr(self, name) is not None and getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")

    @property
    def all_shards(self) -> bool:
        return self.routing == "all"

    @property
    def checkpoint(self) -> str:
        return f"{self.store}/checkpoint"

    @property
    def batch_limit(self) -> int:
        if self.max_per_trigger is not None:
            return self.max_per_trigger
        return MAX_OFFSETS_PER_TRIGGER if self.source_kind == "kafka" else MAX_FILES_PER_TRIGGER

    def with_options(self, **changes) -> IngestConfig:
        return replace(self, **changes)

    @classmethod
    def from_settings(
        cls, settings: Mapping[str, str], collection: str, store: str, **more
    ) -> IngestConfig:
        """Read the eight named string settings of a configuration file."""
        for name in ("topicNames", "kafkaBroker"):
            if not settings.get(name):
                raise ValueError(f"{name} is required")
        known = dict(
            topics=parse_topics(settings["topicNames"]),
            source=settings["kafkaBroker"],
            source_kind="kafka",
            format=settings.get("incomingDataType", "json"),
            commit_interval_ms=int(settings.get("commitInterval", DEFAULT_COMMIT_INTERVAL_MS)),
            routing="all" if settings.get("ignoreShardRouting", "false").lower() == "true" else "hash",
            poll_interval_ms=int(settings.get("kafkaPollInterval", DEFAULT_POLL_INTERVAL_MS)),
            starting_offsets=_starting_offsets(settings.get("autoOffsetResetConfig", "beginning")),
            # A limit per poll of one consumer, not per batch.
            kafka_options={"kafka.max.poll.records": str(int(settings["kafkaPollRecords"]))}
            if "kafkaPollRecords" in settings
            else {},
        )
        return cls(collection=collection, store=store, **{**known, **more})


def _starting_offsets(word: str) -> str:
    words = {"beginning": "earliest", "earliest": "earliest", "latest": "latest"}
    if word.lower() not in words:
        raise ValueError(f"Unknown starting offsets: {word}")
    return words[word.lower()]
