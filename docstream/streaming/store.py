"""A collection on disk: record batches, snapshots and completion marks.

    records/batch_id=K/accepted=true   decoded records of one batch, every version
    records/batch_id=K/accepted=false  records of the batch that were set aside
    commit_ledger/batch_id=K           next offset per (topic, partition)
    batches/batch_id=K                 one row, written last: the batch is complete, with its columns
    snapshot/gen=G                     last arrivals per document and partition, bucketed by key
    folded/commit_ledger/gen=G         commit rows of the batches since the generation before
    folded/quarantine/gen=G            records set aside in those batches
    folded/committed/gen=G             committed offset per (group, topic, partition) so far
    generations/gen=G                  one row, written last: the generation is complete
    run_state                          what was last asked for: RUNNING or STOPPED
    seen/batch_id=K                    runs of offsets of one batch, where they are tracked
    folded/seen/gen=G                  runs of offsets of all batches so far
    epochs/N                           an empty file for every start; batches of an older one are refused
    zone_map                           offsets by file of the parquet log that the job reads

A batch is written in one pass, without a shuffle; the newest version per key is worked out where
it is read, and for good by ``compact``, which also folds what batches committed and set aside, so
that readers open only the folders of later batches. Every folder is written once or replaced as a whole by a
repeat of the same batch, so a batch that failed half-way leaves nothing that a reader would take.
There is no rename or lock to rely on.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.utils import AnalysisException

from docstream.constants import NOT_INITIALIZED
from docstream.operators.offsets import gaps_between, merge_runs
from docstream.operators.routing import every_shard
from docstream.operators.upsert import between_partitions, latest_per_partition, merge_latest
from docstream.session import shuffle_partitions


def files_exist(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


class FencedError(RuntimeError):
    """A batch of a job that another one has taken over from."""


def merged_type(old: T.DataType, new: T.DataType, name: str = "document") -> T.DataType:
    """A type that holds values of both: fields of structs are joined by name.

    Anything else has to be the same in both, or the change is refused.
    """
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        known = {f.name: f.dataType for f in old.fields}
        fields = dict(known)
        for field in new.fields:
            kept = known.get(field.name, field.dataType)
            fields[field.name] = merged_type(kept, field.dataType, f"{name}.{field.name}")
        return T.StructType([T.StructField(n, t) for n, t in fields.items()])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged_type(old.elementType, new.elementType, f"{name}[]"))
    if old != new:
        raise ValueError(f"{name} was stored as {old.simpleString()}, not {new.simpleString()}")
    return old


def widened(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """A value as a type that has all its fields; the others are null."""
    if old == new:
        return value
    if isinstance(new, T.StructType):
        known = {f.name: f.dataType for f in old.fields}
        fields = [
            (
                widened(value[f.name], known[f.name], f.dataType)
                if f.name in known
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in new.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(new, T.ArrayType):
        return F.transform(value, lambda x: widened(x, old.elementType, new.elementType))
    return value.cast(new)


def with_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly these columns, filled in by name at every depth."""
    known = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (
                widened(F.col(f.name), known[f.name], f.dataType)
                if f.name in known
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )


class CollectionStore:
    """Readers and writers of one collection's folders."""

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        buckets: int | None = None,
        all_shards: bool = False,
        num_shards: int = 1,
    ) -> None:
        self.spark = spark
        self.base = base.rstrip("/")
        self.buckets = buckets
        self.all_shards = all_shards
        self.num_shards = num_shards

    def path(self, part: str) -> str:
        return f"{self.base}/{part}"

    def _read(self, part: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path(part))
        except AnalysisException as missing:
            if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    # One writer at a time ----------------------------------------------------------------------

    def _epochs(self) -> list[int]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path("epochs"))
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        return [int(status.getPath().getName()) for status in files.listStatus(folder)]

    def claim_epoch(self) -> int:
        """A number higher than any before, held by an empty file that only one caller can create."""
        files = None
        epoch = max(self._epochs(), default=0) + 1
        while True:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(f"epochs/{epoch}"))
            files = files or path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            if files.createNewFile(path):
                return epoch
            epoch += 1

    def check_epoch(self, epoch: int) -> None:
        """Raise if a job was started on this collection after the one that holds ``epoch``."""
        newest = max(self._epochs(), default=0)
        if newest > epoch:
            raise FencedError(f"epoch {epoch} of {self.base} has ended: epoch {newest} was started")

    # Writing one batch -------------------------------------------------------------------------

    def write_records(self, rows: DataFrame, batch_id: int) -> None:
        (
            rows.write.mode("overwrite")
            .partitionBy("accepted")
            .parquet(self.path(f"records/batch_id={batch_id}"))
        )

    def records(
        self, after: int, through: int, schema: T.StructType | None = None
    ) -> DataFrame | None:
        """What was written for some batches, complete or not.

        They are read with the columns of all of them together, so that fields declared later are
        there, and null where a batch did not have them.
        """
        schema = self.columns(after, through) if schema is None else schema
        rows = None if schema is None else self._batch_rows("records", after, through, schema)
        # The value comes out of a folder name, as text; batches without a record have no such folder.
        if rows is None or "accepted" not in rows.columns:
            return None
        return rows.withColumn("accepted", F.col("accepted").cast("boolean"))

    def columns(self, after: int = -1, through: int | None = None) -> T.StructType | None:
        """Columns of complete batches, joined by name; None without a batch."""
        through = self.last_batch() if through is None else through
        marks = self._batch_rows("batches", after, through)
        if marks is None:
            return None
        found = marks.groupBy("columns").agg(F.min("batch_id").alias("n")).orderBy("n").collect()
        return reduce(merged_type, [T.StructType.fromDDL(row["columns"]) for row in found])

    def check_schema(self, doc: T.DataType) -> None:
        """Raise if documents of this type can't be kept beside those that are stored."""
        generation = self.generation()
        after = -1 if generation is None else generation["compacted_through"]
        kept = [self.columns(after)]
        if generation is not None:
            kept.append(T.StructType.fromDDL(generation["columns"]))
        for columns in kept:
            if columns is not None:
                merged_type(columns["doc"].dataType, doc)

    def write_ledger(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(self.path(f"commit_ledger/batch_id={batch_id}"))

    def write_seen(self, runs: DataFrame, batch_id: int) -> None:
        runs.write.mode("overwrite").parquet(self.path(f"seen/batch_id={batch_id}"))

    def batch_positions(self, batch_id: int) -> list[tuple[str, int]]:
        """The (topic, partition) pairs of a batch's commit record."""
        rows = self.spark.read.parquet(self.path(f"commit_ledger/batch_id={batch_id}"))
        return [tuple(row) for row in rows.select("topic", "partition").distinct().collect()]

    def complete_batch(self, batch_id: int, started_ms: int, columns: T.StructType) -> None:
        """Mark a batch complete, with its counts, times and columns."""
        (
            self.spark.read.parquet(self.path(f"commit_ledger/batch_id={batch_id}"))
            .agg(
                F.coalesce(F.sum("n_ok"), F.lit(0)).alias("n_ok"),
                F.coalesce(F.sum("n_bad"), F.lit(0)).alias("n_bad"),
            )
            .select(
                "n_ok",
                "n_bad",
                F.timestamp_millis(F.lit(started_ms)).alias("started_at"),
                F.current_timestamp().alias("finished_at"),
                F.lit(columns.toDDL()).alias("columns"),
            )
            .write.mode("overwrite")
            .parquet(self.path(f"batches/batch_id={batch_id}"))
        )

    # Reading -----------------------------------------------------------------------------------

    def batches(self) -> DataFrame | None:
        """Complete batches: counts and times, one row each (A10)."""
        return self._read("batches")

    def last_batch(self) -> int:
        """Highest complete batch, -1 before the first. Batches complete in order.

        Told by the names of the completion marks; none of them is opened.
        """
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path("batches"))
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return -1
        last = -1
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            mark = self.spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if name.startswith("batch_id=") and int(name[9:]) > last and files.exists(mark):
                last = int(name[9:])
        return last

    def generation(self) -> Row | None:
        """The newest complete snapshot: gen, compacted_through, buckets, columns."""
        generations = self._read("generations")
        if generations is None:
            return None
        return generations.orderBy(F.desc("gen")).first()

    def _batch_paths(self, part: str, after: int, through: int) -> list[str]:
        return [self.path(f"{part}/batch_id={k}") for k in range(after + 1, through + 1)]

    def _batch_rows(
        self, part: str, after: int, through: int, schema: T.StructType | None = None
    ) -> DataFrame | None:
        """Rows of complete batches; only their folders are listed."""
        paths = self._batch_paths(part, after, through)
        if not paths:
            return None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        try:
            return reader.option("basePath", self.path(part)).parquet(*paths)
        except AnalysisException as empty:
            # Batches without an accepted record have no files.
            if empty.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return None
            raise

    def _folded(self, part: str, generation: Row | None) -> DataFrame | None:
        """Rows folded into the generations up to one."""
        if generation is None:
            return None
        numbers = range(generation["gen"] + 1)
        return self._together(*[self._read(f"folded/{part}/gen={k}") for k in numbers])

    @staticmethod
    def _together(*parts: DataFrame | None) -> DataFrame | None:
        found = [part for part in parts if part is not None]
        if not found:
            return None
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)

    def _since(self, generation: Row | None) -> int:
        return -1 if generation is None else generation["compacted_through"]

    def changelog(self, after: int = -1, through: int | None = None) -> DataFrame | None:
        """Accepted records of complete batches, every version (DM4)."""
        rows = self.records(after, self.last_batch() if through is None else through)
        if rows is None:
            return None
        return rows.filter(F.col("accepted")).drop(
            "batch_id", "accepted", "value", "error_class", "error_detail"
        )

    def _set_aside(self, after: int, through: int) -> DataFrame | None:
        rows = self.records(after, through)
        return None if rows is None else rows.filter(~F.col("accepted")).drop("accepted", "doc", "shard_id")

    def quarantine(self) -> DataFrame | None:
        """Records set aside in complete batches."""
        generation = self.generation()
        later = self._set_aside(self._since(generation), self.last_batch())
        return self._together(self._folded("quarantine", generation), later)

    def ledger(self) -> DataFrame | None:
        """Next offsets of complete batches; the batch number is the commit round (ST3)."""
        generation = self.generation()
        later = self._batch_rows("commit_ledger", self._since(generation), self.last_batch())
        return self._together(self._folded("commit_ledger", generation), later)

    def committed(self, rounds_late: int = 0) -> DataFrame | None:
        """Committed offset per (group, topic, partition).

        The checkpoint is exact, so a finished batch counts at once; ``rounds_late=1`` shows the
        view of a group that publishes every round when the next one closes. Commits of compacted
        batches come folded, one row each.
        """
        last = self.last_batch() - rounds_late
        generation = self.generation()
        if generation is not None and generation["compacted_through"] > last:
            rows = self.ledger().filter(F.col("batch_id") <= last)
        else:
            folded = None
            if generation is not None:
                folded = self._read(f"folded/committed/gen={generation['gen']}")
            rows = self._together(folded, self._batch_rows("commit_ledger", self._since(generation), last))
        if rows is None:
            rows = self.ledger()
            rows = None if rows is None else rows.filter(F.col("batch_id") <= last)
        return None if rows is None else self._commits(rows)

    @staticmethod
    def _commits(rows: DataFrame) -> DataFrame:
        return (
            rows.filter(F.col("next_offset").isNotNull())
            .groupBy("group_id", "topic", "partition")
            .agg(F.max("next_offset").alias("committed_offset"))
        )

    def seen(self, through: int | None = None) -> DataFrame | None:
        """Runs of offsets that complete batches held (W3); those of compacted batches come merged."""
        generation = self.generation()
        folded = None if generation is None else self._read(f"folded/seen/gen={generation['gen']}")
        last = self.last_batch() if through is None else through
        return self._together(folded, self._batch_rows("seen", self._since(generation), last))

    def gaps(self) -> DataFrame | None:
        """Offsets missing between those that batches held; the log isn't read.

        There for jobs that have kept ``track_offsets`` on from their first batch.
        """
        runs = self.seen()
        return None if runs is None else gaps_between(runs)

    def snapshot(self, generation: Row) -> DataFrame:
        """A snapshot as a bucketed table, so that plans can use where its keys lie."""
        name = self._table_name(generation["gen"])
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({generation['columns']}) USING parquet "
            f"CLUSTERED BY (key) INTO {generation['buckets']} BUCKETS "
            f"LOCATION '{self.path('snapshot')}/gen={generation['gen']}'"
        )
        return self.spark.table(name)

    def _table_name(self, gen: int) -> str:
        return f"docstream_{hashlib.md5(self.base.encode()).hexdigest()[:12]}_{gen}"

    def _view(self, generation: Row | None, through: int) -> DataFrame | None:
        """Last arrivals of every document and partition up to a batch."""
        changes = self.changelog(self._since(generation), through)
        if generation is None:
            return None if changes is None else latest_per_partition(changes)
        snapshot = self.snapshot(generation)
        if changes is None:
            return snapshot
        schema = merged_type(snapshot.schema, changes.schema)
        return merge_latest(
            with_columns(snapshot, schema),
            with_columns(changes, schema),
            buckets=generation["buckets"],
        )

    def current(self) -> DataFrame | None:
        """The collection: one row per document, or per document and shard (DM4).

        In all-shard mode all shards hold the same documents. They are stored once and copied to
        the shards where they are read.
        """
        view = self._view(self.generation(), self.last_batch())
        if view is None:
            return None
        documents = between_partitions(view)
        return every_shard(documents, self.num_shards) if self.all_shards else documents

    def write_shards(self, path: str) -> None:
        """The current documents as one folder per shard, copies and all."""
        current = self.current()
        if current is not None:
            current.write.mode("overwrite").partitionBy("shard_id").parquet(path)

    def _fold(self, old: Row | None, through: int, gen: int) -> None:
        """Carry what the batches since the last generation committed and set aside."""
        after, commits, runs = self._since(old), self.committed(), None
        if files_exist(self.spark, self.path("seen")):
            runs = self.seen(through)
        parts = {
            "commit_ledger": self._batch_rows("commit_ledger", after, through),
            "quarantine": self._set_aside(after, through),
            "committed": None if commits is None else commits.withColumnRenamed("committed_offset", "next_offset"),
        }
        parts["seen"] = None if runs is None else merge_runs(runs)
        for part, rows in parts.items():
            if rows is not None:
                rows.write.mode("overwrite").parquet(self.path(f"folded/{part}/gen={gen}"))

    def compact(self, buckets: int | None = None) -> int | None:
        """Write the current documents as a new generation; returns its number.

        The number of buckets is that of the collection's settings or, once there is a generation,
        that generation's; only ``buckets`` given here changes it, at the price of one shuffle of
        the whole collection. It should be a multiple of the shards, so that each bucket has one.
        The old generation is left for readers that already use it.
        """
        old, through = self.generation(), self.last_batch()
        kept = (self.buckets or self.num_shards) if old is None else old["buckets"]
        buckets = kept if buckets is None else buckets
        if old is not None and old["compacted_through"] >= through and buckets == old["buckets"]:
            return old["gen"]
        view = self._view(old, through)
        if view is None:
            return None
        gen = 0 if old is None else old["gen"] + 1
        if old is None or buckets != old["buckets"]:
            view = view.repartition(buckets, "key")
        name = self._table_name(gen)
        columns = view.schema.toDDL()
        # A table of this name can only be left from an attempt that did not finish.
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        # With as many shuffle partitions as buckets, the exchange that brings the changes down to
        # one version per key is also the one that deals them into buckets.
        with shuffle_partitions(self.spark, buckets):
            (
                view.write.mode("overwrite")
                .option("path", f"{self.path('snapshot')}/gen={gen}")
                .bucketBy(buckets, "key")
                .saveAsTable(name)
            )
        self._fold(old, through, gen)
        (
            self.spark.createDataFrame(
                [(through, buckets, columns)], "compacted_through bigint, buckets int, columns string"
            )
            .write.mode("overwrite")
            .parquet(self.path(f"generations/gen={gen}"))
        )
        return gen

    # What was asked for ------------------------------------------------------------------------

    def set_run_state(self, state: str) -> None:
        row = self.spark.createDataFrame([(state,)], "state string")
        row.withColumn("at", F.current_timestamp()).write.mode("append").parquet(self.path("run_state"))

    def run_state(self) -> str:
        states = self._read("run_state")
        if states is None:
            return NOT_INITIALIZED
        return states.agg(F.max_by("state", "at")).first()[0]
