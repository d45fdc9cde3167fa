"""Which offsets each file of a parquet log holds, so that a log is read from where it matters (ST5, U2, A2, S7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from docstream.operators.offsets import POSITION, in_topics, replay_window
from docstream.schema import RECORD_LOG

FILE = ["file", "size", "modified"]
ZONES = "file string, size bigint, modified timestamp, topic string, partition int, first_offset bigint, last_offset bigint, n_records bigint"


class ZoneMap:
    """Smallest and largest offset per file and partition of a log, kept in a folder of its own.

    ``extend`` reads the offsets of files it has not seen and adds their zones; a file that was
    replaced (another size or time) counts as new, one that is gone no longer counts. Ends come from
    the map alone, and a replay opens just the files that reach beyond the committed offsets. Files
    may overlap and may hold several partitions: what is read is filtered record by record.
    """

    def __init__(self, spark: SparkSession, log: str, path: str) -> None:
        self.spark = spark
        self.log = log.rstrip("/")
        self.path = path

    def files(self) -> DataFrame:
        """The files of the log as they are now; none is opened."""
        reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        return reader.option("pathGlobFilter", "*.parquet").load(self.log).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )

    def kept(self) -> DataFrame:
        """All zones written so far, those of files that are gone too."""
        try:
            return self.spark.read.schema(ZONES).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ZONES)

    def extend(self) -> ZoneMap:
        """Add the zones of new files; one without a record gets a row without a partition."""
        new = self.files().join(self.kept().select(*FILE).distinct(), FILE, "left_anti")
        paths = [row["file"] for row in new.select("file").collect()]
        if paths:
            found = self.read(paths).groupBy(F.col("_metadata.file_path").alias("file"), *POSITION).agg(
                F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.count(F.lit(1)).alias("n_records")
            )
            columns = [part.split()[0] for part in ZONES.split(", ")]
            new.join(found, "file", "left").select(*columns).write.mode("append").parquet(self.path)
        return self

    def read(self, paths: Sequence[str]) -> DataFrame:
        """Records of some files, with the file they come from in ``_metadata``."""
        return self.spark.read.schema(RECORD_LOG).option("basePath", self.log).parquet(*paths)

    def zones(self) -> DataFrame:
        """Zones of the files that are there now."""
        return self.kept().join(self.files(), FILE, "left_semi").filter(F.col("partition").isNotNull())

    def end_offsets(self, topics: Sequence[str] | None = None) -> DataFrame:
        """End offset per (topic, partition) (A2); no record is read."""
        zones = self.zones() if topics is None else self.zones().filter(in_topics(topics))
        return zones.groupBy(*POSITION).agg((F.max("last_offset") + 1).alias("end_offset"))

    def tail_files(self, committed: DataFrame) -> list[str]:
        """Files with a record at or above a committed offset, or of a partition without one."""
        start = committed.select(*POSITION, "committed_offset")
        reaching = self.zones().join(start, POSITION, "left").filter(F.col("last_offset") >= F.coalesce("committed_offset", F.lit(0)))
        return sorted(row["file"] for row in reaching.select("file").distinct().collect())

    def replay(self, committed: DataFrame) -> DataFrame:
        """Records at or above the committed offsets (ST5, U2), read from the files that hold some."""
        paths = self.tail_files(committed)
        log = self.read(paths) if paths else self.spark.createDataFrame([], RECORD_LOG)
        return replay_window(log.select(*RECORD_LOG.fieldNames()), committed)
