"""What a run has changed: landed files, and the events they belong to.

A lake keeps a ledger of the classification files it has taken over: one row
per landed file with its size, its time and partial aggregates of its rows
(row count, NULLs per measure).  Partials of different files add up, so data
quality over all landed rows comes from the ledger, and a run reads the rows
of new files only.

The change set of a run is the set of (season, event) keys whose gold rows
can differ: events with files that the ledger does not know, and events below
a dimension row that the crawl has changed.  Silver and gold rewrite the
partitions of these events and nothing else.  The set is stored before any
of it is applied and put aside when gold is done, so what a dead run left half
applied is part of the next run's set.  The ledger is published last; until
then its files count as new.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.quality import file_partials
from tierline.plans.lake import Lake, read_bronze, read_silver
from tierline.schemas import S, struct
from tierline.sinks.files import session_conf
from tierline.tables import files
from tierline.tables.published import PublishedTable

#: Measures whose NULLs are counted per landed file.
MEASURES = ("number", "position", "points")
EVENT_KEYS = ["season_id", "event_id"]
FILE_KEYS = [*EVENT_KEYS, "run_id"]
LISTING = struct(*[(k, S) for k in FILE_KEYS], ("filename", S), ("bytes", T.LongType()),
                 ("modified", T.TimestampType()))
LEDGER = T.StructType([*LISTING.fields, T.StructField("rows", T.LongType()),
                       *[T.StructField(f"null_{m}", T.LongType()) for m in MEASURES]])
_SAME_FILE = ["season_id", "filename", "bytes", "modified"]
CHANGES = struct(*[(k, S) for k in EVENT_KEYS], ("kind", S))
#: Kinds of change: new files, or the dimension with a changed row.
FACT, DIMENSIONS = "classifications", ("seasons", "events", "categories", "sessions")


def list_landed(spark: SparkSession, lake: Lake, into: str,
                seasons: Sequence[str] | None = None) -> DataFrame:
    """The landed classification files (of some seasons), as a stored table.

    Their contents are not read.  Many files are listed by one task, as none
    of them costs anything but its row.
    """
    bronze = lake.bronze(FACT)
    if not files.exists(spark, bronze):
        return spark.createDataFrame([], LISTING)
    with session_conf(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false",
                              "spark.sql.files.maxPartitionNum": str(4 * spark.sparkContext.defaultParallelism)}):
        found = spark.read.format("binaryFile").load(bronze)
        if seasons is not None:
            found = found.filter(F.col("season_id").isin(sorted(seasons)))
        meta = [F.col(f"_metadata.file_{a}").alias(b) for a, b in
                (("path", "filename"), ("size", "bytes"), ("modification_time", "modified"))]
        found.select(*FILE_KEYS, *meta).write.mode("overwrite").parquet(into)
    return spark.read.schema(LISTING).parquet(into)


class FileLedger:
    """The files a lake has taken over, with their partial aggregates."""

    def __init__(self, spark: SparkSession, lake: Lake):
        self.spark = spark
        self.table = PublishedTable(spark, lake.table("landed_files"), schema=LEDGER)

    def known(self, seasons: Sequence[str] | None = None) -> DataFrame:
        if self.table.current() is None:
            return self.spark.createDataFrame([], LEDGER)
        rows = self.table.read()
        return rows if seasons is None else rows.filter(F.col("season_id").isin(sorted(seasons)))

    def new_files(self, listing: DataFrame) -> DataFrame:
        """Rows of ``listing`` that are not known with this size and time."""
        return listing.join(self.known().select(*_SAME_FILE), _SAME_FILE, "left_anti")

    def after(self, listing: DataFrame, partials: DataFrame, seasons: Sequence[str]) -> DataFrame:
        """The ledger after a run that listed ``seasons``: files still there
        keep their partials, new ones get ``partials``, others go."""
        known = self.known()
        others = known.filter(~F.col("season_id").isin(sorted(seasons)))
        kept = known.join(listing.select(*_SAME_FILE), _SAME_FILE, "left_semi")
        counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in LEDGER.names[len(LISTING):]]
        new = self.new_files(listing).join(partials, "filename", "left").select(*LISTING.names, *counts)
        return others.unionByName(kept).unionByName(new).select(*LEDGER.names)

    def save(self, listing: DataFrame, partials: DataFrame, seasons: Sequence[str]) -> None:
        self.table.replace(self.after(listing, partials, seasons))
        self.table.remove_unused()

    def findings_with(self, listing: DataFrame, partials: DataFrame, seasons: Sequence[str]) -> DataFrame:
        """Findings over all landed files: partials combined."""
        return null_findings(self.after(listing, partials, seasons))


def null_findings(ledger: DataFrame, measure: str = "position",
                  name: str = "NULL_POSITION_COUNT") -> DataFrame:
    """Files with NULLs of a measure and their number."""
    nulls = F.col(f"null_{measure}")
    return ledger.filter(nulls > 0).select("filename", nulls.alias(name))


def of_new_files(spark: SparkSession, lake: Lake, new: DataFrame, seasons: Sequence[str],
                 filename: str | None = None) -> DataFrame:
    """Landed rows of the files ``new`` (a stored listing).

    The semi join is on partition columns: Spark reads the folders that the
    few keys name (dynamic partition pruning).
    """
    rows = read_bronze(spark, lake, FACT, filename=filename, seasons=seasons, keep_run=True)
    keys = new.filter(F.col("season_id").isin(sorted(seasons))).select(*FILE_KEYS)
    return rows.join(keys, FILE_KEYS, "left_semi").drop("run_id")


def changed_rows(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct ``keys`` of rows that only one of two versions has, or that
    they have a different number of times; NULLs are equal."""
    sign = new.withColumn("_n", F.lit(1)).unionByName(old.withColumn("_n", F.lit(-1)))
    return (sign.groupBy(*new.columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
            .select(*keys).distinct())


@dataclass
class Changes:
    """A stored change set.

    ``whole``: silver and gold are built anew (a first run, or landed events
    that are gone); else ``rows`` (season_id, event_id, kind) are the events
    to rewrite, all of them in ``seasons``, and ``kinds`` says which kinds
    there are.
    """

    rows: DataFrame
    seasons: list[str]
    kinds: set[str] = field(default_factory=set)
    whole: bool = False

    def events(self, *kinds: str) -> DataFrame:
        """Keys of the events with these kinds of change (all by default)."""
        some = F.col("kind").isin(sorted(kinds or (FACT, *DIMENSIONS)))
        return self.rows.filter(some).select(*EVENT_KEYS).distinct()

    def of(self, df: DataFrame, *kinds: str) -> DataFrame:
        """Rows of ``df`` (partitioned by season and event) in those events."""
        return df.join(self.events(*kinds), EVENT_KEYS, "left_semi")


def _silver_exists(spark: SparkSession, lake: Lake) -> bool:
    return all(files.exists(spark, lake.silver(e)) for e in (FACT, *DIMENSIONS)) \
        and files.exists(spark, lake.gold("results"))


def _dimension_changes(spark: SparkSession, lake: Lake, listing: DataFrame,
                       crawled: Sequence[str] | None) -> list[DataFrame]:
    """Events below a landed dimension row that silver does not have alike."""
    keys = {"seasons": ["id"], "events": ["season_id", "id"],
            "categories": EVENT_KEYS, "sessions": EVENT_KEYS}
    out = []
    for e in DIMENSIONS:
        rows = changed_rows(read_bronze(spark, lake, e, seasons=crawled),
                            read_silver(spark, lake, e, seasons=crawled), keys[e])
        if e == "seasons":  # a season's row is part of all its events
            rows = listing.select(*EVENT_KEYS).distinct().unionByName(
                read_bronze(spark, lake, "events", seasons=crawled)
                .select("season_id", F.col("id").alias("event_id"))).distinct() \
                .join(rows.withColumnRenamed("id", "season_id"), "season_id", "left_semi")
        elif e == "events":
            rows = rows.withColumnRenamed("id", "event_id")
        out.append(rows.select(*EVENT_KEYS, F.lit(e).alias("kind")))
    return out


def pending_path(lake: Lake) -> str:
    return lake.logs("changes/pending")


def find_changes(spark: SparkSession, lake: Lake, ledger: FileLedger, listing: DataFrame,
                 listed: Sequence[str], crawled: Sequence[str] | None, run_id: str) -> Changes:
    """The change set of a run after its landing, with what dead runs left.

    ``listing``: the landed files of the seasons ``listed``; ``crawled``:
    seasons whose dimensions were landed (all of them if None).
    """
    if not _silver_exists(spark, lake):
        return Changes(spark.createDataFrame([], CHANGES), [], whole=True)
    parts = [ledger.new_files(listing).select(*EVENT_KEYS, F.lit(FACT).alias("kind")).distinct(),
             *_dimension_changes(spark, lake, listing, crawled)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    path = pending_path(lake)
    rows.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")
    rows = spark.read.schema(CHANGES).parquet(path).select(*CHANGES.names)
    # One row per season and kind: bounded by the season dimension.
    found = rows.select("season_id", "kind").distinct().collect()
    seasons = sorted({r["season_id"] for r in found})
    gone = ledger.known(listed).select(*EVENT_KEYS).distinct().join(listing, EVENT_KEYS, "left_anti")
    whole = not gone.isEmpty()
    return Changes(rows, seasons, {r["kind"] for r in found}, whole)


def applied(spark: SparkSession, lake: Lake, changes: Changes, run_id: str) -> Changes:
    """The same change set, kept under the run that applied it: silver and
    gold hold it, so no later run has to."""
    if not files.exists(spark, pending_path(lake)):
        return changes
    path = lake.logs(f"changes/applied/{run_id}")
    files.move_folder(spark, pending_path(lake), path)
    return replace(changes, rows=spark.read.schema(CHANGES).parquet(path).select(*CHANGES.names))


def partials_of_new(spark: SparkSession, lake: Lake, ledger: FileLedger, listing: DataFrame,
                    seasons: Sequence[str], into: str) -> DataFrame:
    """Partial aggregates of the files the ledger does not know, stored."""
    new_path = f"{into}/files"
    ledger.new_files(listing).write.mode("overwrite").parquet(new_path)
    new = spark.read.schema(LISTING).parquet(new_path)
    rows = of_new_files(spark, lake, new, seasons, filename="filename")
    file_partials(rows, MEASURES).write.mode("overwrite").parquet(f"{into}/partials")
    return spark.read.parquet(f"{into}/partials")
