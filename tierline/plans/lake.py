"""Folder layout of a data lake: bronze, silver, gold, logs, queue."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.schemas import (CLASSIFICATIONS, CLASSIFICATIONS_BRONZE,
                              ENTITY_SCHEMAS, LEVELS, S, struct)
from tierline.sinks.files import UNSORTED, land_csv, session_conf, together, write_parquet
from tierline.sources.files import create_namespace, read_csv_by_folder, read_csv_raw, read_csv_typed
from tierline.tables import files

ENTITIES = ["seasons", "events", "categories", "sessions", "classifications"]

# Bronze partition layout at scale.  The reference layout (``LEVELS[...]
# .partition_by``) gives classifications one directory per session, which
# means one tiny file per session: at 100 TB that is billions of files.  By
# default classifications are partitioned by season and event only; the
# reference layout stays available with ``layout="reference"``.
SCALE_LAYOUT = {
    # one folder per season, so a run that crawls some seasons replaces only
    # those (an unpartitioned file would lose the seasons it did not crawl)
    "seasons": ("id",),
    "events": ("season_id",),
    "categories": ("season_id", "event_id"),
    "sessions": ("season_id", "event_id"),
    "classifications": ("season_id", "event_id"),
}


def partition_layout(entity: str, layout: str = "scale") -> tuple[str, ...]:
    # Seasons land per season id in every layout: a single seasons file
    # rewritten by an incremental run would keep only the crawled season.
    if layout == "reference" and entity != "seasons":
        return LEVELS[entity].partition_by
    return SCALE_LAYOUT[entity]


# The entities that grow with the data land compressed: ids repeat in every
# line.  Such a file is not split, so it holds this many lines at most.
COMPRESSED = {"sessions", "classifications"}
LINES_PER_FILE = 250_000

# Classification files lie below a ``run_id=`` level in every layout, so a
# run that is repeated replaces its own files and runs add up.  Landings that
# are no run use this id.
LANDING = "landing"


class LayoutError(ValueError):
    """The lake's bronze files were landed in another layout."""


@dataclass(frozen=True)
class Lake:
    root: str

    def use_layout(self, spark: SparkSession, layout: str) -> None:
        """Note the bronze layout at the first landing, refuse another later."""
        path = f"{self.root}/_bronze_layout"
        known = files.read_line(spark, path)
        if known is None:
            files.write_line(spark, path, layout)
        elif known != layout:
            raise LayoutError(f"{self.root} is landed in layout {known!r}, not {layout!r}")

    def bronze(self, entity: str) -> str:
        return f"{self.root}/bronze/{entity}"

    def silver(self, entity: str) -> str:
        return f"{self.root}/silver/{entity}"

    def gold(self, name: str = "results") -> str:
        return f"{self.root}/gold/{name}"

    def logs(self, name: str) -> str:
        return f"{self.root}/logs/{name}"

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    @property
    def silver_db(self) -> str:
        """Catalog namespace of this lake's bucketed silver tables."""
        return "silver_" + hashlib.sha1(self.root.encode()).hexdigest()[:12]

    @property
    def gold_db(self) -> str:
        """Catalog namespace of this lake's gold tables."""
        return "gold_" + hashlib.sha1(self.root.encode()).hexdigest()[:12]


def to_bronze_columns(entity: str, df: DataFrame) -> DataFrame:
    """Rows in the landed column order; classifications use the short
    landing names ``pos`` and ``pts``."""
    if entity == "classifications":
        return df.select(*[F.col(a).alias(b) for a, b in
                           zip(CLASSIFICATIONS.names, CLASSIFICATIONS_BRONZE.names)])
    return df.select(*ENTITY_SCHEMAS[entity].names)


def land_entity(lake: Lake, entity: str, df: DataFrame, layout: str = "scale",
                run_id: str = LANDING, replace: bool = False) -> None:
    """Land rows of an entity; the partitions present in ``df`` are replaced,
    with ``replace`` the whole entity."""
    lake.use_layout(df.sparkSession, layout)
    rows, keys = to_bronze_columns(entity, df), tuple(partition_layout(entity, layout))
    if entity == "classifications":
        rows, keys = rows.withColumn("run_id", F.lit(run_id)), (*keys, "run_id")
    packed = {"compression": "gzip", "maxRecordsPerFile": LINES_PER_FILE} if entity in COMPRESSED else {}
    with session_conf(df.sparkSession, UNSORTED if entity in COMPRESSED else {}):
        land_csv(rows, lake.bronze(entity), keys, dynamic=not replace, **packed)


def read_bronze(spark: SparkSession, lake: Lake, entity: str, filename: str | None = None,
                seasons: Sequence[str] | None = None, run_id: str | None = None,
                keep_run: bool = False, by_folder: Sequence[str] = ()) -> DataFrame:
    """Typed bronze read; the entity columns in schema order (plus
    ``filename`` when asked, and the ``run_id`` of classifications with
    ``keep_run``).  ``seasons`` and ``run_id`` are literal filters on
    partition columns, so only their folders are listed and read.  ``by_folder``
    are the partition keys of a layout of very many folders
    (``read_csv_by_folder``)."""
    schema = ENTITY_SCHEMAS[entity]
    if entity == "classifications":
        schema = struct(*[(f.name, f.dataType) for f in schema.fields], ("run_id", S))
    if by_folder:
        df = read_csv_by_folder(spark, lake.bronze(entity), schema, by_folder, filename=filename)
    else:
        df = read_csv_typed(spark, lake.bronze(entity), schema, filename=filename)
    if run_id is not None:
        df = df.filter(F.col("run_id") == run_id)
    return of_seasons(df, entity, seasons).select(*ENTITY_SCHEMAS[entity].names,
                                                  *([filename] if filename else []),
                                                  *(["run_id"] if keep_run else []))


def of_seasons(df: DataFrame, entity: str, seasons: Sequence[str] | None) -> DataFrame:
    if seasons is None:
        return df
    return df.filter(F.col("id" if entity == "seasons" else "season_id").isin(sorted(seasons)))


def read_bronze_raw(spark: SparkSession, lake: Lake, entity: str) -> DataFrame:
    return read_csv_raw(spark, lake.bronze(entity))


# Join key of the entities that can be bucketed for the gold join.
BUCKET_KEYS = {"classifications": "session_id", "sessions": "id"}


# Silver layout of the entities that grow with the data: a run refreshes
# only the partitions of the seasons it touched.
SILVER_LAYOUT = {"classifications": ("season_id", "event_id"),
                 "sessions": ("season_id", "event_id")}
# Silver classifications keep the file each row was landed in.
FILENAME = "filename"


def load_silver(spark: SparkSession, lake: Lake, entities=ENTITIES,
                buckets: int | None = None, seasons: Sequence[str] | None = None,
                changes=None) -> None:
    """Bronze CSV -> one parquet dataset per entity.

    Classifications and sessions are partitioned by (season, event).  With
    ``seasons`` only those seasons are re-read from bronze (literal partition
    filters) and only their partitions replaced; the bounded dimensions are
    rewritten whole.  With ``changes`` (see ``plans.changes``) only what they
    name is read and replaced: the partitions of changed events, and a bounded
    dimension only if one of its rows differs.  With neither every dataset is
    replaced.  Bronze is laid out by season and event already, so silver is
    written straight from its scan, without an exchange.

    With ``buckets`` (full loads), classifications and sessions are written
    instead as catalog tables bucketed on the session id (one file per
    bucket, after a hash repartition), so the gold join between them reads
    co-located buckets and shuffles neither side.  This moves the shuffle to
    the silver load, where it is paid once.  It suits data without hot
    sessions: with bucketing, one session's rows are always one task,
    whereas the default shuffle join lets AQE split a hot session.
    """
    if buckets and seasons is not None:
        raise ValueError("bucketed silver is loaded whole; pass no seasons")
    if changes is not None:
        seasons = None if changes.whole else changes.seasons
        entities = [e for e in entities if changes.whole or e in changes.kinds]

    def load(e: str) -> None:
        fact = e == "classifications"
        df = read_bronze(spark, lake, e, filename=FILENAME if fact else None,
                         seasons=seasons if e in SILVER_LAYOUT else None)
        if changes is not None and not changes.whole and e in SILVER_LAYOUT:
            df = changes.of(df, e).select(*df.columns)
        if buckets and e in BUCKET_KEYS:
            key = BUCKET_KEYS[e]
            create_namespace(spark, f"{lake.silver_db}.{e}", lake.silver(e))
            (df.repartition(buckets, key).write.mode("overwrite")
               .bucketBy(buckets, key).option("path", lake.silver(e))
               .saveAsTable(f"{lake.silver_db}.{e}"))
            return
        if e in BUCKET_KEYS and spark.catalog.tableExists(f"{lake.silver_db}.{e}"):
            # A plain reload replaces an earlier bucketed table.
            spark.sql(f"DROP TABLE {lake.silver_db}.{e}")
        if e in SILVER_LAYOUT:
            write_parquet(df, lake.silver(e), partition_by=SILVER_LAYOUT[e],
                          dynamic=seasons is not None, spread=False)
        else:
            write_parquet(df, lake.silver(e))
    # Compressed files are few for their rows: read them by more tasks.
    tasks = 4 * spark.sparkContext.defaultParallelism
    with session_conf(spark, {**UNSORTED, "spark.sql.files.minPartitionNum": str(tasks)}):
        together([partial(load, e) for e in entities])


def read_silver(spark: SparkSession, lake: Lake, entity: str, filename: bool = False,
                seasons: Sequence[str] | None = None) -> DataFrame:
    """Silver dataset; through the catalog when it is a bucketed table of
    this lake (bucket-aware scan), else by path.  ``seasons`` is a literal
    filter on the partition column."""
    name, schema = f"{lake.silver_db}.{entity}", ENTITY_SCHEMAS[entity]
    if entity in BUCKET_KEYS and spark.catalog.tableExists(name):
        df = spark.table(name)
    else:
        # The schema types partition columns too (ids stay strings).
        typed = struct(*[(f.name, f.dataType) for f in schema.fields], *([(FILENAME, S)] if filename else []))
        df = spark.read.schema(typed).parquet(lake.silver(entity))
    return of_seasons(df, entity, seasons).select(*schema.names, *([FILENAME] if filename else []))
