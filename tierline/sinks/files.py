"""File sinks: CSV landing (flat or partitioned), parquet, NDJSON, text.

Partitioned landings use a ``REBALANCE`` hint on the partition columns
instead of ``repartition``: rows of one partition value still go to few
tasks (few files per directory), but AQE splits a partition value that holds
a large share of the rows over several tasks, so one hot key never lands
through one task.  Overwrites are dynamic: only the partitions present in
the written rows are replaced, other partitions stay.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# CSV dialect of the bronze layer.  The token ``null`` marks a NULL field,
# quotes and commas inside values are quoted, and the same options are used
# when reading back.
NULL_TOKEN = "null"
CSV_OPTIONS = {"nullValue": NULL_TOKEN, "quote": '"', "escape": '"'}

# Lines that later steps read again (payloads, logs, metrics, findings) are
# stored compressed: ids and field names repeat in every line.  Such a file is
# not split, so it holds this many lines at most.
TEXT_OPTIONS = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}

# Layouts of very many small files.  Hadoop's local file system keeps a checksum
# file beside each file and starts processes to set the permissions of the two,
# which takes far longer than the rows; its plain form starts fewer.  The file
# system is cached per application, so the cache is passed by.  Other file systems
# are not concerned.
MANY_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
              "fs.file.impl.disable.cache": "true"}

# Writers that a task keeps open at once.  Rows that already lie by partition
# meet few folders in a task, and are then written without being sorted first;
# a task that meets more folders sorts its remaining rows.
UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "4"}


def _spread(df: DataFrame, partition_by: Sequence[str],
            writers: int | None = None) -> DataFrame:
    if not partition_by:
        return df
    if writers:
        return df.hint("rebalance", writers, *partition_by)
    return df.hint("rebalance", *partition_by)


def many_files(spark: SparkSession) -> dict[str, str]:
    """Write options for layouts of very many small files; none where
    the cluster names a local file system of its own."""
    return {} if spark.conf.get("spark.hadoop.fs.file.impl", None) else MANY_FILES


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]):
    """Runtime SQL settings for the actions run inside the block."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def together(calls: Sequence[Callable[[], object]]) -> list:
    """Run independent steps at the same time, each with its own Spark jobs, so
    that small ones do not wait for each other; their results.  All of them
    end before the first error is raised."""
    with ThreadPoolExecutor(max(1, len(calls))) as pool:
        return [done.result() for done in [pool.submit(c) for c in calls]]


def land_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (),
             header: bool = True, mode: str = "overwrite",
             null_token: str = NULL_TOKEN, writers: int | None = None,
             dynamic: bool = True, **options) -> None:
    """CSV landing; with ``partition_by`` one directory per key value
    (``key=value``), only rewritten partitions are replaced (all of them
    unless ``dynamic``).

    ``writers`` is for layouts whose cost is the number of files rather than
    bytes (one directory per leaf key): the rebalance keeps at least that
    many writer tasks instead of letting AQE merge small partitions into
    one task; hot keys are still split.  Local files are written plainly
    (``MANY_FILES``).  ``options`` are further write options, such as a
    compression.
    """
    w = (_spread(df, partition_by, writers).write.mode(mode)
         .options(**{**CSV_OPTIONS, "nullValue": null_token})
         .option("header", header).options(**options)
         .option("partitionOverwriteMode", "dynamic" if dynamic else "static"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if writers and partition_by:
        with session_conf(df.sparkSession,
                          {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
            w.options(**many_files(df.sparkSession)).csv(path)
    else:
        w.csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = (), dynamic: bool = True,
                  spread: bool = True) -> None:
    """Parquet write; with ``partition_by`` an overwrite replaces only the
    partitions present in ``df`` (``dynamic``) or the whole dataset.
    ``spread=False`` writes rows as they come, for inputs that already lie by
    the partition columns."""
    w = (_spread(df, partition_by) if spread else df).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option(
            "partitionOverwriteMode", "dynamic" if dynamic else "static")
    w.parquet(path)


def export_csv_noheader(df: DataFrame, path: str) -> None:
    """Headerless CSV export of a result (rows only, fields by position)."""
    land_csv(df, path, header=False)


def append_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append NDJSON records (one object per line), null fields kept."""
    w = df.write.mode("append").options(**TEXT_OPTIONS).option("ignoreNullFields", "false")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def append_text(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append lines from a single ``value`` string column (plus partitions)."""
    w = df.write.mode("append").options(**TEXT_OPTIONS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.text(path)


def land_payloads(df: DataFrame, path: str, partition_by: Sequence[str],
                  body: str = "body", mode: str = "overwrite") -> None:
    """Raw JSON payloads, one array per line, in one folder per request key
    (``key=value``); rewritten request keys replace their folder only."""
    (_spread(df.select(*partition_by, body), partition_by).write.mode(mode)
        .options(**TEXT_OPTIONS).option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).text(path))
