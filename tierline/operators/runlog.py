"""Run logs and metrics: parse process logs, derive failed keys, build and
archive metric records.

Everything is a DataFrame step: the ids of failed requests come from
``regexp_extract_all`` over the log lines, never from a driver-side loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions import logs as L
from tierline.schemas import METRICS
from tierline.sinks.files import append_json, append_text

# Metric event names of a run, per request of a level.
EVENT_GET_SEASONS = "GET_SEASONS"
EVENT_GET_EVENTS = "GET_EVENTS"
EVENT_GET_CATEGORIES = "GET_CATEGORIES"
EVENT_GET_SESSIONS = "GET_SESSIONS"
EVENT_GET_CLASSIFICATION = "GET_CLASSIFICATION"
# Metric event names of the stages of a run.
STAGE_TASKS_LIST = "GET_TASKS_LIST"
STAGE_UPSERT = "UPSERT_QUEUE"
STAGE_TASKS = "GET_TASKS"
STAGE_UPDATE = "UPDATE_TASKS"
STAGE_SILVER = "LOAD_SILVER"
STAGE_DQ = "CHECK_DQ"
STAGE_GOLD = "LOAD_GOLD"
EVENT_RUN = "SCRAPE"


def parse_log(lines: DataFrame) -> DataFrame:
    """Text lines (``value``) -> ts_text, level, message, entity, ids."""
    v = F.col("value")
    return lines.select(
        L.line_time(v).alias("ts_text"), L.line_level(v).alias("level"),
        L.line_message(v).alias("message")
    ).withColumn("entity", L.message_entity(F.col("message"))) \
     .withColumn("ids", L.extract_ids(F.col("message")))


def strip_time(lines: DataFrame) -> DataFrame:
    """Lines without their leading time field."""
    return lines.select(F.regexp_replace("value", r"^\S+ ", "").alias("value"))


def failed_keys(parsed: DataFrame) -> DataFrame:
    """Keys of requests that found no children: one row (entity, first,
    second) per distinct key, from one pass over the log.

    ``entity`` is what was not found; first is the season of missing events,
    the event of missing categories, the event (second: the category) of
    missing sessions, the session of missing classifications.
    """
    err = parsed.filter((F.col("level") == "ERROR") & (F.size("ids") > 0) & (F.col("entity") != "seasons"))
    pair = F.col("entity") == "sessions"
    return err.select("entity", F.col("ids")[0].alias("first"),
                      F.when(pair, F.get("ids", F.lit(1))).alias("second")) \
        .filter(F.col("second").isNotNull() | (F.col("entity") != "sessions")).distinct()


def failed_sets(failed: DataFrame) -> dict[str, DataFrame]:
    """The four key sets of stored :func:`failed_keys` rows.

    ``seasons`` -> season_id (no events), ``events`` -> event_id (no
    categories), ``pairs`` -> (event_id, category_id) (no sessions),
    ``sessions`` -> session_id (no classification data).
    """
    def of(entity: str, *names: str) -> DataFrame:
        cols = [F.col(c).alias(n) for c, n in zip(("first", "second"), names)]
        return failed.filter(F.col("entity") == entity).select(*cols)
    return {
        "seasons": of("events", "season_id"),
        "events": of("categories", "event_id"),
        "pairs": of("sessions", "event_id", "category_id"),
        "sessions": of("classifications", "session_id"),
    }


def count_requests(parsed: DataFrame) -> DataFrame:
    """One row: number of INFO lines (requests made)."""
    return parsed.agg(F.count_if(F.col("level") == "INFO").cast("long").alias("requests"))


def run_summary(parsed: DataFrame, duration_ms: int) -> DataFrame:
    """One metric record for the whole run: duration, requests, rps."""
    req = count_requests(parsed)
    return req.select(
        F.lit(EVENT_RUN).alias("event"), F.lit(duration_ms).cast("long").alias("duration_ms"),
        "requests",
        L.requests_per_second(F.col("requests"), F.lit(duration_ms)).alias("rps"))


def metric_records(requests: DataFrame, event: str, duration_ms: int,
                   dims: Sequence[str]) -> DataFrame:
    """One metric record per request of a level; the level runs as one
    Spark job, so every record carries the level's measured duration."""
    cols = []
    for f in METRICS.fields:
        if f.name == "event":
            cols.append(F.lit(event).alias("event"))
        elif f.name == "duration_ms":
            cols.append(F.lit(duration_ms).cast("long").alias("duration_ms"))
        elif f.name in dims:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return requests.select(*cols)


def read_metrics(spark: SparkSession, path: str, *partitions: str) -> DataFrame:
    """NDJSON metric records with the fixed schema (plus partition columns)."""
    schema = T.StructType([*METRICS.fields, *[T.StructField(p, T.StringType()) for p in partitions]])
    return spark.read.schema(schema).json(path)


def archive(run_id: str, into: str, metrics: DataFrame, log: DataFrame, findings: DataFrame) -> None:
    """Add the three logs of a run to the archive, under its run id."""
    append_json(metrics.withColumn("run_id", F.lit(run_id)), f"{into}/metrics", ["run_id"])
    append_text(log.select("value", F.lit(run_id).alias("run_id")), f"{into}/process", ["run_id"])
    append_json(findings.withColumn("run_id", F.lit(run_id)), f"{into}/data_quality", ["run_id"])
