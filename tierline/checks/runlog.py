"""Process logs, metrics and the run archive."""

from __future__ import annotations

import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.checks import query
from tierline.checks.env import env
from tierline.functions.logs import line_level, requests_per_second
from tierline.operators.crawl import crawl, request_log
from tierline.operators.ordering import top1
from tierline.operators.runlog import (EVENT_GET_CATEGORIES, EVENT_GET_CLASSIFICATION,
                                       EVENT_GET_EVENTS, EVENT_GET_SESSIONS,
                                       archive, count_requests, failed_keys,
                                       metric_records, parse_log,
                                       read_metrics, run_summary, strip_time)
from tierline.operators.quality import null_count_by_file
from tierline.oracle import ENTITY_SQL, UUID_SQL
from tierline.plans.lake import read_silver
from tierline.schemas import DQ_FINDINGS
from tierline.sinks.files import append_json, append_text

def _parsed(spark, sf_dir):
    e = env(spark, sf_dir)
    return parse_log(spark.read.text(e.log_path))


@query("log_lines", "SELECT '[' || level || '] ' || message AS value FROM f_log")
def log_lines(spark, sf_dir):
    """INFO lines appended, then ERROR lines appended; read back as text and
    returned without the time field."""
    e = env(spark, sf_dir)
    lines = request_log(e.gaps, e.src.classifications)
    path = e.scratch("process_log")
    append_text(lines.filter(F.col("value").contains("[INFO]")), path)
    append_text(lines.filter(F.col("value").contains("[ERROR]")), path)
    return strip_time(spark.read.text(path))


@query("log_scan_parse", f"""
SELECT level, {ENTITY_SQL} AS entity, count(*) AS n FROM f_log GROUP BY ALL""")
def log_scan_parse(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    return p.groupBy("level", "entity").agg(F.count(F.lit(1)).alias("n"))


@query("log_extract_ids", f"""
SELECT level, entity, unnest(ids) AS id FROM (
  SELECT level, {ENTITY_SQL} AS entity, regexp_extract_all(message, {UUID_SQL}, 0) AS ids
  FROM f_log)""")
def log_extract_ids(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    return p.select("level", "entity", F.explode("ids").alias("id"))


@query("log_extract_pairs", f"""
SELECT DISTINCT ids[1] AS event_id, ids[2] AS category_id FROM (
  SELECT regexp_extract_all(message, {UUID_SQL}, 0) AS ids
  FROM f_log WHERE level = 'ERROR' AND {ENTITY_SQL} = 'sessions')""")
def log_extract_pairs(spark, sf_dir):
    """(event, category) pair of each failed session request: the first two
    ids of its ERROR line."""
    return env(spark, sf_dir).failed["pairs"]


@query("log_failed_keys", f"""
SELECT DISTINCT entity, ids[1] AS first, CASE WHEN entity = 'sessions' THEN ids[2] END AS second FROM (
  SELECT {ENTITY_SQL} AS entity, regexp_extract_all(message, {UUID_SQL}, 0) AS ids
  FROM f_log WHERE level = 'ERROR') WHERE len(ids) > 0""")
def log_failed_keys(spark, sf_dir):
    """The keys of every failed request, of all levels, in one pass."""
    return failed_keys(_parsed(spark, sf_dir))


@query("metrics_requests", """
SELECT CAST(count(*) AS BIGINT) AS requests FROM f_log WHERE level = 'INFO'""")
def metrics_requests(spark, sf_dir):
    return count_requests(_parsed(spark, sf_dir))


_LEVEL_RUN_MS = 2500


@query("metrics_rps", f"""
SELECT {ENTITY_SQL} AS entity, CAST(count(*) AS BIGINT) AS requests,
       CAST(count(*) // nullif({_LEVEL_RUN_MS} // 1000, 0) AS BIGINT) AS rps
FROM f_log WHERE level = 'INFO' GROUP BY ALL""")
def metrics_rps(spark, sf_dir):
    """Requests per whole second per level, for a level run of 2.5 s."""
    p = _parsed(spark, sf_dir).filter(F.col("level") == "INFO")
    per = p.groupBy("entity").agg(F.count(F.lit(1)).cast("long").alias("requests"))
    return per.select("entity", "requests",
                      requests_per_second(F.col("requests"), F.lit(_LEVEL_RUN_MS)).alias("rps"))


_RUN_MS = 90_000


@query("metrics_run_summary", f"""
SELECT 'SCRAPE' AS event, CAST({_RUN_MS} AS BIGINT) AS duration_ms,
       CAST(count(*) AS BIGINT) AS requests,
       CAST(count(*) // ({_RUN_MS} // 1000) AS BIGINT) AS rps
FROM f_log WHERE level = 'INFO'""")
def metrics_run_summary(spark, sf_dir):
    return run_summary(_parsed(spark, sf_dir), _RUN_MS)


def _level_records(c, timed=True):
    """Metric records per request of every level; the duration of a level
    is the measured time of the job that counts its requests."""
    out = []
    for event, req, dims in [
        (EVENT_GET_EVENTS, c.requests["events"], ["season_id"]),
        (EVENT_GET_CATEGORIES, c.requests["categories"], ["event_id"]),
        (EVENT_GET_SESSIONS, c.requests["sessions"], ["event_id", "category_id"]),
        (EVENT_GET_CLASSIFICATION, c.requests["classifications"], ["session_id"]),
    ]:
        t0 = time.monotonic()
        if timed:
            req.count()
        ms = int((time.monotonic() - t0) * 1000)
        out.append(metric_records(req, event, ms, dims))
    return out


_METRICS_SQL = """
SELECT 'GET_EVENTS' AS event, id AS season_id, NULL AS event_id, NULL AS category_id,
       NULL AS session_id FROM f_seasons
UNION ALL SELECT 'GET_CATEGORIES', NULL, id, NULL, NULL FROM f_events
UNION ALL SELECT 'GET_SESSIONS', NULL, event_id, id, NULL FROM f_categories
UNION ALL SELECT 'GET_CLASSIFICATION', NULL, NULL, NULL, id FROM f_sessions"""


@query("metrics_ndjson", f"""
m AS ({_METRICS_SQL})
SELECT event, CAST(season_id AS VARCHAR) AS season_id, CAST(event_id AS VARCHAR) AS event_id,
       CAST(category_id AS VARCHAR) AS category_id, CAST(session_id AS VARCHAR) AS session_id,
       true AS has_duration
FROM m""")
def metrics_ndjson(spark, sf_dir):
    e = env(spark, sf_dir)
    recs = _level_records(e.crawl)
    path = e.scratch("metrics")
    append_json(recs[0].unionByName(recs[1]), path)
    append_json(recs[2].unionByName(recs[3]), path)
    back = read_metrics(spark, path)
    return back.select("event", "season_id", "event_id", "category_id", "session_id",
                       (F.col("duration_ms") >= 0).alias("has_duration"))


_LATEST = "(SELECT id FROM f_seasons ORDER BY year DESC, id LIMIT 1)"


@query("run_archive", f"""
runs AS (SELECT 'r1' AS run_id, id AS season_id FROM f_seasons
         UNION ALL SELECT 'r2', id FROM f_seasons WHERE id IN {_LATEST}),
lines AS (
  SELECT run_id, 'GET_EVENTS' AS kind, count(*) AS n FROM runs GROUP BY run_id
  UNION ALL SELECT run_id, 'GET_CATEGORIES', count(*) FROM runs JOIN f_events USING (season_id) GROUP BY run_id
  UNION ALL SELECT run_id, 'GET_SESSIONS', count(*) FROM runs JOIN f_categories USING (season_id) GROUP BY run_id
  UNION ALL SELECT run_id, 'GET_CLASSIFICATION', count(*) FROM runs JOIN f_sessions USING (season_id) GROUP BY run_id)
SELECT run_id, 'metrics' AS log, kind, CAST(n AS BIGINT) AS n FROM lines
UNION ALL SELECT run_id, 'process', 'INFO', CAST(sum(n) + 1 AS BIGINT) FROM lines GROUP BY run_id
UNION ALL SELECT run_id, 'process', 'ERROR', count(*) FROM runs JOIN f_sessions s USING (season_id)
  ANTI JOIN f_classifications c ON c.session_id = s.id GROUP BY run_id
UNION ALL SELECT run_id, 'data_quality', 'NULL_POSITION_COUNT', count(*)
  FROM runs JOIN f_classifications USING (season_id) WHERE position IS NULL GROUP BY run_id""")
def run_archive(spark, sf_dir):
    """Metrics, process log and data-quality findings of a full run (r1) and
    of an incremental run over the latest season (r2), archived by run id;
    all three logs of both runs are read back."""
    e = env(spark, sf_dir)
    s = e.src
    latest = top1(s.seasons, "year", "id")
    inc = crawl(latest, s.events, s.categories, s.sessions)
    ids = [r["id"] for r in latest.select("id").collect()]
    into = e.scratch("archive")
    for run_id, c, only in [("r1", e.crawl, None), ("r2", inc, ids)]:
        recs = _level_records(c)
        allr = recs[0]
        for r in recs[1:]:
            allr = allr.unionByName(r)
        fact = read_silver(spark, e.lake, "classifications", filename=True, seasons=only)
        archive(run_id, into, allr, request_log(c, fact), null_count_by_file(fact))
    n = F.count(F.lit(1)).alias("n")
    metrics = read_metrics(spark, f"{into}/metrics", "run_id").groupBy("run_id", F.col("event").alias("kind")).agg(n)
    log = spark.read.schema("value string, run_id string").text(f"{into}/process")
    log = log.select("run_id", line_level(F.col("value")).alias("kind")).groupBy("run_id", "kind").agg(n)
    dq = spark.read.schema(T.StructType([*DQ_FINDINGS.fields, T.StructField("run_id", T.StringType())])).json(f"{into}/data_quality") \
        .groupBy("run_id").agg(F.sum("NULL_POSITION_COUNT").cast("long").alias("n")) \
        .withColumn("kind", F.lit("NULL_POSITION_COUNT"))
    out = [df.select("run_id", F.lit(name).alias("log"), "kind", "n")
           for name, df in [("metrics", metrics), ("process", log), ("data_quality", dq)]]
    return out[0].unionByName(out[1]).unionByName(out[2])
