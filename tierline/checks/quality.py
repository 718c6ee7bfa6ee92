"""Data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.checks import query
from tierline.checks.env import env
from tierline.operators.gold import gold_results
from tierline.operators.ordering import rank_desc, top1
from tierline.operators.quality import (failing_not_null, failing_unique,
                                        failing_year_range, missing_children,
                                        null_count_by_file, null_counts)
from tierline.plans.lake import read_bronze
from tierline.schemas import AUDIT_DIMS
from tierline.sinks.files import append_json
from tierline.sources.files import partition_value


@query("dq_null_by_file", """
SELECT season_id AS season_part, count(*) AS null_position_count
FROM f_classifications WHERE position IS NULL GROUP BY season_id""")
def dq_null_by_file(spark, sf_dir):
    """Null positions per landed file, appended as NDJSON findings, read
    back and summed per season (the stable part of the file path)."""
    e = env(spark, sf_dir)
    landed = read_bronze(spark, e.lake, "classifications", filename="filename")
    findings = null_count_by_file(landed)
    path = e.scratch("dq_findings")
    append_json(findings, path)
    back = spark.read.schema("filename string, NULL_POSITION_COUNT long").json(path)
    return (back.groupBy(partition_value(F.col("filename"), "season_id").alias("season_part"))
                .agg(F.sum("NULL_POSITION_COUNT").cast("long").alias("null_position_count")))


@query("test_not_null", """
SELECT session_id, name FROM f_classifications WHERE position IS NULL""")
def test_not_null(spark, sf_dir):
    cls = env(spark, sf_dir).src.classifications
    return failing_not_null(cls, "position").select("session_id", "name")


@query("test_unique", """
SELECT session_id, position, count(*) AS n FROM f_classifications
GROUP BY session_id, position HAVING count(*) > 1""")
def test_unique(spark, sf_dir):
    cls = env(spark, sf_dir).src.classifications
    return failing_unique(cls, ["session_id", "position"])


@query("test_year_range", """
y AS (SELECT id, CAST(1940 + row_number() OVER (ORDER BY id) * 7 AS INTEGER) AS year FROM f_events)
SELECT id, year FROM y WHERE year NOT BETWEEN 1949 AND year(current_date)""")
def test_year_range(spark, sf_dir):
    """Every event with a year of its own, from 1947 to 2115: those outside
    the documented range."""
    events = rank_desc(env(spark, sf_dir).src.events.select("id"), "id", "back")
    total = events.agg(F.count(F.lit(1)).alias("_n"))
    years = events.join(total).select("id", (F.lit(1940) + (F.col("_n") - F.col("back") + 1) * 7)
                                      .cast("int").alias("year"))
    return failing_year_range(years)


_AUDIT_GOLD = """
g AS (
  SELECT se.year, e.name AS event, ca.name AS category, s.name AS session
  FROM f_classifications c
  LEFT JOIN (SELECT * FROM f_seasons WHERE year < (SELECT max(year) FROM f_seasons)) se
    ON se.id = c.season_id
  LEFT JOIN f_events e ON e.id = c.event_id
  LEFT JOIN f_categories ca ON ca.id = c.category_id AND ca.event_id = c.event_id
  LEFT JOIN f_sessions s ON s.id = c.session_id)
SELECT 'year' AS dim, count(*) FILTER (WHERE year IS NULL) AS nulls FROM g
UNION ALL SELECT 'event', count(*) FILTER (WHERE event IS NULL) FROM g
UNION ALL SELECT 'category', count(*) FILTER (WHERE category IS NULL) FROM g
UNION ALL SELECT 'session', count(*) FILTER (WHERE session IS NULL) FROM g"""


@query("audit_null_dims", _AUDIT_GOLD)
def audit_null_dims(spark, sf_dir):
    """Gold built while the latest season is missing from the seasons
    dimension; one pass counts NULLs of all four audited dimensions."""
    s = env(spark, sf_dir).src
    latest = top1(s.seasons, "year", "id").select("id")
    seasons = s.seasons.join(latest, "id", "left_anti")
    g = gold_results(s.classifications, seasons, s.events, s.categories, s.sessions,
                     style="table")
    return null_counts(g, AUDIT_DIMS)


@query("empty_children", """
SELECT 'seasons' AS level, p.id AS parent_id FROM f_seasons p
  ANTI JOIN p_events c ON c.season_id = p.id
UNION ALL SELECT 'events', p.id FROM p_events p ANTI JOIN p_categories c ON c.event_id = p.id
UNION ALL SELECT 'categories', p.id FROM p_categories p ANTI JOIN p_sessions c
  ON c.event_id = p.event_id AND c.category_id = p.id
UNION ALL SELECT 'sessions', p.id FROM p_sessions p
  ANTI JOIN f_classifications c ON c.session_id = p.id""")
def empty_children(spark, sf_dir):
    e = env(spark, sf_dir)
    s, c = e.src, e.gaps
    parts = [
        missing_children(c.seasons, c.events, [("id", "season_id")], "seasons"),
        missing_children(c.events, c.categories, [("id", "event_id")], "events"),
        missing_children(c.categories, c.sessions,
                         [("event_id", "event_id"), ("id", "category_id")], "categories"),
        missing_children(c.sessions, s.classifications, [("id", "session_id")], "sessions"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
