"""Replaced tables and write-audit-publish."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tierline.checks import query
from tierline.checks.env import env
from tierline.operators.gold import gold_results
from tierline.operators.ordering import top1
from tierline.operators.quality import AuditError
from tierline.schemas import AUDIT_DIMS
from tierline.tables import wap
from tierline.tables.published import PublishedTable

_LATEST = "(SELECT id FROM f_seasons ORDER BY year DESC, id LIMIT 1)"
_A = f"SELECT * FROM f_sessions WHERE season_id <> {_LATEST}"


def _a_b(e):
    """A = sessions of every season but the latest, B = all sessions."""
    s = e.src
    latest = top1(s.seasons, "year", "id").select(F.col("id").alias("season_id"))
    return s.sessions.join(latest, "season_id", "left_anti"), s.sessions


def _table(spark, e, name):
    return PublishedTable(spark, e.scratch(name), name=f"suite_{e.tag}.{name}_{uuid.uuid4().hex[:8]}")


@query("table_create_or_replace", "SELECT * FROM f_sessions")
def table_create_or_replace(spark, sf_dir):
    e = env(spark, sf_dir)
    a, b = _a_b(e)
    t = _table(spark, e, "replace")
    t.replace(a)
    t.replace(b)
    return t.read()


@query("wap_stage_isolated", _A)
def wap_stage_isolated(spark, sf_dir):
    e = env(spark, sf_dir)
    a, b = _a_b(e)
    t = _table(spark, e, "wap_stage")
    t.replace(a)
    t.stage(b)
    return t.read()


@query("wap_read_branch", "SELECT * FROM f_sessions")
def wap_read_branch(spark, sf_dir):
    e = env(spark, sf_dir)
    a, b = _a_b(e)
    t = _table(spark, e, "wap_branch")
    t.replace(a)
    return t.read(t.stage(b).folder)


@query("wap_publish", "SELECT * FROM f_sessions")
def wap_publish(spark, sf_dir):
    e = env(spark, sf_dir)
    a, b = _a_b(e)
    t = _table(spark, e, "wap_publish")
    t.replace(a)
    staged = t.stage(b)
    wap.audit(t, staged, ["id", "season_id", "event_id", "category_id"])
    t.publish(staged)
    return t.read()


_GOLD_TABLE = """
SELECT year, event_name AS event, event_short_name AS event_short, category, session,
       rider_name, rider_number, position, points, true AS blocked
FROM f_gold"""


@query("wap_audit_blocks", _GOLD_TABLE)
def wap_audit_blocks(spark, sf_dir):
    """The table holds gold; a new gold built while the latest season is
    missing from the seasons dimension is staged, fails the audit, and the
    table keeps the published rows."""
    e = env(spark, sf_dir)
    s = e.src
    t = _table(spark, e, "wap_gold")
    good = gold_results(s.classifications, s.seasons, s.events, s.categories,
                        s.sessions, style="table")
    wap.write_audit_publish(t, good, AUDIT_DIMS)
    latest = top1(s.seasons, "year", "id").select("id")
    bad = gold_results(s.classifications, s.seasons.join(latest, "id", "left_anti"),
                       s.events, s.categories, s.sessions, style="table")
    blocked = False
    try:
        wap.write_audit_publish(t, bad, AUDIT_DIMS)
    except AuditError:
        blocked = True
    return t.read().withColumn("blocked", F.lit(blocked))


@query("wap_cleanup", "SELECT 'main' AS ref, count(*) AS n FROM f_sessions")
def wap_cleanup(spark, sf_dir):
    """Folders left after a write-audit-publish, a staging that was given up
    and a clean-up: only the published one."""
    e = env(spark, sf_dir)
    a, b = _a_b(e)
    t = _table(spark, e, "wap_cleanup")
    t.replace(a)
    published = wap.write_audit_publish(t, b, ["id"])
    t.stage(a)
    counts = [t.read(f).agg(F.count(F.lit(1)).alias("n"))
              .select(F.lit("main" if f == published else f).alias("ref"), "n") for f in t.remove_unused()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("time_travel_version", _A)
def time_travel_version(spark, sf_dir):
    """An earlier publish stays readable by its folder until clean-up."""
    e = env(spark, sf_dir)
    a, b = _a_b(e)
    t = _table(spark, e, "travel")
    first = t.replace(a)
    t.replace(b)
    return t.read(first)


@query("wap_reader_pinned", _A)
def wap_reader_pinned(spark, sf_dir):
    """A reader opened before a publish keeps reading its folder."""
    e = env(spark, sf_dir)
    a, b = _a_b(e)
    t = _table(spark, e, "pinned")
    t.replace(a)
    reader = t.read()
    wap.write_audit_publish(t, b, ["id"])
    return reader
