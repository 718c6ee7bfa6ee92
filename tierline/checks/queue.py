"""Task queue and incremental runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.checks import query
from tierline.checks.env import env
from tierline.operators.crawl import crawl, expand_classifications, task_keys
from tierline.operators.ordering import first_n, top1
from tierline.operators.taskqueue import (TaskQueue, apply_run, mark, mark_completed,
                                          new_tasks, next_batch, open_tasks, upsert, with_defaults,
                                          without_clocks)
from tierline.oracle import UUID_SQL
from tierline.plans.lake import read_silver
from tierline.schemas import ERRORED, TASK_KEYS, TASKS

_BAD = f"""
bad_seasons AS (SELECT DISTINCT unnest(regexp_extract_all(message, {UUID_SQL}, 0)) AS season_id
  FROM f_log WHERE level = 'ERROR' AND message LIKE 'found no events%'),
bad_events AS (SELECT DISTINCT unnest(regexp_extract_all(message, {UUID_SQL}, 0)) AS event_id
  FROM f_log WHERE level = 'ERROR' AND message LIKE 'found no categories%'),
bad_pairs AS (SELECT DISTINCT regexp_extract_all(message, {UUID_SQL}, 0)[1] AS event_id,
    regexp_extract_all(message, {UUID_SQL}, 0)[2] AS category_id
  FROM f_log WHERE level = 'ERROR' AND message LIKE 'found no sessions%'),
bad_sessions AS (SELECT DISTINCT unnest(regexp_extract_all(message, {UUID_SQL}, 0)) AS session_id
  FROM f_log WHERE level = 'ERROR' AND message LIKE 'found no classification%'),
landed AS (SELECT DISTINCT session_id FROM f_classifications)"""


def _state(e):
    """Queue state before the run: status derived from the order status."""
    s = e.src.task_state
    return with_defaults(s, status=F.col("status")).select(*TASKS.names)


def _landed(spark, e):
    return read_silver(spark, e.lake, "classifications").select("session_id")


@query("queue_create_defaults", """
SELECT id, 0 AS status, 0 AS attempt, false AS has_updated FROM f_sessions""")
def queue_create_defaults(spark, sf_dir):
    e = env(spark, sf_dir)
    q = TaskQueue(spark, e.scratch("queue"))
    state = q.upsert(task_keys(e.src.sessions))
    return without_clocks(state).select("id", "status", "attempt", "has_updated")


_KNOWN = "known AS (SELECT * FROM f_tasks WHERE status <> 0)"


@query("queue_new_tasks", f"""
{_KNOWN}
SELECT id, season_id, event_id, category_id, id AS session_id, 0 AS status, 0 AS attempt
FROM f_sessions WHERE id NOT IN (SELECT id FROM known)""")
def queue_new_tasks(spark, sf_dir):
    """Known = tasks already done or failed; the batch is every task key
    plus the latest season's keys a second time (duplicates)."""
    e = env(spark, sf_dir)
    known = _state(e).filter(F.col("status") != 0)
    keys = task_keys(e.src.sessions)
    latest = top1(e.src.seasons, "year", "id").select(F.col("id").alias("season_id"))
    batch = keys.unionByName(keys.join(latest, "season_id", "left_semi"))
    return new_tasks(known, batch).drop("added_timestamp", "updated_timestamp")


@query("queue_upsert", f"""
{_KNOWN}
SELECT id, season_id, event_id, category_id, session_id, status, 0 AS attempt FROM known
UNION ALL
SELECT id, season_id, event_id, category_id, id, 0, 0 FROM f_sessions
WHERE id NOT IN (SELECT id FROM known)""")
def queue_upsert(spark, sf_dir):
    e = env(spark, sf_dir)
    known = _state(e).filter(F.col("status") != 0)
    keys = task_keys(e.src.sessions)
    out = upsert(known, keys.unionByName(keys))
    return out.drop("added_timestamp", "updated_timestamp")


@query("queue_next_batch", """
SELECT season_id, event_id, category_id, session_id FROM f_tasks
WHERE status < 2 ORDER BY id LIMIT 100""")
def queue_next_batch(spark, sf_dir):
    return next_batch(_state(env(spark, sf_dir)), 100)


@query("queue_first_many", """
SELECT season_id, event_id, category_id, id AS session_id FROM f_tasks WHERE status < 2
ORDER BY id LIMIT (SELECT count(*) * 2 // 3 FROM f_tasks WHERE status < 2)""")
def queue_first_many(spark, sf_dir):
    """The first two thirds of all open tasks by id, cut by a histogram: only
    an interval of at most 1,000 rows is ordered."""
    todo = open_tasks(_state(env(spark, sf_dir)))
    return first_n(todo, "id", todo.count() * 2 // 3, interval=1000).select(*TASK_KEYS)


@query("queue_mark_completed", """
landed AS (SELECT DISTINCT session_id FROM f_classifications)
SELECT t.id,
       CASE WHEN l.session_id IS NOT NULL AND t.status <> 2 THEN 2 ELSE t.status END AS status,
       (l.session_id IS NOT NULL AND t.status <> 2) AS has_updated
FROM f_tasks t LEFT JOIN landed l ON l.session_id = t.id""")
def queue_mark_completed(spark, sf_dir):
    e = env(spark, sf_dir)
    out = mark_completed(_state(e), _landed(spark, e))
    return without_clocks(out).select("id", "status", "has_updated")


def _errored_sql(cte: str, cond: str) -> str:
    return f"""
{_BAD}
SELECT t.id, CASE WHEN EXISTS (SELECT 1 FROM {cte} b WHERE {cond}) THEN 4 ELSE t.status END
         AS status,
       EXISTS (SELECT 1 FROM {cte} b WHERE {cond}) AS has_updated
FROM f_tasks t"""


@query("queue_mark_errored_events",
       _errored_sql("bad_seasons", "b.season_id = t.season_id"))
def queue_mark_errored_events(spark, sf_dir):
    e = env(spark, sf_dir)
    out = mark(_state(e), e.failed["seasons"], [("season_id", "season_id")], ERRORED)
    return without_clocks(out).select("id", "status", "has_updated")


@query("queue_mark_errored_categories",
       _errored_sql("bad_events", "b.event_id = t.event_id"))
def queue_mark_errored_categories(spark, sf_dir):
    e = env(spark, sf_dir)
    out = mark(_state(e), e.failed["events"], [("event_id", "event_id")], ERRORED)
    return without_clocks(out).select("id", "status", "has_updated")


@query("queue_mark_errored_sessions",
       _errored_sql("bad_pairs", "b.event_id = t.event_id AND b.category_id = t.category_id"))
def queue_mark_errored_sessions(spark, sf_dir):
    e = env(spark, sf_dir)
    out = mark(_state(e), e.failed["pairs"],
               [("event_id", "event_id"), ("category_id", "category_id")], ERRORED)
    return without_clocks(out).select("id", "status", "has_updated")


@query("queue_mark_errored_classification",
       _errored_sql("bad_sessions", "b.session_id = t.session_id"))
def queue_mark_errored_classification(spark, sf_dir):
    e = env(spark, sf_dir)
    out = mark(_state(e), e.failed["sessions"], [("session_id", "session_id")],
               ERRORED)
    return without_clocks(out).select("id", "status", "has_updated")


@query("queue_apply_run", f"""
{_BAD},
flags AS (
  SELECT t.id, t.status,
    (EXISTS (SELECT 1 FROM bad_seasons b WHERE b.season_id = t.season_id)
     OR EXISTS (SELECT 1 FROM bad_events b WHERE b.event_id = t.event_id)
     OR EXISTS (SELECT 1 FROM bad_pairs b WHERE b.event_id = t.event_id
                AND b.category_id = t.category_id)
     OR EXISTS (SELECT 1 FROM bad_sessions b WHERE b.session_id = t.session_id)) AS err,
    (EXISTS (SELECT 1 FROM landed l WHERE l.session_id = t.id) AND t.status <> 2) AS done
  FROM f_tasks t)
SELECT id, CASE WHEN err THEN 4 WHEN done THEN 2 ELSE status END AS status,
       (err OR done) AS has_updated
FROM flags""")
def queue_apply_run(spark, sf_dir):
    e = env(spark, sf_dir)
    out = apply_run(_state(e), _landed(spark, e), e.failed)
    return without_clocks(out).select("id", "status", "has_updated")


@query("incremental_batch", """
latest AS (SELECT id FROM f_seasons ORDER BY year DESC, id LIMIT 1),
batch AS (SELECT id FROM f_tasks WHERE status < 2 AND season_id IN (SELECT id FROM latest)
          ORDER BY id LIMIT 100)
SELECT c.* FROM f_classifications c WHERE c.session_id IN (SELECT id FROM batch)""")
def incremental_batch(spark, sf_dir):
    """Incremental run: crawl the latest season only, queue its tasks over
    the prior state, take the next 100 open tasks, fetch their rows."""
    e = env(spark, sf_dir)
    s = e.src
    latest = top1(s.seasons, "year", "id")
    c = crawl(latest, s.events, s.categories, s.sessions)
    prior = _state(e).join(c.tasks.select("session_id"), "session_id", "left_semi")
    q = TaskQueue(spark, e.scratch("inc_queue"))
    q.save(prior.select(*TASKS.names), TaskQueue.seasons_of(prior))
    q.upsert(c.tasks)
    batch = q.next_batch(100)
    return expand_classifications(batch, s.classifications)

