"""Task queue transitions and log-derived keys (Q3, Q4, Q8, Q9, Q11)."""

import os
import uuid

from pyspark.sql import functions as F

from tierline.functions.logs import requests_per_second
from tierline.operators.runlog import failed_keys, failed_sets, parse_log
from tierline.session import local_path
from tierline.operators.taskqueue import (TaskQueue, apply_run, empty_queue, next_batch,
                                          upsert)
from tierline.schemas import COMPLETED, ERRORED, PENDING

KEYS = "season_id string, event_id string, category_id string, session_id string"


def _u():
    return str(uuid.uuid4())


def _keys(spark, rows):
    return spark.createDataFrame(rows, KEYS)


def test_upsert_collapses_duplicates_and_keeps_known_rows(spark):
    s, e, c = _u(), _u(), _u()
    known, new = _u(), _u()
    q = upsert(empty_queue(spark), _keys(spark, [(s, e, c, known)]))
    q = q.withColumn("status", F.lit(COMPLETED))
    q2 = upsert(q, _keys(spark, [(s, e, c, known), (s, e, c, new), (s, e, c, new)]))
    got = {r.id: (r.status, r.attempt) for r in q2.collect()}
    assert got == {known: (COMPLETED, 0), new: (PENDING, 0)}


def test_new_tasks_plan_is_an_anti_join(spark):
    q = upsert(empty_queue(spark), _keys(spark, [("s", "e", "c", "x")]))
    plan = upsert(q, _keys(spark, [("s", "e", "c", "y")]))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "LeftAnti" in plan


def test_next_batch_is_ordered_by_id_and_skips_done(spark):
    rows = [("s", "e", "c", i) for i in ["d", "a", "c", "b"]]
    q = upsert(empty_queue(spark), _keys(spark, rows))
    q = q.withColumn("status", F.when(F.col("id") == "a", COMPLETED).otherwise(F.col("status")))
    assert [r.session_id for r in next_batch(q, 2).collect()] == ["b", "c"]


def _log(spark, lines):
    return spark.createDataFrame([(f"2024-01-01T00:00:00Z [{lv}] {m}",) for lv, m in lines],
                                 "value string")


def test_failed_keys_from_each_error_kind(spark):
    s, e, c, x = _u(), _u(), _u(), _u()
    lines = [("INFO", f"getting events for season: {s}"),
             ("ERROR", f"found no events for season: {s}"),
             ("ERROR", f"found no categories for event: {e}"),
             ("ERROR", f"found no sessions for event: {e}, category: {c}"),
             ("ERROR", f"found no classification data for session: {x}"),
             ("ERROR", f"found no classification data for session: {x}")]
    f = failed_sets(failed_keys(parse_log(_log(spark, lines))))
    assert [r.season_id for r in f["seasons"].collect()] == [s]
    assert [r.event_id for r in f["events"].collect()] == [e]
    assert [(r.event_id, r.category_id) for r in f["pairs"].collect()] == [(e, c)]
    assert [r.session_id for r in f["sessions"].collect()] == [x]


def test_errored_beats_completed_and_completed_is_not_restamped(spark):
    s, e, c = _u(), _u(), _u()
    both, done, done_before, open_ = _u(), _u(), _u(), _u()
    q = upsert(empty_queue(spark), _keys(spark, [(s, e, c, t) for t in
                                                  [both, done, done_before, open_]]))
    q = q.withColumn("status", F.when(F.col("id") == done_before, COMPLETED)
                     .otherwise(F.col("status")))
    landed = spark.createDataFrame([(both,), (done,), (done_before,)], "session_id string")
    log = _log(spark, [("ERROR", f"found no classification data for session: {both}")])
    out = {r.id: (r.status, r.updated_timestamp is not None)
           for r in apply_run(q, landed, failed_sets(failed_keys(parse_log(log)))).collect()}
    assert out[both] == (ERRORED, True)
    assert out[done] == (COMPLETED, True)
    assert out[done_before] == (COMPLETED, False)
    assert out[open_] == (PENDING, False)


def test_the_same_id_under_other_keys_is_one_task(spark):
    rows = [("s2", "e", "c", "x"), ("s1", "e", "d", "x"), ("s1", "e", "c", "x")]
    got = upsert(empty_queue(spark), _keys(spark, rows)).collect()
    assert [(r.season_id, r.event_id, r.category_id) for r in got] == [("s1", "e", "c")]


def test_every_open_task_without_a_number(spark):
    q = upsert(empty_queue(spark), spark.range(70_000).select(
        F.lit("s").alias("season_id"), F.lit("e").alias("event_id"), F.lit("c").alias("category_id"),
        F.col("id").cast("string").alias("session_id")))
    assert next_batch(q).count() == 70_000


def test_queue_states_are_published(spark, folder):
    tq = TaskQueue(spark, folder("queue"))
    tq.upsert(_keys(spark, [("s", "e", "c", "a")]))
    tq.upsert(_keys(spark, [("s", "e", "c", "a"), ("s", "e", "c", "b")]))
    assert tq.state().count() == 2
    assert sorted(r.id for r in TaskQueue(spark, tq.location).state(["s"]).collect()) == ["a", "b"]


def test_rps_is_floored_and_null_under_one_second(spark):
    df = spark.createDataFrame([(10, 999), (10, 1000), (10, 3999), (7, 2000)],
                               "r long, ms long")
    got = [r[0] for r in df.select(requests_per_second(F.col("r"), F.col("ms"))).collect()]
    assert got == [None, 10, 3, 3]


def test_queue_commits_only_touched_seasons(spark, folder):
    tq = TaskQueue(spark, folder("queue"))
    tq.upsert(_keys(spark, [("s1", "e", "c", "a"), ("s2", "e", "c", "b")]))
    def files_of(season):
        return sorted(os.listdir(f"{local_path(tq.location)}/season_id={season}"))
    first = {s: files_of(s) for s in ("s1", "s2")}
    tq.upsert(_keys(spark, [("s2", "e", "c", "c")]))
    assert files_of("s1") == first["s1"]          # season s1 was not rewritten
    assert files_of("s2") != first["s2"]
    assert sorted(r.id for r in tq.state().collect()) == ["a", "b", "c"]
    landed = spark.createDataFrame([("b",)], "session_id string")
    empty = spark.createDataFrame([], "season_id string")
    failed = {"seasons": empty, "events": empty.withColumnRenamed("season_id", "event_id"),
              "pairs": spark.createDataFrame([], "event_id string, category_id string"),
              "sessions": empty.withColumnRenamed("season_id", "session_id")}
    tq.apply_run(landed, failed, seasons=["s2"])
    assert files_of("s1") == first["s1"]
    got = {r.id: r.status for r in tq.state().collect()}
    assert got == {"a": PENDING, "b": COMPLETED, "c": PENDING}
