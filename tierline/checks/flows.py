"""End-to-end runs (L1-L4) and incremental file ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.checks import query
from tierline.checks.core import GOLD_DBT_SQL, GOLD_TABLE_SQL
from tierline.checks.env import env
from tierline.operators.crawl import crawl
from tierline.operators.hierarchy import descendants
from tierline.operators.ordering import top1
from tierline.operators.runlog import STAGE_SILVER
from tierline.operators.taskqueue import TaskQueue, without_clocks
from tierline.plans import runs
from tierline.plans.changes import MEASURES, FileLedger
from tierline.plans.lake import Lake, land_entity, read_silver
from tierline.plans.medallion import land_classifications, land_crawl
from tierline.schemas import SESSIONS, S, TASK_KEYS, struct
from tierline.sinks.files import land_csv
from tierline.sources.entities import EntitySource, land_payload_entities, payload_entities
from tierline.sources.files import read_csv_typed
from tierline.streaming.new_files import batch_folder_sink, ingest_new_files, queue_sink
from tierline.tables.clustered import write_clustered

@query("medallion_transform", "SELECT * FROM f_gold")
def medallion_transform(spark, sf_dir):
    e = env(spark, sf_dir)
    return runs.transform(spark, Lake(e.scratch("transform")), e.src)


@query("medallion_full", "SELECT * FROM f_gold")
def medallion_full(spark, sf_dir):
    """Full run with the queue: every season, every open task."""
    e = env(spark, sf_dir)
    rep = runs.run(spark, Lake(e.scratch("full")), e.src, runs.FULL, run_id="full-1")
    return rep.gold


@query("medallion_incremental", """
latest AS (SELECT id FROM f_seasons ORDER BY year DESC, id LIMIT 1),
batch AS (SELECT id FROM f_sessions WHERE season_id IN (SELECT id FROM latest)
          ORDER BY id LIMIT 200)
SELECT se.year, e.name AS event_name, e.sname AS event_short_name, ca.name AS category,
       s.name AS session, c.name AS rider_name, c.number AS rider_number, c.position,
       c.points
FROM f_classifications c
LEFT JOIN f_seasons se ON se.id = c.season_id
LEFT JOIN f_events e ON e.id = c.event_id
LEFT JOIN f_categories ca ON ca.id = c.category_id AND ca.event_id = c.event_id
LEFT JOIN f_sessions s ON s.id = c.session_id
WHERE c.session_id IN (SELECT id FROM batch)""")
def medallion_incremental(spark, sf_dir):
    """Two incremental runs of 100 tasks each on a fresh lake; gold then
    holds the rows of the first 200 open tasks of the latest season."""
    e = env(spark, sf_dir)
    lake = Lake(e.scratch("incremental"))
    runs.run(spark, lake, e.src, runs.INCREMENTAL, n=100, run_id="inc-1")
    rep = runs.run(spark, lake, e.src, runs.INCREMENTAL, n=100, run_id="inc-2")
    return rep.gold


_FIRST_200 = """
latest AS (SELECT id FROM f_seasons ORDER BY year DESC, id LIMIT 1),
batch AS (SELECT id, row_number() OVER (ORDER BY id) AS nth FROM f_sessions
          WHERE season_id IN (SELECT id FROM latest) QUALIFY nth <= 200)"""


def _two_runs(spark, sf_dir, name):
    """A lake after two incremental runs of 100 tasks, and the last report."""
    e = env(spark, sf_dir)
    lake = Lake(e.scratch(name))
    runs.run(spark, lake, e.src, runs.INCREMENTAL, n=100, run_id="inc-1")
    return lake, runs.run(spark, lake, e.src, runs.INCREMENTAL, n=100, run_id="inc-2")


@query("incremental_change_set", f"""{_FIRST_200}
SELECT DISTINCT c.season_id, c.event_id, 'classifications' AS kind
FROM f_classifications c JOIN batch b ON b.id = c.session_id WHERE b.nth > 100""")
def incremental_change_set(spark, sf_dir):
    """What the second of two incremental runs has to rewrite: the events of
    its own 100 tasks."""
    _, rep = _two_runs(spark, sf_dir, "changes")
    return rep.changes.rows.distinct()


@query("dq_incremental", f"""{_FIRST_200}
SELECT c.season_id, c.event_id, count(*) AS n_rows, count(*) - count(c.number) AS null_number,
       count(*) - count(c.position) AS null_position, count(*) - count(c.points) AS null_points
FROM f_classifications c JOIN batch b ON b.id = c.session_id GROUP BY c.season_id, c.event_id""")
def dq_incremental(spark, sf_dir):
    """Partial aggregates of the landed files of two runs, each file counted
    by the run that landed it, added up per event."""
    lake, _ = _two_runs(spark, sf_dir, "dq")
    return FileLedger(spark, lake).known().groupBy("season_id", "event_id").agg(
        F.sum("rows").alias("n_rows"), *[F.sum(f"null_{m}").alias(f"null_{m}") for m in MEASURES])


@query("medallion_changed_dimensions", """
latest AS (SELECT id FROM f_seasons ORDER BY year DESC, id LIMIT 1),
ev AS (SELECT min(id) AS id FROM f_events WHERE season_id IN (SELECT id FROM latest)),
ses AS (SELECT max(id) AS id FROM f_sessions WHERE season_id IN (SELECT id FROM latest))
SELECT se.year, CASE WHEN e.id IN (SELECT id FROM ev) THEN e.name || ' (new)' ELSE e.name END AS event_name,
       e.sname AS event_short_name, ca.name AS category,
       CASE WHEN s.id IN (SELECT id FROM ses) THEN s.name || ' (new)' ELSE s.name END AS session,
       c.name AS rider_name, c.number AS rider_number, c.position, c.points
FROM f_classifications c
LEFT JOIN f_seasons se ON se.id = c.season_id
LEFT JOIN f_events e ON e.id = c.event_id
LEFT JOIN f_categories ca ON ca.id = c.category_id AND ca.event_id = c.event_id
LEFT JOIN f_sessions s ON s.id = c.session_id""")
def medallion_changed_dimensions(spark, sf_dir):
    """A full run; then the source renames an event and a session of the
    latest season, and an incremental run takes that up: gold is that of a
    full build over the changed source."""
    e = env(spark, sf_dir)
    s, lake = e.src, Lake(e.scratch("renamed"))
    runs.run(spark, lake, s, runs.FULL, run_id="full")
    latest = top1(s.seasons, "year", "id").select(F.col("id").alias("season_id"))

    def renamed(df, pick):
        one = df.join(latest, "season_id").agg(pick("id").alias("_one"))
        return df.join(one, df["id"] == one["_one"], "left").withColumn(
            "name", F.when(F.col("_one").isNull(), F.col("name")).otherwise(F.concat("name", F.lit(" (new)")))) \
            .select(*df.columns)
    changed = EntitySource(s.seasons, renamed(s.events, F.min), s.categories, renamed(s.sessions, F.max),
                           s.classifications)
    return runs.run(spark, lake, changed, runs.INCREMENTAL, n=1, run_id="inc").gold


@query("medallion_restart", "SELECT * FROM f_gold")
def medallion_restart(spark, sf_dir):
    """A full run dies after landing, before silver; the next run, under a
    new id, takes up what is landed and ends as one clean run would."""
    e = env(spark, sf_dir)
    lake = Lake(e.scratch("restart"))

    def dies(stage):
        if stage == STAGE_SILVER:
            raise InterruptedError("killed after landing")
    try:
        runs.run(spark, lake, e.src, runs.FULL, run_id="dead", on_stage=dies)
    except InterruptedError:
        pass
    return runs.run(spark, lake, e.src, runs.FULL, run_id="again").gold


@query("medallion_mixed_modes", "SELECT * FROM f_gold")
def medallion_mixed_modes(spark, sf_dir):
    """A transform, then a full run on the same lake: everything is landed
    already, so nothing doubles."""
    e = env(spark, sf_dir)
    lake = Lake(e.scratch("mixed"))
    runs.transform(spark, lake, e.src)
    return runs.run(spark, lake, e.src, runs.FULL, run_id="full-1").gold


@query("medallion_from_payloads", "SELECT * FROM f_gold")
def medallion_from_payloads(spark, sf_dir):
    """Every entity is landed as JSON payloads first; the whole flow then
    reads those payloads."""
    e = env(spark, sf_dir)
    root = e.scratch("payload_source")
    land_payload_entities(e.src, root)
    return runs.transform(spark, Lake(e.scratch("from_payloads")), payload_entities(spark, root))


@query("medallion_models", GOLD_DBT_SQL)
def medallion_models(spark, sf_dir):
    e = env(spark, sf_dir)
    return runs.models(spark, e.lake, e.scratch("models"))


@query("models_changed_only", GOLD_DBT_SQL.replace("SELECT year,", "SELECT year + 1 AS year,"))
def models_changed_only(spark, sf_dir):
    """The model graph is built, the seasons are landed anew a year later, and
    a second build makes only what depends on them."""
    e = env(spark, sf_dir)
    lake, out = Lake(e.scratch("models_lake")), e.scratch("models_kept")
    c = land_crawl(spark, lake, e.src.seasons, e.src)
    land_classifications(lake, c.tasks, e.src.classifications, replace=True)
    runs.model_graph(spark, lake, out, changed_only=True).ref("fct_placements")
    land_entity(lake, "seasons", e.src.seasons.withColumn("year", (F.col("year") + 1).cast("int")))
    again = runs.model_graph(spark, lake, out, changed_only=True)
    mart = again.ref("fct_placements")
    if sorted(again.rebuilt) != ["fct_placements", "stg_seasons"]:
        raise AssertionError(f"models built again: {again.rebuilt}")
    return mart


@query("medallion_wap", GOLD_TABLE_SQL)
def medallion_wap(spark, sf_dir):
    e = env(spark, sf_dir)
    lake = Lake(e.scratch("wap"))
    # Bronze is shared with the other queries: point the run at it.
    return runs.wap_run(spark, lake, bronze_root=e.lake.root)


@query("stream_new_files", """
latest AS (SELECT id FROM f_seasons ORDER BY year DESC, id LIMIT 1)
SELECT id, CASE WHEN season_id IN (SELECT id FROM latest) THEN 1 ELSE 0 END AS batch_no
FROM f_sessions""")
def stream_new_files(spark, sf_dir):
    """Sessions of all seasons but the latest land first; one availableNow
    run takes them as batch 0.  The latest season lands next; the second
    run takes only those new files, as batch 1."""
    e = env(spark, sf_dir)
    s = e.src
    latest = top1(s.seasons, "year", "id").select(F.col("id").alias("season_id"))
    landing, out, ckpt = e.scratch("stream_in"), e.scratch("stream_out"), e.scratch("ckpt")
    sink = batch_folder_sink(out)
    land_csv(s.sessions.join(latest, "season_id", "left_anti").select(*SESSIONS.names),
             landing, mode="append")
    ingest_new_files(spark, landing, SESSIONS, ckpt, sink)
    land_csv(s.sessions.join(latest, "season_id", "left_semi").select(*SESSIONS.names),
             landing, mode="append")
    ingest_new_files(spark, landing, SESSIONS, ckpt, sink)
    return spark.read.parquet(out).select("id", "batch_no")


@query("queue_from_stream", """
SELECT id, season_id, event_id, category_id, session_id, status, attempt, false AS has_updated FROM (
  SELECT id, season_id, event_id, category_id, id AS session_id, 0 AS status, 0 AS attempt FROM f_sessions)""")
def queue_from_stream(spark, sf_dir):
    """Sessions arrive as files in two waves that overlap: the second repeats
    every session of the first one's last season, with a later time.  Repeats
    within the watermark end in the stream's state, others in the queue."""
    e = env(spark, sf_dir)
    seasons = e.src.seasons.select(F.col("id").alias("season_id"), "year")
    timed = e.src.sessions.join(seasons, "season_id").withColumn(
        "seen_at", F.make_timestamp(F.col("year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    newest = top1(e.src.seasons, "year", "id").select(F.col("id").alias("season_id"))
    second = top1(e.src.seasons.join(newest, e.src.seasons["id"] == newest["season_id"], "left_anti"), "year", "id") \
        .select(F.col("id").alias("season_id"))
    landing, ckpt = e.scratch("queue_in"), e.scratch("queue_ckpt")
    queue = TaskQueue(spark, e.scratch("queue_of_stream"))
    schema = T.StructType([*SESSIONS.fields, T.StructField("seen_at", T.TimestampType())])
    waves = [timed.join(newest, "season_id", "left_anti"),
             timed.join(newest.unionByName(second), "season_id", "left_semi")
             .withColumn("seen_at", F.col("seen_at") + F.expr("INTERVAL 1 HOUR"))]
    for rows in waves:
        land_csv(rows.select(*schema.names), landing, mode="append")
        ingest_new_files(spark, landing, schema, ckpt, queue_sink(queue), once=("id", "seen_at", "1 day"))
    return without_clocks(queue.state())


@query("crawl_closure", """
edges AS (SELECT season_id AS parent, id AS child FROM f_events
  UNION SELECT event_id, event_id || '/' || id FROM f_categories
  UNION SELECT event_id || '/' || category_id, id FROM f_sessions
  UNION SELECT max(id), max(season_id) FROM f_sessions),
closure AS (SELECT root, node, min(depth) AS depth FROM (
  WITH RECURSIVE walk(root, node, depth) AS (
    SELECT id, id, 0 FROM f_seasons
    UNION SELECT w.root, e.child, w.depth + 1 FROM walk w JOIN edges e ON e.parent = w.node WHERE w.depth < 9)
  SELECT * FROM walk) GROUP BY root, node)
SELECT root, node, CAST(depth AS INTEGER) AS depth FROM closure""")
def crawl_closure(spark, sf_dir):
    """Everything below each season, over an edge table that does not know the
    levels; one edge leads back from a session to a season, a cycle."""
    s = env(spark, sf_dir).src
    pair = F.concat("event_id", F.lit("/"), F.col("id"))
    edges = s.events.select(F.col("season_id").alias("parent"), F.col("id").alias("child")) \
        .unionByName(s.categories.select(F.col("event_id").alias("parent"), pair.alias("child"))) \
        .unionByName(s.sessions.select(F.concat("event_id", F.lit("/"), "category_id").alias("parent"),
                                       F.col("id").alias("child"))) \
        .unionByName(s.sessions.agg(F.max("id").alias("parent"), F.max("season_id").alias("child")))
    return descendants(edges, s.seasons.select(F.col("id").alias("root")))


@query("lookup_clustered", """
busy AS (SELECT session_id AS id FROM f_classifications GROUP BY session_id ORDER BY count(*) DESC, session_id LIMIT 1)
SELECT c.* FROM f_classifications c WHERE c.session_id IN (SELECT id FROM busy)
  OR c.name IN (SELECT min(name) FROM f_classifications)""")
def lookup_clustered(spark, sf_dir):
    """Point lookups by session and by rider on a copy of silver that is
    clustered by both."""
    e = env(spark, sf_dir)
    silver, path = read_silver(spark, e.lake, "classifications"), e.scratch("clustered")
    write_clustered(silver, path, ["session_id", "name"], bloom=["session_id"], group_bytes=1 << 20)
    rows = spark.read.schema(silver.schema).parquet(path)
    busy = rows.groupBy("session_id").count().orderBy(F.desc("count"), "session_id").first()[0]
    rider = rows.agg(F.min("name")).first()[0]
    return rows.filter((F.col("session_id") == busy) | (F.col("name") == rider))


@query("crawl_tasks", """
SELECT season_id, event_id, category_id, id AS session_id FROM f_sessions""")
def crawl_tasks(spark, sf_dir):
    """Seasons -> events -> categories -> sessions by one join per level;
    the task list is written as CSV with a header and read back."""
    e = env(spark, sf_dir)
    c = crawl(e.src.seasons, e.src.events, e.src.categories, e.src.sessions)
    path = e.scratch("task_list")
    land_csv(c.tasks, path)
    return read_csv_typed(spark, path, struct(*[(k, S) for k in TASK_KEYS]))


@query("crawl_full", """
n AS (SELECT session_id, count(*) AS n_rows FROM f_classifications GROUP BY session_id)
SELECT s.season_id, s.event_id, s.category_id, s.id AS session_id,
       coalesce(n.n_rows, 0) AS n_rows
FROM f_sessions s LEFT JOIN n ON n.session_id = s.id""")
def crawl_full(spark, sf_dir):
    """The crawl down to the leaf: every task with its number of
    classification rows (0 for a session without data)."""
    e = env(spark, sf_dir)
    c = crawl(e.src.seasons, e.src.events, e.src.categories, e.src.sessions)
    leaf = (e.src.classifications.groupBy("session_id")
            .agg(F.count(F.lit(1)).alias("n_rows")))
    return (c.tasks.join(leaf, "session_id", "left")
            .select("season_id", "event_id", "category_id", "session_id",
                    F.coalesce(F.col("n_rows"), F.lit(0)).cast("long").alias("n_rows")))
