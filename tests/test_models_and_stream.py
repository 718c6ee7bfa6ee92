"""Model graph source tests, lookups, ordering and file streams."""

import pytest
from pyspark.sql import functions as F

from tierline.operators.lookup import lookup_by
from tierline.operators.ordering import rank_desc, top1
from tierline.plans.lake import Lake, land_entity
from tierline.plans.models import DataTestError, ModelGraph, passthrough
from tierline.schemas import SEASONS, SESSIONS
from tierline.sinks.files import land_csv
from tierline.sources.registry import SourceRegistry
from tierline.streaming.new_files import batch_folder_sink, ingest_new_files


def test_source_tests_block_dependants(spark, folder):
    lake = Lake(folder())
    land_entity(lake, "seasons", spark.createDataFrame([("a", 2023), ("b", 2023)], SEASONS))
    reg = SourceRegistry(spark, lake.root + "/bronze/{name}").declare("seasons", SEASONS)
    g = ModelGraph(spark, reg, folder() + "/{name}")
    g.test("seasons", "unique", "year")
    g.model("stg_seasons")(passthrough("seasons"))
    with pytest.raises(DataTestError):
        g.ref("stg_seasons")


def test_lookup_filter_reaches_the_parquet_scan(spark, folder):
    path = folder()
    spark.createDataFrame([("n", "x", "s1", "e1", "c1")], SESSIONS).write.parquet(path)
    df = lookup_by(spark.read.parquet(path), event_id="e1", category_id="c1")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(event_id,e1)" in plan


def test_top1_and_rank(spark):
    df = spark.createDataFrame([("a", 2001), ("b", 2003), ("c", 2002)], SEASONS)
    plan = top1(df, "year")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert top1(df, "year").first().id == "b"
    assert {r.id: r.rank for r in rank_desc(df, "year").collect()} == {"b": 1, "c": 2, "a": 3}


def test_second_stream_run_sees_only_new_files(spark, folder):
    landing, out, ckpt = folder(), folder(), folder()
    sink = batch_folder_sink(out)
    first = spark.createDataFrame([("n", "1", "s", "e", "c")], SESSIONS)
    land_csv(first, landing, mode="append")
    ingest_new_files(spark, landing, SESSIONS, ckpt, sink)
    land_csv(spark.createDataFrame([("n", "2", "s", "e", "c")], SESSIONS), landing,
             mode="append")
    ingest_new_files(spark, landing, SESSIONS, ckpt, sink)
    got = {r.id: r.batch_no for r in spark.read.parquet(out).collect()}
    assert got == {"1": 0, "2": 1}
    assert spark.read.parquet(out).filter(F.col("batch_no") == 1).count() == 1


def test_stream_batches_upsert_the_queue_and_replays_add_nothing(spark, folder):
    from tierline.operators.taskqueue import TaskQueue
    from tierline.streaming.new_files import queue_sink

    landing, ckpt = folder(), folder()
    q = TaskQueue(spark, folder("queue"))
    sink = queue_sink(q)
    land_csv(spark.createDataFrame([("n", "1", "s", "e", "c"), ("n", "2", "s", "e", "c")],
                                   SESSIONS), landing, mode="append")
    ingest_new_files(spark, landing, SESSIONS, ckpt, sink)
    land_csv(spark.createDataFrame([("n", "2", "s", "e", "c"), ("n", "3", "s", "e", "c")],
                                   SESSIONS), landing, mode="append")
    ingest_new_files(spark, landing, SESSIONS, ckpt, sink)
    # replaying the last batch (after a failure) must not add rows
    sink(spark.createDataFrame([("n", "3", "s", "e", "c")], SESSIONS), 1)
    assert sorted(r.id for r in q.state().collect()) == ["1", "2", "3"]


def test_run_records_metrics_logs_and_findings_per_run(spark, folder):
    from tierline.plans import runs
    from tierline.sources.fixture import derive_entities

    src = derive_entities(spark, "/root/testdata/sf0.001")
    lake = Lake(folder())
    rep = runs.run(spark, lake, src, runs.INCREMENTAL, n=20, run_id="r-1")
    assert rep.gold.count() > 0
    metrics = spark.read.json(lake.logs("metrics")).filter(F.col("run_id") == "r-1")
    events = {r.event for r in metrics.select("event").distinct().collect()}
    assert {"GET_SEASONS", "GET_EVENTS", "GET_CATEGORIES", "GET_SESSIONS",
            "GET_CLASSIFICATION", "UPSERT_QUEUE", "UPDATE_TASKS", "LOAD_SILVER",
            "CHECK_DQ", "LOAD_GOLD", "SCRAPE"} <= events
    assert metrics.filter(F.col("event") == "GET_CLASSIFICATION").count() == 20
    assert spark.read.text(lake.logs("process") + "/run_id=r-1").count() > 0


def test_incremental_batch_from_an_older_season_reaches_gold(spark, folder):
    """A full run that leaves open tasks in every season, then an incremental
    run (latest season crawled) whose batch still takes the oldest open
    tasks: their rows must reach silver and gold."""
    from tierline.plans import runs
    from tierline.plans.lake import read_bronze
    from tierline.sources.fixture import derive_entities

    src = derive_entities(spark, "/root/testdata/sf0.001")
    lake = Lake(folder())
    runs.run(spark, lake, src, runs.FULL, n=50, run_id="full")
    rep = runs.run(spark, lake, src, runs.INCREMENTAL, n=50, run_id="inc")
    assert read_bronze(spark, lake, "classifications", run_id="inc").count() > 0
    assert rep.gold.count() == read_bronze(spark, lake, "classifications").count()
    # the incremental run crawled one season; every other season keeps its year
    assert rep.gold.filter(F.col("year").isNull()).count() == 0


def test_models_are_built_again_only_where_inputs_changed(spark, folder):
    lake, out = Lake(folder()), folder("models") + "/{name}"
    land_entity(lake, "seasons", spark.createDataFrame([("a", 2001), ("b", 2002)], SEASONS))
    land_entity(lake, "sessions", spark.createDataFrame([("n", "1", "a", "e", "c")], SESSIONS))

    def graph(extra=0, sessions=None):
        reg = SourceRegistry(spark, lake.root + "/bronze/{name}").declare("seasons", SEASONS)
        reg.declare("sessions", sessions or SESSIONS)
        g = ModelGraph(spark, reg, out, changed_only=True)
        g.test("seasons", "unique", "year")
        g.model("stg_seasons")(passthrough("seasons"))
        g.model("stg_sessions")(passthrough("sessions"))
        g.model("later")(lambda g: g.ref("stg_seasons").withColumn("year", F.col("year") + extra))
        g.model("both")(lambda g: g.ref("stg_sessions").join(
            g.ref("later").select(F.col("id").alias("season_id"), "year"), "season_id"))
        g.build()
        return sorted(g.rebuilt), [r.year for r in g.ref("later").orderBy("year").collect()]
    every = ["both", "later", "stg_seasons", "stg_sessions"]
    assert graph() == (every, [2001, 2002])
    assert graph() == ([], [2001, 2002])
    assert graph(extra=10) == (["both", "later"], [2011, 2012])  # a model's code
    land_entity(lake, "sessions", spark.createDataFrame([("m", "2", "a", "e", "c")], SESSIONS))
    assert graph(extra=10) == (["both", "stg_sessions"], [2011, 2012])  # a source's files
    land_entity(lake, "seasons", spark.createDataFrame([("a", 2001), ("b", 2001)], SEASONS))
    with pytest.raises(DataTestError):
        graph(extra=10)
    land_entity(lake, "seasons", spark.createDataFrame([("a", 2001), ("b", 2005)], SEASONS))
    assert graph(extra=10) == (["both", "later", "stg_seasons"], [2011, 2015])
