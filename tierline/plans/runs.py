"""End-to-end runs: transform, full / incremental with queue, model graph,
write-audit-publish.

Each step is a Spark job over whole DataFrames; driver code only sequences
the steps, measures their wall time for the metric records, and reads one
row back where a step needs a decision (the audit).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.crawl import request_log
from tierline.operators.gold import check_dimensions, gold_results
from tierline.operators.ordering import top1
from tierline.operators.runlog import (EVENT_GET_CATEGORIES, EVENT_GET_CLASSIFICATION,
                                       EVENT_GET_EVENTS, EVENT_GET_SEASONS,
                                       EVENT_GET_SESSIONS, STAGE_DQ, STAGE_GOLD,
                                       STAGE_SILVER, STAGE_TASKS, STAGE_TASKS_LIST,
                                       STAGE_UPDATE, STAGE_UPSERT, failed_keys, failed_sets,
                                       metric_records, parse_log, run_summary)
from tierline.operators.taskqueue import (TaskQueue, apply_run, mark_completed, new_tasks,
                                          next_batch, open_tasks)
from tierline.plans.changes import (EVENT_KEYS, LISTING, Changes, FileLedger, applied,
                                    find_changes, list_landed, of_new_files, partials_of_new)
from tierline.plans.lake import Lake, load_silver, read_bronze
from tierline.plans.medallion import (build_gold, land_classifications, land_crawl,
                                      register_gold)
from tierline.plans.models import ModelGraph, passthrough, renamed
from tierline.schemas import AUDIT_DIMS, CLASSIFICATIONS_BRONZE, DQ_FINDINGS, ENTITY_SCHEMAS, TASKS
from tierline.sinks.files import TEXT_OPTIONS, together
from tierline.sources.entities import EntitySource
from tierline.sources.registry import SourceRegistry
from tierline.tables import files, wap
from tierline.tables.published import PublishedTable

FULL, INCREMENTAL = "FULL", "INCREMENTAL"


@dataclass
class RunReport:
    run_id: str
    mode: str
    stage_ms: dict[str, int] = field(default_factory=dict)
    gold: DataFrame | None = None
    dq_alert: bool = False
    changes: Changes | None = None


class _Clock:
    def __init__(self, report: RunReport, on_stage: Callable[[str], None]):
        self.report, self.on_stage = report, on_stage

    def __call__(self, name: str):
        clock = self
        self.on_stage(name)

        class _T:
            def __enter__(self):
                self.t0 = time.monotonic()

            def __exit__(self, *exc):
                clock.report.stage_ms[name] = int((time.monotonic() - self.t0) * 1000)
        return _T()


def transform(spark: SparkSession, lake: Lake, src: EntitySource,
              style: str = "bash", layout: str = "scale") -> DataFrame:
    """Bronze -> silver -> gold for every entity (no queue); replaces the
    classifications that earlier runs landed.  ``layout`` "reference" lands
    bronze with one folder level per parent key."""
    c = land_crawl(spark, lake, src.seasons, src, layout)
    land_classifications(lake, c.tasks, src.classifications, layout, replace=True)
    load_silver(spark, lake)
    return build_gold(spark, lake, style)


def landed_sessions(spark: SparkSession, lake: Lake, events: DataFrame, seasons: list[str]) -> DataFrame:
    """Session ids with landed classifications, of the given (season, event)
    keys; ``seasons`` are those of the keys."""
    if not seasons or not files.exists(spark, lake.bronze("classifications")):
        return spark.createDataFrame([], "session_id string")
    landed = read_bronze(spark, lake, "classifications", seasons=seasons)
    keys = events.filter(F.col("season_id").isin(seasons)).select(*EVENT_KEYS).distinct()
    return landed.join(keys, EVENT_KEYS, "left_semi").select("session_id").distinct()


def run(spark: SparkSession, lake: Lake, src: EntitySource, mode: str = FULL,
        n: int | None = None, run_id: str | None = None, layout: str = "scale",
        on_stage: Callable[[str], None] = lambda stage: None) -> RunReport:
    """One run with the task queue.

    FULL: every season, every open task (``n`` of them if given).
    INCREMENTAL: the latest season, ``n`` tasks.  Landed tasks are marked
    completed, tasks whose request found no data errored (errored wins), and
    logs, metrics and data-quality findings are stored under ``run_id``.
    ``on_stage`` is called with the name of each stage before it starts; what
    it raises ends the run.

    A run costs what it changes.  Only the crawled seasons of the queue and
    its open tasks elsewhere are read; silver and gold rewrite the events of
    the change set (``plans.changes``); findings come from the ledger of
    landed files, and only new files are counted.

    A run may die at any point and be repeated under a new id.  Files that the
    ledger does not know yet are taken up by the next run, as landed sessions
    and as changed events; the change set is stored before it is applied; the
    queue is stored after gold and the ledger last.  A task enters the queue
    as complete if its session is landed, so nothing is fetched twice.
    """
    if n is not None and n < 1 or mode != FULL and n is None:
        raise ValueError(f"a run of mode {mode} cannot take {n} tasks")
    run_id = run_id or str(time.time_ns())
    rep = RunReport(run_id, mode)
    clock = _Clock(rep, on_stage)
    t_run = time.monotonic()
    queue, ledger = TaskQueue(spark, lake.table("tasks")), FileLedger(spark, lake)

    seasons = src.seasons if mode == FULL else top1(src.seasons, "year", "id")
    only = None if mode == FULL else [r["id"] for r in seasons.select("id").collect()]
    event_of = {"seasons": EVENT_GET_SEASONS, "events": EVENT_GET_EVENTS,
                "categories": EVENT_GET_CATEGORIES, "sessions": EVENT_GET_SESSIONS}
    with clock(STAGE_TASKS_LIST):
        c = land_crawl(spark, lake, seasons, src, layout, only, lambda e: clock(event_of[e]))
        crawled = TaskQueue.seasons_of(c.tasks) if only is None else only
    with clock(STAGE_UPSERT):
        new_path = lake.logs(f"new_tasks/run_id={run_id}")
        new_tasks(queue.state(crawled), c.tasks).write.mode("overwrite").parquet(new_path)
        unseen = spark.read.schema(TASKS).parquet(new_path)
        todo = open_tasks(queue.state()).unionByName(unseen)
        # Seasons with open tasks: bounded by the season dimension.
        open_seasons = TaskQueue.seasons_of(todo)
        before = list_landed(spark, lake, lake.logs(f"files_before/run_id={run_id}"), open_seasons)
        fresh_path = lake.logs(f"files_left/run_id={run_id}")
        ledger.new_files(before).write.mode("overwrite").parquet(fresh_path)
        left = spark.read.schema(LISTING).parquet(fresh_path)  # landed by dead runs
        left_seasons = TaskQueue.seasons_of(left)
        landed = landed_sessions(spark, lake, unseen, TaskQueue.seasons_of(unseen))
        if left_seasons:
            landed = landed.unionByName(of_new_files(spark, lake, left, left_seasons).select("session_id"))
        done_path = lake.logs(f"landed_before/run_id={run_id}")
        landed.write.mode("overwrite").parquet(done_path)
        landed = spark.read.schema("session_id string").parquet(done_path)
        ready = mark_completed(todo, landed)
    with clock(STAGE_TASKS):
        batch_path = lake.logs(f"batches/run_id={run_id}")
        next_batch(ready, n).write.mode("overwrite").parquet(batch_path)
        batch = spark.read.parquet(batch_path)
        batch_seasons = TaskQueue.seasons_of(batch)
    with clock(EVENT_GET_CLASSIFICATION):
        land_classifications(lake, batch, src.classifications, layout, run_id)

    this_run = read_bronze(spark, lake, "classifications", seasons=batch_seasons, run_id=run_id)
    log_path, failed_path = lake.logs(f"process/run_id={run_id}"), lake.logs(f"failed/run_id={run_id}")
    # Seasons that were crawled, have tasks in the batch, or were left half done.
    touched = sorted({*crawled, *batch_seasons, *left_seasons})
    listing = list_landed(spark, lake, lake.logs(f"files/run_id={run_id}"), touched)

    def write_log() -> None:
        request_log(c, this_run.select("session_id"), batch).write.mode("overwrite") \
            .options(**TEXT_OPTIONS).text(log_path)
        failed_keys(parse_log(spark.read.text(log_path))).write.mode("overwrite").parquet(failed_path)

    def refresh_silver() -> None:
        with clock(STAGE_SILVER):
            rep.changes = find_changes(spark, lake, ledger, listing, touched, only, run_id)
            load_silver(spark, lake, changes=rep.changes)

    def count_files() -> DataFrame:
        with clock(STAGE_DQ):
            partials = partials_of_new(spark, lake, ledger, listing, touched, lake.logs(f"partials/run_id={run_id}"))
            dq_path = lake.logs(f"data_quality/run_id={run_id}")
            ledger.findings_with(listing, partials, touched).write.mode("overwrite").options(**TEXT_OPTIONS).json(dq_path)
            rep.dq_alert = not spark.read.schema(DQ_FINDINGS).json(dq_path).isEmpty()
            return partials

    def refresh_gold() -> None:
        with clock(STAGE_GOLD):
            rep.gold = build_gold(spark, lake, changes=rep.changes)
            register_gold(spark, lake)
            rep.changes = applied(spark, lake, rep.changes, run_id)
    # The log is of no use to silver, nor the findings to gold.
    together([write_log, refresh_silver])
    partials, _ = together([count_files, refresh_gold])
    parsed = parse_log(spark.read.text(log_path))
    with clock(STAGE_UPDATE):
        done = landed.unionByName(this_run.select("session_id"))
        failed = failed_sets(spark.read.parquet(failed_path))
        tasks = queue.state(touched).unionByName(unseen)
        queue.save(apply_run(tasks, done, failed), touched)
        ledger.save(listing, partials, touched)

    _store_metrics(spark, lake, rep, c, batch, parsed, int((time.monotonic() - t_run) * 1000))
    return rep


def _store_metrics(spark, lake, rep: RunReport, c, batch: DataFrame, parsed: DataFrame,
                   duration: int) -> None:
    """One record per request of each level, with that level's duration; the
    other stages and the run get one record each."""
    levels = [(EVENT_GET_SEASONS, spark.range(1), []),
              (EVENT_GET_EVENTS, c.requests["events"], ["season_id"]),
              (EVENT_GET_CATEGORIES, c.requests["categories"], ["event_id"]),
              (EVENT_GET_SESSIONS, c.requests["sessions"], ["event_id", "category_id"]),
              (EVENT_GET_CLASSIFICATION, batch, ["session_id"])]
    per_request = {event for event, _, _ in levels}
    metrics = spark.createDataFrame(
        [(k, v) for k, v in rep.stage_ms.items() if k not in per_request],
        "event string, duration_ms long")
    for event, requests, dims in levels:
        metrics = metrics.unionByName(metric_records(requests, event, rep.stage_ms[event], dims),
                                      allowMissingColumns=True)
    metrics = metrics.unionByName(run_summary(parsed, duration), allowMissingColumns=True)
    metrics.write.mode("overwrite").options(**TEXT_OPTIONS).option("ignoreNullFields", "false") \
        .json(lake.logs(f"metrics/run_id={rep.run_id}"))


def models(spark: SparkSession, lake: Lake, out_root: str) -> DataFrame:
    """The placements mart of :func:`model_graph`, and all it is made of."""
    return model_graph(spark, lake, out_root).ref("fct_placements")


def model_graph(spark: SparkSession, lake: Lake, out_root: str, changed_only: bool = False) -> ModelGraph:
    """Model graph over the bronze sources: five staging models and the
    placements mart, each materialised as parquet; source tests on
    ``seasons.year`` (not null, unique) run before any dependant."""
    reg = SourceRegistry(spark, lake.root + "/bronze/{name}")
    for name in ["seasons", "events", "categories", "sessions"]:
        reg.declare(name, ENTITY_SCHEMAS[name])
    reg.declare("classifications", CLASSIFICATIONS_BRONZE, nullValue="null")
    g = ModelGraph(spark, reg, out_root + "/{name}.parquet", changed_only)
    g.test("seasons", "not_null", "year").test("seasons", "unique", "year")
    for name in ["seasons", "events", "categories", "sessions"]:
        g.model(f"stg_{name}")(passthrough(name))
    g.model("stg_classification")(renamed("classifications", {
        "name": "rider_name", "number": "rider_number",
        "pos": "rider_position", "pts": "rider_points"}))

    @g.model("fct_placements")
    def _placements(g):
        c = g.ref("stg_classification").select(
            "season_id", "event_id", "category_id", "session_id",
            F.col("rider_name").alias("name"), F.col("rider_number").alias("number"),
            F.col("rider_position").alias("position"), F.col("rider_points").alias("points"))
        dims = {e: g.ref(f"stg_{e}") for e in ["seasons", "events", "categories", "sessions"]}
        check_dimensions(**dims)
        return gold_results(c, **dims, style="dbt")

    return g


def wap_run(spark: SparkSession, lake: Lake, bronze_root: str | None = None) -> DataFrame:
    """Bronze -> silver tables (replaced directly) -> gold staged, audited and
    published in the lake's gold namespace; returns the published table.

    ``bronze_root`` reads bronze from another lake (default: this one).
    """
    bronze = Lake(bronze_root) if bronze_root else lake
    tables = {e: PublishedTable(spark, lake.table(f"silver/{e}")) for e in ENTITY_SCHEMAS}
    together([partial(lambda e, t: t.replace(read_bronze(spark, bronze, e)), e, t) for e, t in tables.items()])
    silver = {e: t.read() for e, t in tables.items()}
    dims = {e: silver[e] for e in ["seasons", "events", "categories", "sessions"]}
    check_dimensions(**dims)
    gold = PublishedTable(spark, lake.table("gold/results"), name=f"{lake.gold_db}.audited_results")
    wap.write_audit_publish(gold, gold_results(silver["classifications"], **dims, style="table"),
                            AUDIT_DIMS)
    return gold.read()
