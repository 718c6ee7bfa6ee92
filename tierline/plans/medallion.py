"""Bronze -> silver -> gold steps shared by the run modes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from tierline.operators.crawl import (Crawl, crawl_of, expand_categories, expand_classifications,
                                      expand_events, expand_sessions)
from tierline.operators.gold import check_dimensions, gold_results
from tierline.plans.changes import Changes
from tierline.plans.lake import LANDING, Lake, land_entity, read_bronze, read_silver
from tierline.sinks.files import write_parquet
from tierline.sources.entities import EntitySource
from tierline.sources.files import register_external


def land_crawl(spark: SparkSession, lake: Lake, seasons: DataFrame, src: EntitySource,
               layout: str = "scale", only: Sequence[str] | None = None,
               clock: Callable = lambda entity: nullcontext()) -> Crawl:
    """Crawl level by level: each level is landed, and its landed rows are
    the requests of the next one, so every source is read once.

    ``only``: the ids of ``seasons`` where these are not all; the landed
    levels are then read for those seasons alone.  ``clock(entity)`` is a
    context manager around the landing of a level.
    """
    levels: dict[str, DataFrame] = {}
    steps = [("seasons", lambda: seasons),
             ("events", lambda: expand_events(levels["seasons"], src.events)),
             ("categories", lambda: expand_categories(levels["events"], src.categories)),
             ("sessions", lambda: expand_sessions(levels["categories"], src.sessions))]
    for entity, rows in steps:
        with clock(entity):
            land_entity(lake, entity, rows(), layout)
            levels[entity] = read_bronze(spark, lake, entity, seasons=only)
    return crawl_of(**levels)


def land_classifications(lake: Lake, batch: DataFrame, classifications_src: DataFrame,
                         layout: str = "scale", run_id: str = LANDING, replace: bool = False) -> None:
    """Fetch and land the leaf rows of a batch of task keys, below the run's
    own folder level; with ``replace`` they become all there is."""
    land_entity(lake, "classifications", expand_classifications(batch, classifications_src),
                layout, run_id, replace)


GOLD_LAYOUT = ("season_id", "event_id")


def silver_dimensions(spark: SparkSession, lake: Lake,
                      seasons: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Seasons, events, categories, sessions of silver; sessions only of the
    given seasons."""
    return {e: read_silver(spark, lake, e, seasons=seasons if e == "sessions" else None)
            for e in ["seasons", "events", "categories", "sessions"]}


def silver_gold(spark: SparkSession, lake: Lake, style: str = "bash",
                seasons: Sequence[str] | None = None, keep: tuple[str, ...] = (),
                changes: Changes | None = None) -> DataFrame:
    """Gold over the silver datasets of a lake (lazy, no job); with
    ``seasons`` only the rows of those seasons, by literal partition filters,
    with ``changes`` only those of the events they name."""
    fact = read_silver(spark, lake, "classifications", seasons=seasons)
    dims = silver_dimensions(spark, lake, seasons)
    if changes is not None:
        fact, dims["sessions"] = changes.of(fact), changes.of(dims["sessions"])
    return gold_results(fact, **dims, style=style, keep=keep)


def build_gold(spark: SparkSession, lake: Lake, style: str = "bash", name: str = "results",
               seasons: Sequence[str] | None = None, changes: Changes | None = None) -> DataFrame:
    """Silver -> gold parquet, read back (gold columns only).

    Gold is stored partitioned by the season and event of its fact rows
    (hidden partition columns; ``year`` can be NULL when a dimension row is
    missing, the keys cannot).  With ``seasons`` only those seasons' folders
    are rebuilt and replaced, with ``changes`` only those of the events they
    name; others stay as they are.  The dimension keys are checked first, the
    sessions unless no changed row could repeat one: a repeated key stops the
    build.
    """
    if changes is not None:
        changes, seasons = (None, None) if changes.whole else (changes, changes.seasons)
    if changes is None or changes.kinds & {"seasons", "events", "categories", "sessions"}:
        check_dimensions(**silver_dimensions(spark, lake, seasons))
    g = silver_gold(spark, lake, style, seasons, GOLD_LAYOUT, changes)
    if changes is None or changes.kinds:
        write_parquet(g, lake.gold(name), partition_by=GOLD_LAYOUT, dynamic=seasons is not None)
    cols = [c for c in g.columns if c not in GOLD_LAYOUT]
    return spark.read.schema(g.schema).parquet(lake.gold(name)).select(*cols)


def register_gold(spark: SparkSession, lake: Lake, name: str = "results") -> DataFrame:
    """The gold dataset as a table of the lake's gold namespace."""
    return register_external(spark, f"{lake.gold_db}.{name}", lake.gold(name))
