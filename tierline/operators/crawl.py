"""Hierarchical key expansion: each level's rows drive the next level.

The reference walks the hierarchy one request per parent key.  Here a level
is one set-based step: the parent rows become request keys, the children of
all requests are found by one join, and the request keys are stamped onto
each child row (they come from the request, not from the child).  Requests
without children become ERROR log rows, every request an INFO log row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions import logs as L
from tierline.schemas import ENTITY_SCHEMAS, TASK_KEYS


def expand(requests: DataFrame, children: DataFrame, match: Sequence[str],
           stamp: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Children of every request row, with the request keys stamped on.

    ``requests`` holds the request-key columns (``stamp``); ``match`` are
    the keys the children are looked up by (child columns of the same
    name).  The child's own copies of the stamped columns are replaced.
    """
    req = requests.select(*stamp)
    own = [c for c in children.columns if c not in stamp or c in match]
    out = children.select(*own).join(req, list(match), "inner")
    cols = list(order) if order else [c for c in children.columns]
    return out.select(*cols)


def missing_children(requests: DataFrame, children: DataFrame,
                     match: Sequence[str]) -> DataFrame:
    """Request rows that found no child (``left_anti`` on the match keys).

    A key is moved once per map task, not once per child: the children of few
    keys would otherwise meet, and be sorted, in as few tasks."""
    return requests.join(children.select(*match).distinct(), list(match), "left_anti")


def shape(payload_rows: DataFrame, renames: dict[str, str] | None = None,
          keep: Sequence[str] | None = None) -> DataFrame:
    """Pick and order fields of API rows, renaming some.

    Events arrive with ``sname``; a source that sends ``short_name`` has it
    used first (``coalesce``), so the short name is never lost.
    """
    df = payload_rows
    if "short_name" in df.columns:
        base = F.col("sname") if "sname" in df.columns else F.lit(None).cast("string")
        df = df.withColumn("sname", F.coalesce(F.col("short_name"), base))
    for old, new in (renames or {}).items():
        df = df.withColumnRenamed(old, new)
    return df.select(*keep) if keep else df


def season_requests(seasons: DataFrame) -> DataFrame:
    return seasons.select(F.col("id").alias("season_id"))


def event_requests(events: DataFrame) -> DataFrame:
    return events.select("season_id", F.col("id").alias("event_id"))


def category_requests(categories: DataFrame) -> DataFrame:
    return categories.select("season_id", "event_id",
                             F.col("id").alias("category_id"))


def task_keys(sessions: DataFrame) -> DataFrame:
    return sessions.select("season_id", "event_id", "category_id",
                           F.col("id").alias("session_id"))


def expand_events(seasons: DataFrame, events_src: DataFrame) -> DataFrame:
    return expand(season_requests(seasons), events_src, ["season_id"],
                  ["season_id"], ENTITY_SCHEMAS["events"].names)


def expand_categories(events: DataFrame, categories_src: DataFrame) -> DataFrame:
    return expand(event_requests(events), categories_src, ["event_id"],
                  ["season_id", "event_id"], ENTITY_SCHEMAS["categories"].names)


def expand_sessions(categories: DataFrame, sessions_src: DataFrame) -> DataFrame:
    req = category_requests(categories)
    return expand(req, sessions_src, ["event_id", "category_id"],
                  ["season_id", "event_id", "category_id"],
                  ENTITY_SCHEMAS["sessions"].names)


def expand_classifications(tasks: DataFrame, classifications_src: DataFrame) -> DataFrame:
    return expand(tasks, classifications_src, ["session_id"], TASK_KEYS,
                  ENTITY_SCHEMAS["classifications"].names)


@dataclass
class Crawl:
    """The hierarchy of one run: lazily expanded, or read back level by level
    (see ``plans.medallion.land_crawl``)."""

    seasons: DataFrame
    events: DataFrame
    categories: DataFrame
    sessions: DataFrame
    tasks: DataFrame
    requests: dict[str, DataFrame] = field(default_factory=dict)


def crawl(seasons: DataFrame, events_src: DataFrame, categories_src: DataFrame,
          sessions_src: DataFrame) -> Crawl:
    """Seasons -> events -> categories -> sessions -> task keys."""
    events = expand_events(seasons, events_src)
    categories = expand_categories(events, categories_src)
    sessions = expand_sessions(categories, sessions_src)
    return crawl_of(seasons, events, categories, sessions)


def crawl_of(seasons: DataFrame, events: DataFrame, categories: DataFrame,
             sessions: DataFrame) -> Crawl:
    tasks = task_keys(sessions)
    return Crawl(seasons, events, categories, sessions, tasks, {
        "events": season_requests(seasons),
        "categories": event_requests(events),
        "sessions": category_requests(categories),
        "classifications": tasks,
    })


def _lines(df: DataFrame, level: str, template: str, ts: Column | None) -> DataFrame:
    return df.select(L.log_line(level, L.message(template), ts).alias("value"))


def request_log(crawl_: Crawl, fetched: DataFrame, batch: DataFrame | None = None,
                ts: Column | None = None) -> DataFrame:
    """Process-log lines of a run: INFO per request, ERROR per request that
    found no children.  ``batch`` are the task keys fetched at the leaf (all
    task keys when None), ``fetched`` the rows that came back for them."""
    batch = crawl_.tasks if batch is None else batch
    spark = crawl_.seasons.sparkSession
    first = spark.range(1).select(L.log_line("INFO", F.lit(L.MSG_GET_SEASONS), ts).alias("value"))
    none = crawl_.seasons.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(
        L.log_line("ERROR", F.lit(L.MSG_NO_SEASONS), ts).alias("value"))
    parts = [
        first,
        none,
        _lines(crawl_.requests["events"], "INFO", L.MSG_GET_EVENTS, ts),
        _lines(crawl_.requests["categories"], "INFO", L.MSG_GET_CATEGORIES, ts),
        _lines(crawl_.requests["sessions"], "INFO", L.MSG_GET_SESSIONS, ts),
        _lines(batch, "INFO", L.MSG_GET_CLASSIFICATION, ts),
        _lines(missing_children(crawl_.requests["events"], crawl_.events,
                                ["season_id"]), "ERROR", L.MSG_NO_EVENTS, ts),
        _lines(missing_children(crawl_.requests["categories"], crawl_.categories,
                                ["event_id"]), "ERROR", L.MSG_NO_CATEGORIES, ts),
        _lines(missing_children(crawl_.requests["sessions"], crawl_.sessions,
                                ["event_id", "category_id"]),
               "ERROR", L.MSG_NO_SESSIONS, ts),
        _lines(missing_children(batch, fetched, ["session_id"]),
               "ERROR", L.MSG_NO_CLASSIFICATION, ts),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
