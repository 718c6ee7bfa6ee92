"""Entity schemas, keys and the five-level hierarchy.

Ids are strings (UUID-shaped in real data) and stay strings in every layer:
an explicit schema is passed to each read so that partition discovery never
retypes an id such as ``2023`` into a number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SEASONS = struct(("id", S), ("year", I))
EVENTS = struct(("name", S), ("sname", S), ("id", S), ("season_id", S))
CATEGORIES = struct(("name", S), ("id", S), ("season_id", S), ("event_id", S))
SESSIONS = struct(("name", S), ("id", S), ("season_id", S), ("event_id", S),
                  ("category_id", S))
CLASSIFICATIONS = struct(("season_id", S), ("event_id", S), ("category_id", S),
                         ("session_id", S), ("name", S), ("number", I),
                         ("position", I), ("points", I))
# Bronze classification files carry the short names of the landing format.
CLASSIFICATIONS_BRONZE = struct(("season_id", S), ("event_id", S),
                                ("category_id", S), ("session_id", S),
                                ("name", S), ("number", I), ("pos", I),
                                ("pts", I))

TASK_KEYS = ["season_id", "event_id", "category_id", "session_id"]

TASKS = T.StructType([
    T.StructField("id", S, False),
    T.StructField("season_id", S, True),
    T.StructField("event_id", S, True),
    T.StructField("category_id", S, True),
    T.StructField("session_id", S, True),
    T.StructField("status", I, False),
    T.StructField("attempt", I, False),
    T.StructField("added_timestamp", T.TimestampType(), False),
    T.StructField("updated_timestamp", T.TimestampType(), True),
])

# Task status codes (fixed values of the queue contract).
PENDING, COMPLETED, ERRORED = 0, 2, 4

METRICS = struct(("event", S), ("duration_ms", T.LongType()), ("season_id", S),
                 ("event_id", S), ("category_id", S), ("session_id", S),
                 ("requests", T.LongType()), ("rps", T.LongType()))

DQ_FINDINGS = struct(("filename", S), ("NULL_POSITION_COUNT", T.LongType()))

ENTITY_SCHEMAS = {
    "seasons": SEASONS,
    "events": EVENTS,
    "categories": CATEGORIES,
    "sessions": SESSIONS,
    "classifications": CLASSIFICATIONS,
}


@dataclass(frozen=True)
class Level:
    """One level of the hierarchy.

    ``parent_on`` maps child columns to the parent's columns; ``stamp`` are
    the request-key columns the child row carries from its parent request;
    ``partition_by`` is the bronze layout of the reference landing.
    """

    name: str
    key: tuple[str, ...]
    parent_on: tuple[tuple[str, str], ...]
    stamp: tuple[str, ...]
    partition_by: tuple[str, ...]


HIERARCHY = (
    Level("seasons", ("id",), (), (), ()),
    Level("events", ("id",), (("season_id", "id"),), ("season_id",),
          ("season_id",)),
    Level("categories", ("id", "event_id"), (("event_id", "id"),),
          ("season_id", "event_id"), ("season_id", "event_id")),
    Level("sessions", ("id",),
          (("event_id", "event_id"), ("category_id", "id")),
          ("season_id", "event_id", "category_id"),
          ("season_id", "event_id", "category_id")),
    Level("classifications", (), (("session_id", "id"),), tuple(TASK_KEYS),
          tuple(TASK_KEYS)),
)
LEVELS = {lvl.name: lvl for lvl in HIERARCHY}

# Gold column names of the three variants of the results table, in order:
# season year, event name, event short name, category, session, rider name,
# rider number, position, points.
GOLD_NAMES = {
    "bash": ["year", "event_name", "event_short_name", "category", "session",
             "rider_name", "rider_number", "position", "points"],
    "dbt": ["year", "event_name", "event_short_name", "category",
            "session_name", "rider_name", "rider_number", "rider_position",
            "rider_points"],
    "table": ["year", "event", "event_short", "category", "session",
              "rider_name", "rider_number", "position", "points"],
}

# Dimensions audited before gold is published (names of the table style).
AUDIT_DIMS = ["year", "event", "category", "session"]
