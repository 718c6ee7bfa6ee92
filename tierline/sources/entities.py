"""The entity source: the five entity tables a crawl reads.

They come from five Parquet tables, from landed JSON payloads, or are derived
from the driver's star tables (``tierline.sources.fixture``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.lookup import PAGE_ROWS, explode_payload, response_payloads
from tierline.schemas import ENTITY_SCHEMAS
from tierline.sinks.files import land_payloads
from tierline.sources.files import read_payloads


@dataclass
class EntitySource:
    """Five entity DataFrames plus the prior task state of a run."""

    seasons: DataFrame
    events: DataFrame
    categories: DataFrame
    sessions: DataFrame
    classifications: DataFrame
    task_state: DataFrame | None = None

    def entity(self, name: str) -> DataFrame:
        return getattr(self, name)


def table_entities(spark: SparkSession, root: str) -> EntitySource:
    """Five Parquet tables ``root/<entity>.parquet`` with the entity columns
    (ids as strings; other columns are ignored)."""
    def read(name):
        schema = ENTITY_SCHEMAS[name]
        df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return EntitySource(**{n: read(n) for n in ENTITY_SCHEMAS})


# Request keys of an entity's payloads, and those that name their folders.
PAYLOAD_KEYS = {
    "seasons": ((), ()),
    "events": (("season_id",), ("season_id",)),
    "categories": (("season_id", "event_id"), ("season_id", "event_id")),
    "sessions": (("season_id", "event_id", "category_id"), ("season_id", "event_id")),
    "classifications": (("season_id", "event_id", "category_id", "session_id"), ("season_id", "event_id")),
}


def land_payload_entities(src: EntitySource, root: str, page_rows: int = PAGE_ROWS) -> None:
    """Land every entity as JSON arrays, one line per request and page, as a
    lookup service answers: seasons, then one request per parent."""
    for name, (keys, folder) in PAYLOAD_KEYS.items():
        rows = src.entity(name)
        if not keys:
            rows = rows.withColumn("_all", F.lit(0))
        match = list(keys) or ["_all"]
        bodies = response_payloads(rows.select(*match).distinct(), rows, match,
                                   ENTITY_SCHEMAS[name].names, page_rows)
        land_payloads(bodies, f"{root}/{name}", list(folder))


def payload_entities(spark: SparkSession, root: str) -> EntitySource:
    """Entities from landed payloads ``root/<entity>/``: text files with one
    JSON array of entity rows per line, in folders of their request keys.
    ``[]`` and ``null`` lines give no row."""
    def read(name):
        folder = PAYLOAD_KEYS[name][1]
        lines = read_payloads(spark, f"{root.rstrip('/')}/{name}", folder)
        return explode_payload(lines, "body", ENTITY_SCHEMAS[name])
    return EntitySource(**{n: read(n) for n in ENTITY_SCHEMAS})
