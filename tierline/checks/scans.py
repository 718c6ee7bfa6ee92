"""Scans and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.checks import query
from tierline.checks.env import env
from tierline.operators.drift import split_payloads, typed
from tierline.operators.lookup import explode_payload, response_payloads
from tierline.plans.lake import read_bronze, read_bronze_raw
from tierline.plans.models import ModelGraph, passthrough
from tierline.schemas import ENTITY_SCHEMAS, EVENTS, SESSIONS, S, struct
from tierline.sinks.files import export_csv_noheader, land_payloads
from tierline.sources.files import (partition_value, read_csv_positional, read_payloads,
                                    register_external, scan_table)
from tierline.sources.registry import SourceRegistry

ENTITIES = ["seasons", "events", "categories", "sessions", "classifications"]


@query("scan_seasons", "SELECT id, year FROM f_seasons")
def scan_seasons(spark, sf_dir):
    return env(spark, sf_dir).src.seasons.select("id", "year")


@query("payload_drift", """
d AS (SELECT *, CAST(right(id, 1) AS INTEGER) AS digit FROM f_events)
SELECT season_id, id, name, CASE WHEN digit % 3 <> 0 THEN sname END AS sname,
       CASE WHEN digit % 2 = 0 THEN '{"country":"' || name || '"}' ELSE '{}' END AS more, 0 AS bad
FROM d UNION ALL
SELECT DISTINCT season_id, NULL, NULL, NULL, NULL, 2 FROM d""")
def payload_drift(spark, sf_dir):
    """Event payloads of which some carry a field that the schema does not
    know and some lack one; each season also has a broken line and one that
    is no array.  The landed lines are read as variants, stored, read back."""
    e = env(spark, sf_dir)
    digit = F.substring("id", -1, 1).cast("int")
    rows = e.src.events.select("season_id", F.struct(
        "id", "name", F.when(digit % 3 != 0, F.col("sname")).alias("sname"),
        F.when(digit % 2 == 0, F.col("name")).alias("country")).alias("row"))
    lines = rows.groupBy("season_id").agg(F.to_json(F.collect_list("row")).alias("body"))
    for broken in ('{"id": "', '{"id": "alone"}'):
        lines = lines.unionByName(rows.select("season_id", F.lit(broken).alias("body")).distinct())
    path, kept = e.scratch("drifting"), e.scratch("variants")
    land_payloads(lines, path, ["season_id"])
    good, bad = split_payloads(read_payloads(spark, path, ["season_id"]), keep=["season_id"])
    good.write.parquet(kept)
    known = struct(("id", S), ("name", S), ("sname", S))
    found = typed(spark.read.schema(good.schema).parquet(kept), known, ["season_id"]).withColumn("bad", F.lit(0))
    counts = bad.groupBy("season_id").agg(F.count(F.lit(1)).cast("int").alias("bad"))
    return found.unionByName(counts, allowMissingColumns=True)


@query("payload_explode", "SELECT id, name, sname, season_id FROM f_events")
def payload_explode(spark, sf_dir):
    """Event payloads (one JSON array per season request) land as raw files
    partitioned by season; the landed files are read back and exploded."""
    e = env(spark, sf_dir)
    payloads = response_payloads(e.src.seasons.select(F.col("id").alias("season_id")),
                                 e.src.events, ["season_id"], EVENTS.names)
    path = e.scratch("raw_events")
    land_payloads(payloads, path, ["season_id"])
    rows = explode_payload(read_payloads(spark, path, ["season_id"]), "body", EVENTS)
    return rows.select("id", "name", "sname", "season_id")


@query("scan_csv_filename", """
SELECT season_id AS season_part, count(*) AS n FROM f_events GROUP BY season_id""")
def scan_csv_filename(spark, sf_dir):
    e = env(spark, sf_dir)
    df = read_bronze(spark, e.lake, "events", filename="filename")
    return (df.select(partition_value(F.col("filename"), "season_id").alias("season_part"))
              .groupBy("season_part").agg(F.count(F.lit(1)).alias("n")))


@query("scan_csv_typed_null", "SELECT * FROM f_classifications")
def scan_csv_typed_null(spark, sf_dir):
    return read_bronze(spark, env(spark, sf_dir).lake, "classifications")


@query("scan_csv_raw", """
SELECT season_id, event_id, category_id, session_id, name,
       coalesce(CAST(number AS VARCHAR), 'null') AS number,
       coalesce(CAST(position AS VARCHAR), 'null') AS pos,
       CAST(points AS VARCHAR) AS pts
FROM f_classifications""")
def scan_csv_raw(spark, sf_dir):
    df = read_bronze_raw(spark, env(spark, sf_dir).lake, "classifications")
    return df.select("season_id", "event_id", "category_id", "session_id", "name",
                     "number", "pos", "pts")


@query("scan_csv_positional", "SELECT * FROM f_sessions")
def scan_csv_positional(spark, sf_dir):
    e = env(spark, sf_dir)
    path = e.scratch("sessions_noheader")
    export_csv_noheader(e.src.sessions, path)
    return read_csv_positional(spark, path, SESSIONS)


@query("source_registry", """
SELECT 'seasons' AS source_name, count(*) AS n FROM f_seasons
UNION ALL SELECT 'events', count(*) FROM f_events
UNION ALL SELECT 'categories', count(*) FROM f_categories
UNION ALL SELECT 'sessions', count(*) FROM f_sessions
UNION ALL SELECT 'classifications', count(*) FROM f_classifications""")
def source_registry(spark, sf_dir):
    lake = env(spark, sf_dir).lake
    reg = SourceRegistry(spark, lake.root + "/bronze/{name}")
    for name in ENTITIES:
        reg.declare(name, ENTITY_SCHEMAS[name])
    counts = [reg.read(n).agg(F.count(F.lit(1)).alias("n"))
              .select(F.lit(n).alias("source_name"), "n") for n in reg.names()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("scan_parquet", "SELECT * FROM f_events")
def scan_parquet(spark, sf_dir):
    path = env(spark, sf_dir).lake.silver("events")
    return spark.sql(f"SELECT * FROM parquet.`{path}`")


@query("scan_catalog_table", "SELECT * FROM f_sessions")
def scan_catalog_table(spark, sf_dir):
    e = env(spark, sf_dir)
    name = f"silver_{e.tag}.sessions"
    register_external(spark, name, e.lake.silver("sessions"))
    return scan_table(spark, name).select(*SESSIONS.names)


@query("model_refs", """
SELECT e.name AS event, s.year FROM f_events e JOIN f_seasons s ON s.id = e.season_id""")
def model_refs(spark, sf_dir):
    """One graph materialises the two staging models; a later graph over the
    same locations registers those outputs as views before it runs, and its
    model refers to them by name."""
    e = env(spark, sf_dir)
    reg = SourceRegistry(spark, e.lake.root + "/bronze/{name}")
    reg.declare("seasons", ENTITY_SCHEMAS["seasons"]).declare("events", EVENTS)
    outputs = e.scratch("models") + "/{name}"
    first = ModelGraph(spark, reg, outputs)
    first.model("stg_seasons")(passthrough("seasons"))
    first.model("stg_events")(passthrough("events"))
    first.build()

    later = ModelGraph(spark, reg, outputs)
    later.register_upstream(["stg_seasons", "stg_events"])

    @later.model("events_by_year", external=False)
    def _events_by_year(g):
        return spark.sql("""
            SELECT e.name AS event, s.year
            FROM stg_events e JOIN stg_seasons s ON s.id = e.season_id""")

    return later.ref("events_by_year")
