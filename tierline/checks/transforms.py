"""Projections, lookups, payload shaping, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.checks import query
from tierline.checks.env import env
from tierline.functions.logs import name_stem
from tierline.functions.payloads import row_json
from tierline.operators.crawl import (category_requests, event_requests, shape,
                                      task_keys)
from tierline.operators.lookup import (explode_payload, lookup_by, lookup_many,
                                        response_payloads)
from tierline.operators.ordering import rank_desc, sort_desc, top1
from tierline.plans.lake import read_bronze_raw, read_silver
from tierline.plans.models import ModelGraph, passthrough, renamed
from tierline.schemas import (CLASSIFICATIONS, CLASSIFICATIONS_BRONZE, SESSIONS,
                              S, struct)
from tierline.sources.registry import SourceRegistry

_LATEST = "(SELECT id FROM f_seasons ORDER BY year DESC, id LIMIT 1)"


def _latest(e):
    return top1(e.src.seasons, "year", "id").select(F.col("id").alias("season_id"))


@query("stg_passthrough", "SELECT * FROM f_sessions")
def stg_passthrough(spark, sf_dir):
    e = env(spark, sf_dir)
    reg = SourceRegistry(spark, e.lake.root + "/bronze/{name}").declare("sessions", SESSIONS)
    g = ModelGraph(spark, reg)
    g.model("stg_sessions", external=False)(passthrough("sessions"))
    return g.ref("stg_sessions")


@query("stg_classification", """
SELECT season_id, event_id, category_id, session_id, name AS rider_name,
       number AS rider_number, position AS rider_position, points AS rider_points
FROM f_classifications""")
def stg_classification(spark, sf_dir):
    e = env(spark, sf_dir)
    reg = SourceRegistry(spark, e.lake.root + "/bronze/{name}").declare(
        "classifications", CLASSIFICATIONS_BRONZE)
    g = ModelGraph(spark, reg)
    g.model("stg_classification", external=False)(renamed("classifications", {
        "name": "rider_name", "number": "rider_number",
        "pos": "rider_position", "pts": "rider_points"}))
    return g.ref("stg_classification")


_EVENT_API = struct(("name", S), ("short_name", S), ("id", S))


@query("shape_events", "SELECT name, sname, id, season_id FROM f_events")
def shape_events(spark, sf_dir):
    """API rows carry ``short_name`` and no season: the shape step picks and
    renames fields and the season comes from the request."""
    e = env(spark, sf_dir)
    api = e.src.events.select("season_id", "name", F.col("sname").alias("short_name"), "id")
    payloads = response_payloads(e.src.seasons.select(F.col("id").alias("season_id")),
                                 api, ["season_id"], _EVENT_API.names)
    rows = explode_payload(payloads, "body", _EVENT_API, keep=["season_id"])
    return shape(rows, keep=["name", "sname", "id", "season_id"])


_SESSION_API = struct(("name", S), ("id", S))


@query("stamp_parent_keys", "SELECT * FROM f_sessions")
def stamp_parent_keys(spark, sf_dir):
    """Session payloads per (event, category) request; the three parent keys
    are stamped on each row from the request."""
    e = env(spark, sf_dir)
    req = category_requests(e.src.categories)
    payloads = response_payloads(req, e.src.sessions, ["event_id", "category_id"],
                                 _SESSION_API.names)
    stamped = payloads.join(req, ["event_id", "category_id"])
    rows = explode_payload(stamped, "body", _SESSION_API,
                           keep=["season_id", "event_id", "category_id"])
    return rows.select(*SESSIONS.names)


@query("key_tuple_format", """
SELECT concat_ws(' ', season_id, event_id, category_id, id) AS k FROM f_sessions""")
def key_tuple_format(spark, sf_dir):
    t = task_keys(env(spark, sf_dir).src.sessions)
    return t.select(F.concat_ws(" ", "season_id", "event_id", "category_id",
                                "session_id").alias("k"))


_CLS_ORDER = ", ".join(f"{c} NULLS FIRST" for c in CLASSIFICATIONS.names)
_CLS_STRUCT = ", ".join(f"'{c}': c.{c}" for c in CLASSIFICATIONS.names)


_PAGE = 3


@query("response_json", f"""
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY session_id ORDER BY {_CLS_ORDER}) - 1) // {_PAGE} AS page
  FROM f_classifications),
bodies AS (
  SELECT c.session_id, c.page,
         CAST(to_json(list({{{_CLS_STRUCT}}} ORDER BY {_CLS_ORDER})) AS VARCHAR) AS body
  FROM placed c GROUP BY c.session_id, c.page)
SELECT s.id AS session_id, CAST(coalesce(b.page, 0) AS INTEGER) AS page, coalesce(b.body, '[]') AS body
FROM f_sessions s LEFT JOIN bodies b ON b.session_id = s.id""")
def response_json(spark, sf_dir):
    """Classification payloads per session, in pages of three rows, served
    from the stored (silver) tables as a lookup service would; sessions
    without rows get ``[]``."""
    e = env(spark, sf_dir)
    req = read_silver(spark, e.lake, "sessions").select(F.col("id").alias("session_id"))
    cls = read_silver(spark, e.lake, "classifications")
    return response_payloads(req, cls, ["session_id"], CLASSIFICATIONS.names, _PAGE)


@query("rows_to_ndjson", """
SELECT CAST(to_json({'name': name, 'id': id, 'season_id': season_id,
                     'event_id': event_id, 'category_id': category_id}) AS VARCHAR) AS line
FROM f_sessions""")
def rows_to_ndjson(spark, sf_dir):
    return env(spark, sf_dir).src.sessions.select(row_json(SESSIONS.names).alias("line"))


@query("lookup_one", "SELECT * FROM f_sessions WHERE event_id = (SELECT min(id) FROM f_events)")
def lookup_one(spark, sf_dir):
    """One request: the children of one key (the filter reaches the scan)."""
    e = env(spark, sf_dir)
    key = e.src.events.agg(F.min("id")).first()[0]
    return lookup_by(read_silver(spark, e.lake, "sessions"), event_id=key)


@query("lookup_events", f"SELECT * FROM f_events WHERE season_id = {_LATEST}")
def lookup_events(spark, sf_dir):
    e = env(spark, sf_dir)
    return lookup_many(e.src.events, _latest(e), ["season_id"])


@query("lookup_categories", f"""
SELECT * FROM f_categories WHERE event_id IN
  (SELECT id FROM f_events WHERE season_id = {_LATEST})""")
def lookup_categories(spark, sf_dir):
    e = env(spark, sf_dir)
    events = lookup_many(e.src.events, _latest(e), ["season_id"])
    return lookup_many(e.src.categories, event_requests(events), ["event_id"])


@query("lookup_sessions", f"""
SELECT s.* FROM f_sessions s SEMI JOIN
  (SELECT * FROM f_categories WHERE season_id = {_LATEST}) c
  ON s.event_id = c.event_id AND s.category_id = c.id""")
def lookup_sessions(spark, sf_dir):
    e = env(spark, sf_dir)
    cats = lookup_many(e.src.categories, _latest(e), ["season_id"])
    return lookup_many(e.src.sessions, category_requests(cats),
                       ["event_id", "category_id"])


@query("lookup_classification", f"""
SELECT c.* FROM f_classifications c SEMI JOIN
  (SELECT * FROM f_sessions WHERE season_id = {_LATEST}) s ON c.session_id = s.id""")
def lookup_classification(spark, sf_dir):
    e = env(spark, sf_dir)
    sessions = lookup_many(e.src.sessions, _latest(e), ["season_id"])
    return lookup_many(e.src.classifications, task_keys(sessions), ["session_id"])


@query("name_stem", "SELECT split_part(id || '.csv', '.', 1) AS stem FROM f_sessions")
def name_stem_q(spark, sf_dir):
    s = env(spark, sf_dir).src.sessions
    return s.select(name_stem(F.concat("id", F.lit(".csv"))).alias("stem"))


@query("sort_seasons_desc", """
SELECT CAST(row_number() OVER (ORDER BY year DESC, id) AS BIGINT) AS rank, id, year
FROM f_seasons""")
def sort_seasons_desc(spark, sf_dir):
    return rank_desc(env(spark, sf_dir).src.seasons, "year").select("rank", "id", "year")


@query("sort_sessions_desc", "SELECT id, name FROM f_sessions ORDER BY id DESC")
def sort_sessions_desc(spark, sf_dir):
    """Global descending sort (a test checks the order, the SQL the rows)."""
    return sort_desc(env(spark, sf_dir).src.sessions, "id").select("id", "name")


@query("top1_latest_season", "SELECT id, year FROM f_seasons ORDER BY year DESC, id LIMIT 1")
def top1_latest_season(spark, sf_dir):
    """Latest season from the raw (all text) bronze seasons: the year is
    converted with ``try_cast`` as untrusted text, then top-1."""
    raw = read_bronze_raw(spark, env(spark, sf_dir).lake, "seasons")
    typed = raw.select("id", F.col("year").try_cast("int").alias("year"))
    return top1(typed, "year", "id")
