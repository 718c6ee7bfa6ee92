"""DuckDB SQL for the correctness check.

Each statement starts with the entity views (``f_*``) derived from the
driver tables exactly as ``tierline.sources.fixture`` derives them, and the
views with childless parents (``p_*``, as ``with_gaps`` has them) that the
process log ``f_log`` is about; then it states the expected result of one
query of ``tierline.checks``.
"""

from __future__ import annotations


def _uuid(tag: str, expr: str) -> str:
    return f"concat('{tag}-0000-0000-0000-', lpad(CAST({expr} AS VARCHAR), 12, '0'))"


_SEA = lambda e: _uuid("00000001", e)
_EVT = lambda e: _uuid("00000002", e)
_CAT = lambda e: _uuid("00000003", e)
_SES = lambda e: _uuid("00000004", e)

ENTITY_CTES = f"""
f_seasons AS (
  SELECT {_SEA('r_regionkey')} AS id, CAST(2000 + r_regionkey AS INTEGER) AS year
  FROM region),
f_events AS (
  SELECT n_name AS name, substr(n_name, 1, 3) AS sname,
         {_EVT('n_nationkey')} AS id, {_SEA('n_regionkey')} AS season_id
  FROM nation),
f_categories AS (
  SELECT DISTINCT c_mktsegment AS name, {_CAT('c_mktsegment')} AS id,
         {_SEA('n_regionkey')} AS season_id, {_EVT('c_nationkey')} AS event_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
f_sessions_k AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority AS name, {_SES('o_orderkey')} AS id,
         {_SEA('n_regionkey')} AS season_id, {_EVT('c_nationkey')} AS event_id,
         {_CAT('c_mktsegment')} AS category_id
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey),
f_sessions AS (SELECT name, id, season_id, event_id, category_id FROM f_sessions_k),
f_classifications AS (
  SELECT s.season_id, s.event_id, s.category_id, s.id AS session_id,
         concat('Rider ', CAST(l_suppkey AS VARCHAR)) AS name,
         CASE WHEN l_linestatus = 'F' THEN CAST(l_partkey % 100 AS INTEGER) END AS number,
         CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS position,
         CAST(l_quantity AS INTEGER) AS points
  FROM lineitem JOIN f_sessions_k s ON s.o_orderkey = l_orderkey),
f_tasks AS (
  SELECT id, season_id, event_id, category_id, id AS session_id,
         CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 4 ELSE 0 END AS status
  FROM f_sessions_k),
f_gold AS (
  SELECT se.year, e.name AS event_name, e.sname AS event_short_name,
         ca.name AS category, s.name AS session, c.name AS rider_name,
         c.number AS rider_number, c.position, c.points
  FROM f_classifications c
  LEFT JOIN f_seasons se ON se.id = c.season_id
  LEFT JOIN f_events e ON e.id = c.event_id
  LEFT JOIN f_categories ca ON ca.id = c.category_id AND ca.event_id = c.event_id
  LEFT JOIN f_sessions s ON s.id = c.session_id),
p_events AS (
  SELECT * FROM f_events WHERE season_id <> (SELECT max(id) FROM f_seasons)),
p_categories AS (
  SELECT * FROM f_categories WHERE event_id IN (SELECT id FROM p_events)
  AND event_id <> (SELECT min(id) FROM p_events)),
p_sessions AS (
  SELECT s.* FROM f_sessions s SEMI JOIN p_categories c
  ON s.event_id = c.event_id AND s.category_id = c.id
  WHERE (s.event_id, s.category_id) <> (SELECT (event_id, id) FROM p_categories ORDER BY event_id, id LIMIT 1)),
f_log AS (
  SELECT 'INFO' AS level, 'getting seasons' AS message
  UNION ALL SELECT 'INFO', 'getting events for season: ' || id FROM f_seasons
  UNION ALL SELECT 'INFO', 'getting category for season: ' || season_id || ', event: ' || id
    FROM p_events
  UNION ALL SELECT 'INFO', 'getting session for season: ' || season_id || ', event: ' || event_id
    || ', category: ' || id FROM p_categories
  UNION ALL SELECT 'INFO', 'getting classification for season: ' || season_id || ', event: '
    || event_id || ', category: ' || category_id || ', session: ' || id FROM p_sessions
  UNION ALL SELECT 'ERROR', 'found no events for season: ' || p.id
    FROM f_seasons p ANTI JOIN p_events c ON c.season_id = p.id
  UNION ALL SELECT 'ERROR', 'found no categories for event: ' || p.id
    FROM p_events p ANTI JOIN p_categories c ON c.event_id = p.id
  UNION ALL SELECT 'ERROR', 'found no sessions for event: ' || p.event_id || ', category: ' || p.id
    FROM p_categories p ANTI JOIN p_sessions c
    ON c.event_id = p.event_id AND c.category_id = p.id
  UNION ALL SELECT 'ERROR', 'found no classification data for session: ' || p.id
    FROM p_sessions p ANTI JOIN f_classifications c ON c.session_id = p.id)
"""


# Fixed values in DuckDB form, as in ``tierline.functions.logs``: an id token,
# and the entity a log message is about.
UUID_SQL = ("'[[:alnum:]]{8}-[[:alnum:]]{4}-[[:alnum:]]{4}-[[:alnum:]]{4}-"
            "[[:alnum:]]{12}'")
ENTITY_SQL = """CASE
  WHEN message LIKE 'getting seasons%' OR message LIKE 'found no seasons%' THEN 'seasons'
  WHEN message LIKE 'getting events%' OR message LIKE 'found no events%' THEN 'events'
  WHEN message LIKE 'getting category%' OR message LIKE 'found no categories%' THEN 'categories'
  WHEN message LIKE 'getting session %' OR message LIKE 'found no sessions%' THEN 'sessions'
  WHEN message LIKE 'getting classification%' OR message LIKE 'found no classification%'
    THEN 'classifications' END"""


def with_entities(body: str) -> str:
    body = body.strip()
    sep = "\n" if body[:6].upper() == "SELECT" else ",\n"
    return f"WITH {ENTITY_CTES.strip()}{sep}{body}"


