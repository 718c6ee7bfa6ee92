"""Column expressions for run logs and metrics (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The process-log messages of a crawl, as the log parser and
# the queue transitions expect them.  ``{season}``, ``{event}``,
# ``{category}`` and ``{session}`` are the request keys of the line.
MSG_GET_SEASONS = "getting seasons"
MSG_GET_EVENTS = "getting events for season: {season}"
MSG_GET_CATEGORIES = "getting category for season: {season}, event: {event}"
MSG_GET_SESSIONS = ("getting session for season: {season}, event: {event}, "
                    "category: {category}")
MSG_GET_CLASSIFICATION = ("getting classification for season: {season}, "
                          "event: {event}, category: {category}, session: {session}")
MSG_NO_SEASONS = "found no seasons"
MSG_NO_EVENTS = "found no events for season: {season}"
MSG_NO_CATEGORIES = "found no categories for event: {event}"
MSG_NO_SESSIONS = "found no sessions for event: {event}, category: {category}"
MSG_NO_CLASSIFICATION = "found no classification data for session: {session}"

# Fixed value: an id token is 8-4-4-4-12 letters or digits.
UUID_PATTERN = r"\p{Alnum}{8}-\p{Alnum}{4}-\p{Alnum}{4}-\p{Alnum}{4}-\p{Alnum}{12}"
# Fixed value: a log line is "<time> [<LEVEL>] <message>".
LINE_PATTERN = r"^(\S+) \[([A-Z]+)\] (.*)$"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

_PLACEHOLDERS = {"season": "season_id", "event": "event_id",
                 "category": "category_id", "session": "session_id"}


def message(template: str) -> Column:
    """The message column for a template, filled from the key columns."""
    parts: list[Column] = []
    rest = template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            parts.append(F.lit(head))
        parts.append(F.col(_PLACEHOLDERS[name]))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def log_line(level: str, msg: Column, ts: Column | None = None) -> Column:
    """``<ISO time> [LEVEL] message``; the time defaults to now."""
    ts = F.current_timestamp() if ts is None else ts
    return F.concat(F.date_format(ts, TIME_FORMAT), F.lit(f" [{level}] "), msg)


def line_time(line: Column) -> Column:
    return F.regexp_extract(line, LINE_PATTERN, 1)


def line_level(line: Column) -> Column:
    return F.regexp_extract(line, LINE_PATTERN, 2)


def line_message(line: Column) -> Column:
    return F.regexp_extract(line, LINE_PATTERN, 3)


def extract_ids(text: Column) -> Column:
    """All UUID-shaped tokens of a text, in order (array<string>)."""
    return F.regexp_extract_all(text, F.lit(UUID_PATTERN), 0)


def name_stem(name: Column) -> Column:
    """Part of a file name before the first dot (``a.b.csv`` -> ``a``)."""
    return F.substring_index(name, ".", 1)


def requests_per_second(requests: Column, duration_ms: Column) -> Column:
    """Requests per whole second, floored; NULL for runs under one second."""
    secs = F.floor(duration_ms / 1000).cast("long")
    return F.when(secs > 0, F.floor(requests / secs).cast("long"))


# Which entity a log message is about, by message prefix.
ENTITY_PATTERNS = [
    ("seasons", r"^(getting seasons|found no seasons)"),
    ("events", r"^(getting events|found no events)"),
    ("categories", r"^(getting category|found no categories)"),
    ("sessions", r"^(getting session |found no sessions)"),
    ("classifications", r"^(getting classification|found no classification)"),
]


def message_entity(msg: Column) -> Column:
    """Entity level a process-log message refers to (NULL if unknown)."""
    out = None
    for name, pattern in ENTITY_PATTERNS:
        out = (F.when(msg.rlike(pattern), F.lit(name)) if out is None
               else out.when(msg.rlike(pattern), F.lit(name)))
    return out
