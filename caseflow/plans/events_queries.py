"""The same operators on the second log, ``events``: one user is one entity
with a long history (about 67 events, up to about 100), which exercises
partial aggregation on large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.consolidate import consolidate
from ..operators.profile import profile_columns
from ..operators.reassign import group_count_histogram
from .fixtures import table
from .spec import LogSpec

# Fixed choice of roles for the events stand-in.
EVENTS = LogSpec(
    id_col="user_id",
    order_by=("ts", "event_id"),
    status_col="event_type",
    closed=("purchase",),
    labels=("event_type",),
    skip=("ts",),
)
EVENT_INPUTS = ("value", "props")
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
EVENT_PROFILED = ("event_id", "event_type", "value", "props")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def q_events_profile(spark: SparkSession, sf: str) -> DataFrame:
    p = profile_columns(events(spark, sf), EVENTS.id_col, EVENTS.status_col, EVENTS.closed, [],
                        skip=EVENTS.skip)
    return p.selectExpr("column_name", "position", "round(constancy, 6) AS constancy",
                        "round(null_ratio, 6) AS null_ratio")


def q_events_consolidate(spark: SparkSession, sf: str) -> DataFrame:
    return consolidate(events(spark, sf), EVENTS.id_col, EVENT_INPUTS, EVENTS.labels, EVENTS.order_by)


def q_events_group_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Groups are price bands of the event's value: their number varies by user."""
    e = events(spark, sf).selectExpr("user_id", "event_type", "CAST(floor(value / 10) AS STRING) AS band")
    return group_count_histogram(e.where("event_type = 'purchase'"), EVENTS.id_col, "band", [])


def q_events_group_histogram_all(spark: SparkSession, sf: str) -> DataFrame:
    """The same bands over the events of every type: every user with a value counts."""
    e = events(spark, sf).selectExpr("user_id", "CAST(floor(value / 10) AS STRING) AS band")
    return group_count_histogram(e, EVENTS.id_col, "band", [])


def q_events_type_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return group_count_histogram(events(spark, sf), EVENTS.id_col, "event_type", [])


QUERIES = {
    "events_profile": q_events_profile,
    "events_consolidate": q_events_consolidate,
    "events_group_histogram": q_events_group_histogram,
    "events_group_histogram_all": q_events_group_histogram_all,
    "events_type_histogram": q_events_type_histogram,
}


def _profile_sql() -> str:
    open_rows = "SELECT * FROM events WHERE event_type NOT IN ('purchase')"
    parts = []
    for c in EVENT_PROFILED:
        pos = EVENT_COLUMNS.index(c) + 1
        k = (f"CAST((SELECT count(*) FROM (SELECT user_id FROM (SELECT DISTINCT user_id, {c} FROM o) "
             f"GROUP BY user_id HAVING count(*) = 1)) AS DOUBLE) / "
             f"(SELECT count(*) FROM (SELECT DISTINCT user_id FROM o))")
        m = f"(SELECT CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) FROM events)"
        parts.append(f"SELECT '{c}' AS column_name, CAST({pos} AS INTEGER) AS position, "
                     f"round({k}, 6) AS constancy, round({m}, 6) AS null_ratio")
    return f"WITH o AS ({open_rows})\n" + "\nUNION ALL\n".join(parts)


ORACLES = {
    "events_profile": _profile_sql(),
    "events_consolidate": """WITH r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS rf,
            row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rl
  FROM events)
SELECT f.user_id, f.props, f.value, l.event_type
FROM (SELECT * FROM r WHERE rf = 1) f JOIN (SELECT * FROM r WHERE rl = 1) l ON f.user_id = l.user_id""",
    "events_group_histogram": """SELECT n_cambios, count(*) AS count FROM (
  SELECT user_id, count(DISTINCT floor(value / 10)) AS n_cambios FROM events
  WHERE event_type = 'purchase' AND value IS NOT NULL GROUP BY user_id) g
GROUP BY n_cambios ORDER BY n_cambios""",
    "events_group_histogram_all": """SELECT n_cambios, count(*) AS count FROM (
  SELECT user_id, count(DISTINCT floor(value / 10)) AS n_cambios FROM events WHERE value IS NOT NULL GROUP BY user_id) g
GROUP BY n_cambios ORDER BY n_cambios""",
    "events_type_histogram": """SELECT n_cambios, count(*) AS count FROM (
  SELECT user_id, count(DISTINCT event_type) AS n_cambios FROM events WHERE event_type IS NOT NULL GROUP BY user_id) g
GROUP BY n_cambios ORDER BY n_cambios""",
}
