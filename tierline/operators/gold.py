"""Gold: one wide results table from a star of left joins.

Plan shape (checked with ``explain``): the fact (classifications) is joined
first to sessions, the one dimension that grows with the data, by a shuffle
join on ``session_id`` that AQE may split when one session is hot, while the
fact rows are still narrow; then to seasons, events and categories, which
Spark broadcasts by their size in bytes.  The category join uses the composite
key (id, event_id) because category ids repeat across events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.operators.joins import check_unique
from tierline.schemas import GOLD_NAMES


def check_dimensions(seasons: DataFrame, events: DataFrame, categories: DataFrame,
                     sessions: DataFrame) -> None:
    """Prove the four dimension keys unique, in one job (a repeated key would
    multiply fact rows)."""
    check_unique([("seasons", seasons, ["id"]), ("events", events, ["id"]),
                  ("categories", categories, ["id", "event_id"]), ("sessions", sessions, ["id"])])


def gold_results(classifications: DataFrame, seasons: DataFrame,
                 events: DataFrame, categories: DataFrame,
                 sessions: DataFrame, style: str = "bash", keep: tuple[str, ...] = ()) -> DataFrame:
    """Results table with the column names of ``style`` (bash, dbt, table);
    lazy, and without a check of its dimensions.

    ``keep``: key columns of the fact to add last, for storing gold
    partitioned by them (they are never NULL, unlike ``year``).
    """
    names = GOLD_NAMES[style]
    fact = classifications.select(
        "season_id", "event_id", "category_id", "session_id",
        F.col("name").alias("_rider_name"),
        F.col("number").alias("_rider_number"),
        F.col("position").alias("_position"),
        F.col("points").alias("_points"))
    ses = sessions.select(F.col("id").alias("_ses_id"),
                          F.col("name").alias("_session"))
    sea = seasons.select(F.col("id").alias("_sea_id"), F.col("year").alias("_year"))
    evt = events.select(F.col("id").alias("_evt_id"),
                        F.col("name").alias("_event_name"),
                        F.col("sname").alias("_event_short"))
    cat = categories.select(F.col("id").alias("_cat_id"),
                            F.col("event_id").alias("_cat_event_id"),
                            F.col("name").alias("_category"))
    g = fact.join(ses, fact.session_id == ses._ses_id, "left")
    g = g.join(sea, g.season_id == sea._sea_id, "left")
    g = g.join(evt, g.event_id == evt._evt_id, "left")
    g = g.join(cat, (g.category_id == cat._cat_id) & (g.event_id == cat._cat_event_id), "left")
    src = ["_year", "_event_name", "_event_short", "_category", "_session",
           "_rider_name", "_rider_number", "_position", "_points"]
    cols = [F.col(s).alias(n) for s, n in zip(src, names)]
    return g.select(*cols, *keep)
