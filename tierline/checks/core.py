"""Gold results and the left joins it is made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.checks import query
from tierline.checks.env import env
from tierline.operators.joins import left_join
from tierline.plans.lake import read_silver
from tierline.plans.medallion import silver_gold

GOLD_DBT_SQL = """
SELECT year, event_name, event_short_name, category, session AS session_name,
       rider_name, rider_number, position AS rider_position, points AS rider_points
FROM f_gold"""

GOLD_TABLE_SQL = """
SELECT year, event_name AS event, event_short_name AS event_short, category, session,
       rider_name, rider_number, position, points
FROM f_gold"""


@query("gold_results", "SELECT * FROM f_gold")
def gold_results(spark, sf_dir):
    return silver_gold(spark, env(spark, sf_dir).lake, "bash")


@query("gold_results_dbt_names", GOLD_DBT_SQL)
def gold_results_dbt_names(spark, sf_dir):
    return silver_gold(spark, env(spark, sf_dir).lake, "dbt")


@query("gold_results_table_names", GOLD_TABLE_SQL)
def gold_results_table_names(spark, sf_dir):
    return silver_gold(spark, env(spark, sf_dir).lake, "table")


@query("join_left_single", """
SELECT s.id, s.name AS session, c.n_rows
FROM f_sessions s
LEFT JOIN (SELECT session_id, count(*) AS n_rows FROM f_classifications GROUP BY session_id) c
  ON c.session_id = s.id""")
def join_left_single(spark, sf_dir):
    """Every session with its number of rows; sessions without any (they are
    in the data) keep their row."""
    lake = env(spark, sf_dir).lake
    fact = read_silver(spark, lake, "sessions").select("id", F.col("name").alias("session"))
    dim = read_silver(spark, lake, "classifications").groupBy("session_id") \
        .agg(F.count(F.lit(1)).alias("n_rows"))
    return left_join(fact, dim, [("id", "session_id")])


@query("join_left_composite", """
SELECT c.session_id, c.event_id, c.category_id, k.name AS category
FROM f_classifications c
LEFT JOIN p_categories k ON k.id = c.category_id AND k.event_id = c.event_id""")
def join_left_composite(spark, sf_dir):
    """Every classification with its category, as far as the crawl with
    childless parents knows it."""
    e = env(spark, sf_dir)
    fact = read_silver(spark, e.lake, "classifications").select(
        "session_id", "event_id", "category_id")
    dim = e.gaps.categories.select("id", F.col("event_id").alias("k_event_id"),
                                   F.col("name").alias("category"))
    return left_join(fact, dim, [("category_id", "id"), ("event_id", "k_event_id")])
