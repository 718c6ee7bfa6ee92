"""A session holding a third of all fact rows: AQE splits it, rows stay whole."""

from pyspark.sql import functions as F

from tierline.operators.gold import gold_results
from tierline.schemas import CATEGORIES, EVENTS, SEASONS, SESSIONS
from tierline.sinks.files import session_conf

SMALL_PARTITIONS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_session_is_split_by_aqe_and_no_row_is_lost(spark):
    n = 30000
    fact = spark.range(n).select(
        F.lit("s1").alias("season_id"), F.lit("e1").alias("event_id"),
        F.lit("c1").alias("category_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .otherwise(F.concat(F.lit("x"), (F.col("id") % 1000).cast("string")))
         .alias("session_id"),
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("name"),
        F.lit(1).alias("number"), F.lit(1).alias("position"), F.lit(1).alias("points"))
    sessions = spark.range(1000).select(
        F.lit("R").alias("name"), F.concat(F.lit("x"), F.col("id").cast("string")).alias("id"),
        F.lit("s1").alias("season_id"), F.lit("e1").alias("event_id"),
        F.lit("c1").alias("category_id")
    ).unionByName(spark.createDataFrame([("HOT", "hot", "s1", "e1", "c1")], SESSIONS))
    seasons = spark.createDataFrame([("s1", 2001)], SEASONS)
    events = spark.createDataFrame([("E", "EEE", "e1", "s1")], EVENTS)
    cats = spark.createDataFrame([("C", "c1", "s1", "e1")], CATEGORIES)
    with session_conf(spark, SMALL_PARTITIONS):
        g = gold_results(fact, seasons, events, cats, sessions)
        rows = g.collect()
        plan = g._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == n
    assert sum(1 for r in rows if r.session == "HOT") == n // 3
    assert "skew=true" in plan
