"""Entities derived from the driver's TPC-H-like star tables:

    region -> seasons, nation -> events, (customer segment, nation) ->
    categories, orders -> sessions, lineitem -> classifications

Ids are UUID-shaped strings built from the integer keys, so that log parsing
and string-id handling see realistic ids.  The same derivation is written as
SQL in ``tierline.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.schemas import COMPLETED, ERRORED, PENDING
from tierline.sources.entities import EntitySource

# The first group of a derived id names the entity kind.
ID_TAGS = {
    "seasons": "00000001",
    "events": "00000002",
    "categories": "00000003",
    "sessions": "00000004",
}
# Fixed value: digits of the key in an id.
ID_DIGITS = 12
# The first season year; years are this plus the region key.
BASE_YEAR = 2000


def uuid_id(kind: str, key: Column) -> Column:
    """``tttttttt-0000-0000-0000-kkkkkkkkkkkk`` from an entity tag and key."""
    return F.concat(F.lit(ID_TAGS[kind] + "-0000-0000-0000-"),
                    F.lpad(key.cast("string"), ID_DIGITS, "0"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derive_entities(spark: SparkSession, sf_dir: str) -> EntitySource:
    """Entity tables derived from the driver tables of ``sf_dir``."""
    region = read_table(spark, sf_dir, "region")
    nation = read_table(spark, sf_dir, "nation").select(
        "n_nationkey", "n_name", "n_regionkey")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus")

    seasons = region.select(
        uuid_id("seasons", F.col("r_regionkey")).alias("id"),
        (F.lit(BASE_YEAR) + F.col("r_regionkey")).cast("int").alias("year"))

    events = nation.select(
        F.col("n_name").alias("name"),
        F.substring("n_name", 1, 3).alias("sname"),
        uuid_id("events", F.col("n_nationkey")).alias("id"),
        uuid_id("seasons", F.col("n_regionkey")).alias("season_id"))

    cust = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    categories = cust.select(
        F.col("c_mktsegment").alias("name"),
        uuid_id("categories", F.col("c_mktsegment")).alias("id"),
        uuid_id("seasons", F.col("n_regionkey")).alias("season_id"),
        uuid_id("events", F.col("c_nationkey")).alias("event_id"),
    ).distinct()

    sess = orders.join(cust, orders.o_custkey == cust.c_custkey)
    sessions_k = sess.select(
        "o_orderkey", "o_orderstatus",
        F.col("o_orderpriority").alias("name"),
        uuid_id("sessions", F.col("o_orderkey")).alias("id"),
        uuid_id("seasons", F.col("n_regionkey")).alias("season_id"),
        uuid_id("events", F.col("c_nationkey")).alias("event_id"),
        uuid_id("categories", F.col("c_mktsegment")).alias("category_id"))
    sessions = sessions_k.select("name", "id", "season_id", "event_id",
                                 "category_id")

    # Joined on the session id that the rows are landed by, so that the landing's
    # own join finds them shuffled already.  Only keys too long for an id share
    # one; these decide themselves.
    def too_long(key: Column) -> Column:
        return F.when(F.length(key.cast("string")) > ID_DIGITS, key).otherwise(0)
    lines = lineitem.select(
        "l_suppkey", "l_quantity", uuid_id("sessions", F.col("l_orderkey")).alias("_line_session"),
        too_long(F.col("l_orderkey")).alias("_line_key"),
        F.when(F.col("l_linestatus") == "F", (F.col("l_partkey") % 100).cast("int")).alias("_number"),
        F.when(F.col("l_returnflag") != "R", F.col("l_linenumber")).alias("_position"))
    line_sessions = sessions_k.withColumn("_key", too_long(F.col("o_orderkey")))
    cls = lines.join(line_sessions, (F.col("_line_session") == F.col("id"))
                     & (F.col("_line_key") >= F.col("_key")) & (F.col("_line_key") <= F.col("_key")))
    classifications = cls.select(
        "season_id", "event_id", "category_id",
        F.col("id").alias("session_id"),
        F.concat(F.lit("Rider "), F.col("l_suppkey").cast("string")).alias("name"),
        F.col("_number").alias("number"), F.col("_position").alias("position"),
        F.col("l_quantity").cast("int").alias("points"))

    task_state = sessions_k.select(
        F.col("id"), "season_id", "event_id", "category_id",
        F.col("id").alias("session_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit(COMPLETED))
         .when(F.col("o_orderstatus") == "O", F.lit(ERRORED))
         .otherwise(F.lit(PENDING)).alias("status"))

    return EntitySource(seasons, events, categories, sessions,
                        classifications, task_state)


def with_gaps(src: EntitySource) -> EntitySource:
    """The source with childless parents at every level, so that each kind of
    failed request occurs: the last season has no events, the first event left
    no categories, the first category left no sessions.  (Sessions without
    classifications are in the data.)  ``tierline.oracle`` states the same."""
    s = src.seasons.agg(F.max("id").alias("_s"))
    events = src.events.join(s, F.col("season_id") == F.col("_s"), "left_anti")
    e = events.agg(F.min("id").alias("_e"))
    categories = src.categories.join(events.select(F.col("id").alias("event_id")), "event_id", "left_semi") \
        .join(e, F.col("event_id") == F.col("_e"), "left_anti").select(*src.categories.columns)
    c = categories.agg(F.min(F.struct("event_id", "id")).alias("_c")) \
        .select(F.col("_c.event_id").alias("_ce"), F.col("_c.id").alias("_cc"))
    kept = categories.select("event_id", F.col("id").alias("category_id"))
    sessions = src.sessions.join(kept, ["event_id", "category_id"], "left_semi") \
        .join(c, (F.col("event_id") == F.col("_ce")) & (F.col("category_id") == F.col("_cc")), "left_anti") \
        .select(*src.sessions.columns)
    return EntitySource(src.seasons, events, categories, sessions, src.classifications, src.task_state)
