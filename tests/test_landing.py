"""Bronze landing and typed re-reads (Q5, Q6, Q7, Q13, Q16)."""

import re

from pyspark.sql import Row

from tierline.plans.lake import Lake, land_entity, read_bronze, read_bronze_raw
from tierline.schemas import CLASSIFICATIONS, EVENTS, SEASONS, SESSIONS
from tierline.sinks.files import export_csv_noheader, land_csv
from tierline.sources.files import read_csv_positional


def _cls(spark, rows):
    return spark.createDataFrame(rows, CLASSIFICATIONS)


def test_names_with_commas_quotes_empty_and_null_survive(spark, folder):
    rows = [("s", "e", "c", "x1", 'A, "B"', 7, 1, 25),
            ("s", "e", "c", "x1", "", None, None, 0),
            ("s", "e", "c", "x2", None, 3, 2, 20)]
    lake = Lake(folder())
    land_entity(lake, "classifications", _cls(spark, rows))
    back = read_bronze(spark, lake, "classifications")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)


def test_null_token_is_null_in_typed_read_and_text_in_raw_read(spark, folder):
    lake = Lake(folder())
    land_entity(lake, "classifications",
                _cls(spark, [("s", "e", "c", "x", "Rider 1", None, None, 3)]))
    typed = read_bronze(spark, lake, "classifications").first()
    assert typed.number is None and typed.position is None and typed.points == 3
    raw = read_bronze_raw(spark, lake, "classifications").first()
    assert raw.number == "null" and raw.pos == "null" and raw.pts == "3"


def test_numeric_looking_partition_value_stays_a_string(spark, folder):
    lake = Lake(folder())
    land_entity(lake, "events", spark.createDataFrame(
        [("Qatar", "QAT", "e1", "2023")], EVENTS))
    back = read_bronze(spark, lake, "events")
    assert dict(back.dtypes)["season_id"] == "string"
    assert back.first().season_id == "2023"
    raw = read_bronze_raw(spark, lake, "events")
    assert dict(raw.dtypes)["season_id"] == "string"


def test_partitioned_landing_replaces_only_rewritten_partitions(spark, folder):
    lake = Lake(folder())
    first = spark.createDataFrame([("a", "A", "1", "s1"), ("b", "B", "2", "s2")], EVENTS)
    land_entity(lake, "events", first)
    again = spark.createDataFrame([("c", "C", "3", "s2")], EVENTS)
    land_entity(lake, "events", again)
    got = {r.id: r.season_id for r in read_bronze(spark, lake, "events").collect()}
    assert got == {"1": "s1", "3": "s2"}


def test_rerun_is_idempotent(spark, folder):
    lake = Lake(folder())
    df = spark.createDataFrame([("n", "1", "s1", "e1", "c1"), ("m", "2", "s1", "e1", "c1")],
                               SESSIONS)
    land_entity(lake, "sessions", df)
    land_entity(lake, "sessions", df)
    assert read_bronze(spark, lake, "sessions").count() == 2


def test_headerless_export_binds_fields_by_position(spark, folder):
    path = folder()
    df = spark.createDataFrame([("2001", 2001)], SEASONS)
    export_csv_noheader(df, path)
    back = read_csv_positional(spark, path, SEASONS)
    assert back.collect() == [Row(id="2001", year=2001)]


def test_four_key_layout_round_trip(spark, folder):
    rows = [("s", "e", "c", f"x{i}", f"r{i}", i, i, i) for i in range(5)]
    path = folder()
    from tierline.plans.lake import to_bronze_columns
    from tierline.schemas import TASK_KEYS
    land_csv(to_bronze_columns("classifications", _cls(spark, rows)), path, TASK_KEYS,
             writers=2)
    from tierline.sources.files import read_csv_typed
    back = read_csv_typed(spark, path, CLASSIFICATIONS).select(*CLASSIFICATIONS.names)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_many_folders_are_written_plainly_and_listed_in_one_job(spark, folder):
    """One file a session: no checksum file beside it, keys as discovered ones."""
    import os

    from tierline.plans.lake import to_bronze_columns
    from tierline.schemas import TASK_KEYS
    from tierline.session import local_path
    from tierline.sinks.files import session_conf
    from tierline.sources.files import read_csv_by_folder, read_csv_typed

    odd = ["a b", "50%", "x+y", "k=v", "\u00e9/\u4e2d", "%2B", "q?[1]{2}", None, ""]
    rows = [("s", "e", f"c{c}", x, "r,\"1\"", 1, None, c) for c in range(4) for x in odd]
    rows += [(None, "e+", "c", f"x{i}", None, None, i, i) for i in range(9)]
    path = folder()
    land_csv(to_bronze_columns("classifications", _cls(spark, rows)), path, TASK_KEYS,
             writers=2)
    names = [n for _, _, ns in os.walk(local_path(path)) for n in ns]
    assert names and not [n for n in names if n.endswith(".crc")]

    with session_conf(spark, {"spark.sql.sources.parallelPartitionDiscovery.threshold": "2"}):
        spark.sparkContext.setJobGroup("by-folder", "")
        by_folder = read_csv_by_folder(spark, path, CLASSIFICATIONS, TASK_KEYS)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("by-folder")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1
    assert by_folder.columns == CLASSIFICATIONS.names
    found = read_csv_typed(spark, path, CLASSIFICATIONS).select(*CLASSIFICATIONS.names)
    assert sorted(map(repr, by_folder.collect())) == sorted(map(repr, found.collect()))
    assert sorted(map(repr, map(tuple, by_folder.collect()))) == sorted(
        repr((*r[:3], r[3] or None, *r[4:])) for r in rows)


def test_a_landing_without_rows_is_read_by_folder(spark, folder):
    from tierline.plans.lake import to_bronze_columns
    from tierline.schemas import TASK_KEYS
    from tierline.sources.files import read_csv_by_folder

    path = folder()
    land_csv(to_bronze_columns("classifications", _cls(spark, [])), path, TASK_KEYS, writers=2)
    assert read_csv_by_folder(spark, path, CLASSIFICATIONS, TASK_KEYS).count() == 0


def test_incremental_refresh_touches_only_the_run_seasons(spark, folder):
    import os

    from tierline.plans.lake import load_silver, read_silver
    from tierline.plans.medallion import build_gold
    from tierline.schemas import CATEGORIES
    from tierline.session import local_path

    lake = Lake(folder())
    seasons = spark.createDataFrame([("s1", 2001), ("s2", 2002)], SEASONS)
    land_entity(lake, "seasons", seasons)
    land_entity(lake, "events", spark.createDataFrame(
        [("A", "AAA", "e1", "s1"), ("B", "BBB", "e2", "s2")], EVENTS))
    land_entity(lake, "categories", spark.createDataFrame(
        [("C", "c1", "s1", "e1"), ("C", "c1", "s2", "e2")], CATEGORIES))
    land_entity(lake, "sessions", spark.createDataFrame(
        [("R", "x1", "s1", "e1", "c1"), ("R", "x2", "s2", "e2", "c1")], SESSIONS))
    land_entity(lake, "classifications", _cls(spark, [
        ("s1", "e1", "c1", "x1", "a", 1, 1, 25), ("s2", "e2", "c1", "x2", "b", 2, 1, 25)]))
    load_silver(spark, lake)
    build_gold(spark, lake)
    y1 = local_path(lake.gold("results")) + "/season_id=s1"
    before = sorted(os.listdir(y1))

    # a later run lands more rows for season s2 only
    land_entity(lake, "classifications", _cls(spark, [
        ("s2", "e2", "c1", "x2", "b", 2, 1, 25), ("s2", "e2", "c1", "x2", "c", 3, 2, 20)]))
    touched = ["s2"]
    load_silver(spark, lake, seasons=touched)
    gold = build_gold(spark, lake, seasons=touched)

    assert sorted(os.listdir(y1)) == before
    assert sorted((r.year, r.rider_name) for r in gold.collect()) == [
        (2001, "a"), (2002, "b"), (2002, "c")]
    assert read_silver(spark, lake, "classifications").count() == 3


def test_hot_partition_key_is_written_by_several_tasks(spark, folder):
    import os

    from pyspark.sql import functions as F

    from tierline.session import local_path
    from tierline.sinks.files import session_conf

    n = 30000
    df = spark.range(n).select(
        F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"),
        F.lit("x").alias("sname"), F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string"))).alias("season_id"))
    lake = Lake(folder())
    with session_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
                              "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        land_entity(lake, "events", df)
    hot = local_path(lake.bronze("events")) + "/season_id=hot"
    assert len([f for f in os.listdir(hot) if f.endswith(".csv")]) > 1
    assert read_bronze(spark, lake, "events").count() == n


def test_filter_on_a_landed_partition_key_prunes_partitions(spark, folder):
    from pyspark.sql import functions as F

    lake = Lake(folder())
    land_entity(lake, "events", spark.createDataFrame(
        [("a", "A", "1", "s1"), ("b", "B", "2", "s2")], EVENTS))
    df = read_bronze(spark, lake, "events").filter(F.col("season_id") == "s2")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season_id" in plan and "= s2)" in plan
    assert [r.id for r in df.collect()] == ["2"]


def test_season_refresh_reads_only_its_folders(spark, folder):
    from tierline.plans.lake import load_silver, read_silver
    from tierline.plans.medallion import silver_gold

    lake = Lake(folder())
    land_entity(lake, "seasons", spark.createDataFrame([("s1", 2001), ("s2", 2002)], SEASONS))
    land_entity(lake, "events", spark.createDataFrame(
        [("A", "AAA", "e1", "s1"), ("B", "BBB", "e2", "s2")], EVENTS))
    from tierline.schemas import CATEGORIES
    land_entity(lake, "categories", spark.createDataFrame(
        [("C", "c1", "s1", "e1"), ("C", "c1", "s2", "e2")], CATEGORIES))
    land_entity(lake, "sessions", spark.createDataFrame(
        [("R", "x1", "s1", "e1", "c1"), ("R", "x2", "s2", "e2", "c1")], SESSIONS))
    land_entity(lake, "classifications", _cls(spark, [
        ("s1", "e1", "c1", "x1", "a", 1, 1, 25), ("s2", "e2", "c1", "x2", "b", 2, 1, 25)]))
    load_silver(spark, lake)
    bronze = read_bronze(spark, lake, "classifications", seasons=["s2"])
    silver = read_silver(spark, lake, "classifications", seasons=["s2"])
    gold = silver_gold(spark, lake, seasons=["s2"])
    for df in (bronze, silver, gold):
        plan = df._jdf.queryExecution().executedPlan().toString()
        facts = [line for line in plan.splitlines() if "FileScan" in line and "points" in line]
        assert facts and all(re.search(r"PartitionFilters: \[[^\]]*season_id[^\]]*s2", line) for line in facts)
        assert "Exchange hashpartitioning(season_id" not in plan and "LeftSemi" not in plan
    assert [r.rider_name for r in gold.collect()] == ["b"]


def test_silver_keeps_the_source_file_and_has_no_exchange(spark, folder):
    from tierline.plans.lake import load_silver, read_silver

    lake = Lake(folder())
    land_entity(lake, "classifications", _cls(spark, [("s1", "e1", "c1", "x1", "a", 1, None, 25)]))
    load_silver(spark, lake, entities=["classifications"])
    row = read_silver(spark, lake, "classifications", filename=True).first()
    assert "/bronze/classifications/season_id=s1/event_id=e1/run_id=" in row.filename


def test_a_second_layout_is_refused(spark, folder):
    import pytest

    from tierline.plans.lake import LayoutError

    lake = Lake(folder())
    events = spark.createDataFrame([("a", "A", "1", "s1")], EVENTS)
    land_entity(lake, "events", events)
    land_entity(lake, "events", events)
    with pytest.raises(LayoutError, match="scale"):
        land_entity(lake, "events", events, layout="reference")


def test_growing_entities_land_compressed_in_files_of_bounded_length(spark, folder, monkeypatch):
    import os

    from tierline.plans import lake as lakes
    from tierline.session import local_path

    monkeypatch.setattr(lakes, "LINES_PER_FILE", 10)
    rows = [("s", "e", "c", f"x{i}", f"r{i}", None, i, i) for i in range(45)]
    lake = Lake(folder())
    land_entity(lake, "classifications", _cls(spark, rows))
    land_entity(lake, "sessions", spark.createDataFrame(
        [("R", f"x{i}", "s", "e", "c") for i in range(25)], SESSIONS))
    for entity, least in (("classifications", 5), ("sessions", 3)):
        names = [n for _, _, found in os.walk(local_path(lake.bronze(entity))) for n in found if n.startswith("part-")]
        assert len(names) >= least and all(n.endswith(".csv.gz") for n in names)
    back = read_bronze(spark, lake, "classifications")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
    assert read_bronze(spark, lake, "sessions").count() == 25


def _tables(spark, root, keys):
    """Driver tables with orders of the given keys, three lines each."""
    spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string").write.parquet(f"{root}/region.parquet")
    spark.createDataFrame([(0, "NATION", 0)], "n_nationkey int, n_name string, n_regionkey int") \
        .write.parquet(f"{root}/nation.parquet")
    spark.createDataFrame([(1, "c", 0, 0.0, "SEG")], "c_custkey long, c_name string, c_nationkey int, "
                          "c_acctbal double, c_mktsegment string").write.parquet(f"{root}/customer.parquet")
    spark.createDataFrame([(k, 1, "F", f"p{i}") for i, k in enumerate(keys)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string") \
        .write.parquet(f"{root}/orders.parquet")
    spark.createDataFrame([(k, 7, i, n, 5.0, "N", "F") for i, k in enumerate(keys) for n in (1, 2, 3)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_returnflag string, l_linestatus string").write.parquet(f"{root}/lineitem.parquet")


def test_derived_rows_are_shuffled_once_by_session_up_to_the_landing(spark, folder):
    from tierline.operators.crawl import expand_classifications, task_keys
    from tierline.sinks.files import session_conf
    from tierline.sources.fixture import derive_entities

    root = folder()
    _tables(spark, root, range(20))
    src = derive_entities(spark, root)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        rows = expand_classifications(task_keys(src.sessions), src.classifications)
        plan = rows._jdf.queryExecution().sparkPlan().toString()
        first = rows._jdf.queryExecution().executedPlan().toString()
        assert rows.count() == 60
    assert "SortMergeJoin" in plan
    assert "hashpartitioning(l_orderkey" not in first and first.count("hashpartitioning(_line_session") == 1
    # the rows of the first join are not shuffled again for the second one
    assert first.count("hashpartitioning(session_id") == 1


def test_orders_with_null_repeated_and_very_long_keys_keep_their_own_lines(spark, folder):
    from tierline.sources.fixture import derive_entities

    long_keys = [1234567890123, 1234567890124]  # more digits than an id holds
    root = folder()
    _tables(spark, root, [1, 1, -5, None, *long_keys])
    rows = derive_entities(spark, root).classifications.groupBy("session_id", "name").count().collect()
    got = sorted((r.session_id[-12:], r.name, r["count"]) for r in rows)
    # key 1 has two orders and six lines; the long keys share an id, not lines
    assert got == sorted([("000000000001", "Rider 0", 6), ("000000000001", "Rider 1", 6), ("0000000000-5", "Rider 2", 3),
                          ("123456789012", "Rider 4", 3), ("123456789012", "Rider 5", 3)])
