"""Gold joins, audits and write-audit-publish (Q12, Q15)."""

import pytest

from tierline.operators.gold import check_dimensions, gold_results
from tierline.operators.joins import DuplicateKeyError
from tierline.operators.quality import AuditError, audit_nulls, null_counts
from tierline.schemas import (AUDIT_DIMS, CATEGORIES, CLASSIFICATIONS, EVENTS, GOLD_NAMES,
                              SEASONS, SESSIONS)
from tierline.tables import wap
from tierline.tables.published import PublishConflict, PublishedTable


def _dims(spark):
    seasons = spark.createDataFrame([("s1", 2023)], SEASONS)
    events = spark.createDataFrame([("Qatar", "QAT", "e1", "s1"),
                                    ("Spain", "SPA", "e2", "s1")], EVENTS)
    # the same category id under two events
    categories = spark.createDataFrame([("Class A", "c1", "s1", "e1"),
                                        ("Class A", "c1", "s1", "e2")], CATEGORIES)
    sessions = spark.createDataFrame([("RAC", "x1", "s1", "e1", "c1"),
                                      ("RAC", "x2", "s1", "e2", "c1")], SESSIONS)
    return seasons, events, categories, sessions


def test_gold_uses_composite_category_key(spark):
    seasons, events, categories, sessions = _dims(spark)
    cls = spark.createDataFrame([("s1", "e1", "c1", "x1", "A", 1, 1, 25),
                                 ("s1", "e2", "c1", "x2", "B", 2, None, 0)], CLASSIFICATIONS)
    g = gold_results(cls, seasons, events, categories, sessions)
    assert g.columns == GOLD_NAMES["bash"]
    assert g.count() == 2
    assert {r.event_name for r in g.collect()} == {"Qatar", "Spain"}


@pytest.mark.parametrize("which", [0, 1, 2, 3])
def test_a_non_unique_dimension_key_is_refused(spark, which):
    dims = list(_dims(spark))
    check_dimensions(*dims)
    dims[which] = dims[which].unionByName(dims[which].limit(1))
    name = ["seasons", "events", "categories", "sessions"][which]
    with pytest.raises(DuplicateKeyError, match=name):
        check_dimensions(*dims)


def test_gold_is_lazy(spark):
    tracker = spark.sparkContext.statusTracker()
    seasons, events, categories, sessions = _dims(spark)
    cls = spark.createDataFrame([("s1", "e1", "c1", "x1", "A", 1, 1, 25)], CLASSIFICATIONS)
    spark.sparkContext.setJobGroup("lazy-gold", "")
    gold_results(cls, seasons, events, categories, sessions)
    assert not tracker.getJobIdsForGroup("lazy-gold")


def test_small_stored_dimensions_are_broadcast_by_size(spark, folder):
    dims = []
    for i, d in enumerate(_dims(spark)):
        path = f"{folder('dims')}/{i}"
        d.write.parquet(path)
        dims.append(spark.read.parquet(path))
    cls = spark.createDataFrame([("s1", "e1", "c1", "x1", "A", 1, 1, 25)], CLASSIFICATIONS)
    plan = gold_results(cls, *dims)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 3


def test_audit_counts_all_dims_in_one_pass_and_raises_with_count(spark):
    seasons, events, categories, sessions = _dims(spark)
    cls = spark.createDataFrame([("s1", "e1", "c1", "x1", "A", 1, 1, 25),
                                 ("s1", "e1", "c1", "missing", "B", 2, 2, 20)],
                                CLASSIFICATIONS)
    g = gold_results(cls, seasons, events, categories, sessions, style="table")
    counts = {r.dim: r.nulls for r in null_counts(g, AUDIT_DIMS).collect()}
    assert counts == {"year": 0, "event": 0, "category": 0, "session": 1}
    with pytest.raises(AuditError) as err:
        audit_nulls(g, AUDIT_DIMS)
    assert err.value.dimension == "session" and err.value.count == 1


_GOLD = "year int, event string, category string, session string"


@pytest.mark.parametrize("named", [False, True])
def test_failed_audit_leaves_the_table_unchanged(spark, folder, named):
    t = PublishedTable(spark, folder("gold"), name="wap_test.audited" if named else None)
    good = spark.createDataFrame([(2023, "Qatar", "Class A", "RAC")], _GOLD)
    wap.write_audit_publish(t, good, AUDIT_DIMS)
    bad = spark.createDataFrame([(2023, "Qatar", "Class A", None)], _GOLD)
    with pytest.raises(AuditError):
        wap.write_audit_publish(t, bad, AUDIT_DIMS)
    assert t.read().collect() == good.collect()
    assert len(t.remove_unused()) == 1
    assert t.read().collect() == good.collect()
    if named:
        spark.sql("DROP TABLE wap_test.audited")


def _one(spark, v):
    return spark.createDataFrame([(v,)], "v int")


def test_staged_rows_are_invisible_until_publish_and_readers_stay_pinned(spark, folder):
    t = PublishedTable(spark, folder("t"), name="wap_test.pinned")
    t.replace(_one(spark, 1))
    reader = t.read()
    staged = t.stage(_one(spark, 2))
    assert [r.v for r in t.read().collect()] == [1]
    assert [r.v for r in t.read(staged.folder).collect()] == [2]
    t.publish(staged)
    assert [r.v for r in t.read().collect()] == [2]
    assert [r.v for r in spark.table("wap_test.pinned").collect()] == [2]
    assert [r.v for r in reader.collect()] == [1]
    spark.sql("DROP TABLE wap_test.pinned")


def test_publish_fails_when_the_table_moved(spark, folder):
    t = PublishedTable(spark, folder("t"))
    t.replace(_one(spark, 1))
    staged = t.stage(_one(spark, 2))
    t.replace(_one(spark, 3))
    with pytest.raises(PublishConflict):
        t.publish(staged)
    assert [r.v for r in t.read().collect()] == [3]


def test_a_dead_writer_blocks_nobody(spark, folder):
    t = PublishedTable(spark, folder("t"))
    t.replace(_one(spark, 1))
    t.stage(_one(spark, 2))  # its writer dies here
    t.replace(_one(spark, 3))
    assert [r.v for r in PublishedTable(spark, t.location).read().collect()] == [3]


def test_a_table_is_registered_again_from_its_pointer(spark, folder):
    where = folder("t")
    PublishedTable(spark, where, name="wap_test.first").replace(_one(spark, 7))
    later = PublishedTable(spark, where, name="wap_test.second")  # a new catalog knows no such table
    assert [r.v for r in later.read().collect()] == [7]
    spark.sql("DROP TABLE wap_test.first")
    spark.sql("DROP TABLE wap_test.second")


def test_an_earlier_folder_is_readable_until_cleanup(spark, folder):
    t = PublishedTable(spark, folder("t"))
    first = t.replace(_one(spark, 1))
    t.replace(_one(spark, 2))
    assert [r.v for r in t.read(first).collect()] == [1]
    assert first not in t.remove_unused()


def test_bucketed_silver_joins_without_exchange(spark, folder):
    from tierline.plans.lake import Lake, land_entity, load_silver
    from tierline.plans.medallion import silver_gold

    seasons, events, categories, sessions = _dims(spark)
    cls = spark.createDataFrame([("s1", "e1", "c1", "x1", "A", 1, 1, 25),
                                 ("s1", "e2", "c1", "x2", "B", 2, None, 0)], CLASSIFICATIONS)
    lake = Lake(folder())
    for name, df in [("seasons", seasons), ("events", events), ("categories", categories),
                     ("sessions", sessions), ("classifications", cls)]:
        land_entity(lake, name, df)
    load_silver(spark, lake, buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        g = silver_gold(spark, lake)
        plan = g._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning(session_id" not in plan
        assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
        assert g.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
