"""Incremental runs: what they read, what they rewrite, what they find."""

import os

import pytest
from pyspark.sql import functions as F

from tierline.operators.quality import AuditError, WriteAudit, audit_nulls, null_count_by_file
from tierline.operators.taskqueue import TaskQueue
from tierline.plans import runs
from tierline.plans.changes import FileLedger, changed_rows, list_landed, null_findings
from tierline.plans.lake import Lake, land_entity, read_bronze, read_silver
from tierline.schemas import CATEGORIES, CLASSIFICATIONS, EVENTS, SEASONS, SESSIONS
from tierline.session import local_path
from tierline.sources.entities import EntitySource
from tierline.tables import wap
from tierline.tables.published import PublishedTable


def uid(kind, n):
    return f"{kind:08d}-0000-0000-0000-{n:012d}"


def source(spark, events=4, per_event=3, renamed=None, year=2002):
    """One old season of one event, one new season of several events; sessions
    are numbered event by event.  Every third row has no position."""
    old, new, cat = uid(1, 0), uid(1, 1), uid(3, 0)
    ev = [(f"E{i}", f"S{i}", uid(2, i), new if i else old) for i in range(events + 1)]
    if renamed is not None:
        ev = [(f"{n} renamed", s, e, y) if e == uid(2, renamed) else (n, s, e, y) for n, s, e, y in ev]
    ses = [(f"R{k}", uid(4, per_event * i + k), ev[i][3], ev[i][2], cat)
           for i in range(events + 1) for k in range(per_event)]
    rows = [(s, e, c, i, f"{n}-{i[-2:]}-{k}", k, None if k == 2 else k, 10)
            for n, i, s, e, c in ses for k in range(3)]
    return EntitySource(
        spark.createDataFrame([(old, 2001), (new, year)], SEASONS), spark.createDataFrame(ev, EVENTS),
        spark.createDataFrame([("C", cat, e[3], e[2]) for e in ev], CATEGORIES),
        spark.createDataFrame(ses, SESSIONS), spark.createDataFrame(rows, CLASSIFICATIONS))


def files_of(lake, *layers):
    """Path -> (size, time) of the Parquet files of some layers."""
    out = {}
    for layer in layers:
        top = local_path(f"{lake.root}/{layer}")
        for d, _, names in os.walk(top):
            for n in names:
                if n.endswith(".parquet"):
                    p = os.path.join(d, n)
                    out[os.path.relpath(p, top)] = (os.stat(p).st_size, os.stat(p).st_mtime_ns)
    return out


def events_in(paths):
    return {p.split("event_id=")[1].split("/")[0] for p in paths}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_run_rewrites_the_files_of_its_own_events(spark, folder):
    src, lake = source(spark), Lake(folder())
    runs.run(spark, lake, src, runs.INCREMENTAL, n=7, run_id="a")  # events 1, 2 and a part of 3
    facts = ("silver/classifications", "gold/results")
    before = files_of(lake, *facts, "silver/sessions", "silver/events")
    rep = runs.run(spark, lake, src, runs.INCREMENTAL, n=4, run_id="b")  # the rest of 3, a part of 4
    after = files_of(lake, *facts, "silver/sessions", "silver/events")
    gone, new = set(before) - set(after), set(after) - set(before)
    assert events_in(gone) == {uid(2, 3)} and events_in(new) == {uid(2, 3), uid(2, 4)}
    assert all(after[p] == before[p] for p in set(before) & set(after))
    assert rep.changes.kinds == {"classifications"} and not rep.changes.whole
    clean = runs.run(spark, Lake(folder("clean")), src, runs.INCREMENTAL, n=11, run_id="c")
    assert rows_of(rep.gold) == rows_of(clean.gold)


def test_older_files_of_other_events_are_not_read(spark, folder):
    src, lake = source(spark), Lake(folder())
    runs.run(spark, lake, src, runs.INCREMENTAL, n=6, run_id="a")  # events 1 and 2
    top = local_path(lake.bronze("classifications"))
    for d, _, names in os.walk(top):
        for n in names:
            if n.endswith(".csv"):  # as long and as old as before, but unreadable
                p = os.path.join(d, n)
                at = os.stat(p)
                with open(p, "wb") as f:
                    f.write(b"\xff" * at.st_size)
                os.utime(p, ns=(at.st_atime_ns, at.st_mtime_ns))
                crc = os.path.join(d, f".{n}.crc")
                if os.path.exists(crc):
                    os.remove(crc)
    rep = runs.run(spark, lake, src, runs.INCREMENTAL, n=6, run_id="b")  # events 3 and 4
    assert rep.gold.count() == 36
    found = spark.read.json(lake.logs("data_quality/run_id=b")).collect()
    assert sum(r.NULL_POSITION_COUNT for r in found) == 12  # both runs' files


@pytest.mark.parametrize("change", [{"renamed": 2}, {"year": 2010}])
def test_changed_dimensions_reach_gold(spark, folder, change):
    lake = Lake(folder())
    runs.run(spark, lake, source(spark), run_id="full")
    before = files_of(lake, "gold/results")
    rep = runs.run(spark, lake, source(spark, **change), runs.INCREMENTAL, n=1, run_id="inc")
    want = runs.run(spark, Lake(folder("want")), source(spark, **change), run_id="full").gold
    assert rows_of(rep.gold) == rows_of(want)
    moved = events_in(set(files_of(lake, "gold/results")) ^ set(before))
    assert moved == ({uid(2, 2)} if "renamed" in change else {uid(2, i) for i in (1, 2, 3, 4)})


def test_a_change_of_a_run_that_died_before_gold_is_not_lost(spark, folder, monkeypatch):
    lake, build = Lake(folder()), runs.build_gold
    runs.run(spark, lake, source(spark), run_id="full")
    monkeypatch.setattr(runs, "build_gold", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        runs.run(spark, lake, source(spark, renamed=3), runs.INCREMENTAL, n=1, run_id="dead")
    monkeypatch.setattr(runs, "build_gold", build)
    rep = runs.run(spark, lake, source(spark, renamed=3), runs.INCREMENTAL, n=1, run_id="again")
    assert {r.event_name for r in rep.gold.collect()} == {"E0", "E1", "E2", "E3 renamed", "E4"}


def test_tasks_that_the_queue_lost_are_not_fetched_again(spark, folder):
    src, lake = source(spark), Lake(folder())
    runs.run(spark, lake, src, run_id="a")
    q = TaskQueue(spark, lake.table("tasks"))
    q.save(q.state([uid(1, 1)]).limit(2), [uid(1, 1)])
    gold = runs.run(spark, lake, src, run_id="b").gold
    assert gold.count() == read_bronze(spark, lake, "classifications").count() == 45
    assert {r.status for r in q.state().collect()} == {2} and q.state().count() == 15


def test_events_whose_files_went_leave_silver_and_gold(spark, folder):
    src, lake = source(spark), Lake(folder())
    runs.run(spark, lake, src, run_id="a")
    part = src.classifications.filter(F.col("event_id") != uid(2, 1))
    land_entity(lake, "classifications", part, replace=True)
    rep = runs.run(spark, lake, src, run_id="b")
    assert rep.changes.whole
    assert rep.gold.count() == 36 and read_silver(spark, lake, "classifications").count() == 36


def test_findings_combined_from_partials_equal_a_scan(spark, folder):
    src, lake = source(spark), Lake(folder())
    for i, n in enumerate((2, 3, 1)):
        runs.run(spark, lake, src, runs.INCREMENTAL, n=n, run_id=f"r{i}")
        want = null_count_by_file(read_silver(spark, lake, "classifications", filename=True))
        ledger = FileLedger(spark, lake).known()
        assert rows_of(null_findings(ledger)) == rows_of(want)
        back = spark.read.schema("filename string, NULL_POSITION_COUNT long") \
            .json(lake.logs(f"data_quality/run_id=r{i}"))
        assert rows_of(back) == rows_of(want)
    assert ledger.agg(F.sum("rows"), F.sum("null_number")).first()[:] == (18, 0)


def test_listing_reads_no_contents_and_knows_seasons(spark, folder):
    src, lake = source(spark), Lake(folder())
    assert list_landed(spark, lake, folder("none")).isEmpty()
    runs.run(spark, lake, src, run_id="a")
    both = list_landed(spark, lake, folder("all"))
    one = list_landed(spark, lake, folder("one"), [uid(1, 0)])
    assert {r.season_id for r in both.collect()} == {uid(1, 0), uid(1, 1)}
    assert {r.season_id for r in one.collect()} == {uid(1, 0)}
    assert FileLedger(spark, lake).new_files(both).isEmpty()
    paths = {r.filename for r in read_silver(spark, lake, "classifications", filename=True).collect()}
    assert paths == {r.filename for r in both.collect()}


def test_changed_rows_count_repeats_and_nulls(spark):
    def t(rows):
        return spark.createDataFrame(rows, "k string, v string")
    old = t([("a", "1"), ("b", None), ("c", "1"), ("d", "x"), ("d", "x")])
    new = t([("a", "1"), ("b", None), ("c", "2"), ("d", "x"), ("e", None)])
    assert {r.k for r in changed_rows(new, old, ["k"]).collect()} == {"c", "d", "e"}


def test_staging_and_audit_are_one_job(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def tap(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(100).selectExpr("id", "IF(id = 7, NULL, id) AS year").mapInArrow(tap, "id long, year long")
    t = PublishedTable(spark, folder("t"))
    wap.write_audit_publish(t, df, ["id"])
    assert seen.value == 100 and t.read().count() == 100
    with pytest.raises(AuditError, match="1 NULL values in column year"):
        wap.write_audit_publish(t, df, ["id", "year"])
    assert seen.value == 200


def test_observed_counts_equal_a_scan(spark, folder):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, NULL, id) AS a", "IF(id < 5, NULL, id) AS b", "id AS c")
    audit = WriteAudit(["c", "a", "b"])
    audit.watch(df).write.parquet(folder("w"))
    assert audit.counts == {"_rows": 1000, "c": 0, "a": 334, "b": 5}
    for check in (audit.check, lambda: audit_nulls(df, ["c", "a", "b"])):
        with pytest.raises(AuditError) as e:
            check()
        assert (e.value.dimension, e.value.count) == ("a", 334)
    empty = WriteAudit(["c"])
    empty.watch(df.where("false")).write.parquet(folder("e"))
    assert empty.check() == 0


def test_older_compressed_files_of_other_events_are_not_read(spark, folder):
    src, lake = source(spark), Lake(folder())
    runs.run(spark, lake, src, runs.INCREMENTAL, n=6, run_id="a")  # events 1 and 2
    spoilt = 0
    for d, _, names in os.walk(local_path(lake.bronze("classifications"))):
        for n in names:
            if n.endswith(".csv.gz"):  # as long and as old as before, but unreadable
                p = os.path.join(d, n)
                at = os.stat(p)
                with open(p, "wb") as f:
                    f.write(b"\xff" * at.st_size)
                os.utime(p, ns=(at.st_atime_ns, at.st_mtime_ns))
                if os.path.exists(os.path.join(d, f".{n}.crc")):
                    os.remove(os.path.join(d, f".{n}.crc"))
                spoilt += 1
    assert spoilt
    rep = runs.run(spark, lake, src, runs.INCREMENTAL, n=6, run_id="b")  # events 3 and 4
    assert rep.gold.count() == 36
