"""Runs: restart after death, task numbers, findings, sources, sorting."""

import pytest
from pyspark.sql import functions as F

from tierline.operators.ordering import rank_desc, sort_desc
from tierline.operators.taskqueue import TaskQueue, without_clocks
from tierline.plans import runs
from tierline.plans.lake import Lake, read_bronze
from tierline.schemas import (CATEGORIES, CLASSIFICATIONS, COMPLETED, ERRORED, EVENTS, SEASONS,
                              SESSIONS)
from tierline.sources.entities import (EntitySource, land_payload_entities, payload_entities,
                                       table_entities)


def uid(kind, n):
    return f"{kind:08d}-0000-0000-0000-{n:012d}"


def source(spark, n_sessions=6, position=1):
    """Two seasons, one event and category each; session 0 has no rows."""
    s, e, c = [uid(1, i) for i in range(2)], [uid(2, i) for i in range(2)], uid(3, 0)
    sessions = [("R", uid(4, i), s[i % 2], e[i % 2], c) for i in range(n_sessions)]
    rows = [(s[i % 2], e[i % 2], c, uid(4, i), f"r{i}{k}", 1, position, 25)
            for i in range(1, n_sessions) for k in range(2)]
    return EntitySource(
        spark.createDataFrame([(s[0], 2001), (s[1], 2002)], SEASONS),
        spark.createDataFrame([("A", "AAA", e[0], s[0]), ("B", "BBB", e[1], s[1])], EVENTS),
        spark.createDataFrame([("C", c, s[0], e[0]), ("C", c, s[1], e[1])], CATEGORIES),
        spark.createDataFrame(sessions, SESSIONS),
        spark.createDataFrame(rows, CLASSIFICATIONS))


def rows_of(df):
    return sorted(map(tuple, df.collect()))


DEATHS = [(step, False) for step in ("land_classifications", "request_log", "load_silver",
                                     "partials_of_new", "build_gold", "apply_run", "_store_metrics")] \
    + [("land_classifications", True), ("build_gold", True)]


@pytest.fixture(scope="module")
def clean_gold(spark, tmp_path_factory):
    return rows_of(runs.run(spark, Lake(str(tmp_path_factory.mktemp("clean"))), source(spark), run_id="r").gold)


@pytest.mark.parametrize("at,after", DEATHS)
def test_a_run_that_died_anywhere_can_be_repeated(spark, folder, monkeypatch, clean_gold, at, after):
    src, lake, step = source(spark), Lake(folder("died")), getattr(runs, at)

    def dies(*args, **kwargs):
        if after:
            step(*args, **kwargs)
        raise InterruptedError(at)
    monkeypatch.setattr(runs, at, dies)
    with pytest.raises(InterruptedError):
        runs.run(spark, lake, src, run_id="one")
    monkeypatch.setattr(runs, at, step)
    assert rows_of(runs.run(spark, lake, src, run_id="two").gold) == clean_gold
    status = {r.id: r.status for r in without_clocks(TaskQueue(spark, lake.table("tasks")).state()).collect()}
    assert status == {uid(4, 0): ERRORED, **{uid(4, i): COMPLETED for i in range(1, 6)}}


def test_an_incremental_run_that_died_before_silver_is_made_up_for(spark, folder, monkeypatch):
    src, lake = source(spark, 12), Lake(folder())
    step = runs.load_silver
    monkeypatch.setattr(runs, "load_silver", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        runs.run(spark, lake, src, runs.INCREMENTAL, n=2, run_id="one")
    monkeypatch.setattr(runs, "load_silver", step)
    gold = runs.run(spark, lake, src, runs.INCREMENTAL, n=2, run_id="two").gold
    # Latest season, sessions 1, 3 (landed by the dead run), 5, 7.
    assert sorted({r.rider_name for r in gold.collect()}) == sorted(f"r{i}{k}" for i in (1, 3, 5, 7) for k in (0, 1))


@pytest.mark.parametrize("mode,n", [(runs.INCREMENTAL, None), (runs.INCREMENTAL, 0), (runs.INCREMENTAL, -1),
                                    (runs.FULL, 0)])
def test_task_numbers_below_one_are_rejected(spark, folder, mode, n):
    with pytest.raises(ValueError):
        runs.run(spark, Lake(folder()), source(spark), mode, n=n)


def test_a_full_run_takes_every_task_or_as_many_as_asked(spark, folder):
    src = source(spark, 40)
    assert runs.run(spark, Lake(folder("all")), src).gold.count() == 78
    lake = Lake(folder("some"))
    assert runs.run(spark, lake, src, n=10, run_id="a").gold.count() == 18  # ids 0..9, 0 is empty
    assert runs.run(spark, lake, src, run_id="b").gold.count() == 78


def test_data_quality_covers_all_of_silver(spark, folder):
    clean = Lake(folder("clean"))
    rep = runs.run(spark, clean, source(spark), run_id="r")
    assert rep.dq_alert is False and rep.gold.count() == 10
    lake = Lake(folder("nulls"))
    assert runs.run(spark, lake, source(spark, position=None), n=3, run_id="a").dq_alert
    # The second run lands rows without a finding; the first run's stay in silver.
    rep = runs.run(spark, lake, source(spark), run_id="b")
    found = spark.read.json(lake.logs("data_quality/run_id=b")).collect()
    assert rep.dq_alert and all("run_id=a" in r.filename for r in found)


def test_a_repeated_session_stops_gold(spark, folder):
    src = source(spark)
    src.sessions = src.sessions.unionByName(src.sessions.limit(1))
    from tierline.operators.joins import DuplicateKeyError
    with pytest.raises(DuplicateKeyError, match="sessions"):
        runs.transform(spark, Lake(folder()), src)


def test_transform_and_full_share_a_lake(spark, folder):
    src = source(spark)
    lake = Lake(folder())
    want = rows_of(runs.transform(spark, lake, src))
    assert rows_of(runs.run(spark, lake, src, run_id="r").gold) == want
    assert rows_of(runs.transform(spark, lake, src)) == want
    assert read_bronze(spark, lake, "classifications").count() == len(want)


def test_each_source_is_read_once_by_a_run(spark, folder):
    src, reads = source(spark), {}

    def counted(name, df):
        seen = spark.sparkContext.accumulator(0)
        reads[name] = (seen, df.count())

        def tap(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return df.mapInArrow(tap, df.schema)
    tapped = EntitySource(src.seasons, *[counted(n, src.entity(n)) for n in
                                         ("events", "categories", "sessions", "classifications")])
    runs.run(spark, Lake(folder()), tapped, run_id="r")
    assert {n: a.value for n, (a, _) in reads.items()} == {n: c for n, (_, c) in reads.items()}


def test_sources_from_tables_and_payloads(spark, folder):
    src, root = source(spark), folder("src")
    want = rows_of(runs.transform(spark, Lake(folder("a")), src))
    for name in ("seasons", "events", "categories", "sessions", "classifications"):
        df = src.entity(name)
        df.withColumn("more", F.lit(1)).select("more", *df.columns[::-1]).write.parquet(f"{root}/{name}.parquet")
    assert rows_of(runs.transform(spark, Lake(folder("b")), table_entities(spark, root))) == want
    land_payload_entities(src, root + "/payloads", page_rows=2)
    assert rows_of(runs.transform(spark, Lake(folder("c")), payload_entities(spark, root + "/payloads"))) == want


def test_no_error_set_of_the_registered_log_is_empty(spark):
    import os

    from tierline.checks.env import env
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("driver tables not present")
    failed = env(spark, "/root/testdata/sf0.001").failed
    assert set(failed) == {"seasons", "events", "pairs", "sessions"}
    assert all(df.count() > 0 for df in failed.values())


def test_global_sort_and_rank(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 701).alias("v"), "id").repartition(7)
    got = [(r.v, r.id) for r in sort_desc(df, "v", "id").collect()]
    assert got == sorted(got, key=lambda x: (-x[0], x[1]))
    ranks = {r.v: r["rank"] for r in rank_desc(df, "v").collect()}
    values = sorted((v for v, _ in got), reverse=True)
    assert ranks == {v: values.index(v) + 1 for v in set(values)}


def test_gold_has_a_namespace(spark, folder):
    lake = Lake(folder())
    rep = runs.run(spark, lake, source(spark), run_id="r")
    table = spark.table(f"{lake.gold_db}.results")
    assert table.count() == rep.gold.count()
    where = spark.sql(f"DESCRIBE DATABASE {lake.gold_db}").collect()
    assert any(lake.root.removeprefix("file:") in str(r) for r in where)
