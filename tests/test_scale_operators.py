"""Distributed first n, clustered layout, staged uniqueness, hierarchies."""

import random

import pytest
from pyspark.sql import functions as F

from tierline.functions.keynumbers import bucket_of, common_bytes, key_number
from tierline.operators.hierarchy import descendants
from tierline.operators.joins import duplicate_keys, duplicate_keys_staged
from tierline.operators.ordering import first_n
from tierline.operators.taskqueue import TaskQueue
from tierline.sinks.files import land_csv, session_conf
from tierline.streaming.new_files import ingest_new_files, queue_sink
from tierline.tables.clustered import rows_scanned, write_clustered


def strings(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id string").repartition(5)


def test_key_numbers_rise_with_strings(spark):
    r = random.Random(1)
    values = sorted({"p-" + "".join(r.choice("ab\x00é~Z0") for _ in range(r.randint(0, 12))) for _ in range(400)},
                    key=lambda s: s.encode())
    skip = common_bytes(values[0], values[-1])
    got = [x.n for x in spark.createDataFrame([(v,) for v in values], "id string").coalesce(1)
           .select(key_number("id", skip).alias("n")).collect()]
    assert got == sorted(got) and len(set(got)) > 300
    edges = [3, 5, 9, 12, 40]
    rows = spark.range(50).select("id", bucket_of(F.col("id"), edges).alias("b")).collect()
    assert all(x.b == sum(e <= x.id for e in edges) for x in rows)
    assert {x.b for x in spark.range(5).select(bucket_of(F.col("id"), []).alias("b")).collect()} == {0}


@pytest.mark.parametrize("n", [0, 1, 7, 499, 3000, 4999, 5000, 9000])
def test_first_n_of_many(spark, n):
    r = random.Random(2)
    values = [f"00000004-0000-0000-0000-{r.randrange(10**9):012d}" for _ in range(2000)] \
        + [f"x{i}" * 3 for i in range(2500)] + ["", "a", "a\x00", "é"] + [f"hot-prefix-{i:09d}" for i in range(496)]
    got = sorted(x.id for x in first_n(strings(spark, values), "id", n, interval=50).collect())
    assert got == sorted(sorted(values, key=lambda s: s.encode())[:n])


def test_first_n_with_one_hot_value_and_nulls(spark):
    values = ["m"] * 3000 + [f"a{i}" for i in range(40)] + [f"z{i}" for i in range(40)] + [None] * 5
    df = strings(spark, values)
    for n, want in ((30, {"a"}), (1000, {"a", "m"}), (3060, {"a", "m", "z"}), (3083, {"a", "m", "z", None})):
        got = [x.id for x in first_n(df, "id", n, interval=10).collect()]
        assert len(got) == n and {g and g[0] for g in got} == want


def test_a_large_batch_is_not_one_limit(spark):
    from tierline.operators import ordering
    df = strings(spark, [f"{i:07d}" for i in range(20_000)])
    out = first_n(df, "id", 15_000, interval=ordering.INTERVAL // 1000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=15000" not in plan and out.count() == 15_000


def test_lookups_skip_row_groups(spark, folder):
    """By session under 5 % of the rows, by the other key under 15 %."""
    df = spark.range(60_000).select(
        F.concat(F.lit("0000-0004-"), F.lpad((F.col("id") * 7919 % 12_000).cast("string"), 12, "0")).alias("session_id"),
        F.concat(F.lit("rider "), (F.col("id") * 31 % 997).cast("string")).alias("name"),
        F.col("id").cast("int").alias("points"), F.lit(None).cast("string").alias("note"))
    path = folder("z")
    write_clustered(df, path, ["session_id", "name"], bloom=["session_id"], group_bytes=16 << 10, bits=5)
    rows = spark.read.parquet(path)
    assert rows.count() == 60_000 and rows.exceptAll(df).isEmpty()
    for key, value, n, share in (("session_id", "0000-0004-000000001234", 5, 0.05), ("name", "rider 77", 61, 0.15),
                                 ("session_id", "0000-0004-0000000012345", 0, 0.05)):
        one = rows.filter(F.col(key) == value)
        assert one.count() == n or key == "name" and one.count() in (60, 61)
        assert rows_scanned(one) < share * 60_000
    empty = folder("e")
    write_clustered(df.where("false"), empty, ["session_id", "name"])
    assert spark.read.schema(df.schema).parquet(empty).count() == 0


def test_a_hot_key_goes_to_several_files(spark, folder):
    import glob

    from tierline.session import local_path
    from tierline.sinks.files import session_conf
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
                                    .alias("session_id"), F.col("id").alias("v"))
    path = folder("hot")
    with session_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        write_clustered(df, path, ["session_id"])
    hot = [f for f in glob.glob(local_path(path) + "/*.parquet")
           if spark.read.parquet(f).filter("session_id = 'hot'").count()]
    assert len(hot) > 1 and spark.read.parquet(path).count() == 30_000


def test_staged_uniqueness_equals_grouping(spark):
    rows = [(i % 900, f"k{i % 1100}") for i in range(1500)] + [(None, "a"), (None, "a"), (1, None), (1, None)]
    df = spark.createDataFrame(rows, "a int, b string")
    for keys in (["a", "b"], ["b"], ["a"]):
        want = sorted(map(tuple, duplicate_keys(df, keys).collect()), key=str)
        assert sorted(map(tuple, duplicate_keys_staged(df, keys).collect()), key=str) == want != []
    assert duplicate_keys_staged(df.where("false"), ["a"]).count() == 0


def test_descendants_of_graphs_with_cycles(spark):
    r = random.Random(5)
    edges = [(r.randrange(30), r.randrange(30)) for _ in range(45)] + [(None, 1), (1, None), (3, 3)] * 2
    roots = [0, 5, 7, 99, 5, None]
    want = set()
    for root in {x for x in roots if x is not None}:
        seen, level, depth = {root}, {root}, 0
        while level:
            want |= {(root, n, depth) for n in level}
            level = {c for p, c in edges if p in level and c is not None} - seen
            seen |= level
            depth += 1
    got = descendants(spark.createDataFrame(edges, "parent int, child int"),
                      spark.createDataFrame([(x,) for x in roots], "root int"))
    assert {tuple(x) for x in got.collect()} == want and got.count() == len(want)
    none = spark.createDataFrame([], "root int")
    assert descendants(spark.createDataFrame(edges, "parent int, child int"), none).count() == 0


def test_repeats_in_a_stream_end_in_its_state_or_in_the_queue(spark, folder):
    schema = "name string, id string, season_id string, event_id string, category_id string, seen_at timestamp"
    landing, ckpt, batches = folder("in"), folder("ckpt"), []
    queue = TaskQueue(spark, folder("queue"))
    into = queue_sink(queue)

    def sink(df, batch_id):
        batches.append(sorted(x.id for x in df.collect()))
        into(df, batch_id)
    waves = [[("1", "01"), ("2", "01")], [("2", "01"), ("3", "02")], [("1", "20"), ("4", "20")], [("2", "20"), ("5", "01")]]
    for wave in waves:
        rows = spark.createDataFrame([("n", i, "s", "e", "c", d) for i, d in wave], schema.replace("timestamp", "string"))
        land_csv(rows.withColumn("seen_at", F.to_timestamp(F.concat(F.lit("2024-01-"), "seen_at"))), landing, mode="append")
        ingest_new_files(spark, landing, spark.createDataFrame([], schema).schema, ckpt, sink,
                         once=("id", "seen_at", "2 days"))
    taken = [b for b in batches if b]
    # "2" is dropped the second time; "1" comes again after its state was given up; "5" is too late.
    assert taken[:2] == [["1", "2"], ["3"]] and "2" not in taken[1]
    assert sorted(x.id for x in queue.state().collect())[:4] == ["1", "2", "3", "4"]
    assert queue.state().groupBy("id").count().where("count > 1").isEmpty()


def test_children_of_few_keys_are_not_moved_to_find_childless_requests(spark):
    from tierline.operators.crawl import missing_children

    req = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    kids = spark.range(5000).select(F.when(F.col("id") % 2 == 0, "a").alias("k"))
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        out = missing_children(req, kids, ["k"])
        assert sorted(r.k or "" for r in out.collect()) == ["", "b"]
        moved = out._jdf.queryExecution().executedPlan().toString().split("Exchange")[-1]
    assert "HashAggregate" in moved  # below the last exchange, that of the children
