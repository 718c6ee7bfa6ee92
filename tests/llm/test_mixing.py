import duckdb
import pytest

from tierline.llm import mixing as M


def run_sql(df, sql):
    con = duckdb.connect()
    documents = df.toPandas().astype({"doc_id": "Int64"})  # noqa: F841
    con.execute("CREATE TABLE documents AS SELECT * REPLACE (CAST(doc_id AS BIGINT) AS doc_id) FROM documents")
    return sorted(con.execute(sql).fetchall(), key=str)


def rows(n=3000):
    out = []
    for i in range(n):
        src = ["big", "big", "big", "mid", "tiny", None, "é", "Z"][i % 8]
        if src == "tiny" and i > 400:
            src = "big"
        out.append((i, "w " * (1 + (i * 7919) % 300), src))
    return out + [(9001, None, "mid"), (9002, "", None), (9003, " \t\n", "void"), (9004, "x" * 100_000, "mid")]


def test_against_sql_and_targets(spark, docs_of):
    df = docs_of(rows(), clash=["size", "target", "u", "g"])
    out = M.op10_mixing(spark, df)
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == run_sql(df.select("doc_id", "text", "source"), M.OP10_SQL)
    assert got == sorted(map(tuple, M.op10_mixing(spark, df).collect()), key=str)
    total = sum(r[1] for r in got)
    by = {}
    for r in got:
        assert r[4] <= 2 * r[1]
        by.setdefault((r[2], r[3]), [0, 0])
        by[(r[2], r[3])][0] += r[4]
    assert abs(sum(t for _, t in by) - 1.5 * total) < 1e-6 * total
    for (size, target), (taken, _) in by.items():
        assert target <= 2 * size and abs(taken - target) <= 300


def test_weights_and_caps_by_hand(spark, docs_of):
    # Words: a 100, b 1000, c 400; weights 3, 1, 2; mix of 2250.
    df = docs_of([(i, "w " * 10, "a") for i in range(10)] + [(100 + i, "w " * 10, "b") for i in range(100)]
                 + [(300 + i, "w " * 10, "c") for i in range(40)])
    got = {r.source: r.target for r in M.allocate(df).select("source", "target").distinct().collect()}
    # a stops at 200; b and c share 2050 by 1:2, c stops at 800, b takes 1250.
    assert got == {"a": 200.0, "b": 1250.0, "c": 800.0}


def test_mixed_rows_repeat_as_taken(spark, docs_of):
    df = docs_of(rows(800), clash=["copies"])
    out = M.mixed(df)
    assert out.columns == df.columns
    want = {r.doc_id: r.copies for r in M.allocate(df).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == want


def test_native_plan(spark, docs_of):
    plan = M.op10_mixing(spark, docs_of(rows(100)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("data", [[], [(1, None, None)], [(1, "", "a"), (2, "", "b")]])
def test_nothing_to_mix(spark, docs_of, data):
    df = docs_of(data or [(1, "x")])
    if not data:
        df = df.limit(0)
    assert [r.taken for r in M.op10_mixing(spark, df).collect()] == [0] * len(data)


def test_ties(spark, docs_of):
    df = docs_of([(1, "a b c", "s")] * 4 + [(2, "a b", "s")])
    out = M.op10_mixing(spark, df).collect()
    assert len({r.taken for r in out if r.doc_id == 1}) == 1


def test_one_task_orders_few_rows_of_a_hot_source(spark, docs_of):
    from pyspark.sql import functions as F
    docs = docs_of([(1, "x")]).drop("doc_id", "text").crossJoin(
        spark.range(40_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), F.lit(3)).alias("text")))
    sizes = M._measured(docs)
    src = M.source_targets(sizes).first()
    assert src.docs == 40_000 and src.target == 1.5 * src.source_size
    # Odds of a document at the cut are near 1; an interval there is 1/200 of them at most.
    pi = 0.5
    q = (F.col("u") / (1 - F.col("u"))) / (pi / (1 - pi))
    held = sizes.groupBy(F.floor(q / (1 + q) * 200).alias("b")).count().agg(F.max("count"), F.count("*")).first()
    assert held[0] < 400 and held[1] <= 200
    got = M.allocate(docs)
    assert got.agg(F.sum(F.col("size") * F.col("copies"))).first()[0] == 1.5 * src.source_size


def test_repeated_ids_are_judged_by_their_own_size(spark, docs_of):
    # Rows that share an id and a source but not a size, nulls among them.
    df = docs_of([(i % 400 if i % 9 else None, "w " * (1 + i % 37), "ab"[i % 2]) for i in range(1500)])
    from collections import Counter
    want = Counter()
    for r in M.allocate(df).collect():
        want[(r.doc_id, r.source, r["size"])] += r.copies
    got = Counter((r.doc_id, r.source, len(r.text.split())) for r in M.mixed(df).collect())
    assert got == +want


def test_documents_are_not_shuffled(spark, docs_of):
    # Sources come by broadcast: neither sizes nor texts have an exchange.
    df = docs_of(rows(400))
    for out in (M.op10_mixing(spark, df), M.mixed(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
