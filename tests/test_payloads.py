"""JSON payloads: explode, shape, stamp, paging (Q1, Q2, Q14)."""

import os

from pyspark.sql import functions as F

from tierline.operators.crawl import shape
from tierline.operators.lookup import explode_payload, response_payloads
from tierline.schemas import S, struct

ELEM = struct(("name", S), ("id", S))


def test_empty_and_null_payloads_give_no_rows_and_one_child_gives_one(spark):
    df = spark.createDataFrame(
        [("p0", "[]"), ("p1", None), ("p2", '[{"name": "only", "id": "c1"}]')],
        "parent string, body string")
    rows = explode_payload(df, "body", ELEM, keep=["parent"]).collect()
    assert [(r.parent, r.name, r.id) for r in rows] == [("p2", "only", "c1")]


def test_short_name_is_used_when_sent(spark):
    df = spark.createDataFrame([("Qatar", "QAT", None, "e1"), ("Spain", None, "SPA", "e2")],
                               "name string, short_name string, sname string, id string")
    got = {r.id: r.sname for r in shape(df, keep=["id", "sname"]).collect()}
    assert got == {"e1": "QAT", "e2": "SPA"}


def test_payloads_keep_nulls_and_give_empty_array_for_childless_keys(spark):
    req = spark.createDataFrame([("a",), ("b",)], "k string")
    kids = spark.createDataFrame([("a", "x", None)], "k string, name string, number int")
    out = {r.k: (r.page, r.body) for r in
           response_payloads(req, kids, ["k"], ["name", "number"]).collect()}
    assert out == {"a": (0, '[{"name":"x","number":null}]'), "b": (0, "[]")}


def test_pages_are_cut_in_order_for_every_key(spark):
    req = spark.createDataFrame([("hot",), ("cold",)], "k string")
    kids = spark.range(100).select(F.when(F.col("id") < 95, "hot").otherwise("cold").alias("k"),
                                   F.lpad(F.col("id").cast("string"), 3, "0").alias("id"))
    pages = response_payloads(req, kids, ["k"], ["id"], page_rows=10)
    back = explode_payload(pages, "body", struct(("id", S)), keep=["k", "page"]).collect()
    assert sorted((r.k, r.page, r.id) for r in back) == sorted(
        ("hot", i // 10, f"{i:03d}") if i < 95 else ("cold", 0, f"{i:03d}") for i in range(100))


def test_very_many_equal_children_are_spread_over_pages(spark):
    req = spark.createDataFrame([("a",)], "k string")
    kids = spark.range(100_000).select(F.lit("a").alias("k"), F.lit("same").alias("id")) \
        .unionByName(spark.createDataFrame([("a", "zz"), ("a", None)], "k string, id string"))
    pages = response_payloads(req, kids, ["k"], ["id"], page_rows=1000)
    sizes = {r.page: r.n for r in explode_payload(pages, "body", struct(("id", S)), keep=["page"])
             .groupBy("page").agg(F.count("*").alias("n")).collect()}
    assert sizes == {**{p: 1000 for p in range(100)}, 100: 2}


def test_raw_payload_files_round_trip(spark, folder):
    from tierline.sinks.files import land_payloads
    from tierline.sources.files import read_payloads

    path = folder()
    df = spark.createDataFrame([("2023", '[{"name": "a", "id": "1"}]'), ("2024", "[]")],
                               "season_id string, body string")
    land_payloads(df, path, ["season_id"])
    back = read_payloads(spark, path, ["season_id"])
    assert dict(back.dtypes)["season_id"] == "string"
    rows = explode_payload(back, "body", ELEM, keep=["season_id"]).collect()
    assert [(r.season_id, r.name, r.id) for r in rows] == [("2023", "a", "1")]


def test_pages_do_not_depend_on_how_they_are_made(spark):
    """Keys that fit a page and keys that do not, null keys, null fields and
    repeated rows: the pages of every size put together are the same rows."""
    req = spark.createDataFrame([("a",), ("b",), ("none",)], "k string")
    kids = spark.range(90).select(
        F.when(F.col("id") < 60, "a").when(F.col("id") < 85, "b").alias("k"),
        F.when(F.col("id") % 7 != 0, F.lpad((F.col("id") % 20).cast("string"), 2, "0")).alias("id"),
        F.when(F.col("id") % 3 != 0, F.col("id").cast("int") % 5).alias("n"))
    one = {r.k: r.body for r in response_payloads(req, kids, ["k"], ["id", "n"], page_rows=100).collect()}
    for size in (1, 7, 25, 26, 60):
        got = response_payloads(req, kids, ["k"], ["id", "n"], page_rows=size).orderBy("k", "page").collect()
        assert all(r.body.count("{") <= size for r in got)
        joined = {}
        for r in got:
            joined[r.k] = joined.get(r.k, []) + ([r.body[1:-1]] if r.body != "[]" else [])
        assert {k: "[" + ",".join(v) + "]" for k, v in joined.items()} == one


def test_keys_beyond_a_page_are_paged_in_one_array_and_larger_ones_alike(spark):
    req = spark.createDataFrame([("a",), ("b",), ("none",)], "k string")
    kids = spark.range(90).select(F.when(F.col("id") < 60, "a").when(F.col("id") < 85, "b").alias("k"),
                                  F.when(F.col("id") % 7 != 0, F.col("id") % 20).alias("id"))
    arrays = response_payloads(req, kids, ["k"], ["id"], page_rows=3)
    # No ordering over all rows: a key's rows are moved once.
    plan = arrays._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("posexplode") == 1
    totals = response_payloads(req, kids, ["k"], ["id"], page_rows=3, array_rows=3)
    mixed = response_payloads(req, kids, ["k"], ["id"], page_rows=3, array_rows=30)
    assert sorted(arrays.collect()) == sorted(totals.collect()) == sorted(mixed.collect())


def test_landed_payloads_are_stored_compressed(spark, folder):
    from tierline.session import local_path
    from tierline.sinks.files import append_json, append_text, land_payloads

    df = spark.createDataFrame([("2023", "[]"), ("2024", None)], "season_id string, body string")
    for write in (lambda p: land_payloads(df.filter("body IS NOT NULL"), p, ["season_id"]),
                  lambda p: append_text(df.select("season_id"), p), lambda p: append_json(df, p)):
        path = folder()
        write(path)
        names = [n for _, _, files in os.walk(local_path(path)) for n in files if n.startswith("part-")]
        assert names and all(n.endswith(".gz") for n in names)
