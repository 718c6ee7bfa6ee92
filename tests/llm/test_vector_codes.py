import hashlib
import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierline.llm import vector_codes as V


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 300), st.sampled_from([2, 4, 30, 900]))
def test_tree_finds_the_nearest_entry(seed, n, spread):
    r = np.random.default_rng(seed)
    dims = int(r.integers(1, 9))
    entries = r.integers(-spread, spread, (n, dims)).astype(np.float64)
    queries = r.integers(-spread, spread, (70, dims)).astype(np.float64)
    index, best = V.Gnat(entries, 5).nearest(queries)
    d = ((queries[:, None, :] - entries[None]) ** 2).sum(2).astype(np.int64)
    assert index.tolist() == d.argmin(1).tolist() and best.tolist() == d.min(1).tolist()


def test_tree_leaves_entries_out():
    r = np.random.default_rng(1)
    centers = r.integers(-4000, 4000, (32, 16))
    entries = (np.repeat(centers, 8, 0) + r.integers(-20, 20, (256, 16))).astype(np.float64)
    tree = V.Gnat(entries)
    tree.nearest(entries + 1.0)
    assert tree.compared < 256 * 256 / 2


@given(st.lists(st.integers(0, 2**62 - 1), min_size=1))
def test_roots(x):
    a = np.array(x, np.int64)
    assert V._root_below(a).tolist() == [math.isqrt(v) for v in x]
    assert V._root_above(a).tolist() == [math.isqrt(v - 1) + 1 if v else 0 for v in x]


def brute(rows, dims):
    kept = [(i, [math.floor(1024 * np.float64(x)) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = dims // 4
    book = [[k[1][p * w:p * w + w] for k in kept[:256]] for p in range(4)]

    def near(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book[p]))
    for _ in range(4):
        groups = [{} for _ in range(4)]
        for _, v, _ in kept:
            for p in range(4):
                x = v[p * w:p * w + w]
                groups[p].setdefault(near(p, x)[1], []).append(x)
        for p in range(4):
            for e, xs in groups[p].items():
                book[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    out, by = [], {}
    for i, v, lab in kept:
        got = [near(p, v[p * w:p * w + w]) for p in range(4)]
        err = sum(d for d, _ in got)
        by[lab] = by.get(lab, 0) + err
        out.append([i, "".join(f"{e:02x}" for _, e in got), err, lab])
    sha = hashlib.sha256(",".join(str(x) for b in book for e in b for x in e).encode()).hexdigest()
    return sorted([(i, c, e, by[lab], sha) for i, c, e, lab in out], key=str)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, error int, part int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


def some(n, dims=8, seed=2):
    r = np.random.default_rng(seed)
    c = r.normal(size=(9, dims))
    rows = [(int(i * 7 % 1009), (c[i % 9] + 0.2 * r.normal(size=dims)).astype(np.float32).tolist(),
             None if i % 5 == 0 else int(i % 3)) for i in range(n)]
    return rows + [(5000, None, 1), (5001, [None] * dims, 1), (5002, [float("nan")] * dims, 2),
                   (5003, [float("inf")] + [0.0] * (dims - 1), 2), (5004, [0.0] * dims, 7), (5004, [0.0] * dims, 7)]


@pytest.mark.parametrize("n", [0, 3, 400])
def test_against_brute_force_and_sql(spark, n):
    rows = some(n)
    df = table(spark, rows)
    got = sorted(map(tuple, V.op12_vector_codes(spark, df).collect()), key=str)
    assert got == brute(rows, 8)
    con = duckdb.connect()
    embeddings = df.select("vec_id", "embedding", "label").toArrow()  # noqa: F841
    assert sorted(con.execute(V.OP12_SQL).fetchall(), key=str) == got


def test_empty_null_ids_and_errors(spark):
    assert V.op12_vector_codes(spark, spark.createDataFrame([], SCHEMA)).count() == 0
    only = spark.createDataFrame([(1, None, 1, "x", 1, 2)], SCHEMA)
    assert V.op12_vector_codes(spark, only).count() == 0
    df = spark.createDataFrame([(None, [1.0] * 4, None, "x", 1, 2), (3, [1.0] * 4, None, "x", 1, 2)], SCHEMA)
    assert [r.error for r in V.op12_vector_codes(spark, df).collect()] == [0, 0]
    for bad in ([1.0] * 6, [1e30] * 4):
        with pytest.raises(Exception, match="equal parts|too large"):
            V.op12_vector_codes(spark, spark.createDataFrame([(1, bad, 1, "x", 1, 2)], SCHEMA)).collect()


def test_codes_decode_near_the_vector(spark):
    df = table(spark, some(400))
    books = V.codebooks(df)
    rows = V.decoded(V.encoded(df, books), books).join(df.select("vec_id", "embedding"), "vec_id").collect()
    off = [np.linalg.norm(np.array(r.approx) - np.array(r.embedding)) for r in rows if r.vec_id < 5000]
    assert len(rows) >= 400 and np.median(off) < 1.0
