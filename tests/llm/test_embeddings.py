import numpy as np
import pytest

from tierline.llm import embed_dedup as X


def brute(rows, cosine=0.9):
    vec = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        vec.append(np.array(v, np.float32).astype(float) if ok else None)
    n = len(rows)
    links, up = [0] * n, list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(n):
        for b in range(n):
            if a != b and vec[a] is not None and vec[b] is not None and len(vec[a]) == len(vec[b]):
                if vec[a] @ vec[b] / np.sqrt((vec[a] @ vec[a]) * (vec[b] @ vec[b])) >= cosine:
                    links[a] += 1
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    low = {}
    for a in range(n):
        low[find(a)] = min(low.get(find(a), rows[a][0]), rows[a][0])
    return sorted((rows[a][0], links[a], low[find(a)], low[find(a)] == rows[a][0]) for a in range(n))


def case(seed=1, groups=60, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        c = rng.normal(size=dim)
        for _ in range(rng.integers(1, 12)):
            rows.append((c + rng.normal(size=dim) * rng.choice([0.05, 0.2, 0.35])).tolist())
    rows = list(enumerate(rows))
    rows += [(2000, rows[3][1]), (2001, rows[3][1]), (2002, (np.array(rows[3][1]) * 1e-20).tolist()),
             (2003, None), (2004, []), (2005, [0.0] * dim), (2006, [float("nan")] + [1.0] * (dim - 1)),
             (2007, [None] + [1.0] * (dim - 1)), (2008, [float("inf")] * dim), (2009, [1.0, 2.0]), (2010, [2.0, 4.0])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, node string")


def test_against_brute_force(spark):
    rows = case()
    out = X.op6_embedding_dedup(spark, frame(spark, rows)).collect()
    assert sorted(map(tuple, out)) == brute(rows)


def test_recall_over_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(X, "SHARD", 60)
    monkeypatch.setattr(X, "BLOCK", 50)
    rows = case(seed=2, groups=120)
    got = sorted(map(tuple, X.op6_embedding_dedup(spark, frame(spark, rows)).collect()))
    want = brute(rows)
    assert all(g[1] <= w[1] for g, w in zip(got, want))  # no link below the threshold
    assert sum(g[1] for g in got) >= 0.95 * sum(w[1] for w in want)


def test_audit_measures_recall(spark):
    rows = case(seed=3, groups=20)
    nodes = X.nodes_of(frame(spark, rows))
    found = X._round(nodes, X._centers(nodes), 2, 0.9)
    assert X.audit(nodes, found) > 0.99
    assert X.audit(nodes, found.withColumn("links", found.links * 0)) < 0.5


def test_low_recall_ends_in_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(X, "BLOCK", 50)
    monkeypatch.setattr(X, "ROUNDS", 1)
    monkeypatch.setattr(X, "range_search", lambda x, adj, q, cosine, beam: np.zeros((len(q), len(x)), bool))
    rows = case(seed=4, groups=20)
    assert sorted(map(tuple, X.op6_embedding_dedup(spark, frame(spark, rows)).collect())) == brute(rows)


def test_audit_is_not_ruled_by_a_large_group(spark):
    nodes = spark.createDataFrame([(1, 2, 1000, [1.0, 0.0]), (2, 2, 1000, [1.0, 0.01]), (3, 2, 1, [0.0, 1.0]),
                                   (4, 2, 1, [0.01, 1.0])], "node long, dim int, n long, vector array<double>")
    found = spark.createDataFrame([(1, 1000), (2, 1000)], "node long, links long")
    assert X.audit(nodes, found) == 0.5


def test_empty_and_null_ids(spark):
    df = frame(spark, [(None, [1.0, 0.0]), (5, [1.0, 0.01]), (None, None)])
    out = sorted(map(tuple, X.op6_embedding_dedup(spark, df).collect()), key=str)
    assert out == sorted([(None, 1, 5, True), (5, 1, 5, True), (None, 0, None, True)], key=str)
    assert X.op6_embedding_dedup(spark, df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 700])
def test_graph_search_finds_the_range(n):
    rng = np.random.default_rng(n)
    x = X._unit(np.repeat(rng.normal(size=(max(1, n // 5), 24)), 5, axis=0)[:n] + 0.1 * rng.normal(size=(n, 24)))
    met = X.range_search(x, X.robust_graph(x), x, 0.9, 32)
    want = x @ x.T >= 0.9
    assert (met & want).sum() >= 0.97 * want.sum()


def test_least_reachable_against_union_find():
    rng = np.random.default_rng(4)
    for n, m in ((1, 0), (2, 1), (50, 10), (300, 250), (300, 2000)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        up = list(range(n))

        def find(i, up=up):
            while up[i] != i:
                i = up[i]
            return i
        for i, j in zip(a.tolist(), b.tolist()):
            i, j = find(i), find(j)
            up[max(i, j)] = min(i, j)
        assert X._least_reachable(n, a, b).tolist() == [find(i) for i in range(n)]
    chain = np.arange(9999)
    assert not X._least_reachable(10_000, chain + 1, chain).any()


def test_lowest_common_shard():
    rng = np.random.default_rng(5)
    a = np.array([np.sort(rng.choice(9, 4, False)) for _ in range(500)])
    b = np.array([np.sort(rng.choice(9, 4, False)) for _ in range(500)])
    want = [min(set(x) & set(y), default=np.iinfo(np.int64).max) for x, y in zip(a.tolist(), b.tolist())]
    assert X._lowest_common(a, b).tolist() == want
