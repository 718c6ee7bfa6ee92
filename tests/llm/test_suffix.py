import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest_llm import words

from tierline.llm import suffix_dedup as X


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k:k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        cover = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                cover[k:k + length] = True
        kept = np.frombuffer(b, np.uint8)[~cover].tobytes()
        runs = int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum())
        out.append((i, len(b), int(cover.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def case():
    rng = random.Random(6)
    rows = [(i, words(rng, rng.randrange(1, 60), 5000)) for i in range(60)]
    passage = words(rng, 14, 5000)  # longer than 60 bytes
    for i in range(40):
        a = rng.randrange(0, 30)
        rows.append((100 + i, words(rng, 8, 5000) + passage[a:a + rng.randrange(50, 80)] + words(rng, 8, 5000)))
    rows += [(300 + i, rows[i][1]) for i in range(20)] + [(400, "ab" * 300), (401, "Le " * 200), (402, "é" * 100),
             (403, None), (404, ""), (405, None), (406, "x" * 59), (407, "x" * 59), (408, "y" * 60), (409, "y" * 60),
             (3, rows[3][1]), (None, rows[5][1]), (410, "z" * 61)]
    rows += [(500, words(rng, 9000, 5000)), (501, rows[0][1] + "tail " + rows[1][1])]
    return rows


def got(df, **k):
    return sorted((tuple(r)[:5] for r in X.dedup(df, **k).collect()), key=str)


def test_against_brute_force(spark, docs_of):
    rows = case()
    df = docs_of(rows, clash=["row", "copy", "gram", "spans"])
    assert got(df, length=60, gram=15) == brute(rows, 60)


def test_ranges_and_stretches_do_not_matter(spark, docs_of, monkeypatch):
    rows = case()
    monkeypatch.setattr(X, "RANGE_BYTES", 2000)  # very many ranges: groups cross boundaries
    monkeypatch.setattr(X, "STRETCH", 300)
    assert got(docs_of(rows), length=60, gram=15) == brute(rows, 60)


def test_splits_may_change_between_jobs(spark, docs_of, monkeypatch):
    rows, stored, sizes = case(), X.saved, ["128m", "1k", "4k", "2k"]
    df, key = docs_of(rows), "spark.sql.files.maxPartitionBytes"

    def saved(df, name):
        out = stored(df, name)
        sizes.append(sizes.pop(0))
        spark.conf.set(key, sizes[0])
        return out
    monkeypatch.setattr(X, "saved", saved)
    before = spark.conf.get(key)
    try:
        assert got(df, length=60, gram=15) == brute(rows, 60)
    finally:
        spark.conf.set(key, before)


def test_production_length(spark, docs_of):
    rng = random.Random(9)
    p = words(rng, 90, 5000)
    rows = [(1, "a " + p + " b"), (2, p[30:470] + " c"), (3, p[5:404]), (4, p[:400])]
    out = {r.doc_id: r for r in X.op1_suffix_dedup(spark, docs_of(rows)).collect()}
    assert sorted((tuple(r)[:5] for r in out.values()), key=str) == brute(rows, 400)


def test_empty(spark, docs_of):
    assert X.op1_suffix_dedup(spark, docs_of([(1, "x")]).limit(0)).count() == 0


@pytest.mark.parametrize("alphabet", [2, 3, 200])
def test_multikey_order(alphabet):
    rng = np.random.default_rng(alphabet)
    c = rng.integers(0, alphabet, (3000, 6)).astype(np.uint64)
    order, shared = X.multikey_order(c)
    rows = [tuple(r) for r in c[order].tolist()]
    assert rows == sorted(rows)
    for i in range(1, len(rows)):
        same = next((k for k in range(6) if rows[i][k] != rows[i - 1][k]), 6)
        assert shared[i] == same
