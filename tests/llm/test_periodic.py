import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tierline.llm import periodic as P


def brute_runs(w, min_words=P.MIN_WORDS):
    """Every maximal stretch per period, by comparing all places."""
    by_extent = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            if i - a >= 2 * q and i + q - a >= min_words:
                by_extent.setdefault((a, i + q), q)
    return sorted((a, b - a, q) for (a, b), q in by_extent.items())


def found(docs, min_words=P.MIN_WORDS):
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    codes = np.array([x for d in docs for x in d], np.int64)
    rows = P.runs_of(codes, first, min_words).tolist()
    return [[tuple(r[1:]) for r in rows if r[0] == d] for d in range(len(docs))]


def words_of(seed):
    """Words with nested and neighbouring repeats at many periods."""
    r = random.Random(seed)
    w = []
    for _ in range(r.randint(1, 6)):
        unit = [r.randrange(r.choice([1, 2, 3, 40])) for _ in range(r.randint(1, 60))]
        if r.random() < 0.5:
            unit = unit * r.randint(2, 6) + [r.randrange(3)]
        w += (unit * 9)[:r.randint(1, 9 * len(unit))]
        w += [r.randrange(50) for _ in range(r.randint(0, 30))]
    return w[:1500]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**9))
def test_runs_against_all_places(seed):
    docs = [words_of(seed + i) for i in range(3)] + [[], [1], [2] * 23, [2] * 24]
    assert found(docs) == [brute_runs(d) for d in docs]
    assert found(docs, 0) == [brute_runs(d, 0) for d in docs]


def test_long_and_structured_words():
    fib = "a"
    prev = "b"
    while len(fib) < 3000:
        fib, prev = fib + prev, fib
    thue = [bin(i).count("1") % 2 for i in range(2048)]
    docs = [[ord(c) for c in fib[:2000]], thue * 3, list(range(900)) * 4, [7] * 5000]
    want = [brute_runs(d) for d in docs[:3]] + [[(0, 5000, 1)]]
    assert found(docs) == want


def brute_row(doc_id, text):
    w = [x for x in (text or "").encode().split()]
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            sha("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()),
            sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_against_brute_force(spark, docs_of):
    r = random.Random(3)
    rows = [(i, " ".join(f"w{x}é" for x in words_of(i)[:400])) for i in range(120)]
    rows += [(1000 + i, "\t ".join(r.choice("abcdefgh") * 3 for _ in range(r.randint(1, 90)))) for i in range(60)]
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "one\x0bmore\x0cword " * 12), (None, "no id " * 20),
             (2004, "x" * 200_000), (2005, "a b c " * 9000), (2003, "one\x0bmore\x0cword " * 12)]
    df = docs_of(rows, clash=["runs", "start", "h", "w", "n", "a", "p"])
    got = P.op13_periodic_runs(spark, df)
    assert sorted(map(tuple, got.collect()), key=str) == sorted((brute_row(*r) for r in rows), key=str)


def test_texts_and_string_ids(spark):
    rows = [("x", "go " * 30 + "stop"), ("y", None), (None, "a b " * 12)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: r for r in P.collapse_runs(df).collect()}
    assert got["x"].collapsed == "go stop" and [tuple(r) for r in got["x"].runs] == [(0, 30, 1)]
    assert got["y"].collapsed == "" and got["y"].runs == []
    assert got[None].collapsed == "a b"
    assert P.op13_periodic_runs(spark, df.where("false")).count() == 0
