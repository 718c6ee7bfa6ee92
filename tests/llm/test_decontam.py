import hashlib
import random
import re

from conftest_llm import words

from tierline.llm import decontam as D

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(_LOWER))


def brute(docs, items, size=10):
    out = []
    wins = []
    for i, t in items:
        w = split(t)
        if w and i is not None:
            n = min(size, len(w))
            wins += [(i, tuple(w[k:k + n])) for k in range(len(w) - n + 1)]
    for d, t in docs:
        w, hit, got = split(t), set(), set()
        for i, g in wins:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    got.add(i)
        names = ",".join(sorted(map(str, got)))
        out.append((d, len(w), len(hit), len(got), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def case():
    rng = random.Random(2)
    items = [(i, words(rng, rng.randrange(10, 40), 60)) for i in range(30)]
    items += [(100, "Zwölf-Boxkämpfer"), (101, "short one"), (102, ""), (103, None), (104, "!!"), (None, "w1x1"),
              (9, "w1x1 w1x1 w1x1 w1x1 w1x1 w1x1 w1x1 w1x1 w1x1 w1x1 w1x1 w1x1")]
    docs = [(i, words(rng, rng.randrange(1, 80), 60)) for i in range(60)]
    for i in range(40):
        src = items[rng.randrange(30)][1].split()
        a = rng.randrange(0, len(src) - 8)
        part = src[a:a + rng.randrange(8, 25)]
        docs.append((200 + i, words(rng, 5) + ", " + " -- ".join(part).upper() + ". " + words(rng, 7)))
    docs += [(300, None), (301, ""), (302, "a short ONE b"), (303, "ZWöLF boxkämpfer"), (304, "zwölf/boxkämpfer x"),
             (305, "w1x1 " * 30), (306, "short"), (307, "one"), (302, "a short ONE b"), (None, "short one")]
    return docs, items


def test_phrases_against_brute_force(spark, docs_of, monkeypatch):
    docs, items = case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs_of(docs, clash=["hits", "items", "row", "n_words"])
    got = D.op8_decontamination(spark, df, bench).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)
    # The same in several blocks of items, on one index and on several.
    monkeypatch.setattr(D, "ITEM_BYTES", 1500)
    built, build = [], D.build_index
    monkeypatch.setattr(D, "build_index", lambda *a: built.append(1) or build(*a))
    for blocks, indexes in ((32, 1), (2, 2)):
        monkeypatch.setattr(D, "INDEX_BLOCKS", blocks)
        got = D.op8_decontamination(spark, df, bench).collect()
        assert sorted(map(tuple, got), key=str) == brute(docs, items)
        assert len(built) >= indexes and (blocks > 2) == (len(built) == 1)
        built.clear()


def test_ids_of_other_types(spark, docs_of):
    docs, items = case()
    df = docs_of(docs).selectExpr("concat('d', doc_id) AS doc_id", "text")
    bench = spark.createDataFrame([(i and f"i-{i}", t) for i, t in items], "item_id string, text string")
    want = brute([(None if d is None else f"d{d}", t) for d, t in docs],
                 [(i and f"i-{i}", t) for i, t in items])
    assert sorted(map(tuple, D.op8_decontamination(spark, df, bench).collect()), key=str) == want


def test_large_ids_beside_null_ones(spark, docs_of):
    big = (1 << 60) + 1
    bench = spark.createDataFrame([(big, "one two")], "item_id long, text string")
    got = D.find_phrases(docs_of([(big, "say one two"), (None, "x")]), bench).collect()
    assert {(r.doc_id, tuple(r.items)) for r in got} == {(big, (big,)), (None, ())}


def test_splits_may_change_between_blocks(spark, docs_of, monkeypatch):
    docs, items = case()
    df, stored, sizes = docs_of(docs), D.saved, ["1k", "2k", "128m", "3k"]
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)

    def saved(frame, name):
        out = stored(frame, name)
        sizes.append(sizes.pop(0))
        spark.conf.set(key, sizes[0])
        return out
    monkeypatch.setattr(D, "saved", saved)
    monkeypatch.setattr(D, "ITEM_BYTES", 1500)
    monkeypatch.setattr(D, "INDEX_BLOCKS", 1)
    try:
        got = D.op8_decontamination(spark, df, spark.createDataFrame(items, "item_id long, text string")).collect()
        assert sorted(map(tuple, got), key=str) == brute(docs, items)
    finally:
        spark.conf.set(key, before)


def test_many_segments(spark, docs_of, monkeypatch):
    docs, items = case()
    monkeypatch.setattr(D, "SEGMENT", 300)
    got = D.op8_decontamination(spark, docs_of(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark, docs_of):
    docs = docs_of([(1, "some words")])
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in D.op8_decontamination(spark, docs, none).collect()] == [0]
    assert D.op8_decontamination(spark, docs.limit(0), none).count() == 0


def test_proximity(spark, docs_of):
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = docs_of([(1, "delta x beta y alpha gamma"), (2, "alpha beta " + "z " * 30 + "gamma delta"),
                    (3, "alpha beta gamma"), (4, "gamma delta alpha beta")])
    got = {tuple(r) for r in D.proximity_matches(docs, items, 6).collect()}
    assert got == {(1, 1), (4, 1)}


def test_clean_rows_are_judged_by_their_own_text(spark, docs_of):
    """Rows with null or repeated ids; several blocks of items."""
    window = " ".join(f"t{i}" for i in range(10))
    rows = [(1, f"before {window} after"), (1, "clean"), (None, window), (None, "clean too"), (2, None), (3, ""),
            (4, "x " * 50_000 + window), (5, " ".join(f"t{i}" for i in range(9))), (6, f"T0, {window[3:].upper()}")]
    df = docs_of(rows, clash=["row", "hits"])
    bench = spark.createDataFrame([(1, window), (2, "short one"), (None, "clean"), (3, None)],
                                  "item_id long, text string")
    want = sorted([(1, "clean"), (None, "clean too"), (2, None), (3, ""), (5, rows[7][1])], key=str)
    got = D.keep_clean(df, bench)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == want
    assert D.keep_clean(df.where("false"), bench).count() == 0
    assert D.keep_clean(df, bench.where("false")).count() == len(rows)


def test_clean_rows_with_several_item_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(D, "ITEM_BYTES", 40)
    monkeypatch.setattr(D, "INDEX_BLOCKS", 4)
    items = [(i, f"item {i} " + " ".join(f"q{i}w{j}" for j in range(9))) for i in range(6)]
    df = docs_of([(i, f"say {items[i][1]} so" if i % 2 else f"nothing {i}") for i in range(6)])
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(r.doc_id for r in D.keep_clean(df, bench).collect()) == [0, 2, 4]
