import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tierline.llm import packing as P

WHOLE = Tokenizer.from_file(P.vocabulary())
WORDS = P.WordTokenizer(open(P.vocabulary(), encoding="utf-8").read())


def ids_of(texts):
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    first, ids = WORDS.ids(np.frombuffer(b"".join(raw), np.uint8), off)
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(
    " \t\n\r\x0b\x0c\x1c\x85  　̈́ΣσİIſ'sdAa1½<|>endoftext"))), max_size=6))
def test_ids_by_word_equal_ids_of_whole_texts(texts):
    assert ids_of(texts) == [WHOLE.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_special_strings_and_marks():
    texts = ["a <|endoftext|> b", "x<|startoftext|>y <|endof text|>", "e ̈ü ́", "It's WE'LL don't",
             "ΟΔΟΣ ΟΔΟΣ Σ", "", " ", "日本語テキスト" * 50, "x" * 5000]
    assert ids_of(texts) == [WHOLE.encode(t, add_special_tokens=False).ids + [2] for t in texts]


@given(st.integers(1, 20_000), st.integers(0, 40))
def test_cuts(n, slack):
    table = P.cut_lengths(4096, slack)
    got = P.cuts(n, table)
    assert sum(got) == n and all(4096 % t <= slack and 0 < t <= 4096 for t in got)


def check(rows, docs, capacity=4096, slack=16):
    """Round trip: every id once, sequences without gaps, little padding."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    want = {}
    for i, t in docs:
        ids = WHOLE.encode(t or "", add_special_tokens=False).ids + [2]
        want.setdefault((i, len(ids)), []).append(ids)
    assert set(by_doc) == set(want)
    for key, lists in want.items():
        assert all(x == lists[0] for x in lists)  # repeated rows of the fixtures are equal
        spans = sorted((r.start, r.length, r.ids_crc32) for r in by_doc[key])
        once = sorted(set(spans))
        raw = np.array(lists[0], "<u4")
        if len(lists) == 1:
            assert [s for s, _, _ in spans] == np.cumsum([0] + [k for _, k, _ in spans])[:-1].tolist()
        assert sum(k for _, k, _ in spans) == key[1] * len(lists)
        assert all(zlib.crc32(raw[s:s + k].tobytes()) == c for s, k, c in once)
    free = 0
    for rows in by_seq.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == np.cumsum([0] + [r.length for r in rows])[:-1].tolist()
        n = sum(r.length for r in rows)
        assert 0 < n <= capacity
        if n & (n - 1):
            free += capacity - n
            assert capacity - n <= slack
    return free, len(by_seq)


def texts():
    docs = [(i, " ".join(f"word{(i * j) % 977} Ünï-{j}" for j in range((i * 37) % 600))) for i in range(250)]
    return docs + [(1000, None), (1001, ""), (1002, " \n"), (None, "no id here"), (1003, "long " * 60_000),
                   (1004, "y" * 100_000), (7, docs[7][1]), (1005, "<|endoftext|> ends")]


def test_round_trip(spark, docs_of):
    docs = texts()
    df = docs_of(docs, clash=["start", "length", "ids", "part", "rank", "sequence_id"])
    free, n = check(P.op11_packing(spark, df).collect(), docs)
    assert n >= sum(len(WHOLE.encode(t or "").ids) + 1 for _, t in docs) // 4096


def test_rounds_with_a_small_fan_and_capacity(spark, docs_of):
    docs = texts()
    df = docs_of(docs).repartition(23)
    from tierline.llm.store import saved
    df = saved(df, "tests_packing")
    from pyspark.sql import functions as F
    got = P.packed(df, capacity=256, slack=4, fan=3).withColumn("ids_crc32", F.crc32("ids")).collect()
    check(got, docs, 256, 4)


def test_sequences_and_edges(spark, docs_of):
    docs = [("a", "one two three"), ("b", None), (None, "four " * 5000)]
    df = spark.createDataFrame(docs, "doc_id string, text string")
    p = P.packed(df)
    seq = P.sequences(p).collect()
    total = sum(len(WHOLE.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in docs)
    assert sum(r.n_tokens for r in seq) == total
    for r in seq:
        power = r.n_tokens & (r.n_tokens - 1) == 0
        assert len(r.tokens) == 4 * (r.n_tokens if power else 4096) and sum(r.lengths) == r.n_tokens
    assert P.op11_packing(spark, df.where("false")).count() == 0
