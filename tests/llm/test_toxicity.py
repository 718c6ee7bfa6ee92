import random
import zlib

import pytest
from conftest_llm import words

from tierline.llm import toxicity as X

BAD = ["grubbit", "snarlof", "vexiden"]


def corpus(n, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        t = words(rng, rng.randrange(30, 120)).split()
        y = int(i % 5 == 0)
        if y:
            for _ in range(rng.randrange(1, 5)):
                t.insert(rng.randrange(len(t)), rng.choice(BAD) + rng.choice(["", "", "s", "ing"]))
        rows.append((i, " ".join(t)))
        labels.append((i, 0, y))
    return rows, labels


@pytest.fixture(scope="module")
def labelled():
    return corpus(1200)


def test_held_out_accuracy_and_contract(spark, docs_of, labelled):
    rows, labels = labelled
    extra = [(9001, None), (9002, ""), (9003, "x" * 200_000), (None, "grubbit " * 5), (5, rows[5][1])]
    docs = docs_of(rows + extra, clash=["score", "predicted", "held_out"])
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = X.op5_toxicity(spark, docs, lab).collect()
    assert len(out) == len(rows) + len(extra)
    want = dict((i, y) for i, _, y in labels)
    held = [r for r in out if r.held_out and r.doc_id in want]
    hit = sum(r.predicted == want[r.doc_id] for r in held)
    assert len(held) > 200 and hit / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    for r in out:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    by = {r.doc_id: r for r in out}
    assert by[9001].score == by[9002].score
    assert by[None].predicted == 1 and by[None].held_out is False
    assert len({r.score for r in out if r.doc_id == 5}) == 1


def test_held_out_labels_never_train(spark, docs_of, labelled):
    rows, labels = labelled
    docs = docs_of(rows)
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, q, y in labels]
    kind = "doc_id long, quality int, toxic int"
    a = X.train(docs, spark.createDataFrame(labels, kind))
    b = X.train(docs, spark.createDataFrame(flipped, kind))
    assert a == b


def test_without_usable_labels_nothing_is_rejected(spark, docs_of):
    docs = docs_of([(1, "some text"), (2, None)])
    none = spark.createDataFrame([(1, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    out = X.op5_toxicity(spark, docs, none).collect()
    assert [r.predicted for r in out] == [0, 0]
    assert X.op5_toxicity(spark, docs.limit(0), none.limit(0)).count() == 0


def test_filter_keeps_columns(spark, docs_of, labelled):
    rows, labels = labelled
    docs = docs_of(rows, clash=["score"])
    model = X.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    kept = X.keep_ordinary(docs, model)
    assert kept.schema == docs.schema
    ids = {r.doc_id for r in X.score(docs, model).where("predicted = 0").collect()}
    assert {r.doc_id for r in kept.collect()} == ids


def test_windows_that_mark_toxic_texts_recur_in_other_toxic_texts(labelled):
    rows, labels = labelled
    toxic = [t.encode() for (_, t), (_, _, y) in zip(rows, labels) if y]
    plain = [t.encode() for (_, t), (_, _, y) in zip(rows, labels) if not y]
    toxic[0] += b" xqzwkjvypt" * 50     # one text's own word marks nothing
    found = X._toxic_windows(toxic, plain)
    bad = [w for w in found if any(w.startswith(b.encode()) for b in BAD)]
    assert {w for t in toxic for w in X.words_of(t) if w.decode() in BAD} <= set(found)
    assert len(bad) > 0.95 * len(found) and b"xqzwkjvypt" not in found


def test_search_for_windows_without_texts():
    assert X._toxic_windows([], []) == [] == X._toxic_windows([], [b"a b"]) == X._toxic_windows([b"a b"], [])
    assert X._toxic_windows([b"a" * X.SEARCH_BYTES], [b""]) == []
