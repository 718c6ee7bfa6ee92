import json
import random
from collections import defaultdict

import numpy as np
import pytest
from conftest_llm import words

from tierline.llm import tokens as K


@pytest.fixture(scope="module")
def encoder():
    with open(K.VOCABULARY, "rb") as f:
        return K.Encoder(f.read())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 100, 4097, 65536, 70001])
def test_places_are_a_permutation(n):
    s = K.places(np.arange(n), n)
    assert np.array_equal(np.sort(s), np.arange(n))
    assert n < 100 or not np.array_equal(s, np.arange(n))
    assert n < 100 or not np.array_equal(s, K.places(np.arange(n), n, key=5))


def case():
    rng = random.Random(1)
    return [(i, words(rng, rng.randrange(1, 200)) + (" é€😀" if i % 3 else "")) for i in range(90)] + \
        [(500, None), (501, ""), (502, "long " * 8000), (7, "again"), (7, "again"), (None, "no id")]


def test_round_trip(spark, docs_of, encoder):
    rows = case()
    plan = K.materialise(docs_of(rows, clash=["slot", "n", "tokens"]), length=64, shard_places=40)
    out = K.read_shards(spark, plan).collect()
    want = defaultdict(list)
    for i, t in rows:
        if t:
            want[i].append(encoder.ids(t).tolist())
    assert sum(r.n_tokens for r in out) == sum(len(x) for v in want.values() for x in v)
    order = sorted(out, key=lambda r: r.slot)
    assert [r.shard for r in order] == sorted(r.shard for r in out) and plan["shards"] > 3
    assert sorted(r.slot for r in out) == list(range(plan["sequences"]))
    got, short = defaultdict(list), 0
    for r in sorted(out, key=lambda r: r.slot):
        assert sum(r.lengths) == r.n_tokens == len(r.tokens) // 2
        ids, at = np.frombuffer(r.tokens, "<u2"), 0
        short += r.n_tokens < 64
        for d, n in zip(r.doc_ids, r.lengths):
            got[d].append(ids[at:at + n].tolist())
            at += n
    assert short <= 3  # at most one padded sequence per input partition
    for d, docs in want.items():
        assert sorted(x for p in got[d] for x in p) == sorted(x for p in docs for x in p)
    # Whole documents that fit one sequence come back as they were encoded.
    for d, docs in want.items():
        for p in got[d]:
            if p[-1] == encoder.end and len(p) == len(docs[0]):
                assert p in docs


def test_fixed_stride_and_resume(spark, docs_of, tmp_path):
    docs = docs_of(case())
    folder = f"file://{tmp_path}/shards"
    plan = K.materialise(docs, folder=folder, length=64, shard_places=40)
    first = {p.name: p.read_bytes() for p in (tmp_path / "shards").glob("*.bin")}
    assert len(first) == plan["shards"]
    for name, raw in first.items():
        assert len(raw) % plan["stride"] == 0
    assert json.loads((tmp_path / "shards" / "manifest.json").read_text())["key"] == K.KEY
    # A run that died half-way: some shards are missing, one only begun.
    names = sorted(first)
    for n in names[:2]:
        (tmp_path / "shards" / n).rename(tmp_path / "shards" / (n + ".7"))
    kept = (tmp_path / "shards" / names[-1]).stat().st_mtime_ns
    K.materialise(docs, folder=folder, length=64, shard_places=40)
    again = {p.name: p.read_bytes() for p in (tmp_path / "shards").glob("*.bin")}
    assert again == first
    assert (tmp_path / "shards" / names[-1]).stat().st_mtime_ns == kept
    with pytest.raises(ValueError, match="another plan"):
        K.materialise(docs, folder=folder, length=32, shard_places=40)


def test_resume_under_other_splits(spark, docs_of, tmp_path):
    rng = random.Random(3)
    docs = docs_of([(i, words(rng, 300, 5000)) for i in range(400)])
    folder = f"file://{tmp_path}/shards"
    K.materialise(docs, folder=folder, length=64, shard_places=40)
    shards = tmp_path / "shards"
    first = {p.name: p.read_bytes() for p in shards.glob("*.bin")}
    names = sorted(first)
    assert len(names) > 8
    for n in names[::2]:
        (shards / n).rename(shards / (n + ".9"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        assert spark.read.parquet(*docs.inputFiles()).rdd.getNumPartitions() > 8  # it is another layout
        K.materialise(docs, folder=folder, length=64, shard_places=40)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "20000"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {p.name: p.read_bytes() for p in shards.glob("*.bin")} == first


def test_other_documents_are_refused(spark, docs_of, tmp_path):
    folder = f"file://{tmp_path}/shards"
    K.materialise(docs_of([(1, "one two"), (2, "three")]), folder=folder, length=64)
    with pytest.raises(ValueError, match="another plan"):
        K.materialise(docs_of([(1, "one owt"), (2, "three")]), folder=folder, length=64)


def test_string_ids(spark, docs_of, encoder):
    docs = docs_of([(1, "one two three"), (None, "four"), (2, "five")]).selectExpr(
        "concat('doc-', doc_id) AS doc_id", "text")
    out = K.op3_token_output(spark, docs).collect()
    assert sorted((d for r in out for d in r.doc_ids), key=str) == [None, "doc-1", "doc-2"]
    assert sum(r.n_tokens for r in out) == sum(len(encoder.ids(t)) for t in ("one two three", "four", "five"))


def test_slots_over_many_runs_of_shards(spark, docs_of, monkeypatch):
    monkeypatch.setattr(K, "_SHARD_RUN", 2)
    rng = random.Random(5)
    plan = K.materialise(docs_of([(i, words(rng, 200)) for i in range(50)]), length=32, shard_places=20)
    assert plan["shards"] > 10
    assert sorted(r.slot for r in K.read_shards(spark, plan).collect()) == list(range(plan["sequences"]))


def test_no_text(spark, docs_of):
    docs = docs_of([(1, None), (2, "")])
    assert K.op3_token_output(spark, docs).count() == 0
    assert K.op3_token_output(spark, docs.limit(0)).count() == 0
