import os

import pytest

import corpus_pipeline as P
from tierline.llm import decontam, jaccard, tokens, toxicity
from tierline.llm.store import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_stages_against_plain_code(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "near_copies", "decontamination", "mixing", "tokens"]
    start = {r.doc_id: r for r in docs.collect()}

    a = P.saved(P.STAGES[0][1](spark, docs, SF), "t")
    scored = toxicity.op5_toxicity(spark, docs, table(spark, SF, "labels")).collect()
    assert {r.doc_id for r in a.collect()} == {r.doc_id for r in scored if not r.predicted}

    b = P.saved(P.STAGES[1][1](spark, a, SF), "t")
    from test_jaccard import brute
    want = brute([(r.doc_id, r.text) for r in a.collect()], 5, 80)
    assert {r.doc_id for r in b.collect()} == {c for _, _, c in want}

    c = P.saved(P.STAGES[2][1](spark, b, SF), "t")
    from test_decontam import brute as hits
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    dirty = {r[0] for r in hits([(r.doc_id, r.text) for r in b.collect()], items) if r[5]}
    assert {r.doc_id for r in c.collect()} == {r.doc_id for r in b.collect()} - dirty

    d = P.saved(P.STAGES[3][1](spark, c, SF), "t")
    left = {r.doc_id for r in c.collect()}
    got = d.collect()
    assert {r.doc_id for r in got} <= left
    for x in (a, b, c, d):
        assert x.columns == docs.columns
        assert all(r.text == start[r.doc_id].text for r in x.collect())
    size = {i: len(start[i].text.split()) for i in left}
    words = sum(size[r.doc_id] for r in got)
    assert abs(words - 1.5 * sum(size.values())) < 0.25 * sum(size.values())

    e = P.STAGES[4][1](spark, d, SF).collect()
    with open(tokens.VOCABULARY, "rb") as f:
        enc = tokens.Encoder(f.read())
    assert sum(r.n_tokens for r in e) == sum(len(enc.ids(r.text)) for r in got)
    assert {i for r in e for i in r.doc_ids} == {r.doc_id for r in got}


def test_run(spark):
    out = P.run(spark, SF)
    n = out.count()
    assert n == out.select("slot").distinct().count() > 0


def test_clean_documents_stay(spark, docs_of):
    docs = docs_of([(1, "one short clean text"), (2, None), (3, ""), (4, "another clean text"), (None, "no id")])
    assert jaccard.op4_jaccard_join(spark, docs, 5, 80).count() == 5
    assert P.drop_near_copies(spark, docs, SF).count() == 5
    assert P.drop_contaminated(spark, docs, SF).count() == 5
    assert decontam.find_phrases(docs, table(spark, SF, "benchmark")).count() == 5
