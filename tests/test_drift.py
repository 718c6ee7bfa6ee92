import json

from tierline.operators.drift import split_payloads, typed
from tierline.schemas import I, S, struct

LINES = [("a", '[{"id":"1","name":"x","n":3,"deep":{"b":[1,2]}},{"id":"2","extra":null}]'), ("b", "[]"), ("c", '{"broken'),
         ("d", None), ("e", "null"), ("f", '{"id":"9"}'), ("g", '[1,"x",null,{"id":"7","n":"many","a b":"é\\"q"}]'), ("h", "")]
ELEMENT = struct(("id", S), ("name", S), ("n", I))


def parts(spark):
    df = spark.createDataFrame(LINES, "k string, body string").repartition(3)
    return split_payloads(df, keep=["k"])


def test_elements_and_quarantine(spark):
    good, bad = parts(spark)
    rows = {(r.k, r.id): (r.name, r.n, json.loads(r.more)) for r in typed(good, ELEMENT, ["k"]).collect()}
    assert rows == {("a", "1"): ("x", 3, {"deep": {"b": [1, 2]}}), ("a", "2"): (None, None, {"extra": None}),
                    ("g", "7"): (None, None, {"n": "many", "a b": 'é"q'})}
    assert sorted((r.k, r.text, r.reason) for r in bad.collect()) == [
        ("c", '{"broken', "unreadable"), ("f", '{"id":"9"}', "no array"), ("g", '"x"', "no object"),
        ("g", "1", "no object"), ("g", "null", "no object"), ("h", "", "unreadable")]


def test_objects_survive_a_round_trip_through_files(spark, folder):
    good, _ = parts(spark)
    path = folder()
    good.write.parquet(path)
    back = spark.read.parquet(path)
    sent = [e for _, t in LINES if t and t.startswith("[") for e in json.loads(t) if isinstance(e, dict)]
    got = [json.loads(r.j) for r in back.selectExpr("to_json(element) AS j").collect()]
    assert sorted(json.dumps(e, sort_keys=True) for e in got) == sorted(json.dumps(e, sort_keys=True) for e in sent)
    assert typed(back, ELEMENT, ["k"]).count() == 3


def test_no_lines(spark):
    good, bad = split_payloads(spark.createDataFrame([], "k string, body string"), keep=["k"])
    assert typed(good, ELEMENT, ["k"]).count() == bad.count() == 0
