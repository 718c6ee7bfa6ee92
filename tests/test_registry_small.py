"""Every registered query against its SQL on the smallest tables (sf0.001).

This is the brute-force check: DuckDB evaluates the oracle SQL over the
same parquet files and the results are compared as multisets.
"""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tierline import checks

SF = "/root/testdata/sf0.001"
_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN",
          "double": "DOUBLE", "timestamp": "TIMESTAMP"}
TABLES = ["region", "nation", "customer", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("key", sorted(checks.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    oracle_types = {d[0]: str(d[1]) for d in res.description}
    assert spark_types == oracle_types
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_every_query_has_an_oracle():
    assert set(checks.queries()) == set(checks.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["year", "event_name"]
    assert df.count() > 0
