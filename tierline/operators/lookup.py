"""Lookups by parent key and the JSON payloads of a lookup service.

A lookup for one parameter is a filter (pushed into the parquet scan); a
lookup for many requested keys is a semi join, so each child is returned
once however often its key was requested.

Payloads are JSON arrays of child rows per requested key, ``[]`` when the
key has no child.  Every key's children are cut into pages of ``page_rows``
in the order of their fields.  Children are counted per key first: those of a
key that fits a page, or an array of ``ARRAY_ROWS``, are sorted in one array
and cut there, so they are moved once.  Of larger keys equal rows are counted
and positions come from running totals, so neither a key with very many
children nor very many equal children meet in one task or one array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.payloads import JSON_OPTS, parse_array
from tierline.operators.numbering import running_total
from tierline.session import fresh_folder

PAGE_ROWS = 1_000
# Children of one key that are put in one array, at most (or a page of them).
ARRAY_ROWS = 10_000


def lookup_by(children: DataFrame, **params) -> DataFrame:
    """Children whose columns equal the given values (one request)."""
    cond = None
    for k, v in params.items():
        c = F.col(k) == F.lit(v)
        cond = c if cond is None else cond & c
    return children.filter(cond) if cond is not None else children


def lookup_many(children: DataFrame, requests: DataFrame,
                match: Sequence[str]) -> DataFrame:
    """Children of every requested key (semi join on ``match``)."""
    return children.join(requests.select(*match), list(match), "left_semi")


def response_payloads(requests: DataFrame, children: DataFrame,
                      match: Sequence[str], fields: Sequence[str],
                      page_rows: int = PAGE_ROWS, array_rows: int = ARRAY_ROWS) -> DataFrame:
    """One JSON array per requested key and page: (match..., page, body).

    Elements are the ``fields`` of each child, sorted (nulls first), null
    fields kept; page p holds elements p * page_rows up to (p + 1) *
    page_rows of its key.  Keys without children get page 0 with ``[]``.
    """
    match = list(match)
    names = [f"_key_{m}" for m in match]
    rows = children.select(*[F.col(m).alias(n) for m, n in zip(match, names)],
                           F.struct(*[F.col(f) for f in fields]).alias("_row"))
    path = fresh_folder(children.sparkSession, "payload_sizes")
    rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_c")) \
        .filter(F.col("_c") > max(page_rows, array_rows)) \
        .select(*[F.col(n).alias(f"{n}_l") for n in names]).write.parquet(path)
    large = children.sparkSession.read.schema(
        T.StructType([T.StructField(f"{n}_l", rows.schema[n].dataType) for n in names])).parquet(path)
    if large.isEmpty():
        bodies = _cut(rows, names, page_rows)
    else:
        same = [F.col(n).eqNullSafe(F.col(f"{n}_l")) for n in names]
        bodies = _cut(rows.join(large, same, "left_anti"), names, page_rows) \
            .unionByName(_paged(rows.join(large, same, "left_semi"), names, page_rows))
    bodies = bodies.select(*[F.col(n).alias(m) for n, m in zip(names, match)],
                           F.col("page").cast("int").alias("page"), "body")
    out = requests.select(*match).join(bodies, match, "left")
    return out.select(*match, F.coalesce(F.col("page"), F.lit(0)).alias("page"),
                      F.coalesce(F.col("body"), F.lit("[]")).alias("body"))


def _cut(rows: DataFrame, names: Sequence[str], page_rows: int) -> DataFrame:
    """(names..., page, body) of keys whose rows fit an array."""
    rows = rows.groupBy(*names).agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    starts = F.sequence(F.lit(1), F.size("_rows"), F.lit(page_rows))
    pages = F.transform(starts, lambda at: F.slice("_rows", at, F.lit(page_rows)))
    return rows.select(*names, F.posexplode(pages).alias("page", "_items")) \
        .select(*names, F.col("page").cast("long").alias("page"), F.to_json("_items", JSON_OPTS).alias("body"))


def _paged(rows: DataFrame, names: Sequence[str], page_rows: int) -> DataFrame:
    """The same for keys of any size."""
    rows = rows.groupBy(*names, "_row").agg(F.count(F.lit(1)).alias("_n"))
    placed = running_total(rows, list(names), [F.col("_row").asc()], "_n", "_upto") \
        .withColumn("_from", F.col("_upto") - F.col("_n"))
    size = F.lit(page_rows)
    placed = placed.withColumn("page", F.explode(F.sequence(
        F.floor(F.col("_from") / size), F.floor((F.col("_upto") - 1) / size))))
    low = F.greatest(F.col("_from"), F.col("page") * size)
    high = F.least(F.col("_upto"), (F.col("page") + 1) * size)
    part = F.struct(low.alias("at"), (high - low).cast("int").alias("n"), F.col("_row").alias("row"))
    items = F.flatten(F.transform(F.array_sort(F.collect_list(part)),
                                  lambda x: F.array_repeat(x["row"], x["n"])))
    return placed.groupBy(*names, "page").agg(F.to_json(items, JSON_OPTS).alias("body"))


def explode_payload(df: DataFrame, payload_col: str, element: T.StructType,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Rows of JSON-array payloads; ``keep`` columns (request keys) are
    carried onto every row.  ``[]`` and ``null`` payloads give no row."""
    arr = parse_array(F.col(payload_col), element)
    return (df.select(*keep, F.explode(arr).alias("_r"))
              .select(*keep, *[F.col(f"_r.{f}").alias(f) for f in element.names]))
