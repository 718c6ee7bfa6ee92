"""Ordering: descending sort, top-1, rank by a value, the first n of very many."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.keynumbers import bucket_of, common_bytes, key_number
from tierline.operators.numbering import running_total

#: Rows that are ordered as one limit; larger numbers are cut by a histogram.
INTERVAL, QUANTILES = 100_000, 256


def sort_desc(df: DataFrame, column: str, tie: str | None = None) -> DataFrame:
    """Global descending sort (range-partitioned, distributed)."""
    keys = [F.col(column).desc()] + ([F.col(tie).asc()] if tie else [])
    return df.orderBy(*keys)


def top1(df: DataFrame, column: str, tie: str | None = None) -> DataFrame:
    """Row with the largest ``column`` (``TakeOrderedAndProject``: each task
    keeps its best row, the driver merges one row per task)."""
    return sort_desc(df, column, tie).limit(1)


def rank_desc(df: DataFrame, column: str, name: str = "rank") -> DataFrame:
    """Competition rank by descending ``column`` (1 = largest).

    Rows are counted per distinct value, the counts are summed in descending
    order over range partitions, and the rank is joined back: no task holds
    the whole input, whatever the column.
    """
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ranks = running_total(per_value, [], [F.col(column).desc()], "_n", "_upto").select(
        F.col(column).alias("_value"), (F.col("_upto") - F.col("_n") + 1).cast("long").alias(name))
    return df.join(ranks, df[column].eqNullSafe(ranks["_value"])).drop("_value")


def first_n(df: DataFrame, column: str, n: int, interval: int = INTERVAL) -> DataFrame:
    """The ``n`` rows with the smallest values of a string column, unordered.

    A histogram finds the value up to which rows are taken: counts between
    some hundred quantiles tell which of these intervals holds the n-th row;
    those before it are taken whole by a filter, and only this one is looked
    at again, until it has at most ``interval`` rows, which are ordered.  So
    no task and no driver holds ``n`` rows.  Rows without a value come last;
    among rows with the value at the cut any are taken.
    """
    if n <= 0:
        return df.limit(0)
    none = df.filter(F.col(column).isNull())
    rest, taken = df.filter(F.col(column).isNotNull()), []
    while True:
        low, high, count = rest.agg(F.min(column), F.max(column), F.count(column)).first()
        if count <= n:
            taken.append(rest)
            if count < n and not taken[:-1]:
                taken.append(none.limit(n - count))
            break
        skip = common_bytes(low, high) if low != high else 0
        number = key_number(column, skip)
        ends = rest.sparkSession.createDataFrame([(low,), (high,)], f"`{column}` string").select(number).collect()
        if count <= interval or ends[0] == ends[1]:
            taken.append(rest.orderBy(column).limit(n))
            break
        parts = [i / QUANTILES for i in range(1, QUANTILES)]
        found = rest.agg(F.percentile_approx(number, parts, 100 * QUANTILES)).first()[0]
        # Each quantile is an interval of its own, so one hot value is set apart.
        edges = sorted({e for q in found for e in (q, q + 1)})
        sizes = {r["b"]: r["n"] for r in rest.groupBy(bucket_of(number, edges).alias("b"))
                 .agg(F.count(F.lit(1)).alias("n")).collect()}
        at = 0
        while sizes.get(at, 0) <= n:  # the intervals before the cut
            n -= sizes.get(at, 0)
            at += 1
        if at:
            taken.append(rest.filter(number < edges[at - 1]))
            rest = rest.filter(number >= edges[at - 1])
        if at < len(edges):
            rest = rest.filter(number < edges[at])
        if n == 0:
            break
    out = taken[0] if taken else df.limit(0)
    for t in taken[1:]:
        out = out.unionByName(t)
    return out
