"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.store import removed, saved


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, root) for every id of ``edges`` (a, b longs); root: smallest id.

    Each round links every node to the smallest node in its neighbourhood,
    first on larger, then on smaller neighbours; rounds grow with the
    logarithm of the longest chain.  Minima are aggregated before they are
    joined back, so a hub with very many neighbours is combined map-side and
    AQE can split its join.  Rounds are written to the shared folder; the one
    before goes when the next is written.  Self loops and nulls are dropped;
    an empty table gives an empty result.
    """
    e = edges.select(F.col("a").cast("long"), F.col("b").cast("long")) \
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    e = saved(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
              name)
    before = _mark(e)
    while before[0]:
        both = e.union(e.select("v", "u"))
        # Stored, so that both sides of the join are plain exchanges: a hub's
        # rows can then be split.
        low_of = saved(both.groupBy("u").agg(F.min("v").alias("m"))
                       .select("u", F.least("u", "m").alias("m")), name)
        large = both.join(low_of, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(low.select("u", F.col("m").alias("v"))).distinct()
        done, e = (e, low_of), saved(small, name)
        removed(*done)
        after = _mark(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("id")).distinct()
    out = e.select(F.col("u").alias("id"), F.col("v").alias("root")) \
        .union(roots.select("id", F.col("id").alias("root")))
    out.stored_at = e.stored_at
    return out


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]
