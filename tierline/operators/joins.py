"""Join helpers: left joins on key pairs and key-uniqueness checks.

No join carries a hint: Spark picks a broadcast from the sizes in bytes it
knows, before the query and, with AQE, while it runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A dimension key is not unique, so a join on it would fan out."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their counts (``n``).

    Partial aggregation runs before the shuffle, so a hot key costs one row
    per map task, not one row per occurrence.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def duplicate_keys_staged(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of :func:`duplicate_keys`, for long keys that are nearly all
    unique.

    First the keys' 64-bit hashes alone are counted: eight bytes a row are
    moved, combined map-side.  Only rows whose hash occurs more than once are
    grouped by their keys, so the result is exact, clean keys are not moved,
    and a collision of hashes costs a few rows.
    """
    marked = df.select(*keys, F.xxhash64(*keys).alias("_h"))
    suspect = marked.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_h")
    return duplicate_keys(marked.join(suspect, "_h", "left_semi"), keys)


def check_unique(dims: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> None:
    """Raise :class:`DuplicateKeyError` if a key of a (name, dimension, keys)
    is not unique.  One job over all of them; one row comes back."""
    parts = [df.select(F.lit(name).alias("dim"),
                       F.to_json(F.struct(*[F.col(k) for k in keys])).alias("key"))
             for name, df, keys in dims]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    bad = duplicate_keys_staged(every, ["dim", "key"]).agg(F.min(F.struct("dim", "key")).alias("b")).first()["b"]
    if bad is not None:
        raise DuplicateKeyError(f"key {bad['key']} of {bad['dim']} is not unique")


def left_join(fact: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """``fact LEFT JOIN dim`` on pairs (fact column, dim column).

    Dimension join columns are dropped from the output, so the fact keeps its
    own key columns and unmatched rows keep them too.
    """
    cond = None
    for fcol, dcol in on:
        c = fact[fcol] == dim[dcol]
        cond = c if cond is None else cond & c
    return fact.join(dim, cond, "left").drop(*[dim[d] for _, d in on])
