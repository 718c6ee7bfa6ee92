"""Files clustered along a space-filling curve, for lookups by several keys.

Every key column is cut at its quantiles, and the bits of the cell numbers are
interleaved (Z-order): rows that are close in all keys lie together, so row
groups cover a small range of each.  A lookup by any of the keys then skips
most row groups by their minima and maxima, which Spark's Parquet scan does
for every pushed filter; Bloom filters rule out the groups whose range covers
a value that they do not hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.keynumbers import bucket_of, common_bytes, key_number

#: Bits of a cell number per key.
BITS = 8
#: Size of a row group: what one lookup reads at least.
GROUP_BYTES = 8 << 20


def curve(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> Column:
    """The Z-value of a row: two aggregates over the key columns find the
    common leading bytes of strings and the quantiles."""
    ends = df.agg(*[f(k) for k in keys for f in (F.min, F.max)]).first()
    numbers = []
    for i, k in enumerate(keys):
        low, high = ends[2 * i], ends[2 * i + 1]
        if isinstance(df.schema[k].dataType, T.StringType):
            numbers.append(key_number(k, common_bytes(low, high) if low is not None else 0))
        else:
            numbers.append(F.col(k).cast("long"))
    parts = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(x, parts, 100 << bits) for x in numbers]).first()
    z = F.lit(0).cast("long")
    for j, (x, found) in enumerate(zip(numbers, cuts)):
        cell = F.coalesce(bucket_of(x, sorted(set(found or []))), F.lit(0)).cast("long")
        for b in range(bits):
            bit = F.shiftright(cell, b).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(bit, b * len(keys) + j))
    return z


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], bloom: Sequence[str] = (),
                    group_bytes: int = GROUP_BYTES, bits: int = BITS, mode: str = "overwrite") -> None:
    """Write ``df`` as Parquet along the curve of ``keys``, with Bloom filters
    on the columns ``bloom``.

    Files are ranges of the curve; rows that agree in it are spread by their
    hash, so a key that a large share of the rows has goes to several files.
    """
    rows = df.withColumn("_z", curve(df, keys, bits)).withColumn("_spread", F.xxhash64(*df.columns))
    rows = rows.repartitionByRange("_z", *keys, "_spread").sortWithinPartitions("_z", *keys).select(*df.columns)
    out = rows.write.mode(mode).option("parquet.block.size", group_bytes)
    for c in bloom:
        out = out.option(f"parquet.bloom.filter.enabled#{c}", "true") \
            .option(f"parquet.bloom.filter.adaptive.enabled#{c}", "true")
    out.parquet(path)


def rows_scanned(df: DataFrame) -> int:
    """Run ``df`` and say how many rows its Parquet scans gave: those of the
    row groups (and pages) that were not skipped."""
    df._jdf.collectToPython()
    plan = df._jdf.queryExecution().executedPlan()
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total
