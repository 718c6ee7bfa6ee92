"""Mixing sources to target weights by Pareto order sampling.

The mix holds ``share`` of all words.  Sources, in code point order with null
last, share it by the repeating weights; no target exceeds ``CAP`` times its
source's size, and what is above is shared again by weight (water-filling, in
closed form over the sources ordered by cap over weight).

A source whose target is t times its size takes floor(t) whole copies of every
document.  The remaining words come from an unequal-probability sample: a
document's inclusion probability is proportional to the bit length of its size
(long documents are a little likelier to repeat), documents are ranked by
random odds over inclusion odds, and the sample is the front of that ranking
whose words come nearest to the remainder.  The random number is a hash of
the doc_id, so reruns agree.

The front is found in two steps, so that no source is sorted in one task: the
ranks of a source of n documents fall into about sqrt(n) fixed intervals whose
sums are aggregated first, and only the documents of the interval that holds
the cut, again about sqrt(n), are ordered.  What comes out is one row per
source that says where its ranking is cut; each document is then judged where
it is read, so neither texts nor sizes are shuffled.

Only DataFrame functions are used; no UDF, pandas, Arrow or RDD code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierline.llm.store import removed, saved

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, target, gsum, docs) per source of (source, size, g)."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"),
                                    F.sum(F.col("g") * F.col("size")).alias("gsum"))
    # One row per source: the aggregate, never the documents, is ordered here.
    nth = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                            ((nth - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("limit", F.col("source_size") * cap) \
        .withColumn("ratio", F.col("limit") / F.col("weight"))
    line = W.orderBy("ratio", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("limit").over(line.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(line.rowsBetween(0, W.unboundedFollowing))
    total = F.sum("source_size").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    s = s.withColumn("level", (F.lit(share) * total - before) / after)
    fits = F.when(F.col("level") <= F.col("ratio"), F.col("level"))
    top = F.max(fits).over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return s.withColumn("top", top).select(
        "source", "source_size", "gsum", "docs",
        F.when(F.col("top").isNull(), F.col("limit").cast("double"))
        .otherwise(F.least(F.col("limit").cast("double"), F.col("top") * F.col("weight"))).alias("target"))


def _measured(docs: DataFrame, *more: Column) -> DataFrame:
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                                  .cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return docs.select("doc_id", "source", size.alias("size"), u.alias("u"), *more) \
        .withColumn("g", F.length(F.bin("size")).cast("long"))


def _ranked(rows: DataFrame, src: DataFrame) -> DataFrame:
    """``rows`` (source, size, g, u, ...) beside their source's row, with the
    rank ``q`` (null: nothing is sampled) and its interval ``bucket``."""
    pi = F.col("rest") * F.col("g") / F.col("gsum")
    odds = (F.col("u") / (1 - F.col("u"))) / (pi / (1 - pi))
    return rows.join(src, rows["source"].eqNullSafe(src["src"])) \
        .withColumn("q", F.when(F.col("rest") <= 0, F.lit(None).cast("double"))
                    .when(pi >= 1, F.lit(0.0)).otherwise(odds)) \
        .withColumn("bucket", F.floor(F.col("q") / (1 + F.col("q")) * F.col("intervals")).cast("long"))


def _sampled(size="size", upto="upto"):
    """Whether a document that ends at ``upto`` words lies in the front."""
    return F.col("below") + F.col(upto) - F.col(size) / 2 <= F.col("rest")


def source_cuts(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """One row per source: whole copies, and where its ranking is cut.

    Documents in intervals before ``cut`` are sampled; within it those ranked
    before ``last`` (q, doc_id, words up to it) and, of the rows that rank like
    it, those whose size brings the words near enough to ``rest``.
    """
    src = source_targets(sizes, weights, share, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))) \
        .otherwise(0).cast("long")
    src = src.withColumn("whole", whole).withColumn("intervals", F.ceil(F.sqrt("docs"))) \
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")) \
        .withColumnRenamed("source", "src")
    src = saved(src, "mix_sources")
    sums = _ranked(sizes, src).where("q IS NOT NULL").groupBy("src", "bucket") \
        .agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = F.sum("words").over(W.partitionBy("src").orderBy("bucket"))
    cut = sums.withColumn("upto", upto).where("upto > rest") \
        .groupBy("src").agg(F.min(F.struct("bucket", "upto", "words")).alias("c")) \
        .select(F.col("src").alias("csrc"), F.col("c.bucket").alias("cut"),
                (F.col("c.upto") - F.col("c.words")).alias("below"))
    # Stored, so that its size is known before the documents are joined with it.
    plain, src = src, saved(src.join(cut, src["src"].eqNullSafe(cut["csrc"]), "left").drop("csrc"), "mix_cuts")
    run = F.sum("size").over(W.partitionBy("src").orderBy("q", "doc_id")
                             .rangeBetween(W.unboundedPreceding, W.currentRow))
    last = _ranked(sizes, src).where("bucket = cut").withColumn("upto", run).where(_sampled()) \
        .groupBy(F.col("src").alias("lsrc")).agg(F.max(F.struct("q", "doc_id", "upto")).alias("last"))
    out = saved(src.join(last, src["src"].eqNullSafe(last["lsrc"]), "left").drop("lsrc"), "mix_lasts")
    removed(plain, src)
    return out


def _copies(rows: DataFrame, src: DataFrame) -> DataFrame:
    """``rows`` with ``copies``, judged where they are read."""
    rows = _ranked(rows, src).withColumn("upto", F.col("last.upto"))
    here, end = F.struct("q", "doc_id"), F.struct(F.col("last.q").alias("q"), F.col("last.doc_id").alias("doc_id"))
    inside = F.col("last").isNotNull() & ((here < end) | (here == end) & _sampled())
    front = F.col("cut").isNull() | (F.col("bucket") < F.col("cut")) | (F.col("bucket") == F.col("cut")) & inside
    return rows.withColumn("copies", F.col("whole") + F.when(F.col("bucket").isNotNull() & front, 1).otherwise(0))


def allocate(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """doc_id, source, size, source_size, target, copies per row of ``docs``.

    Null texts have size 0; a null source is a source of its own; rows that
    agree in doc_id, source and size get the same copies, as they rank alike.
    Sources without words have target 0 and no copies.
    """
    sizes = saved(_measured(docs), "mix_sizes")
    return _copies(sizes, source_cuts(sizes, weights, share, cap)) \
        .select("doc_id", "source", "size", "source_size", "target", "copies")


def op10_mixing(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return allocate(docs).select("doc_id", "size", "source_size", "target",
                                 (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.

    Each row is judged by its own size, whatever rows share its id; no text is
    shuffled while the table of sources is small enough for a broadcast.
    """
    sizes = saved(_measured(docs), "mix_sizes")
    src = source_cuts(sizes)
    removed(sizes)
    rows = _copies(_measured(docs, F.struct(*docs.columns).alias("row")), src)
    copies = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return rows.where("copies > 0").select("row", F.explode(copies)).select("row.*")


def allocation_sql(docs: str = "documents") -> str:
    """DuckDB SQL of :func:`allocate` over the relation ``docs``."""
    return rf"""
sizes AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    (CAST(CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
      / {float(1 << 52)} AS u FROM {docs}),
sized AS (SELECT *, CAST(length(bin(size)) AS BIGINT) AS g FROM sizes),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(g * size) AS BIGINT) AS gsum
  FROM sized GROUP BY source),
s1 AS (SELECT *, [{', '.join(map(str, WEIGHTS))}][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS INT) + 1]
    AS weight, source_size * {CAP} AS lim FROM s0),
s2 AS (SELECT *, lim / weight AS ratio FROM s1),
s3 AS (SELECT *, ({SHARE}::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT)
    - coalesce(CAST(sum(lim) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))
    / CAST(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
  FROM s2),
s4 AS (SELECT *, max(CASE WHEN level <= ratio THEN level END) OVER () AS top FROM s3),
s5 AS (SELECT source, source_size, gsum,
    CASE WHEN top IS NULL THEN CAST(lim AS DOUBLE) ELSE least(CAST(lim AS DOUBLE), top * weight) END AS target FROM s4),
src AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole,
    target - CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END * source_size AS rest FROM s5),
p AS (SELECT d.*, s.source_size, s.target, s.whole, s.rest, s.rest * d.g / s.gsum AS pi
  FROM sized d JOIN src s ON d.source IS NOT DISTINCT FROM s.source),
ranked AS (SELECT *, CASE WHEN rest <= 0 THEN NULL WHEN pi >= 1 THEN 0.0 ELSE (u / (1 - u)) / (pi / (1 - pi)) END AS q FROM p),
run AS (SELECT *, CAST(sum(CASE WHEN q IS NOT NULL THEN size END) OVER
    (PARTITION BY source ORDER BY q NULLS LAST, doc_id RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto FROM ranked),
allocated AS (SELECT doc_id, source, size, source_size, target,
    whole + CASE WHEN q IS NOT NULL AND upto - size / 2 <= rest THEN 1 ELSE 0 END AS copies FROM run)"""


OP10_SQL = f"""WITH {allocation_sql()}
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken FROM allocated"""
