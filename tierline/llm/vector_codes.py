"""Vector codes: product codebooks whose nearest entries are found by GNATs.

Components become integers floor(SCALE * x) and a vector is cut into ``PARTS``
equal parts; each part position has its own codebook.  It starts as the parts
of the vectors with the smallest ids and is moved ``ROUNDS`` times: every part
goes to its nearest entry, then every entry becomes the floored mean of its
parts; unused entries stay.  All of it is integer arithmetic, so the result
does not depend on how the rows are split.

Nearest entries are found in a geometric near-neighbour access tree over the
entries: a node keeps some of them as split points, gives every other one to
its closest split point, and stores for each pair (split point, child) the
range of distances from that split point to all entries of that child.  With
the best distance r so far, a child is left out if for any split point p its
whole range lies beyond d(query, p) +- r.  Distances to split points, ranges
and r are rounded to whole numbers away from such a decision, and the test is
strict, so an entry that ties is always compared: by exact squared distances,
ties to the lower index.  A task searches many queries at once, each with its
own bounds.

A round is one pass over the table.  Tasks return the sum and the count of
each entry's parts, Spark adds them up, and only the codebooks (``ENTRIES``
rows a part, whatever the table's size) reach the driver and the tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.store import saved

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Split points of a node; nodes of at most twice as many entries are scanned.
DEGREE = 12


def _root_below(square: np.ndarray) -> np.ndarray:
    """Exact floor of the square roots of int64 numbers."""
    r = np.sqrt(square.astype(np.float64)).astype(np.int64)
    r -= r * r > square
    r += (r + 1) * (r + 1) <= square
    return r


def _root_above(square: np.ndarray) -> np.ndarray:
    r = _root_below(square)
    return r + (r * r < square)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` (float64) to those of ``b``.

    Components are integers; as long as all sums stay below 2**53 the float
    product is exact, beyond it integers are used.
    """
    top = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if 4.0 * top * top * a.shape[1] < 2.0**53:
        d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
        return d.astype(np.int64)
    x, y = a.astype(np.int64), b.astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in y], axis=1)


class Gnat:
    """The tree over the rows of ``entries`` (integers held as float64)."""

    def __init__(self, entries: np.ndarray, degree: int = DEGREE):
        self.entries, self.degree, self.compared = entries, degree, 0
        self.root = self._node(np.arange(len(entries)))

    def _node(self, own: np.ndarray):
        if len(own) <= 2 * self.degree:
            return (own, None, None, None)
        # Split points: each next one is the farthest from those chosen.
        pick, far = [0], _squares(self.entries[own], self.entries[own[:1]])[:, 0]
        while len(pick) < self.degree:
            pick.append(int(far.argmax()))
            far = np.minimum(far, _squares(self.entries[own], self.entries[own[pick[-1:]]])[:, 0])
        if len(set(pick)) < self.degree:  # too few different entries to split by
            return (own, None, None, None)
        splits, rest = own[pick], np.delete(own, pick)
        d = _squares(self.entries[rest], self.entries[splits])
        child = d.argmin(1)
        low, high = np.zeros((len(splits), len(splits)), np.int64), np.full((len(splits),) * 2, -1, np.int64)
        nodes = []
        for j in range(len(splits)):
            inside = child == j
            nodes.append(self._node(rest[inside]) if inside.any() else None)
            if inside.any():
                low[:, j] = _root_below(d[inside].min(0))
                high[:, j] = _root_above(d[inside].max(0))
        return (splits, nodes, low, high)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each query's nearest entry."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.full(len(queries), len(self.entries), np.int64)
        self._search(self.root, queries, np.arange(len(queries)), best, index)
        return index, best

    def _search(self, node, queries, who, best, index) -> None:
        own, nodes, low, high = node
        d = _squares(queries[who], self.entries[own])
        self.compared += d.size
        for at in np.argsort(own):  # rising index: a tie keeps the lower one
            closer = (d[:, at] < best[who]) | ((d[:, at] == best[who]) & (own[at] < index[who]))
            best[who[closer]] = d[closer, at]
            index[who[closer]] = own[at]
        if nodes is None:
            return
        below, above = _root_below(d), _root_above(d)
        # Nearest child first: its entries shrink the bound for the others.
        for step in (True, False):
            for j, child in enumerate(nodes):
                if child is None:
                    continue
                turn = (d.argmin(1) == j) == step
                r = _root_above(best[who])
                out = (below - r[:, None] > high[:, j]) | (above + r[:, None] < low[:, j])
                go = turn & ~out.any(1)
                if go.any():
                    self._search(child, queries, who[go], best, index)


def _integers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, their components) of an array column of floats."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return np.zeros(0, np.int64), np.zeros((0, 0))
    off = col.offsets.to_numpy().astype(np.int64)
    size = np.diff(off)
    flat = col.values
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = ~np.isfinite(x) | flat.is_null().to_numpy(zero_copy_only=False)
    ok = col.is_valid().to_numpy(zero_copy_only=False)
    worst = np.concatenate([[0], np.cumsum(bad)])
    ok = ok & (worst[off[1:]] == worst[off[:-1]])
    kept = np.flatnonzero(ok)
    if not len(kept):
        return kept, np.zeros((0, 0))
    width = int(size[kept[0]])
    if (size[kept] != width).any():
        raise ValueError("vectors have different lengths")
    rows = np.floor(SCALE * x[off[kept][:, None] + np.arange(width)])
    if width * 4.0 * np.abs(rows).max(initial=0) ** 2 >= 2.0**62:
        raise ValueError("components are too large for distances in 64 bits")
    return kept, rows


def _parts(rows: np.ndarray, parts: int) -> list[np.ndarray]:
    if rows.shape[1] % parts:
        raise ValueError(f"{rows.shape[1]} components cannot be cut into {parts} equal parts")
    return np.split(rows, parts, axis=1)


#: Queries searched at once.
_BLOCK = 8192


def _blocks(batches):
    """(batch, rows kept, components) of at most ``_BLOCK`` rows each."""
    for b in batches:
        for lo in range(0, b.num_rows, _BLOCK):
            part = b.slice(lo, _BLOCK)
            kept, rows = _integers(part.column("embedding"))
            if len(kept):
                yield part, kept, rows


def first_entries(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """Codebooks from the rows with the smallest ids: at most ``entries`` rows
    reach the driver.  Null ids come last; equal ids are ordered by vector."""
    good = vectors.where(F.col("embedding").isNotNull()).where(F.forall("embedding", lambda x: x.isNotNull()
                         & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = good.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(entries).collect()
    if not rows:
        return []
    x = np.floor(SCALE * np.array([r["embedding"] for r in rows], np.float64))
    return [np.ascontiguousarray(p) for p in _parts(x, parts)]


def _moved(vectors: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round."""
    width, parts = books[0].shape[1], len(books)

    def run(batches):
        trees = [Gnat(b) for b in books]
        sums = [np.zeros((len(b), width), np.int64) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]

        def flush():
            for p in range(parts):
                used = np.flatnonzero(count[p])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)),
                     pa.array(count[p][used]), pa.array(list(sums[p][used]), pa.list_(pa.int64()))],
                    names=["part", "entry", "n", "sums"])
                sums[p][:] = 0
                count[p][:] = 0
        held = 0.0
        for _, _, rows in _blocks(batches):
            largest = np.abs(rows).max(initial=1) * len(rows)
            if held + largest >= 2.0**62:  # before a sum could leave 64 bits
                yield from flush()
                held = 0.0
            held += largest
            for p, x in enumerate(_parts(rows, parts)):
                index, _ = trees[p].nearest(x)
                np.add.at(sums[p], index, x.astype(np.int64))
                count[p] += np.bincount(index, minlength=len(books[p]))
        yield from flush()
    found = vectors.select("embedding").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    total = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    out = [b.copy() for b in books]
    # At most parts * entries rows.
    for r in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total).collect():
        out[r["part"]][r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return out


def codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Fitted codebooks, one array of entries per part position."""
    books = first_entries(vectors, parts, entries)
    for _ in range(rounds if books else 0):
        books = _moved(vectors, books)
    return books


def encoded(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, codes (array), error per kept row of ``vectors``."""
    def run(batches):
        trees = [Gnat(b) for b in books]
        for part, kept, rows in _blocks(batches):
            found = [t.nearest(x) for t, x in zip(trees, _parts(rows, len(books)))]
            codes = np.stack([i for i, _ in found], axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(pa.array(kept)), part.column("label").take(pa.array(kept)),
                 pa.array(list(codes), pa.list_(pa.int32())), pa.array(sum(d for _, d in found))],
                names=["vec_id", "label", "codes", "error"])
    out = T.StructType([vectors.schema["vec_id"], vectors.schema["label"],
                        T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])
    return vectors.select("vec_id", "label", "embedding").mapInArrow(run, out)


def decoded(codes: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``codes`` with ``approx``: the vector that its codes stand for."""
    tables = [F.array(*[F.array(*[F.lit(float(x) / SCALE) for x in e]) for e in b]) for b in books]
    return codes.withColumn("approx", F.concat(*[F.get(t, F.col("codes")[p]) for p, t in enumerate(tables)]))


def books_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """Codes of all vectors with their errors, and those summed per label.

    Rows whose vector is null or holds null or non-finite components are
    dropped; with fewer rows than entries the codebooks are smaller; ids may
    repeat or be null, of any type; null labels are one label; other columns
    are ignored; an empty table gives an empty result.  Vectors of unequal
    length, of a length that four does not divide, or with components whose
    squared distances need more than 62 bits are an error.
    """
    books = codebooks(vectors)
    rows = saved(encoded(vectors, books), "vector_codes") if books else \
        spark.createDataFrame([], encoded(vectors, [np.zeros((1, 1))]).schema)
    # Stored, so that the join's exchanges are its own and a hot label is split.
    sums = saved(rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")),
                 "vector_code_labels")
    hexed = F.concat(*[F.lower(F.lpad(F.hex(F.col("codes")[p]), 2, "0")) for p in range(PARTS)])
    return rows.join(sums, rows["label"].eqNullSafe(sums["_label"])).select(
        "vec_id", hexed.alias("code"), "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))


def _op12_sql() -> str:
    """The definition as SQL: one step per round, all entries compared."""
    near = """SELECT part, vec, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT p.part, p.vec, c.entry, list_sum(list_transform(list_zip(p.v, c.c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d
    FROM parts p JOIN {book} c USING (part)) GROUP BY part, vec"""
    steps = []
    for r in range(ROUNDS):
        steps.append(f"a{r} AS MATERIALIZED ({near.format(book=f'b{r}')})")
        steps.append(f"""m{r} AS MATERIALIZED (SELECT part, entry, list(m ORDER BY i) AS c FROM (
    SELECT a.part, a.entry, i, CAST(floor(sum(p.v[i])::DECIMAL(38, 0) / count(*)) AS BIGINT) AS m
    FROM a{r} a JOIN parts p USING (part, vec), range(1, len(p.v) + 1) AS t(i) GROUP BY a.part, a.entry, i)
    GROUP BY part, entry)""")
        steps.append(f"b{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.c, b.c) AS c "
                     f"FROM b{r} b LEFT JOIN m{r} m USING (part, entry))")
    return f"""WITH kept AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS vec,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] AS v
  FROM kept, range({PARTS}) AS t(part)),
b0 AS MATERIALIZED (SELECT part, vec - 1 AS entry, v AS c FROM parts WHERE vec <= {ENTRIES}),
{', '.join(steps)},
last AS MATERIALIZED ({near.format(book=f'b{ROUNDS}')}),
coded AS (SELECT vec, string_agg(printf('%02x', CAST(entry AS INT)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM last GROUP BY vec),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (vec), digest"""


OP12_SQL = _op12_sql()
