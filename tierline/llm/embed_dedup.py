"""Embedding near-duplicates with a robust-pruned flat graph.

1. Equal vectors are one node.  Centers are fitted on a bounded sample (at
   most ``SAMPLE`` rows and ``SAMPLE_VALUES`` numbers); every node joins the shards of its ``probes`` nearest
   centers, so shards overlap.  Shards beyond ``BLOCK`` nodes are cut in blocks.
2. Per block a neighbour graph is built: nearest nodes and a few random far
   ones are robust-pruned (a candidate goes when a kept one is closer to it,
   by ``ALPHA``, than the node is).  Lists of a node from all its shards are
   united into one flat graph.
3. Every node is searched in its shards: a greedy beam from the shard's
   medoids, which then expands whatever lies within reach of the range until
   nothing new is.  Hits are verified in double precision.
4. Recall is audited against brute force on ``AUDIT`` nodes; below ``RECALL``
   the search is repeated with one more probe and a wider beam, and after
   ``ROUNDS`` rounds all pairs are compared.

Pairs do not leave a task: it returns each node's number of links and its
root in the task's own forest.  A pair met in several shards counts in the
lowest of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.components import components
from tierline.llm.store import removed, saved, width

COSINE = 0.9
SAMPLE = 32_768
SAMPLE_VALUES = 1 << 23
MAX_CENTERS = 4_096
SHARD = 1_000
BLOCK = 3_000
NEAREST, RANDOM, DEGREE, ALPHA = 40, 12, 32, 1.2
BEAM, REACH, STEP = 32, 0.06, 4
AUDIT, RECALL, ROUNDS = 64, 0.95, 3


def _matrix(col: pa.Array) -> np.ndarray:
    flat = pc.list_flatten(col).to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nodes_of(vectors: DataFrame) -> DataFrame:
    """(node, dim, n, vector) per distinct usable vector, n rows holding it.

    Null, empty and zero vectors and those with null or non-finite components
    have no node.
    """
    return _keyed(vectors).where("node IS NOT NULL").groupBy("node").agg(
        F.first("vector").alias("vector"), F.count("*").alias("n")) \
        .select("node", F.size("vector").alias("dim"), "n", "vector")


def _keyed(vectors: DataFrame) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    usable = F.col("embedding").isNotNull() & (F.size("embedding") > 0) \
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists(v, lambda x: x != 0)
    return vectors.select("vec_id", v.alias("vector"),
                          F.when(usable, F.xxhash64(v, F.reverse(v))).alias("node"))


def _centers(nodes: DataFrame) -> dict[int, np.ndarray]:
    """Unit centers per dimension, by a few spherical k-means steps."""
    total, widest = nodes.agg(F.count("*"), F.max("dim")).first()
    rows = min(SAMPLE, SAMPLE_VALUES // max(widest or 1, 1) + 1)
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(rows).select("dim", "vector").toArrow()
    out = {}
    for dim in set(sample.column("dim").to_pylist()):
        x = _unit(_matrix(sample.filter(pc.equal(sample.column("dim"), dim)).column("vector").combine_chunks()))
        share = len(x) / max(1, sample.num_rows)
        k = int(max(1, min(math.ceil(total * share / SHARD), MAX_CENTERS, len(x) // 4 or 1)))
        c = x[np.linspace(0, len(x) - 1, k).astype(int)]
        for _ in range(8):
            near = np.concatenate([(part @ c.T).argmax(1) for part in np.array_split(x, 1 + len(x) // 2048)])
            total_of = np.zeros_like(c)
            np.add.at(total_of, near, x)
            norm = np.sqrt((total_of ** 2).sum(1, keepdims=True))
            c = np.where(norm > 0, total_of / np.maximum(norm, 1e-300), c)
        out[dim] = c
    return out


def _assigned(nodes: DataFrame, centers: dict[int, np.ndarray], probes: int) -> DataFrame:
    """(node, n, vector, shards): the nearest centers as dim * 2^20 + number."""
    def run(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = b.filter(pa.array(dims == dim))
                x = _unit(_matrix(part.column("vector")))
                c = centers.get(int(dim))
                if c is None:  # a length the sample did not meet: one shard
                    near = np.zeros((len(x), 1), np.int64)
                else:
                    p = min(probes, len(c))
                    near = np.argpartition(-(x @ c.T), p - 1, axis=1)[:, :p]
                near = np.sort(near + (int(dim) << 20), axis=1)
                off = np.arange(len(x) + 1, dtype=np.int32) * near.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("n"), part.column("vector"),
                     pa.ListArray.from_arrays(pa.array(off), pa.array(near.ravel(), pa.int64()))],
                    names=["node", "n", "vector", "shards"])
    return nodes.mapInArrow(run, "node long, n long, vector array<double>, shards array<long>")


def _grouped(rows: DataFrame, work, schema: str) -> DataFrame:
    """Run ``work(table)`` on the rows of each ``task``, one at a time."""
    def run(batches):
        held, key = [], None

        def flush():
            return work(pa.Table.from_batches(held)) if held else None
        for b in batches:
            keys = b.column("task").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi == lo:
                    continue
                if held and keys[lo] != key:
                    yield flush()
                    held = []
                key = keys[lo]
                held.append(b.slice(int(lo), int(hi - lo)))
        if held:
            yield flush()
    return rows.repartition(width(rows.sparkSession), "task").sortWithinPartitions("task") \
        .mapInArrow(run, schema)


def robust_graph(x: np.ndarray, seed: int = 1) -> list[np.ndarray]:
    """Neighbour lists of a robust-pruned graph over unit vectors."""
    n = len(x)
    if n == 1:
        return [np.zeros(0, np.int64)]
    near = min(NEAREST, n - 1)
    rng = np.random.default_rng(seed)
    out: list[np.ndarray] = []
    for lo in range(0, n, 512):
        hi = min(n, lo + 512)
        sim = x[lo:hi] @ x.T
        sim[np.arange(hi - lo), np.arange(lo, hi)] = -2
        cand = np.argpartition(-sim, near - 1, axis=1)[:, :near]
        far = rng.integers(0, n, (hi - lo, min(RANDOM, n)))
        cand = np.concatenate([cand, far], axis=1)
        s = np.take_along_axis(sim, cand, 1)
        order = np.argsort(-s, axis=1, kind="stable")
        cand, s = np.take_along_axis(cand, order, 1), np.take_along_axis(s, order, 1)
        own = np.sqrt(np.maximum(2 - 2 * s, 0))
        between = np.einsum("ncd,ned->nce", x[cand], x[cand])
        alive = s > -1.5
        kept = np.zeros_like(alive)
        for c in range(cand.shape[1]):
            take = alive[:, c] & (kept.sum(1) < DEGREE)
            kept[:, c] = take
            apart = np.sqrt(np.maximum(2 - 2 * between[:, c, :], 0))
            alive &= ~(take[:, None] & (ALPHA * apart <= own))
        out += [np.unique(cand[i][kept[i]]) for i in range(hi - lo)]
    back: list[list[int]] = [[] for _ in range(n)]
    for i, ns in enumerate(out):
        for j in ns:
            back[j].append(i)
    return [np.union1d(a, np.array(b[:DEGREE], np.int64)) for a, b in zip(out, back)]


def _medoids(x: np.ndarray) -> np.ndarray:
    """The node nearest to the mean, and one per few rough clusters."""
    whole = int((x @ x.mean(0)).argmax())
    k = min(len(x), 1 + int(math.sqrt(len(x)) / 4))
    seeds = x[np.linspace(0, len(x) - 1, k).astype(int)]
    near = (x @ seeds.T).argmax(1)
    found = [whole]
    for c in range(k):
        at = np.flatnonzero(near == c)
        if len(at):
            found.append(int(at[(x[at] @ x[at].mean(0)).argmax()]))
    return np.unique(found)


def range_search(x: np.ndarray, adj: list[np.ndarray], q: np.ndarray, cosine: float, beam: int) -> np.ndarray:
    """Boolean (queries, nodes): nodes met with at least about the cosine."""
    n, m = len(x), len(q)
    width_of = max(1, max((len(a) for a in adj), default=1))
    table = np.full((n, width_of), n, np.int64)  # n: no neighbour
    for i, a in enumerate(adj):
        table[i, :len(a)] = a
    x32 = np.concatenate([x, np.zeros((1, x.shape[1]))]).astype(np.float32)
    q32 = q.astype(np.float32)
    sim = np.full((m, n + 1), -9, np.float32)
    done = np.zeros((m, n + 1), bool)
    done[:, n] = True
    start = _medoids(x)
    sim[:, start] = q32 @ x32[start].T
    live = np.arange(m)
    while len(live):
        s = np.where(done[live], -9, sim[live])
        step = min(STEP, n)
        best = np.argpartition(-s, step - 1, axis=1)[:, :step]
        value = np.take_along_axis(s, best, 1)
        if n > beam:
            bar = -np.partition(-sim[live, :n], beam - 1, axis=1)[:, beam - 1]
        else:
            bar = np.full(len(live), -9, np.float32)
        go = (value > -5) & ((value >= bar[:, None]) | (value >= cosine - REACH))
        some = go.any(1)
        live, best, go = live[some], best[some], go[some]
        if not len(live):
            break
        r, c = np.nonzero(go)
        rows, hubs = live[r], best[r, c]
        done[rows, hubs] = True
        near = table[hubs]
        rr = np.repeat(rows, width_of)
        nn = near.ravel()
        new = (nn < n) & (sim[rr, nn] < -5)
        rr, nn = rr[new], nn[new]
        for lo in range(0, len(rr), 1 << 16):
            a, b = rr[lo:lo + (1 << 16)], nn[lo:lo + (1 << 16)]
            sim[a, b] = np.einsum("ij,ij->i", q32[a], x32[b])
    return sim[:, :n] >= cosine - 1e-3


def _build(tasks: DataFrame) -> DataFrame:
    """(node, near) per task row."""
    def work(t: pa.Table):
        ids = t.column("node").to_numpy()
        order = np.argsort(ids)
        x = _unit(_matrix(t.column("vector").combine_chunks()))[order]
        ids = ids[order]
        adj = robust_graph(x)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array([ids[a] for a in adj], pa.list_(pa.int64()))], names=["node", "near"])
    return _grouped(tasks.select("task", "node", "vector"), work, "node long, near array<long>")


def _lowest_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lowest number in both of two rows; a pair counts in that shard."""
    both = (a[:, :, None] == b[:, None, :]).any(2)
    return np.where(both, a, np.iinfo(np.int64).max).min(1)


def _least_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per node 0..n-1 the least one reachable by the links a-b: the ends of
    a link hook the larger of their roots onto the smaller, until none does."""
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    return root


def _search(tasks: DataFrame, cosine: float, beam: int | None) -> DataFrame:
    """(node, links, root) per query row of a task; no beam: all pairs."""
    def work(t: pa.Table):
        order = np.argsort(t.column("node").to_numpy(), kind="stable")
        t = t.take(pa.array(order))
        ids, n = t.column("node").to_numpy(), t.column("n").to_numpy()
        x = _unit(_matrix(t.column("vector").combine_chunks()))
        is_node, is_query = (t.column(c).to_numpy(zero_copy_only=False) for c in ("is_node", "is_query"))
        shard = t.column("shard")[0].as_py()
        # All vectors of a shard have as many shards.
        shards = pc.list_flatten(t.column("shards")).to_numpy().reshape(len(ids), -1)
        v, q = np.flatnonzero(is_node), np.flatnonzero(is_query)
        adj = []
        near = t.column("near").to_pylist()
        for i in v:
            a = np.array(near[i] or [], np.int64)
            at = np.searchsorted(ids[v], a)
            at[at == len(v)] = 0
            adj.append(at[ids[v][at] == a])
        met = x[q] @ x[v].T >= cosine - 1e-9 if beam is None else range_search(x[v], adj, x[q], cosine, beam)
        if len(v) == len(q) and (v == q).all():
            met |= met.T
        a, b = np.nonzero(met)
        exact = np.zeros(len(a), bool)
        for lo in range(0, len(a), 1 << 16):
            i, j = q[a[lo:lo + (1 << 16)]], v[b[lo:lo + (1 << 16)]]
            exact[lo:lo + (1 << 16)] = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
        a, b = q[a[exact]], v[b[exact]]
        other = ids[a] != ids[b]
        a, b = a[other], b[other]
        mine = np.concatenate([np.zeros(0, bool), *(
            _lowest_common(shards[a[lo:lo + (1 << 16)]], shards[b[lo:lo + (1 << 16)]]) == shard
            for lo in range(0, len(a), 1 << 16))])
        links = np.bincount(a[mine], weights=n[b[mine]], minlength=len(ids)).astype(np.int64)
        root = ids[_least_reachable(len(ids), a, b)]
        keep = is_query | (root != ids)
        return pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(links[keep]), pa.array(root[keep])],
                                          names=["node", "links", "root"])
    return _grouped(tasks, work, "node long, links long, root long")


def _round(nodes: DataFrame, centers: dict, probes: int, cosine: float, exact: bool = False) -> DataFrame:
    placed = saved(_assigned(nodes, centers, probes), "embed_assigned")
    member = placed.select("node", F.explode("shards").alias("shard"))
    blocks = member.groupBy("shard").count() \
        .select("shard", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    inside = placed.select("*", F.explode("shards").alias("shard")).join(blocks, "shard") \
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    done = [placed]
    if exact:
        inside = inside.withColumn("near", F.lit(None).cast("array<long>"))
    else:
        graph = _build(inside.withColumn("task", F.xxhash64("shard", "block"))) \
            .groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        done.append(saved(graph, "embed_graph"))
        inside = inside.join(done[-1], "node")
    # One task per (block of nodes, block of queries) of a shard.
    pairs = inside.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    both = F.col("other") == F.col("block")
    as_node = pairs.select(F.xxhash64("shard", "block", "other").alias("task"), "shard", "node", "n", "vector",
                           "shards", "near", F.lit(True).alias("is_node"), both.alias("is_query"))
    as_query = pairs.where(~both).select(
        F.xxhash64("shard", "other", "block").alias("task"), "shard", "node", "n", "vector", "shards",
        F.lit(None).cast("array<long>").alias("near"), F.lit(False).alias("is_node"), F.lit(True).alias("is_query"))
    found = saved(_search(as_node.unionAll(as_query), cosine, None if exact else BEAM * (probes - 1)), "embed_found")
    removed(*done)
    return found


def audit(nodes: DataFrame, found: DataFrame, cosine: float = COSINE, sample: int = AUDIT) -> float:
    """Share of the links of ``sample`` nodes, by brute force over all nodes,
    that ``found`` (node, links) has: of all their links, or the mean of the
    nodes' own shares if that is less, so that a large group does not hide the
    others.  The sample is a fixed number of rows."""
    q = nodes.orderBy(F.xxhash64("node", F.lit(7)), "node").limit(sample).toArrow()
    ids, dims = q.column("node").to_numpy(), q.column("dim").to_numpy()
    by_dim = {int(d): (ids[dims == d], _unit(_matrix(q.filter(pa.array(dims == d)).column("vector").combine_chunks())))
              for d in np.unique(dims)}

    def run(batches):
        for b in batches:
            dims_of = b.column("dim").to_numpy()
            for d in np.unique(dims_of):
                if int(d) not in by_dim:
                    continue
                qi, qx = by_dim[int(d)]
                part = b.filter(pa.array(dims_of == d))
                near = qx @ _unit(_matrix(part.column("vector"))).T >= cosine
                near &= qi[:, None] != part.column("node").to_numpy()[None, :]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qi), pa.array((near * part.column("n").to_numpy()).sum(1))], names=["node", "want"])
    want = nodes.mapInArrow(run, "node long, want long").groupBy("node").agg(F.sum("want").alias("want"))
    got = found.groupBy("node").agg(F.sum("links").alias("got"))
    r = want.join(got, "node", "left").where("want > 0").agg(
        F.sum("want"), F.sum("got"), F.avg(F.coalesce("got", F.lit(0)) / F.col("want"))).first()
    return 1.0 if not r[0] else min((r[1] or 0) / r[0], r[2])


def op6_embedding_dedup(spark: SparkSession, vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``vectors``.

    Unusable vectors (see nodes_of) link with nothing, and so do vectors of
    different lengths.  Rows with equal vectors link; rows that repeat a
    vec_id each appear with the links of their own vector.  A null vec_id has
    links, but names no component unless it is alone (component_id null, kept).
    """
    keyed = _keyed(vectors)
    nodes = saved(nodes_of(vectors), "embed_nodes")
    centers = _centers(nodes)
    for probes in range(2, 2 + ROUNDS):
        found = _round(nodes, centers, probes, cosine)
        if audit(nodes, found, cosine) >= RECALL:
            break
        removed(found)
    else:  # one shard per length, its blocks met pair by pair
        found = _round(nodes, {}, 1, cosine, exact=True)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("root <> node").select(F.col("node").alias("a"), F.col("root").alias("b")),
                       "embed_components")
    ids = keyed.where("node IS NOT NULL").groupBy("node").agg(F.min("vec_id").alias("low"))
    home = nodes.select("node", "n").join(links, "node", "left").join(ids, "node") \
        .join(roots.withColumnRenamed("id", "node"), "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    least = home.groupBy("root").agg(F.min("low").alias("component_id"))
    home = home.join(least, "root").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = keyed.join(home, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
