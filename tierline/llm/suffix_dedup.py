"""Suffix-array removal of byte strings that occur more than once.

A window is a ``LENGTH``-byte string at some start.  Sorting every suffix of
the corpus by its first 400 bytes would move hundreds of times the corpus, so
only synchronised suffixes are sorted:

1. *Anchors.*  Every window has an anchor, the leftmost of the least hashes of
   its ``GRAM``-byte grams; equal windows have it at the same place.  One
   anchor serves a run of neighbouring windows, about one in 150 bytes.  An
   anchor whose gram occurs only once, or only at one place of copies of one
   text, has no repeated window of its own and is dropped.
2. *Ranges.*  Around each remaining anchor the bytes its windows span go to a
   range of anchor suffixes: the suffix's leading bytes are the range key and
   Spark's sampled splitters cut the ranges, with a hash as tie-breaker so
   that a gram which very many documents share spreads over many ranges.
3. *Buckets.*  A task sorts its anchor suffixes, and the reversed prefixes
   before the anchors, by multikey quicksort on 8-byte characters.  For every
   distance d of a window's start before its anchor, windows are equal if
   their suffixes share 400 - d bytes and their prefixes d bytes: both are
   blocks of the two sorted orders.
4. *Boundaries.*  The first and last gram of a bucket may go on in the next
   one.  Windows of those grams leave the bucket once each as a digest; those
   digests are counted across buckets.

Copies of one text are found by digest first: if it has a window at all, all
of it is repeated.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.store import saved, width
from tierline.llm.textbytes import byte_codes, column_bytes, mix, pieces, powers, prefix_sums

LENGTH = 400
GRAM = 100
#: Bytes of context that one range is meant to hold.
RANGE_BYTES = 16 << 20
#: Longer documents are hashed in stretches of this size.
STRETCH = 2 << 20
#: Low bits that hold a position inside a stretch.
_PLACE = np.uint64(22)


def _sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours (block-wise running minima)."""
    n = len(x) - w + 1
    pad = -len(x) % w
    top = np.iinfo(np.uint64).max
    blocks = np.concatenate([x, np.full(pad, top, np.uint64)]).reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


def anchors(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Runs of window starts with one anchor, for the documents of a piece.

    Returns arrays (document, gram hash, anchor, first start, last start),
    positions counted in the document's bytes.
    """
    n, span = len(data), length - gram + 1
    out = [[] for _ in range(5)]
    for lo in range(0, max(n - length + 1, 0), STRETCH):
        hi = min(n, lo + STRETCH + length - 1)
        part = data[lo:hi]
        if len(part) < length:
            break
        up, down = powers(len(part))
        sums = prefix_sums(byte_codes()[part], up)
        g = mix((sums[gram:] - sums[:-gram]) * down[:len(part) - gram + 1])
        # High bits order the grams, the position breaks ties to the left.
        key = ((g >> _PLACE) << _PLACE) | np.arange(len(g), dtype=np.uint64)
        least = _sliding_least(key, span)
        at = (least & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64)
        start = np.arange(len(at))
        doc = np.searchsorted(off, lo + start, "right") - 1
        ok = lo + start + length <= off[doc + 1]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | (ok[1:] != ok[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        keep = ok[first]
        first, last = first[keep], last[keep]
        d, base = doc[first], off[doc[first]] - lo
        for o, v in zip(out, (d, g[at[first]], at[first] - base, first - base, last - base)):
            o.append(v)
    kinds = (np.int64, np.uint64, np.int64, np.int64, np.int64)
    return [np.concatenate(o) if o else np.zeros(0, k) for o, k in zip(out, kinds)]


def _anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(row, copy, gram, places) per anchor; places: anchor, first, last."""
    def run(batches):
        for b in batches:
            data, off = column_bytes(b.column("text"))
            rows = b.column("row").to_numpy()
            copy = b.column("copy").to_numpy()
            for i, j in pieces(off):
                d, g, at, a, z = anchors(data[off[i]:off[j]], off[i:j + 1] - off[i], length, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[i:j][d]), pa.array(copy[i:j][d]), pa.array(g.view(np.int64)),
                     pa.array(at), pa.array((at - a).astype(np.int32)), pa.array((at - z).astype(np.int32))],
                    names=["row", "copy", "gram", "at", "most", "least"])
    return docs.select("row", "copy", "text").mapInArrow(
        run, "row long, copy long, gram long, at long, most int, least int")


def multikey_order(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of rows of fixed-width characters.

    ``chars``: (rows, depth) uint64, rows compared left to right.  Every group
    of rows that are equal so far is split in three around a pivot character;
    the middle part moves one character deeper.  All groups take a step
    together, so a step is a few vector operations over the unsorted rows.
    Returns the order and, per sorted row, how many leading characters it
    shares with the row before it.
    """
    n, depth = chars.shape
    order, shared = np.arange(n), np.zeros(n, np.int64)
    start, size = np.array([0]), np.array([n])
    level = np.array([0])
    while True:
        full = level == depth
        for lo, m in zip(start[full], size[full]):
            shared[lo + 1:lo + m] = depth
        open_ = ~full & (size > 1)
        start, size, level = start[open_], size[open_], level[open_]
        if not len(start):
            return order, shared
        group = np.repeat(np.arange(len(start)), size)
        pos = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size) + start[group]
        rows = order[pos]
        c = chars[rows, level[group]]
        pivot = chars[order[start + size // 2], level]
        side = (c > pivot[group]).astype(np.int64) - (c < pivot[group]) + 1
        key = group * 3 + side
        inner = np.argsort(key, kind="stable")
        order[pos] = rows[inner]
        key = key[inner]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        of = key[first] // 3
        cut = np.flatnonzero(np.diff(of, prepend=-1) == 0)
        shared[pos[first[cut]]] = level[of[cut]]
        start, size = pos[first], np.diff(np.append(first, len(key)))
        level = level[of] + (key[first] % 3 == 1)


def _matrix(parts: list[np.ndarray], size: int) -> np.ndarray:
    """Byte strings as rows of big-endian 8-byte characters, zero-padded."""
    depth = -(-size // 8)
    out = np.zeros((len(parts), depth * 8), np.uint8)
    for i, p in enumerate(parts):
        out[i, :len(p)] = p[:depth * 8]
    return out.view(">u8").astype(np.uint64)


def _shared_bytes(chars: np.ndarray, order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Shared leading bytes of neighbours in sorted order."""
    depth = chars.shape[1]
    out = shared * 8
    inner = np.flatnonzero((shared < depth) & (np.arange(len(order)) > 0))
    if len(inner):
        x = chars[order[inner], shared[inner]] ^ chars[order[inner - 1], shared[inner]]
        same = np.zeros(len(inner), np.int64)
        for k in range(7):
            same[(x >> np.uint64(56 - 8 * k)) == 0] = k + 1
        out[inner] += same
    return out


def repeated_windows(contexts: list[np.ndarray], most: np.ndarray, least: np.ndarray,
                     length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Which windows occur more than once among the given contexts.

    Context i holds the bytes from ``most[i]`` before its anchor on; its
    windows start d bytes before the anchor, least[i] <= d <= most[i].
    Returns (repeated, stand-in): boolean (contexts, length - gram + 1) by d,
    and the first window of each set of equal ones.
    """
    n, span = len(contexts), length - gram + 1
    flag, lead = np.zeros((n, span), bool), np.zeros((n, span), bool)
    right = _matrix([c[m:] for c, m in zip(contexts, most)], length)
    r_order, r_shared = multikey_order(right)
    r_bytes = _shared_bytes(right, r_order, r_shared)
    del right
    left = _matrix([c[:m][::-1] for c, m in zip(contexts, most)], span - 1)
    l_order, l_shared = multikey_order(left)
    l_bytes = _shared_bytes(left, l_order, l_shared)
    del left
    for d in range(span):
        live = (least <= d) & (d <= most)
        if not live.any():
            continue
        r_id, l_id = np.empty(n, np.int64), np.empty(n, np.int64)
        r_id[r_order] = np.cumsum(r_bytes < length - d)
        l_id[l_order] = np.cumsum(l_bytes < d)
        at = np.flatnonzero(live)
        key = r_id[at] * (n + 2) + l_id[at]
        inner = np.argsort(key, kind="stable")
        key, at = key[inner], at[inner]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        size = np.diff(np.append(np.flatnonzero(new), len(key)))
        flag[at, d] = np.repeat(size > 1, size)
        lead[at[new], d] = True
    return flag, lead


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    """[a, b) runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


_FOUND = "row long, first long, last long, digest binary"


def _compare_ranges(contexts: DataFrame, length: int, gram: int, parts: int) -> DataFrame:
    """Per range: repeated window runs (row, first, last), and for windows
    that may go on in a neighbouring range (row, first, last, digest)."""
    dealt = contexts.repartitionByRange(parts, "lead", "salt")

    def run(batches):
        rows, at, most, least, body = [], [], [], [], []
        for b in batches:
            rows.append(b.column("row").to_numpy())
            at.append(b.column("at").to_numpy())
            most.append(b.column("most").to_numpy())
            least.append(b.column("least").to_numpy())
            body += [np.frombuffer(x, np.uint8) for x in b.column("body").to_pylist()]
        if not body:
            return
        rows, at, most, least = (np.concatenate(x).astype(np.int64) for x in (rows, at, most, least))
        flag, lead = repeated_windows(body, most, least, length, gram)
        grams = [body[i][most[i]:most[i] + gram].tobytes() for i in range(len(body))]
        edge = {min(grams), max(grams)}
        out = [[], [], [], []]

        def put(*values):
            for o, v in zip(out, values):
                o.append(v)
        for i in range(len(body)):
            for a, b in _spans(flag[i]):  # d in [a, b): starts at - b + 1 .. at - a
                put(rows[i], at[i] - b + 1, at[i] - a, None)
            if grams[i] in edge:
                for d in np.flatnonzero(lead[i] | ~flag[i]):
                    if least[i] <= d <= most[i]:
                        s = most[i] - d
                        digest = hashlib.blake2b(body[i][s:s + length].tobytes(), digest_size=16).digest()
                        put(rows[i], at[i] - d, at[i] - d, digest)
            if len(out[0]) >= 50_000:
                yield _found(out)
                out = [[], [], [], []]
        yield _found(out)

    def _found(out):
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
             pa.array(out[3], pa.binary())], names=["row", "first", "last", "digest"])
    return dealt.mapInArrow(run, _FOUND)


def _contexts(docs: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """Bytes around each anchor; places: (row, places array)."""
    joined = docs.select("row", "text").join(places, "row")

    def run(batches):
        for b in batches:
            data, off = column_bytes(b.column("text"))
            out = [[], [], [], [], [], []]
            for i, (row, ps) in enumerate(zip(b.column("row").to_pylist(), b.column("places").to_pylist())):
                text = data[off[i]:off[i + 1]]
                for p in ps:
                    at, most, least = p["at"], p["most"], p["least"]
                    body = text[at - most:at - least + length].tobytes()
                    lead = body[most:most + GRAM]
                    for o, v in zip(out, (row, at, most, least, lead, body)):
                        o.append(v)
                if len(out[0]) >= 4096:
                    yield batch(out)
                    out = [[], [], [], [], [], []]
            yield batch(out)

    def batch(out):
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds)],
                                          names=["row", "at", "most", "least", "lead", "body"])
    return joined.mapInArrow(
        run, "row long, at long, most int, least int, lead binary, body binary") \
        .withColumn("salt", F.xxhash64("body", "row"))


def repeated_runs(docs: DataFrame, extra: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(row, first, last): runs of starts of repeated windows.

    ``docs``: (row, copy, text), row unique, copy equal for equal texts;
    ``extra``: (row) of texts that another row stands for.
    """
    found = saved(_anchor_rows(docs, length, gram), "suffix_anchors")
    place = F.xxhash64("copy", "at")
    # Stored, so that both sides of the join are plain exchanges and the
    # anchors of a gram that very many documents share can be split.
    twice = saved(found.groupBy("gram").agg(F.min(place).alias("a"), F.max(place).alias("b"))
                  .where("a <> b").select("gram"), "suffix_grams")
    live = found.join(twice, "gram", "left_semi").join(extra, "row", "left_anti")
    places = live.groupBy("row").agg(F.collect_list(F.struct("at", "most", "least")).alias("places"))
    context = saved(_contexts(docs, places, length), "suffix_contexts")
    size = context.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = max(width(docs.sparkSession), -(-size // RANGE_BYTES))
    hits = saved(_compare_ranges(context, length, gram, parts), "suffix_hits")
    runs = hits.where("digest IS NULL").select("row", "first", "last")
    edge = hits.where("digest IS NOT NULL")
    over = edge.groupBy("digest").count().where("count > 1").select("digest")
    across = edge.join(over, "digest", "left_semi").select("row", "first", "last")
    return runs.unionAll(across)


_OUT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def _cut(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """Apply the runs to the texts."""
    marks = runs.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(_OUT).fields])

    def run(batches):
        for b in batches:
            data, off = column_bytes(b.column("text"))
            out = []
            for i, (rs, whole) in enumerate(zip(b.column("runs").to_pylist(), b.column("whole").to_pylist())):
                text = data[off[i]:off[i + 1]]
                n = len(text)
                if whole:
                    spans = [(0, n)]
                elif rs:
                    cover = np.zeros(n + 1, np.int32)
                    for r in rs:
                        cover[r["first"]] += 1
                        cover[r["last"] + length] -= 1
                    spans = _spans(np.cumsum(cover[:n]) > 0)
                else:
                    spans = []
                kept, at = hashlib.sha256(), 0
                for a, z in spans:
                    kept.update(text[at:a].tobytes())
                    at = z
                kept.update(text[at:].tobytes())
                out.append((n, sum(z - a for a, z in spans), len(spans), kept.hexdigest(),
                            [{"start": a, "end": z} for a, z in spans]))
            cols = list(zip(*out)) if out else [[]] * 5
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), span)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")] + [pa.array(list(c), k) for c, k in zip(cols, kinds)],
                names=[f.name for f in schema.fields])
    return docs.join(marks, "row", "left").select("doc_id", "text", "whole", "runs").mapInArrow(run, schema)


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans per row.

    Every byte covered by a ``length``-byte string that also starts elsewhere,
    in the same or another row, is removed; strings are judged on the input.
    A null text is empty and keeps the digest of nothing; rows that repeat
    whole are copies of each other; other columns are never read.  Rows are
    numbered once and stored with their numbers: a later job may split the
    input in another way.
    """
    base = saved(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                             F.monotonically_increasing_id().alias("row")), "suffix_rows")
    light = saved(base.select("row", F.sha2(F.col("text").cast("binary"), 256).alias("sha"),
                              F.octet_length("text").alias("n")), "suffix_digests")
    same = light.groupBy("sha", "n").agg(F.min("row").alias("one"), F.count("*").alias("c")) \
        .where((F.col("c") > 1) & (F.col("n") >= length))
    # Stored, so that both sides of the join are plain exchanges and the rows
    # of a text with very many copies can be split.
    same = saved(same, "suffix_texts")
    copies = light.join(same, ["sha", "n"]).select("row", (F.col("row") == F.col("one")).alias("one"))
    copies = saved(copies, "suffix_copies")
    text = base.withColumn("copy", F.xxhash64("text", F.md5("text")))
    runs = repeated_runs(text, copies.where("NOT one").select("row"), length, gram)
    marked = base.join(copies.select("row", F.lit(True).alias("whole")), "row", "left")
    return _cut(marked, runs, length)


def op1_suffix_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return dedup(docs)
