"""N-gram Jaccard join with signature trees.

Documents are sets of word shingles; two sets link when
``100 * |A & B| >= percent * |A | B|``.

1. *Sets that may link.*  A linked set shares at least ``percent`` of its
   shingles with another one.  Shingles are counted over all sets; a set that
   holds fewer shared ones links with nothing and goes no further, so long
   texts that meet in some chance shingles connect nobody.
2. *Routing.*  Linked sets of sizes a <= b differ in at most
   ``d = a * (100 - percent) / percent`` shingles.  The shingle space is hashed
   into a little more than d parts, and every set gives a key per part it has
   shingles in.  Shingles that very many documents share are left out here
   (that makes no set differ more), so a common passage connects nobody.  If
   one of two linked sets has shingles in more than d parts, some part of it is
   equal in both, and they share a key.  A set with no more than d such parts
   also gives the front of its shingles in a fixed order, common ones last, as
   keys; two of these share a shingle of their fronts (prefix filtering).  Sets
   that share a key are connected into candidate groups: no link is lost.
3. *Trees.*  Inside a candidate group the fronts are taken again, now by the
   number of the group's sets that hold a shingle, rarest first: sets without a
   shingle in common there are parted.  Each part is joined by a signature tree: leaves hold a
   few sets, every node the OR of their token bitmaps and their size range.
   A dual traversal drops node pairs whose size ranges, or whose largest
   possible overlap (common bits plus the collisions inside one set), cannot
   reach the threshold, and pairs already known to be connected.  What remains
   is verified on the full shingle sets.
4. *Large groups* are cut by set size.  Linked sets lie at most one size band
   apart, so each two neighbouring bands that fit a block are joined as a task
   of their own, and a set goes to two tasks.  Bands that do not fit are cut
   into blocks: these are joined alone first, under two independent cuts;
   afterwards only sets outside the largest component meet the other blocks of
   like sizes.  Nothing is capped.

Equal sets are represented once.  Only spanning links leave a task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.components import components
from tierline.llm.store import removed, saved, width
from tierline.llm.textbytes import column_bytes, mix, pieces, shingles, word_hashes

PERCENT = 90
WORDS = 3
#: Shingles (8 bytes each) that one block of a candidate group may hold.
BLOCK_TOKENS = 1 << 23
#: Text whose routing keys a task combines before it sends them.
RUN_BYTES = 8 << 20
#: Bits by which shingles are told apart when they are counted.
KEY_BITS = 48
#: Rows of counts that a task holds before it adds them up.
COUNTS = 1 << 20
#: A shingle is common from this share of the documents on; at most so many.
COMMON, COMMON_MOST = 1 / 1000, 1 << 20
_CLASS_RATIO = 1.5
_LEAF = 16


def size_classes(top: int = 1 << 40) -> np.ndarray:
    """Ascending lower bounds of the size classes: 1, 2, 3, 4, 6, 9, ..."""
    lows = [1]
    while lows[-1] < top:
        lows.append(max(lows[-1] + 1, int(lows[-1] * _CLASS_RATIO)))
    return np.array(lows)


def _routing_keys(doc, tok, n_docs, percent, hot):
    """(document, key) rows of step 1, for a document's size class and the
    classes below that a partner can be of."""
    lows = size_classes()
    count = np.bincount(doc, minlength=n_docs)
    own = np.searchsorted(lows, count, "right") - 1
    at = np.searchsorted(hot, tok)
    at[at == len(hot)] = 0
    common = hot[at] == tok if len(hot) else np.zeros(len(tok), bool)
    out_doc, out_key = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for below in range(len(lows)):
        c = own - below
        # In a class below only while a partner of that class can exist.
        live = (count > 0) & (c >= 0)
        if below:
            live &= percent * count <= 100 * (lows[c + 1] - 1)
        if not live.any():
            break
        differ = ((lows[c + 1] - 1) * (100 - percent)) // percent
        salt = mix(c.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1))
        at = np.flatnonzero(live[doc] & ~common)
        d, t = doc[at], tok[at]
        m = differ[d] + 3 + differ[d] // 8
        part = mix(t ^ np.uint64(0x5BD1E995)) % m.astype(np.uint64)
        order = np.lexsort((part, d))
        d, part, t = d[order], part[order], mix(t[order])
        first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (part[1:] != part[:-1])]) if len(d) else d
        key = np.add.reduceat(t, first) if len(d) else t
        d, part = d[first], part[first]
        out_doc.append(d)
        out_key.append(mix(mix(key) + part * np.uint64(0x9E3779B97F4A7C15) + salt[d]))
        short = live & (np.bincount(d, minlength=n_docs) <= differ)
        at = np.flatnonzero(short[doc])
        order = at[np.lexsort((mix(tok[at]), common[at], doc[at]))]
        d = doc[order]
        place = np.arange(len(d)) - np.searchsorted(d, d)
        front = place <= count[d] + (-percent * count[d]) // 100
        out_doc.append(d[front])
        out_key.append(mix(mix(tok[order[front]] + np.uint64(0x2545F4914F6CDD1D)) + salt[d[front]]))
    d, k = np.concatenate(out_doc), np.concatenate(out_key)
    order = np.argsort(d, kind="stable")
    return d[order], k[order]


def _set_hash(doc, tok, n_docs):
    """A 64-bit hash of each document's set; 0 for the empty set."""
    count = np.bincount(doc, minlength=n_docs)
    total = np.zeros(n_docs, np.uint64)
    if len(doc):
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        total[doc[first]] = np.add.reduceat(mix(tok + np.uint64(0x632BE59BD9B4E019)), first)
    out = mix(total + count.astype(np.uint64))
    out[count == 0] = 0
    return out.view(np.int64), count


def set_ids(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, set_id) per row; empty sets have set_id 0."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_shingles", T.LongType()),
                           T.StructField("set_id", T.LongType())])

    def run(batches):
        for b in batches:
            data, off = column_bytes(b.column("text"))
            for i, j in pieces(off):
                n = j - i
                doc, w = word_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i], "space")
                d, t = shingles(doc, w, n, words)
                sid, count = _set_hash(d, t, n)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, n), pa.array(count.astype(np.int64)), pa.array(sid)],
                    names=["doc_id", "n_shingles", "set_id"])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def common_shingles(docs: DataFrame, n_docs: int, n_total: int, words: int) -> np.ndarray:
    """Shingles of more than a ``COMMON`` share of all documents, sorted.

    Runs of text report shingles that at least three of their documents hold;
    the reports are summed.  At most ``COMMON_MOST`` come to the driver, as a
    shingle must hold that share of all shingles.  They only steer the
    routing: any choice of them gives the same links.
    """
    least = max(n_docs * COMMON, n_total / COMMON_MOST, 3)

    def run(batches):
        held, size = [], 0

        def report():
            t, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= 3
            return pa.RecordBatch.from_arrays([pa.array(t[often].view(np.int64)), pa.array(n[often])],
                                              names=["t", "n"])
        for b in batches:
            data, off = column_bytes(b.column("text"))
            for i, j in pieces(off):
                doc, w = word_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i], "space")
                held.append(shingles(doc, w, j - i, words)[1])
                size += int(off[j] - off[i])
                if size >= RUN_BYTES:
                    yield report()
                    held, size = [], 0
        if held:
            yield report()
    found = docs.select("text").mapInArrow(run, "t long, n long").groupBy("t") \
        .agg(F.sum("n").alias("n")).where(F.col("n") > least).select("t").toArrow()
    return np.sort(found.column("t").to_numpy().view(np.uint64)) if found.num_rows else np.zeros(0, np.uint64)


def shared_counts(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(set_id, n_shared): how many shingles of a set other sets hold too, or
    a number above that; sets without one may be missing.

    A task sends each shingle once, to the range it falls in: with its set, or
    with 0 if sets of the same run of ``RUN_BYTES`` share it, which then know it
    already.  So a shingle of very many documents costs a range one entry per
    run.  Shingles are told apart by ``KEY_BITS`` bits; what is taken for shared
    by mistake, or counted for two copies of a text, only lets a set go further.
    """
    ranges = width(docs.sparkSession)
    step = np.uint64((1 << KEY_BITS) // ranges + 1)

    def send(held):
        sid = np.concatenate([s for _, _, s in held])
        first = np.cumsum([0] + [len(s) for _, _, s in held])
        doc = np.concatenate([d + n for (d, _, _), n in zip(held, first)])
        tok = np.concatenate([t for _, t, _ in held]) >> np.uint64(64 - KEY_BITS)
        once = np.zeros(len(sid), bool)
        once[np.unique(sid, return_index=True)[1]] = True
        doc, tok = doc[once[doc]], tok[once[doc]]
        order = np.argsort(tok, kind="stable")
        doc, tok = doc[order], tok[order]
        new = np.flatnonzero(np.r_[True, tok[1:] != tok[:-1]]) if len(tok) else order
        n = np.diff(np.r_[new, len(tok)])
        keys, sets = tok[new], np.where(n == 1, sid[doc[new]], 0)
        own = np.bincount(doc[np.repeat(n > 1, n)], minlength=len(sid))
        cut = np.searchsorted(keys // step, np.arange(ranges + 1))
        full = [r for r in range(ranges) if cut[r + 1] > cut[r]]
        rows = [(r, _pack(keys[cut[r]:cut[r + 1]], sets[cut[r]:cut[r + 1]])) for r in full]
        seen = np.flatnonzero(own)
        blob = np.c_[sid[seen], own[seen]].tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([r for r, _ in rows] + full[:1], pa.int32()),
             pa.array([x for _, x in rows] + [None] * len(full[:1]), pa.binary()),
             pa.array([None] * len(rows) + [blob] * len(full[:1]), pa.binary())],
            names=["range", "keys", "counts"])

    def collect(batches):
        held, size = [], 0
        for b in batches:
            data, off = column_bytes(b.column("text"))
            for i, j in pieces(off):
                doc, w = word_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i], "space")
                d, t = shingles(doc, w, j - i, words)
                held.append((d, t, _set_hash(d, t, j - i)[0]))
                size += int(off[j] - off[i])
                if size >= RUN_BYTES:
                    yield send(held)
                    held, size = [], 0
        if held:
            yield send(held)

    def dealt(sets, counts):
        """Counts of sets, to the parts that add them up."""
        part = (sets.astype(np.uint64) >> np.uint64(20)) % np.uint64(ranges)
        order = np.argsort(part, kind="stable")
        both = np.c_[sets, counts][order]
        cut = np.searchsorted(part[order], np.arange(ranges + 1))
        full = [r for r in range(ranges) if cut[r + 1] > cut[r]]
        return pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()),
             pa.array([_pack_counts(both[cut[r]:cut[r + 1]]) for r in full], pa.binary())],
            names=["part", "counts"])

    def meet(batches):
        held, at, own, size = [], None, [], 0

        def joined():
            keys, sets = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(keys, kind="stable")
            keys, sets = keys[order], sets[order]
            new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            shared = np.minimum.reduceat(sets, new) != np.maximum.reduceat(sets, new)
            sets = sets[np.repeat(shared, np.diff(np.r_[new, len(keys)])) & (sets != 0)]
            return dealt(*np.unique(sets, return_counts=True))
        for b in batches:
            for r, keys, counts in zip(*(b.column(c).to_pylist() for c in ("range", "keys", "counts"))):
                if counts is not None:
                    own.append(np.frombuffer(counts, np.int64).reshape(-1, 2))
                    size += len(own[-1])
                    if size >= COUNTS:
                        yield dealt(*_summed(own).T)
                        own, size = [], 0
                    continue
                if r != at and held:
                    yield joined()
                    held = []
                at = r
                held.append(_unpack(keys))
        if held:
            yield joined()
        if own:
            yield dealt(*_summed(own).T)

    def added(batches):
        held, size = [], 0
        for b in batches:
            for x in b.column("counts").to_pylist():
                held.append(_unpack_counts(x))
                size += len(held[-1])
                if size >= 2 * COUNTS + len(held[0]):
                    held, size = [_summed(held)], 0
        if held:
            ids, total = _summed(held).T.copy()
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["set_id", "n_shared"])

    sent = docs.where("doc_id IS NOT NULL").select("text") \
        .mapInArrow(collect, "range int, keys binary, counts binary")
    met = sent.repartition(ranges, "range").sortWithinPartitions("range") \
        .mapInArrow(meet, "part int, counts binary")
    return met.repartition(ranges, "part").mapInArrow(added, "set_id long, n_shared long")


def _summed(held: list[np.ndarray]) -> np.ndarray:
    """Rows (set, count) with one row per set."""
    both = np.concatenate(held)
    ids, at = np.unique(both[:, 0], return_inverse=True)
    total = np.zeros(len(ids), np.int64)
    np.add.at(total, at, both[:, 1])
    return np.c_[ids, total]


def _pack_counts(both: np.ndarray) -> bytes:
    """Rows (set, count), the sets in any order."""
    return zs.ZstdCompressor(level=1).compress(np.ascontiguousarray(both.T).tobytes())


def _unpack_counts(blob: bytes) -> np.ndarray:
    return np.frombuffer(zs.ZstdDecompressor().decompress(blob), np.int64).reshape(2, -1).T


def _by_key(keys: np.ndarray, sets: np.ndarray):
    """Distinct keys with their lowest set, and the (set, lowest) pairs of
    sets that share a key."""
    order = np.lexsort((sets, keys))
    keys, sets = keys[order], sets[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    low = sets[np.flatnonzero(new)][np.cumsum(new) - 1] if len(keys) else sets
    other = sets != low
    pairs = np.unique(np.c_[sets[other], low[other]], axis=0)
    return keys[new], sets[new], pairs


def _pack(keys: np.ndarray, sets: np.ndarray) -> bytes:
    """Sorted keys and their sets: differences by byte plane, set numbers
    into a list of the sets met."""
    ids, at = np.unique(sets, return_inverse=True)
    planes = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()
    kind = np.uint16 if len(ids) <= 1 << 16 else np.uint32
    head = np.array([len(keys), len(ids)], np.int64).tobytes()
    return zs.ZstdCompressor(level=1).compress(head + planes + ids.tobytes() + at.astype(kind).tobytes())


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zs.ZstdDecompressor().decompress(blob)
    n, m = np.frombuffer(raw, np.int64, 2)
    planes = np.frombuffer(raw, np.uint8, 8 * n, 16).reshape(8, n)
    keys = np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)
    ids = np.frombuffer(raw, np.int64, m, 16 + 8 * n)
    kind = np.uint16 if m <= 1 << 16 else np.uint32
    return keys, ids[np.frombuffer(raw, kind, n, 16 + 8 * n + 8 * m)]


def shared_keys(docs: DataFrame, hot: np.ndarray, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(a, b) pairs of set_ids that connect all sets sharing a routing key.

    A task sends each key once, with the lowest set that has it, to the range
    the key falls in, and the pairs it saw itself; so a key of very many
    documents costs a range one entry per run of ``RUN_BYTES`` of text.
    """
    ranges = width(docs.sparkSession)
    step = np.uint64((1 << 64) // ranges + 1)

    def send(held):
        keys, sets, pairs = _by_key(np.concatenate([k for k, _ in held]),
                                    np.concatenate([s for _, s in held]))
        cut = np.searchsorted(keys // step, np.arange(ranges + 1))
        full = [r for r in range(ranges) if cut[r + 1] > cut[r]]
        rows = [(r, _pack(keys[cut[r]:cut[r + 1]], sets[cut[r]:cut[r + 1]])) for r in full]
        spread = np.arange(len(pairs)) % ranges
        own = [(r, pairs[spread == r].tobytes()) for r in range(min(ranges, len(pairs)))]
        return pa.RecordBatch.from_arrays(
            [pa.array([r for r, _ in rows + own], pa.int32()),
             pa.array([x for _, x in rows] + [None] * len(own), pa.binary()),
             pa.array([None] * len(rows) + [x for _, x in own], pa.binary())],
            names=["range", "keys", "pairs"])

    def collect(batches):
        held, size = [], 0
        for b in batches:
            data, off = column_bytes(b.column("text"))
            for i, j in pieces(off):
                n = j - i
                doc, w = word_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i], "space")
                d, t = shingles(doc, w, n, words)
                sid, _ = _set_hash(d, t, n)
                kd, key = _routing_keys(d, t, n, percent, hot)
                held.append((key, sid[kd]))
                size += int(off[j] - off[i])
                if size >= RUN_BYTES:
                    yield send(held)
                    held, size = [], 0
        if held:
            yield send(held)

    def meet(batches):
        held, at = [], None

        def joined():
            _, _, pairs = _by_key(np.concatenate([k for k, _ in held]), np.concatenate([s for _, s in held]))
            return batch(pairs)

        def batch(pairs):
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
        for b in batches:
            for r, keys, pairs in zip(*(b.column(c).to_pylist() for c in ("range", "keys", "pairs"))):
                if pairs is not None:
                    yield batch(np.frombuffer(pairs, np.int64).reshape(-1, 2))
                    continue
                if r != at and held:
                    yield joined()
                    held = []
                at = r
                held.append(_unpack(keys))
        if held:
            yield joined()

    sent = docs.where("doc_id IS NOT NULL").select("text") \
        .mapInArrow(collect, "range int, keys binary, pairs binary")
    return sent.repartition(ranges, "range").sortWithinPartitions("range") \
        .mapInArrow(meet, "a long, b long").distinct()


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


class _Node:
    __slots__ = ("lo", "hi", "kids", "bits", "small", "big", "spare", "one")

    def __init__(self, lo, hi, kids, bits, small, big, spare):
        self.lo, self.hi, self.kids, self.bits = lo, hi, kids, bits
        self.small, self.big, self.spare, self.one = small, big, spare, False


class SignatureTree:
    """Dual-traversal join of shingle sets (sorted uint64 arrays)."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.percent = percent
        # Similar sizes, then similar lowest shingles, stand next to each other.
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][0] if len(sets[i]) else 0))
        self.order, self.sets = order, [sets[i] for i in order]
        self.size = np.array([len(s) for s in self.sets])
        self.forest = _Forest(len(sets))
        self.links: list[tuple[int, int]] = []
        typical = int(np.median(self.size)) if len(sets) else 1
        self.width = 1 << int(np.clip(np.ceil(np.log2(4 * max(typical, 1))), 8, 16))
        self.bits = np.zeros((len(sets), self.width // 8), np.uint8)
        for i, s in enumerate(self.sets):
            at = (mix(s) % np.uint64(self.width)).astype(np.int64)
            np.bitwise_or.at(self.bits[i], at >> 3, (1 << (at & 7)).astype(np.uint8))
        # Shingles of a set beyond one per bit: what common bits may hide.
        self.spare = self.size - np.bitwise_count(self.bits).sum(1) if len(sets) else self.size
        self.verified = 0

    def _build(self, lo: int, hi: int) -> _Node:
        if hi - lo <= _LEAF:
            kids, bits = None, np.bitwise_or.reduce(self.bits[lo:hi], axis=0)
        else:
            mid = (lo + hi) // 2
            kids = (self._build(lo, mid), self._build(mid, hi))
            bits = kids[0].bits | kids[1].bits
        return _Node(lo, hi, kids, bits, int(self.size[lo]), int(self.size[hi - 1]),
                     int(self.spare[lo:hi].max()))

    def _needed(self, a: int, b: int) -> int:
        return -(-self.percent * (a + b) // (100 + self.percent))

    def _connected(self, x: _Node) -> bool:
        if not x.one:
            if x.kids:
                x.one = all(self._connected(k) for k in x.kids) and \
                    self.forest.find(x.kids[0].lo) == self.forest.find(x.kids[1].lo)
            else:
                x.one = len({self.forest.find(i) for i in range(x.lo, x.hi)}) == 1
        return x.one

    def join(self) -> list[tuple[int, int]]:
        """Spanning links (pairs of input positions) of the linked sets."""
        if self.sets:
            root = self._build(0, len(self.sets))
            stack = [(root, root)]
            while stack:
                x, y = stack.pop()
                if self._prunable(x, y):
                    continue
                if x is y and x.kids:
                    stack += [(x.kids[0], x.kids[1]), (x.kids[1], x.kids[1]), (x.kids[0], x.kids[0])]
                elif x.kids and (not y.kids or x.hi - x.lo >= y.hi - y.lo):
                    stack += [(x.kids[0], y), (x.kids[1], y)]
                elif y.kids:
                    stack += [(x, y.kids[1]), (x, y.kids[0])]
                else:
                    self._leaves(x, y)
        return self.links

    def _prunable(self, x: _Node, y: _Node) -> bool:
        if x.big * 100 < y.small * self.percent or y.big * 100 < x.small * self.percent:
            return True
        if x is not y:
            common = int(np.bitwise_count(x.bits & y.bits).sum()) + min(x.spare, y.spare)
            if common < self._needed(x.small, y.small):
                return True
        return self._connected(x) and self._connected(y) and \
            self.forest.find(x.lo) == self.forest.find(y.lo)

    def _leaves(self, x: _Node, y: _Node) -> None:
        for i in range(x.lo, x.hi):
            js = np.arange(max(i + 1, y.lo), y.hi)
            if not len(js):
                continue
            a, b = self.size[i], self.size[js]
            need = -(-self.percent * (a + b) // (100 + self.percent))
            common = np.bitwise_count(self.bits[js] & self.bits[i]).sum(1) \
                + np.minimum(self.spare[js], self.spare[i])
            ok = (common >= need) & (np.minimum(a, b) * 100 >= self.percent * np.maximum(a, b))
            for j, k in zip(js[ok].tolist(), need[ok].tolist()):
                if self.forest.find(i) != self.forest.find(j):
                    self.verified += 1
                    s, t = self.sets[i], self.sets[j]
                    at = np.searchsorted(t, s)
                    at[at == len(t)] = 0
                    if int((t[at] == s).sum()) >= k:
                        self.forest.join(i, j)
                        self.links.append((self.order[i], self.order[j]))


def _parted(sets: list[np.ndarray], percent: int) -> list[list[int]]:
    """Positions of the sets that may link, in parts: sets whose fronts share
    a shingle.  The front of a set are its rarest shingles among ``sets``, so
    many that two linked sets share one (prefix filtering); one that no other
    set holds connects nobody, and a set without others is in no part."""
    every = np.sort(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.zeros(0, np.int64)
    n = np.diff(np.r_[first, len(every)])
    known, often = every[first[n > 1]], n[n > 1]
    del every, first, n
    forest, lowest = _Forest(len(sets)), np.full(len(known), -1)
    for i, s in enumerate(sets):
        at = np.searchsorted(known, s)
        at[at == len(known)] = 0
        held = np.sort(at[known[at] == s]) if len(known) else at[:0]
        front = len(s) + (-percent * len(s)) // 100 + 1 - (len(s) - len(held))
        if front > 0:
            at = held[np.argsort(often[held], kind="stable")[:front]]
            met = lowest[at]
            for j in np.unique(met[met >= 0]).tolist():
                forest.join(i, j)
            lowest[at[met < 0]] = i
    parts: dict[int, list[int]] = {}
    for i in range(len(sets)):
        parts.setdefault(forest.find(i), []).append(i)
    return [p for p in parts.values() if len(p) > 1]


def _solve(sets: list[np.ndarray], labels: list | None, percent: int) -> list[tuple[int, int]]:
    """Spanning links; sets with equal labels are connected beforehand."""
    links = []
    for part in _parted(sets, percent):
        found = _tree_links([sets[i] for i in part], labels and [labels[i] for i in part], percent)
        links += [(part[i], part[j]) for i, j in found]
    return links


def _tree_links(sets: list[np.ndarray], labels: list | None, percent: int) -> list[tuple[int, int]]:
    tree = SignatureTree(sets, percent)
    if labels is not None:
        first: dict = {}
        for pos, i in enumerate(tree.order):
            if labels[i] is not None:
                tree.forest.join(first.setdefault(labels[i], pos), pos)
    return tree.join()


def _join_groups(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) spanning links of the rows (task, set_id, label, toks)."""
    n = width(rows.sparkSession)

    def run(batches):
        import itertools

        def flat():
            for b in batches:
                yield from zip(*(b.column(c).to_pylist() for c in ("task", "set_id", "label", "toks")))
        for _, group in itertools.groupby(flat(), key=lambda r: r[0]):
            group = list(group)
            ids = [r[1] for r in group]
            links = _solve([np.frombuffer(r[3], np.uint64) for r in group],
                           [r[2] for r in group], percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i, _ in links], pa.int64()),
                 pa.array([ids[j] for _, j in links], pa.int64())], names=["a", "b"])
    return rows.repartition(n, "task").sortWithinPartitions("task") \
        .mapInArrow(run, "a long, b long")


def _with_tokens(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """(task, set_id, label, toks) of members (doc_id, set_id, label, tasks):
    the shingles of the texts that stand for the sets, to each of its tasks."""
    # Shuffled at every size: a broadcast that ends as the members grow would
    # make the cost jump.
    picked = docs.select("doc_id", "text").join(members.hint("merge"), "doc_id")

    def run(batches):
        for b in batches:
            data, off = column_bytes(b.column("text"))
            want = b.column("set_id").to_numpy()
            for i, j in pieces(off):
                n = j - i
                doc, w = word_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i], "space")
                d, t = shingles(doc, w, n, words)
                sid, count = _set_hash(d, t, n)
                off8 = np.concatenate([[0], np.cumsum(count)]) * 8
                raw = t.tobytes()
                keep = np.flatnonzero(sid == want[i:j])  # repeated doc_ids may hold other texts
                part = b.slice(i, n).take(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [part.column("tasks"), part.column("set_id"), part.column("label"),
                     pa.array([raw[off8[k]:off8[k + 1]] for k in keep], pa.binary())],
                    names=["tasks", "set_id", "label", "toks"])
    rows = picked.select("set_id", "label", "tasks", "text") \
        .mapInArrow(run, "tasks array<long>, set_id long, label long, toks binary")
    return rows.select(F.explode("tasks").alias("task"), "set_id", "label", "toks")


def link_sets(docs: DataFrame, sig: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, root): the connected linked sets, by set_id."""
    sets = sig.where("doc_id IS NOT NULL AND set_id <> 0").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"))
    # Stored, and shuffled at every size, like the join with the texts below.
    shared = saved(shared_counts(docs, words), "jaccard_shared")
    sets = saved(sets.join(shared.hint("merge"), "set_id").where(100 * F.col("n_shared") >= percent * F.col("n"))
                 .select("set_id", "doc_id", "n"), "jaccard_may_link")
    removed(shared)
    of = sets.select("doc_id").distinct()
    docs = saved(docs.select("doc_id", "text").join(of.hint("merge"), "doc_id", "left_semi"), "jaccard_texts")
    n_docs, n_total = sets.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    hot = common_shingles(docs, n_docs, n_total, words)
    found = components(shared_keys(docs, hot, words, percent), "jaccard_groups")
    group = found.withColumnsRenamed({"id": "set_id", "root": "grp"})
    # Sizes and places of groups are known from the sets' sizes alone.
    may, sets = sets, saved(sets.join(group, "set_id"), "jaccard_members")
    removed(found, may)
    size = sets.groupBy("grp").agg(F.ceil(F.sum("n") / BLOCK_TOKENS).cast("int").alias("blocks"))
    sized = sets.join(size, "grp")

    small = sized.where("blocks = 1").select("doc_id", "set_id", F.array(F.xxhash64("grp")).alias("tasks"))
    big = saved(_banded(sized.where("blocks > 1"), percent), "jaccard_large")
    alone = small.unionAll(big.select("doc_id", "set_id", "tasks")).select(
        "doc_id", "set_id", F.lit(None).cast("long").alias("label"), "tasks")
    links = saved(_join_groups(_with_tokens(docs, alone, words), percent), "jaccard_links")
    done = [sets, docs, big, links]
    large = big.where("hot").select("grp", "set_id", "doc_id", "n")
    if not large.isEmpty():
        across = saved(_across_blocks(large, links, percent), "jaccard_across")
        done.append(across)
        if not across.isEmpty():
            cross = saved(_join_groups(_with_tokens(docs, across, words), percent), "jaccard_cross")
            done.append(cross)
            links = links.unionAll(cross)
    roots = components(links, "jaccard_components")
    removed(*done)
    return roots


def _band(percent: int):
    """The size band of a set of n shingles: linked sets are one apart at most
    (a little wider than the threshold, so that rounding separates no pair)."""
    return F.floor(F.log(F.col("n").cast("double")) / (1.001 * math.log(100 / percent))).cast("int")


def _banded(sets: DataFrame, percent: int) -> DataFrame:
    """(grp, set_id, doc_id, n, tasks, hot) of the sets of large groups.

    A task holds two neighbouring bands, or one without a neighbour.  ``hot``
    sets have a neighbouring band, or their own, that does not fit a task with
    theirs; they also go to a block of each of two cuts of the hot sets.
    """
    sets = sets.select("grp", "set_id", "doc_id", "n", _band(percent).alias("band"))
    # Some dozens of rows a group.
    size = sets.groupBy("grp", "band").agg(F.sum("n").alias("t"))
    line = Window.partitionBy("grp").orderBy("band")
    for name, side, step in (("above", F.lead, 1), ("below", F.lag, -1)):
        size = size.withColumn(name, F.when(side("band").over(line) == F.col("band") + step,
                                            side("t").over(line)))

    def fits(other: str):
        return F.col("t") + F.coalesce(F.col(other), F.lit(0)) <= BLOCK_TOKENS
    down, up = F.col("below").isNotNull() & fits("below"), F.col("above").isNotNull() & fits("above")
    alone = F.col("below").isNull() & F.col("above").isNull() & fits("above")

    def task(band):
        return F.xxhash64("grp", F.lit("bands"), band)
    of_bands = F.array_compact(F.array(F.when(down, task(F.col("band") - 1)), F.when(up | alone, task(F.col("band")))))
    size = size.select(F.col("grp").alias("_g"), F.col("band").alias("_b"), of_bands.alias("near"),
                       (~fits("below") | ~fits("above")).alias("hot"), "t")
    # Stored, so that both sides of the join are plain exchanges.
    size = saved(size, "jaccard_size_bands")
    blocks = size.where("hot").groupBy(F.col("_g").alias("_h")).agg(
        F.greatest(F.ceil(F.sum("t") / BLOCK_TOKENS), F.lit(1)).cast("int").alias("blocks"))
    rows = sets.join(size, (sets["grp"] == size["_g"]) & (sets["band"] == size["_b"])) \
        .join(blocks, F.col("grp") == F.col("_h"), "left")

    def block(cut: int):
        return F.xxhash64("grp", F.lit(cut), F.pmod(F.xxhash64("set_id", F.lit(cut)), F.col("blocks")))
    tasks = F.when(F.col("hot"), F.concat("near", F.array(block(0), block(1)))).otherwise(F.col("near"))
    return rows.select("grp", "set_id", "doc_id", "n", tasks.alias("tasks"), "hot")


def _across_blocks(large: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """(doc_id, set_id, label, tasks): how the hot sets of large groups are
    compared across blocks after these were joined alone.

    A group whose hot sets are already one component needs nothing.  Elsewhere the
    sets outside the largest component meet the blocks of the group that hold
    sets of their own or a neighbouring size band; linked sets lie at most one
    band apart.
    """
    part = components(links, "jaccard_parts").withColumnsRenamed({"id": "set_id", "root": "label"})
    lab = large.join(part, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    by = lab.groupBy("grp", "label").agg(F.sum("n").alias("t"))
    top = by.groupBy("grp").agg(F.max(F.struct("t", "label")).alias("top"), F.count("*").alias("labels")) \
        .where("labels > 1")
    rows = saved(lab.join(top, "grp").select(
        "grp", "set_id", "doc_id", "label", "n", (F.col("label") == F.col("top.label")).alias("main"),
        _band(percent).alias("band")), "jaccard_bands")
    size = rows.groupBy("grp", "main", "band").agg(
        F.struct("band", F.ceil(F.sum("n") / BLOCK_TOKENS).cast("int").alias("blocks")).alias("b"))
    # One entry per size band: some dozens.
    size = size.groupBy("grp").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("main"), F.col("b")))).alias("of_main"),
        F.map_from_entries(F.collect_list(F.when(~F.col("main"), F.col("b")))).alias("of_others"))
    rows = rows.join(size, "grp")
    own = F.when(F.col("main"), F.col("of_main")[F.col("band")]) \
        .otherwise(F.col("of_others")[F.col("band")])
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("set_id"), own).cast("int"))

    def near(blocks: str, make):
        """``make(band, block)`` for the blocks of the own and next bands."""
        def of(at):
            n = F.coalesce(F.col(blocks)[at], F.lit(0))
            return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda y: make(at, y))) \
                .otherwise(F.array().cast("array<long>"))
        return F.concat(*[of(F.col("band") + d) for d in (-1, 0, 1)])
    me = F.struct(F.col("band").alias("b"), F.col("mine").alias("i"))

    def pair(b, i):
        other = F.struct(b.alias("b"), i.alias("i"))
        return F.xxhash64("grp", F.lit(False), F.least(me, other), F.greatest(me, other))
    tasks = F.when(F.col("main"), near("of_others", lambda b, i: F.xxhash64(
        "grp", F.lit(True), b, i, "band", "mine"))) \
        .otherwise(F.concat(near("of_main", lambda b, i: F.xxhash64(
            "grp", F.lit(True), "band", "mine", b, i)), near("of_others", pair)))
    return rows.select("doc_id", "set_id", "label", tasks.alias("tasks")).where("size(tasks) > 0")


def op4_jaccard_join(spark: SparkSession, docs: DataFrame, words: int = WORDS,
                     percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    component_id is the smallest doc_id reachable by links, itself included.
    Null and empty texts have the empty set, which links with nothing.  Rows
    with equal sets link; rows that repeat a doc_id each appear, with the
    component of their own text.  A null doc_id takes no part in links and has
    a null component_id.  Other columns of ``docs`` are never read.
    """
    sig = saved(set_ids(docs, words), "jaccard_sets_of")
    roots = link_sets(docs, sig, words, percent)
    home = sig.where("set_id <> 0 AND doc_id IS NOT NULL").groupBy("set_id") \
        .agg(F.min("doc_id").alias("low")) \
        .join(roots.withColumnRenamed("id", "set_id"), "set_id", "left") \
        .withColumn("root", F.coalesce("root", "set_id"))
    least = home.groupBy("root").agg(F.min("low").alias("component_id"))
    home = home.join(least, "root").select("set_id", "component_id")
    return sig.select("doc_id", "n_shingles", "set_id").join(home, "set_id", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
