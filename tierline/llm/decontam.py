"""Benchmark decontamination over a distributed positional inverted index.

The index is a table of segments, one row per run of documents (``SEGMENT``
bytes of text): for every benchmark term the positions at which it occurs in
the segment, as binary columns.  Position numbers leave a gap between
documents, so a phrase never crosses two of them.

Search reads the segments only.  The terms of each test window are ordered by
their corpus frequency; the postings of the rarest one, shifted by its offset,
are the candidate starts, and each further term keeps those candidates whose
shifted position is in its own postings.  The survivors are exact phrase
matches.  ``proximity_matches`` keeps instead the places where every term
occurs within a number of words of the rarest.

Benchmark items are the stated query set: they are read in blocks of about
``ITEM_BYTES`` of text, whose windows (some 15 times that) go to the tasks.
One index holds the terms of ``INDEX_BLOCKS`` blocks (eight bytes per distinct
word go to the tasks) and is searched block by block; only a larger benchmark
needs another index.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.store import saved
from tierline.llm.textbytes import column_bytes, pieces, word_hashes

WINDOW = 10
SEGMENT = 8 << 20
ITEM_BYTES = 2 << 20
INDEX_BLOCKS = 32
_BITS = np.uint64(40)


class Windows:
    """The test windows of a block of items, as rows of numbers of the terms
    in ``vocab`` (by default the block's own) and of the ids in ``names``."""

    def __init__(self, items: pa.Table, size: int = WINDOW, vocab: np.ndarray | None = None):
        items = items.filter(items.column("item_id").is_valid())
        data, off = column_bytes(items.column("text"))
        doc, words = word_hashes(data, off, "plain")
        self.vocab = np.unique(words) if vocab is None else vocab
        term = np.searchsorted(self.vocab, words)
        count = np.bincount(doc, minlength=len(off) - 1)
        first = np.concatenate([[0], np.cumsum(count)])
        coded = items.column("item_id").combine_chunks().dictionary_encode()
        self.names, ids = coded.dictionary, coded.indices.to_numpy()
        item, start, length = [], [], []
        for i in np.flatnonzero(count):
            k = max(1, int(count[i]) - size + 1)
            item += [ids[i]] * k
            start += range(first[i], first[i] + k)
            length += [min(size, int(count[i]))] * k
        self.item = np.array(item, np.int64)
        self.length = np.array(length, np.int64)
        at = np.array(start, np.int64)[:, None] + np.arange(size) if item else np.zeros((0, size), int)
        live = np.arange(size) < self.length[:, None]
        self.term = np.where(live, term[np.minimum(at, max(len(term) - 1, 0))], -1) \
            if len(term) else at
        # Equal windows of one item are one.
        if item:
            _, keep = np.unique(np.c_[self.item, self.term], axis=0, return_index=True)
            self.item, self.length, self.term = self.item[keep], self.length[keep], self.term[keep]

    def by_rarity(self, frequency: np.ndarray) -> np.ndarray:
        """Per window its offsets, rarest term first, unused offsets last."""
        if not len(self.item):
            return np.zeros((0, self.term.shape[1]), np.int64)
        f = np.where(self.term >= 0, frequency[self.term], np.iinfo(np.int64).max)
        return np.argsort(f, axis=1, kind="stable")


_INDEX = T.StructType([
    T.StructField("doc_ids", T.BinaryType()), T.StructField("n_words", T.BinaryType()), T.StructField("terms", T.BinaryType()),
    T.StructField("counts", T.BinaryType()), T.StructField("steps", T.BinaryType()),
    T.StructField("rows", T.BinaryType())])


def _packed(ids: pa.Array) -> bytes:
    """Ids of any type, nulls included, as an Arrow stream."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([ids], names=["id"])
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _segment(rows, ids, count, term, pos) -> pa.RecordBatch:
    """One row of the index; ``ids`` is an Arrow array."""
    order = np.lexsort((pos, term))
    term, pos = term[order], pos[order]
    steps = np.diff(pos, prepend=0)
    new = np.flatnonzero(np.diff(term, prepend=-1))
    steps[new] = pos[new]
    cols = [count.astype(np.int64), term[new].astype(np.int32),
            np.diff(np.append(new, len(term))).astype(np.int32), steps.astype(np.int32), rows]
    return pa.RecordBatch.from_arrays(
        [pa.array([x], pa.binary()) for x in (_packed(ids), *(c.tobytes() for c in cols))],
        names=[f.name for f in _INDEX.fields])


def _postings_of(data: np.ndarray, off: np.ndarray, vocab: np.ndarray):
    """(words per document, term, document, position) of the terms in a piece."""
    doc, w = word_hashes(data, off, "plain")
    count = np.bincount(doc, minlength=len(off) - 1)
    first = np.concatenate([[0], np.cumsum(count)])
    at = np.searchsorted(vocab, w)
    at[at == len(vocab)] = 0
    hit = np.flatnonzero(vocab[at] == w) if len(vocab) else np.zeros(0, np.int64)
    return count, at[hit], doc[hit], hit - first[doc[hit]]


def build_index(docs: DataFrame, vocab: np.ndarray, gap: int = WINDOW) -> DataFrame:
    """Index segments of ``docs`` (row, doc_id, text) for the terms ``vocab``.

    Positions are stored term by term as differences (int32).
    """
    def run(batches):
        held, size = [], 0

        def flush():
            rows, ids, count, term, pos = [], [], [], [], []
            base = 0
            for r, i, c, t, d, p in held:
                start = base + np.concatenate([[0], np.cumsum(c + gap)])
                rows.append(r), ids.append(i), count.append(c), term.append(t)
                pos.append(start[d] + p)
                base = start[-1]
            return _segment(np.concatenate(rows), pa.concat_arrays(ids),
                            *(np.concatenate(x) for x in (count, term, pos)))

        for b in batches:
            data, off = column_bytes(b.column("text"))
            ids = b.column("doc_id")
            rows = b.column("row").to_numpy(zero_copy_only=False)
            for i, j in pieces(off):
                held.append((rows[i:j], ids.slice(i, j - i),
                             *_postings_of(data[off[i]:off[j]], off[i:j + 1] - off[i], vocab)))
                size += int(off[j] - off[i])
                if size >= SEGMENT:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
    return docs.select("row", "doc_id", "text").mapInArrow(run, _INDEX)


class Segment:
    """One decoded row of the index."""

    def __init__(self, row: dict, gap: int):
        self.rows = np.frombuffer(row["rows"], np.int64)
        self.ids = pa.ipc.open_stream(row["doc_ids"]).read_all().column("id").combine_chunks()
        self.n_words = np.frombuffer(row["n_words"], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.n_words + gap)])
        terms = np.frombuffer(row["terms"], np.int32)
        counts = np.frombuffer(row["counts"], np.int32)
        steps = np.frombuffer(row["steps"], np.int32).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        total = np.cumsum(steps)
        before = np.concatenate([[0], total])[first[:-1]]
        self.pos = total - np.repeat(before, counts)
        term = np.repeat(terms, counts).astype(np.uint64)
        self.keys = (term << _BITS) | self.pos.astype(np.uint64)
        self.terms, self.first = terms, first

    def postings(self, term: np.ndarray):
        """(window index, position) of all postings of each window's term."""
        at = np.searchsorted(self.terms, term)
        at[at == len(self.terms)] = 0
        ok = self.terms[at] == term if len(self.terms) else np.zeros(len(term), bool)
        w, at = np.flatnonzero(ok), at[ok]
        n = self.first[at + 1] - self.first[at]
        win = np.repeat(w, n)
        inner = np.arange(len(win)) - np.repeat(np.cumsum(n) - n, n)
        return win, self.pos[np.repeat(self.first[at], n) + inner]

    def has(self, term: np.ndarray, pos: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(term), bool)
        key = (term.astype(np.uint64) << _BITS) | pos.astype(np.uint64)
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return self.keys[at] == key

    def phrases(self, win: Windows, order: np.ndarray):
        """(window, start) of every exact occurrence."""
        if not len(win.item):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows = np.arange(len(order))
        w, pos = self.postings(win.term[rows, order[:, 0]])
        pos = pos - order[w, 0]
        w, pos = w[pos >= 0], pos[pos >= 0]
        for j in range(1, order.shape[1]):
            off = order[w, j]
            term = win.term[w, off]
            ok = term < 0
            ok[~ok] = self.has(term[~ok], pos[~ok] + off[~ok])
            w, pos = w[ok], pos[ok]
        return w, pos

    def near(self, win: Windows, order: np.ndarray, reach: int):
        """(window, position of its rarest term) with all terms in reach."""
        if not len(win.item) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        w, pos = self.postings(win.term[np.arange(len(order)), order[:, 0]])
        for j in range(1, order.shape[1]):
            term = win.term[w, order[w, j]]
            doc = np.searchsorted(self.start, pos, "right") - 1
            low = np.maximum(pos - reach, self.start[doc])
            high = np.minimum(pos + reach, self.start[doc] + self.n_words[doc] - 1)
            base = np.maximum(term, 0).astype(np.uint64) << _BITS
            a = np.searchsorted(self.keys, base | low.astype(np.uint64))
            b = np.searchsorted(self.keys, base | high.astype(np.uint64), "right")
            ok = (term < 0) | (b > a)
            w, pos = w[ok], pos[ok]
        return w, pos


def _frequencies(index: DataFrame, n_terms: int) -> np.ndarray:
    """Corpus frequency of each benchmark term (one number per term)."""
    def run(batches):
        for b in batches:
            for t, c in zip(b.column("terms").to_pylist(), b.column("counts").to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(t, np.int32)),
                     pa.array(np.frombuffer(c, np.int32).astype(np.int64))], names=["t", "c"])
    got = index.select("terms", "counts").mapInArrow(run, "t int, c long") \
        .groupBy("t").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(n_terms, np.int64)
    out[got.column("t").to_numpy()] = got.column("c").to_numpy()
    return out


def _schema(docs: DataFrame, benchmark: DataFrame, *fields) -> T.StructType:
    """Fields by name; ids keep the types they have."""
    doc, item = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    kinds = {"doc_id": doc, "item_id": item, "items": T.ArrayType(item), "hits": T.ArrayType(T.LongType())}
    return T.StructType([T.StructField(f, kinds.get(f, T.LongType())) for f in fields])


def _search(index: DataFrame, win: Windows, order: np.ndarray, gap: int, schema: T.StructType,
            clean: bool) -> DataFrame:
    """(row, doc_id, n_words, hits, items) per document of the index, or per
    document with hits unless ``clean``."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                seg = Segment(row, gap)
                w, pos = seg.phrases(win, order)
                doc = np.searchsorted(seg.start, pos, "right") - 1
                cover = np.zeros(int(seg.start[-1]) + 1, np.int32)
                np.add.at(cover, pos, 1)
                np.add.at(cover, pos + win.length[w], -1)
                hit = np.flatnonzero(np.cumsum(cover) > 0)
                owner = np.searchsorted(seg.start, hit, "right") - 1
                pair = np.unique(np.c_[doc, win.item[w]], axis=0) if len(w) else np.zeros((0, 2), np.int64)
                n = len(seg.ids)

                def lists(of, values):
                    off = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))])
                    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), values)
                out = pa.RecordBatch.from_arrays(
                    [pa.array(seg.rows), seg.ids, pa.array(seg.n_words),
                     lists(owner, pa.array(hit - seg.start[owner], pa.int64())),
                     lists(pair[:, 0], win.names.take(pa.array(pair[:, 1], pa.int64())))],
                    names=["row", "doc_id", "n_words", "hits", "items"])
                yield out if clean else out.take(pa.array(np.unique(owner)))
    return index.mapInArrow(run, schema)


def _n_blocks(benchmark: DataFrame) -> int:
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, math.ceil(size / ITEM_BYTES))


def _terms(items: DataFrame) -> np.ndarray:
    """The distinct words of at most INDEX_BLOCKS blocks of items, hashed."""
    def run(batches):
        for b in batches:
            data, off = column_bytes(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.unique(word_hashes(data, off, "plain")[1]).view(np.int64))], names=["t"])
    got = items.select("text").mapInArrow(run, "t long").distinct().toArrow()
    return np.sort(got.column("t").to_numpy().view(np.uint64))


def _searches(numbered: DataFrame, benchmark: DataFrame, n: int, size: int):
    """(windows, their orders, index) for each of ``n`` blocks of items."""
    items = benchmark.where("item_id IS NOT NULL").select("item_id", "text") \
        .withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n)))
    for lo in range(0, n, INDEX_BLOCKS):
        group = items.where(F.col("block").between(lo, min(lo + INDEX_BLOCKS, n) - 1))
        vocab = _terms(group)
        index = saved(build_index(numbered, vocab, size), "decontam_index")
        frequency = _frequencies(index, len(vocab))
        for k in range(lo, min(lo + INDEX_BLOCKS, n)):
            win = Windows(group.where(F.col("block") == k).toArrow(), size, vocab)
            order = win.by_rarity(frequency)
            del win.vocab  # the tasks that search need term numbers only
            yield win, order, index, vocab


def find_phrases(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, hits (positions of its words
    inside any occurrence of a test window), items (ids with occurrences).

    Null and empty texts have no words; items without words or id match
    nothing; repeated rows each get their result.  Ids may be of any type;
    other columns are ignored.  With several blocks of items, rows are numbered
    once and stored with their numbers: a later job may split the input in
    another way.
    """
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    n = _n_blocks(benchmark)
    if n > INDEX_BLOCKS:
        numbered = saved(numbered, "decontam_rows")
    schema = _schema(docs, benchmark, "row", "doc_id", "n_words", "hits", "items")
    parts = []
    for win, order, index, _ in _searches(numbered, benchmark, n, size):
        # The first block brings every document, the others those they hit.
        parts.append(_search(index, win, order, size, schema, clean=not parts))
    out = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            out = out.unionAll(p)
        out = out.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return out.select("doc_id", "n_words", "hits", "items")


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, without an occurrence of a test window.

    Every row is judged by its own text, so null and repeated ids make no
    difference; null and empty texts stay.  The stored index gives the order
    in which terms are intersected; the rows are then searched where they are
    read, and no text is moved.
    """
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    out = docs
    for win, order, _, vocab in _searches(numbered, benchmark, _n_blocks(benchmark), size):
        def run(batches, win=win, order=order, vocab=vocab):
            for b in batches:
                data, off = column_bytes(b.column("text"))
                dirty = np.zeros(b.num_rows, bool)
                for i, j in pieces(off):
                    count, term, doc, pos = _postings_of(data[off[i]:off[j]], off[i:j + 1] - off[i], vocab)
                    start = np.concatenate([[0], np.cumsum(count + size)])
                    none = np.zeros(j - i, np.int64)
                    seg = Segment(_segment(none, pa.array(none), count, term, start[doc] + pos).to_pylist()[0], size)
                    _, at = seg.phrases(win, order)
                    dirty[i + np.searchsorted(seg.start, at, "right") - 1] = True
                yield b.filter(pa.array(~dirty))
        out = out.mapInArrow(run, docs.schema)
    return out


def proximity_matches(docs: DataFrame, benchmark: DataFrame, reach: int,
                      size: int = WINDOW) -> DataFrame:
    """(doc_id, item_id) of documents with all terms of a test window within
    ``reach`` words of an occurrence of its rarest term, in any order."""
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    schema = _schema(docs, benchmark, "doc_id", "item_id")
    out = None
    for win, order, index, _ in _searches(numbered, benchmark, _n_blocks(benchmark), size):
        def run(batches, win=win, order=order):
            for b in batches:
                for row in b.to_pylist():
                    seg = Segment(row, size)
                    w, pos = seg.near(win, order, reach)
                    doc = np.searchsorted(seg.start, pos, "right") - 1
                    pair = np.unique(np.c_[doc, win.item[w]], axis=0) if len(w) else np.zeros((0, 2), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [seg.ids.take(pa.array(pair[:, 0])), win.names.take(pa.array(pair[:, 1]))],
                        names=["doc_id", "item_id"])
        part = index.mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return out.distinct()


def digest(found: DataFrame) -> DataFrame:
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


def op8_decontamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return digest(find_phrases(docs, benchmark))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k,
    array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
grams AS (SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hits AS (SELECT r, i, k, item_id FROM grams JOIN win USING (k, g)),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN it USING (r)
"""
