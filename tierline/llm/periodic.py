"""Periodic runs of words by string synchronising sets.

A run is a maximal stretch of consecutive words with smallest period q that is
at least ``EXPONENT`` periods and ``MIN_WORDS`` words long.  Texts of a piece
are laid end to end as word codes with one unequal mark after each, so runs
never cross documents, and all of them are searched at once:

* Periods below 8 come from comparing the words with themselves 1 to 7 places
  on.  The stretches found so, and those of earlier scales, are the highly
  periodic regions of the later scales.
* The scale t = 4, 8, 16, ... covers the periods 2t <= q < 4t.  A place i is
  synchronising if the smallest hash among the t-word strings that start in
  i..i+t, those with a period of at most t/3 left out, is the one at i or at
  i+t.  That depends on the words i..i+2t-1 only, so equal contexts are
  selected alike.  Each pair of synchronising places with equal contexts of 2t
  words that lie 2t to 4t-1 words apart proposes its distance as a period; the
  proposal is extended to both sides by comparing codes.

No run is lost.  Every t places hold a synchronising one unless the 3t-1 words
there have a period of at most t/3; a run whose first q places held none would
have that period over more than q words and hence (two periods, long enough)
no smallest period q.  So one place s among the first q is selected, and with
2t <= q and three periods the context at s+q lies inside the run and equals
the one at s.  Contexts whose period is at most t/3 are never selected, hence
a context occurs a dozen times at most within 4t words: the number of pairs
is linear.  Hashes only select and propose; what is reported was compared
word by word.  A stretch proposed with a multiple of its smallest period has
the extent of the run of that period, and the smallest one is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.textbytes import column_bytes, mix, pieces
from tierline.llm.wordcodes import word_codes

EXPONENT = 3
MIN_WORDS = 24
#: First scale; periods below twice this are compared place by place.
_FIRST = 4
_NONE = np.uint64(2**64 - 1)
_STEP = np.uint64(0xD6E8FEB86659FD93)

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def _extent(w: np.ndarray, s: int, q: int) -> tuple[int, int]:
    """The largest [a, b) around s with w[i] == w[i + q] for a <= i < b."""
    b, step = s, 64
    while b < len(w) - q:
        top = min(b + step, len(w) - q)
        bad = np.flatnonzero(w[b:top] != w[b + q:top + q])
        if bad.size:
            b += int(bad[0])
            break
        b, step = top, 2 * step
    a, step = s, 64
    while a > 0:
        low = max(a - step, 0)
        bad = np.flatnonzero(w[low:a] != w[low + q:a + q])
        if bad.size:
            a = low + int(bad[-1]) + 1
            break
        a, step = low, 2 * step
    return a, b


def _near_periods(w: np.ndarray) -> list[tuple[int, int, int]]:
    """Stretches (start, end, q) of q < 2 * _FIRST, three periods or longer."""
    out = []
    for q in range(1, min(2 * _FIRST, len(w))):
        same = np.zeros(len(w) - q + 2, np.int8)
        same[1:-1] = w[q:] == w[:-q]
        edge = np.flatnonzero(np.diff(same))
        a, b = edge[::2], edge[1::2]
        long = b - a >= (EXPONENT - 1) * q
        out += [(int(x), int(y) + q, q) for x, y in zip(a[long], b[long])]
    return out


def _synchronising(f: np.ndarray, tau: int, regions: list[tuple[int, int, int]]) -> np.ndarray:
    """Synchronising places of the scale; ``f``: hashes of the tau-word strings."""
    g = np.minimum(f, _NONE - np.uint64(1))
    inside = np.zeros(len(g) + 1, np.int64)
    for a, b, q in regions:
        if 3 * q <= tau <= b - a:
            inside[a] += 1
            inside[b - tau + 1] -= 1
    g[np.cumsum(inside[:-1]) > 0] = _NONE
    least, k = g.copy(), 1
    while 2 * k <= tau:
        least[:-k] = np.minimum(least[:-k], least[k:])
        k *= 2
    least[:-1] = np.minimum(least[:-1], least[1:])
    m = max(len(g) - 2 * tau, 0)
    low = least[:m]
    return np.flatnonzero((low != _NONE) & ((low == g[:m]) | (low == g[tau:m + tau])))


def _proposals(at: np.ndarray, context: np.ndarray, tau: int) -> np.ndarray:
    """(period, place) rows, ordered, of equal contexts 2t..4t-1 apart."""
    order = np.argsort(context, kind="stable")
    c, p = context[order], at[order]
    found, k = [], 1
    while k < len(c):
        gap = p[k:] - p[:-k]
        near = (c[k:] == c[:-k]) & (gap < 4 * tau)
        if not near.any():
            break
        take = np.flatnonzero(near & (gap >= 2 * tau))
        found.append(np.c_[gap[take], p[take]])
        k += 1
    if not found:
        return np.zeros((0, 2), np.int64)
    rows = np.concatenate(found)
    return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


def runs_of(codes: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """(document, start, length, period) of every run, ordered.

    Document d has the words codes[first[d]:first[d + 1]].
    """
    size = np.diff(first)
    n_docs = len(size)
    base = first[:-1] + np.arange(n_docs)  # where a document lies in w
    w = np.empty(len(codes) + n_docs, np.int64)
    mark = np.zeros(len(w), bool)
    mark[base + size] = True
    w[~mark] = codes
    w[mark] = -1 - np.arange(n_docs)
    regions = _near_periods(w)

    kept = np.arange(n_docs)
    f, done, tau = mix(w.view(np.uint64) + np.uint64(1)), 1, _FIRST
    found = [(a, b, q) for a, b, q in regions]  # in places of the whole w
    place = np.arange(len(w))
    while True:
        stay = size[kept] >= 2 * EXPONENT * tau
        if not stay.all():
            mask = np.repeat(stay, size[kept] + 1)
            w, f, place, kept = w[mask], f[mask], place[mask], kept[stay]
        if not len(kept):
            break
        while done <= tau:  # f: hashes of strings of tau words, then twice as many
            g = np.empty_like(f)
            g[:-done] = mix(f[:-done] * _STEP + f[done:])
            g[-done:] = mix(f[-done:] * _STEP)
            if done == tau:
                break
            f, done = g, 2 * done
        local = []
        # Regions as places of the documents left at this scale.
        for a, b, q in found:
            if 3 * q <= tau <= b - a:
                x = int(np.searchsorted(place, a))
                if x < len(place) and place[x] == a:
                    local.append((x, x + b - a, q))
        at = _synchronising(f, tau, local)
        last = (0, 0, 0)
        for q, s in _proposals(at, g[at], tau).tolist():
            if last[0] == q and last[1] <= s < last[2]:
                continue
            a, b = _extent(w, s, q)
            last = (q, a, b)
            if b - a >= (EXPONENT - 1) * q:
                found.append((int(place[a]), int(place[a]) + b + q - a, q))
        f, done, tau = g, 2 * done, 2 * tau

    rows = np.array(sorted(found), np.int64).reshape(-1, 3)
    if len(rows):  # by start, end, period: the smallest period of an extent
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        rows = rows[new & (rows[:, 1] - rows[:, 0] >= min_words)]
    doc = np.searchsorted(base, rows[:, 0], "right") - 1
    out = np.c_[doc, rows[:, 0] - base[doc], rows[:, 1] - rows[:, 0], rows[:, 2]]
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def dropped(runs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Flags of the words inside any run after its first period."""
    change = np.zeros(int(first[-1]) + 1, np.int64)
    start = first[runs[:, 0]] + runs[:, 1]
    np.add.at(change, start + runs[:, 3], 1)
    np.add.at(change, start + runs[:, 2], -1)
    return np.cumsum(change[:-1]) > 0


def collapse_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, runs, collapsed of every row of ``docs`` (doc_id, text).

    ``runs``: array of (start, length, period) in words, by start, then
    period; ``collapsed``: the words outside of what runs repeat, joined by
    one space.  Null and empty texts have no runs and collapse to the empty
    string; ids are of any type, may be null and may repeat; other columns are
    ignored; an empty table gives an empty result.  One text is worked on in
    one task; memory follows a piece of texts or the longest one.
    """
    def run(batches):
        for b in batches:
            data, off = column_bytes(b.column("text"))
            for lo, hi in pieces(off):
                first, codes, words = word_codes(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                runs = runs_of(codes, first, min_words)
                gone = dropped(runs, first)
                text = np.array(words.to_pylist(), object)
                kept = [b" ".join(text[codes[s:e][~gone[s:e]]]) for s, e in zip(first[:-1], first[1:])]
                ends = np.searchsorted(runs[:, 0], np.arange(hi - lo + 1)).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in (1, 2, 3)],
                                                   names=RUN.names)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), pa.ListArray.from_arrays(ends, spans),
                     pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])
    out = T.StructType([docs.schema["doc_id"], T.StructField("runs", T.ArrayType(RUN)),
                        T.StructField("collapsed", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(run, out)


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, the words of every tenth text repeated.

    With h the CRC-32 of the decimal doc_id and g = floor(h / 10): if h is
    divisible by 10, word i >= a becomes word a + (i - a) % p, where
    a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).  Rows without an id or
    without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    picked = docs.select("doc_id", "text", h.alias("h"))
    some = picked.where("h % 10 = 0").withColumn("w", words).withColumn("n", F.size("w").cast("long"))
    g = F.floor(F.col("h") / 10).cast("long")
    a = F.when(F.col("n") > 0, g % F.greatest("n", F.lit(1)))
    some = some.withColumn("a", a).withColumn(
        "p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)).cast("long"))

    def nth(i: Column) -> Column:
        at = F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
        return F.get("w", at.cast("int"))
    text = F.when(F.col("n") > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), nth), " ")) \
        .otherwise(F.col("text"))
    return some.select("doc_id", text.alias("text")).unionAll(
        picked.where("h IS NULL OR h % 10 <> 0").select("doc_id", "text"))


def op13_periodic_runs(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Runs of every document (after :func:`with_repeats`) as digests."""
    found = collapse_runs(with_repeats(docs))
    none = F.lit(None).cast(RUN)
    # Exact: a / b > c / d as a * d > c * b.  Runs come by start, then period.
    top = F.aggregate("runs", none, lambda best, x: F.when(
        best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"top.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.lit(1000) * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
