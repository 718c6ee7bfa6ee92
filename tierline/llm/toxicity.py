"""Toxicity by compression distance between two zstandard dictionaries.

One dictionary is trained on windows that mark toxic texts, one on ordinary
texts.  The marking windows are found by compression distance too: first whole
texts of both classes serve as dictionaries, each fold of the toxic texts is
compressed against the others, and what lies beyond nearly all windows of
ordinary texts is the toxic dictionary of the next round.  No word list or
count of words decides.

Every distinct word of a text is a window (words over ``WINDOW_BYTES`` are cut
into overlapping windows): it is compressed against both dictionaries, and the
difference of the two lengths is its distance.  Bytes are recoded before
compression, each to four bytes hashed from itself and its two predecessors,
so that a short match saves enough bytes to be seen over the frame's fixed
cost.  A logistic calibration, fitted on labelled documents that no dictionary
saw, turns a document's distances into a score.

Training looks at a bounded sample of labelled rows (``TRAIN_TOXIC`` and
``TRAIN_ORDINARY``, lowest hash of the id first; ``SEARCH_BYTES`` of each class
where windows are searched); scoring reads whole texts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bounds of the labelled sample that the model is fitted on, in rows.
TRAIN_TOXIC = 3_000
TRAIN_ORDINARY = 6_000
THRESHOLD = 0.7
WINDOW_BYTES = 64
TOXIC_DICT_BYTES = 8 << 10
ORDINARY_DICT_BYTES = 256 << 10
ORDINARY_WORDS = 250_000
#: Bound of the texts of a class that toxic windows are searched in, in bytes.
SEARCH_BYTES = 2 << 20
#: Share of the windows of ordinary texts that may lie beyond the cut, by round.
MARK_SHARE = (0.005, 0.002, 0.001, 0.0003)

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Folds of the search for windows that mark toxic texts.
_FOLDS = 3
#: Distances that count as a strong and as a weak sign, in bytes.
_STRONG, _WEAK = 12, 10
_NONE = -20.0


@dataclass(frozen=True)
class Model:
    """Two dictionaries, calibration weights, and the prior if untrainable."""

    toxic: bytes
    ordinary: bytes
    raw: bool
    mean: tuple
    scale: tuple
    weights: tuple
    prior: float


def words_of(text: bytes) -> set[bytes]:
    found = set(_WORD.findall(text.translate(_LOWER)))
    long = [w for w in found if len(w) > WINDOW_BYTES]
    for w in long:
        found.discard(w)
        found.update(w[i:i + WINDOW_BYTES] for i in range(0, len(w), WINDOW_BYTES * 3 // 4))
    return found


def recode(words: list[bytes]) -> list[bytes]:
    """Each byte of word + space as four bytes hashed from three bytes."""
    data = np.frombuffer(b"".join(b"  " + w + b" " for w in words), np.uint8).astype(np.uint32)
    x = data.copy()
    x[1:] |= data[:-1] << np.uint32(8)
    x[2:] |= data[:-2] << np.uint32(16)
    x *= np.uint32(2654435761)
    x ^= x >> np.uint32(15)
    x *= np.uint32(2246822519)
    x ^= x >> np.uint32(13)
    x *= np.uint32(3266489917)
    x ^= x >> np.uint32(16)
    raw, out, at = x.astype("<u4").tobytes(), [], 0
    for w in words:
        end = at + len(w) + 3
        out.append(raw[4 * (at + 2):4 * end])
        at = end
    return out


class Distance:
    """Distance of a word: length with the ordinary dictionary less that
    with the toxic one.  Remembers words, up to a fixed number."""

    def __init__(self, model: Model):
        self.toxic = self._compressor(model.toxic, model.raw)
        self.ordinary = self._compressor(model.ordinary, model.raw)
        self.known: dict[bytes, int] = {}

    @staticmethod
    def _compressor(content: bytes, raw: bool) -> zs.ZstdCompressor:
        kind = zs.DICT_TYPE_RAWCONTENT if raw else zs.DICT_TYPE_FULLDICT
        d = zs.ZstdCompressionDict(content, dict_type=kind)
        p = zs.ZstdCompressionParameters.from_level(
            3, source_size=WINDOW_BYTES, dict_size=len(content), min_match=4,
            write_content_size=0, write_checksum=0, write_dict_id=0)
        d.precompute_compress(compression_params=p)
        return zs.ZstdCompressor(dict_data=d, compression_params=p)

    def of(self, words) -> list[int]:
        if len(self.known) > 500_000:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        if new:
            for w, x in zip(new, recode(new)):
                self.known[w] = len(self.ordinary.compress(x)) - len(self.toxic.compress(x))
        return [self.known[w] for w in words]

    def features(self, text: bytes) -> list[float]:
        d = sorted(self.of(words_of(text)), reverse=True)
        top = (d + [_NONE] * 3)[:3]
        n = max(len(d), 1)
        return [*top, float(sum(x >= _STRONG for x in d)),
                sum(x >= _WEAK for x in d) / n, math.log(n)]


def _one_per_family(texts: list[bytes]) -> list[bytes]:
    """One text of each set of near copies (equal lowest hashes of words), so
    that a family does not count as so many independent documents."""
    family = {}
    for t in sorted(set(texts)):
        key = tuple(sorted(zlib.crc32(w) for w in words_of(t))[:3])
        family.setdefault(key, t)
    return list(family.values())


def _search_texts(texts: list[bytes]) -> list[tuple[int, list[bytes]]]:
    """(fold, distinct words) of texts by lowest hash, ``SEARCH_BYTES`` together;
    a text over an eighth of that is passed over, so that several are left."""
    out, size = [], 0
    for t in sorted((t for t in texts if len(t) <= SEARCH_BYTES // 8), key=lambda t: (zlib.crc32(t), t)):
        size += len(t)
        if size > SEARCH_BYTES:
            break
        out.append((zlib.crc32(b"fold" + t) % _FOLDS, sorted(words_of(t))))
    return out


def _content(rows: list[tuple[int, list[bytes]]], left_out: int) -> bytes:
    """Raw dictionary content: the windows of all folds but one."""
    return b"".join(recode([w for f, ws in rows if f != left_out for w in ws])).ljust(8, b"\0")


def _toxic_windows(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Windows of toxic texts that mark them, found by compression distance.

    Whole texts of both classes serve as dictionaries, and each fold is
    compressed against the other folds.  Windows of toxic texts whose distance
    is beyond nearly all windows of ordinary texts become the next toxic
    dictionary.  What one text alone holds never counts: its fold is left out.
    """
    plain, all_toxic = _search_texts(ordinary), _search_texts(toxic)
    marked = all_toxic
    for share in MARK_SHARE:
        found, base = [], []
        for f in range(_FOLDS):
            dist = Distance(Model(_content(marked, f), _content(plain, f), True, (), (), (), 0.0))
            found += [(f, ws, dist.of(ws)) for g, ws in all_toxic if g == f]
            base += [x for g, ws in plain if g == f for x in dist.of(ws)]
        if not base:
            return []
        cut = max(0.0, float(np.quantile(base, 1 - share)))
        marked = [(f, [w for w, x in zip(ws, d) if x > cut]) for f, ws, d in found]
    return [w for _, ws in marked for w in ws]


def _dictionary(size: int, words: list[bytes]) -> bytes | None:
    try:
        return zs.train_dictionary(size, recode(words)).as_bytes()
    except zs.ZstdError:
        return None


def fit(toxic: list[bytes], ordinary: list[bytes]) -> Model:
    """Train on labelled texts; a family of copies counts once.

    Two thirds of them train the dictionaries, the rest the calibration.
    With too few texts of a class, or no word that sets the classes apart,
    the model scores every text with the share of toxic ones, at most 0.5.
    """
    toxic, ordinary = _one_per_family(toxic), _one_per_family(ordinary)
    prior = min(0.5, len(toxic) / max(1, len(toxic) + len(ordinary)))
    none = Model(b"", b"", True, (), (), (), prior)
    third = lambda t: zlib.crc32(t) % 3 == 0
    train_t, train_o = ([t for t in ts if not third(t)] for ts in (toxic, ordinary))
    if not train_t or not train_o:
        return none
    marked = _toxic_windows(train_t, train_o)
    plain = sorted({w for t in train_o for w in words_of(t)}, key=zlib.crc32)[:ORDINARY_WORDS]
    if not marked or not plain:
        return none
    dicts = [_dictionary(TOXIC_DICT_BYTES, marked), _dictionary(ORDINARY_DICT_BYTES, plain)]
    raw = None in dicts
    if raw:  # too few samples for the trainer: the samples themselves serve as content
        common = [w for w, _ in Counter(marked).most_common()]
        dicts = [b"".join(recode(common))[:TOXIC_DICT_BYTES].ljust(8, b"\0"),
                 b"".join(recode(plain))[:ORDINARY_DICT_BYTES].ljust(8, b"\0")]
    model = Model(dicts[0], dicts[1], raw, (), (), (), prior)
    dist = Distance(model)
    cal_t, cal_o = ([t for t in ts if third(t)] or list(ts) for ts in (toxic, ordinary))
    x = np.array([dist.features(t) for t in [*cal_t, *cal_o]])
    y = np.r_[np.ones(len(cal_t)), np.zeros(len(cal_o))]
    mean, scale = x.mean(0), x.std(0) + 1e-9
    w = _logistic((x - mean) / scale, y)
    return Model(model.toxic, model.ordinary, raw, tuple(mean), tuple(scale), tuple(w), prior)


def _logistic(z: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 60) -> np.ndarray:
    """Ridge logistic regression by damped Newton steps."""
    z = np.c_[z, np.ones(len(z))]
    w, ridge = np.zeros(z.shape[1]), np.r_[np.full(z.shape[1] - 1, l2), 1e-6]
    for _ in range(steps):
        p = _sigmoid(z @ w)
        grad = z.T @ (p - y) / len(y) + ridge * w
        hess = (z * (p * (1 - p))[:, None]).T @ z / len(y) + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= step / max(1.0, np.abs(step).max() / 2)
    return w


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def score_texts(texts: list[bytes], model: Model, dist: Distance | None) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    if dist is None:
        return np.full(len(texts), model.prior)
    x = np.array([dist.features(t) for t in texts])
    z = np.c_[(x - np.array(model.mean)) / np.array(model.scale), np.ones(len(x))]
    return _sigmoid(z @ np.array(model.weights))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the labelled rows of ``docs`` outside the held-out fold.

    ``labels``: (doc_id, toxic); rows with a null in either are left out, and
    so are ids labelled both ways.  Only the texts of the bounded sample of
    ids come to the driver.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("y")) \
        .where("doc_id IS NOT NULL AND y IN (0, 1)").where(fold != 1) \
        .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2")
    pick = F.xxhash64("doc_id")
    ids = known.where("y = 1").orderBy(pick, "doc_id").limit(TRAIN_TOXIC) \
        .unionAll(known.where("y = 0").orderBy(pick, "doc_id").limit(TRAIN_ORDINARY))
    # At most TRAIN_TOXIC + TRAIN_ORDINARY ids: a proven bound for the broadcast.
    rows = docs.select("doc_id", "text").where("text IS NOT NULL") \
        .join(F.broadcast(ids.select("doc_id", "y")), "doc_id") \
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y")) \
        .select("text", "y").toArrow()
    texts, y = rows.column("text").cast(pa.binary()).to_pylist(), rows.column("y").to_pylist()
    return fit([t for t, v in zip(texts, y) if v], [t for t, v in zip(texts, y) if not v])


def _column_scores(col, model: Model, dist: Distance | None) -> np.ndarray:
    return score_texts([t or b"" for t in col.cast(pa.binary()).to_pylist()], model, dist)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) per row; a null text counts as empty.

    Columns of ``docs`` other than doc_id and text are never read.  Repeated
    rows each get their score.
    """
    out = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType()),
                        T.StructField("predicted", T.IntegerType())])

    def run(batches):
        dist = Distance(model) if model.weights else None
        for b in batches:
            s = _column_scores(b.column("text"), model, dist)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "score", "predicted"])
    return docs.select("doc_id", "text").mapInArrow(run, out)


def keep_ordinary(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    def run(batches):
        dist = Distance(model) if model.weights else None
        for b in batches:
            s = _column_scores(b.column("text"), model, dist)
            yield b.filter(pa.array(s < THRESHOLD))
    return docs.mapInArrow(run, docs.schema)


def op5_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted.  A null doc_id is not held out."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    return score(docs, train(docs, labels)).select(
        "doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score", "predicted")
