"""Harmonic packing of tokenised documents into sequences.

A document's ids (those of a public tokenizer, then ``END``) are cut into
pieces whose lengths lie close below a unit fraction of the capacity: class k
holds the lengths in (CAPACITY/(k+1), CAPACITY/k], and a piece is only cut to a
length whose k-fold leaves at most ``SLACK`` places free.  Full sequences'
worth comes first, then the longest such length that the rest allows, so a
document gives a handful of pieces.  Every bin of class k takes exactly k
pieces, whatever they are; hence each worker fills its bins as the pieces
come, without knowing of others or of what is still to come.

A worker ends with at most k - 1 pieces of a class, under one sequence per
class.  These remainders meet in rounds: the workers of ``FAN`` neighbouring
partitions' remainders fill bins again by the same rule, so what one task
holds is bounded, whatever the size of the corpus, and each round moves a
small part of the one before.  What the last one leaves, a bounded number of
pieces, is laid end to end and cut at the capacity; its last part is cut at
powers of two, which are not padded.  So padding is at most ``SLACK`` of
``CAPACITY`` places.

Words are tokenised once per task: the tokenizer's rules never look across
white space (its normaliser maps it to a space, which its splitter removes),
so the ids of a text are those of its words end to end.  The same holds
between ASCII letters, digits and other signs, where words are cut too; a
piece of text that spells a special token is only cut at white space.
"""

from __future__ import annotations

import json
import math
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tierline.llm.store import saved
from tierline.llm.textbytes import column_bytes, pieces
from tierline.llm.wordcodes import word_codes

CAPACITY = 4096
#: Free places that a full bin may have.
SLACK = 16
#: The id that closes every document.
END = 2
#: Partitions whose remainders meet in one task.
FAN = 64
#: Words whose ids a task remembers beside those of its piece; beyond that it
#: starts anew.
_MEMO = 300_000


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """A class per byte, and the pairs of classes between which a word may be
    cut: where the tokenizer's splitter ends one match and starts another
    whatever stands around.  It matches runs of letters, single digits, runs
    of other characters, and an apostrophe with the letters after it; bytes
    of other scripts are left alone, as marks may join what is before them.
    """
    letter, digit, other, apostrophe, wide = range(5)
    kind = np.full(256, other, np.uint8)
    kind[0x41:0x5B] = kind[0x61:0x7B] = letter
    kind[0x30:0x3A] = digit
    kind[0x27] = apostrophe
    kind[0x80:] = wide
    cut = np.zeros((5, 5), bool)
    cut[letter, [digit, other, apostrophe]] = True
    cut[digit, [letter, digit, other, apostrophe]] = True
    cut[other, [letter, digit]] = True
    cut[apostrophe, digit] = True
    return kind, cut


_KIND, _CUT = _classes()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Parts that are one match of the splitter and that the normaliser only
#: lower-cases: precomposed Latin letters, a digit, or other ASCII signs.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")


class WordTokenizer:
    """Ids of texts, by their words and parts of words; equal to encoding each
    text whole."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        # How the tokenizer spells the bytes of the plain letters.
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {c: spell(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.special = [t["content"].encode() for t in json.loads(definition).get("added_tokens", [])]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool, self.used, self.size = np.zeros(1 << 16, np.uint32), 0, []

    def _index(self, words: list[bytes]) -> np.ndarray:
        """Place of each word among those whose ids are held."""
        if len(self.known) > _MEMO:
            self._forget()
        known, merge, spelling, plain = self.known, self.model.tokenize, self.spelling, _PLAIN.fullmatch
        new = [w for w in words if w not in known]
        others = []
        for lo in range(0, len(new), 4096):
            ids = []
            for w in new[lo:lo + 4096]:
                text = w.decode()
                if not plain(text):
                    others.append(w)
                    continue
                text = text.lower()
                if not text.isascii():
                    text = text.translate(spelling)
                known[w] = len(self.size) + len(ids)
                ids.append([t.id for t in merge(text)])
            self._keep(ids)
        for lo in range(0, len(others), 4096):
            part = others[lo:lo + 4096]
            known.update(zip(part, range(len(self.size), len(self.size) + len(part))))
            self._keep([e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in part],
                                                                        add_special_tokens=False)])
        return np.array([known[w] for w in words], np.int64)

    def _keep(self, ids: list[list[int]]) -> None:
        self.size += [len(x) for x in ids]
        flat = np.array([i for x in ids for i in x], np.uint32)
        start, end = self.used, self.used + len(flat)
        if end > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), end), np.uint32)])
        self.pool[start:end] = flat
        self.used = end

    def ids(self, data: np.ndarray, off: np.ndarray, end: int = END) -> tuple[np.ndarray, np.ndarray]:
        """(first, ids): document d has ids[first[d]:first[d + 1]], closed by ``end``."""
        apart, lower = None, _LOWER[data]
        raw = lower.tobytes()
        if len(data) and not any(t.lower() in raw for t in self.special):
            # ASCII letters can be lower-cased before the normaliser does it.
            data, kind = lower, _KIND[data]
            apart = np.zeros(len(data), bool)
            np.take(_CUT.ravel(), kind[:-1] * np.uint8(5) + kind[1:], out=apart[1:])
        start, codes, words = word_codes(data, off, apart)
        index = self._index(words.to_pylist())
        held = np.array(self.size, np.int64)
        at, size = (np.cumsum(held) - held)[index], held[index]
        count = size[codes]
        # Ids word after word, then one place after each document for the end.
        upto = np.concatenate([[0], np.cumsum(count)])
        stream = self.pool[np.repeat(at[codes] - upto[:-1], count) + np.arange(upto[-1])]
        cut = upto[start]
        out = np.insert(stream, cut[1:], end)
        return cut + np.arange(len(cut)), out


def cut_lengths(capacity: int, slack: int) -> np.ndarray:
    """cut[r]: the longest length of at most r whose bins have at most
    ``slack`` free places (length 1 always has none)."""
    n = np.arange(1, capacity + 1)
    fits = np.where(capacity % n <= slack, n, 0)
    return np.concatenate([[0], np.maximum.accumulate(fits)])


def cuts(n: int, table: np.ndarray) -> list[int]:
    """Lengths of the pieces of a document of n ids, in its order."""
    capacity = len(table) - 1
    out = [capacity] * (n // capacity)
    n %= capacity
    while n:
        out.append(int(table[n]))
        n -= out[-1]
    return out


_PIECE = [T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
          T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
          T.StructField("offset", T.LongType()), T.StructField("part", T.LongType()),
          T.StructField("rank", T.LongType()), T.StructField("ids", T.BinaryType())]
_NAMES = ["doc_id", *(f.name for f in _PIECE)]


class _Bins:
    """One worker's open bins, at most one per class."""

    def __init__(self, round_: int, capacity: int, schema: pa.Schema):
        self.capacity, self.schema = capacity, schema
        self.part = TaskContext.get().partitionId()
        # Round, partition and count of a bin make up its number.
        self.number = round_ << 56 | self.part << 32
        self.open: dict[int, list] = {}
        self.rows: list = []
        self.bytes = 0

    def put(self, piece: tuple) -> None:
        k = self.capacity // piece[2]
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            self.close(held)
            self.open[k] = []

    def close(self, held: list) -> None:
        offset = 0
        for doc, start, length, total, body in held:
            self.rows.append((doc, start, length, total, self.number, offset, None, None, body))
            self.bytes += len(body)
            offset += length
        self.number += 1

    def batch(self) -> pa.RecordBatch:
        rows, self.rows, self.bytes = self.rows, [], 0
        cols = list(zip(*rows)) or [[]] * len(_NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, self.schema)],
                                          schema=self.schema)

    def left(self) -> list:
        return [p for k in sorted(self.open) for p in self.open[k]]

    def remainder(self) -> pa.RecordBatch:
        """What is left, as rows without a sequence."""
        self.rows += [(*p[:4], None, None, self.part, i, p[4]) for i, p in enumerate(self.left())]
        return self.batch()

    def end_to_end(self) -> pa.RecordBatch:
        """What is left, cut at the capacity and at last at powers of two."""
        held, room = [], 0
        rest = self.left()
        total = sum(p[2] for p in rest)
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in range(self.capacity.bit_length(), -1, -1) if total % self.capacity >> b & 1]
        sizes.reverse()
        for doc, start, length, whole, body in rest:
            while length:
                room = room or sizes.pop()
                n = min(room, length)
                held.append((doc, start, n, whole, body[:4 * n]))
                start, length, body, room = start + n, length - n, body[4 * n:], room - n
                if not room:
                    self.close(held)
                    held = []
        return self.batch()


def _out_schema(docs: DataFrame) -> T.StructType:
    return T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *_PIECE])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def packed(docs: DataFrame, definition: str | None = None, capacity: int = CAPACITY,
           slack: int = SLACK, end: int = END, fan: int = FAN) -> DataFrame:
    """Pieces of ``docs`` (a stored table with doc_id, text) in sequences.

    Per piece: doc_id, start (ids of its document before it), length,
    doc_tokens (with the end), sequence_id, offset (there), ids (little-endian
    unsigned 32-bit).  Every id lies in one piece; offsets of a sequence have
    no gaps.  Null and empty texts have the end id alone; repeated rows are
    documents of their own; ids are of any type and may be null; other columns
    are ignored; an empty table gives an empty result.  ``definition``: the
    tokenizer as JSON, by default ``vocabulary()``'s file, read on the driver.
    """
    if definition is None:
        with open(vocabulary(), encoding="utf-8") as f:
            definition = f.read()
    if capacity < 1 or slack < 0:
        raise ValueError("capacity must be at least 1, slack at least 0")
    out = _out_schema(docs)
    arrow = _arrow(out)

    def tokenise(batches):
        words, table = WordTokenizer(definition), cut_lengths(capacity, slack)
        bins = _Bins(0, capacity, arrow)
        for b in batches:
            data, off = column_bytes(b.column("text"))
            names = b.column("doc_id").to_pylist()
            for lo, hi in pieces(off):
                first, ids = words.ids(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], end)
                for d in range(hi - lo):
                    n, start = int(first[d + 1] - first[d]), 0
                    body = ids[first[d]:first[d + 1]].astype("<u4").tobytes()
                    for length in cuts(n, table):
                        bins.put((names[lo + d], start, length, n, body[4 * start:4 * (start + length)]))
                        start += length
                if bins.bytes > 1 << 20:
                    yield bins.batch()
        yield bins.remainder()

    def refill(round_: int, last: bool):
        def run(batches):
            bins = _Bins(round_, capacity, arrow)
            for b in batches:
                for r in zip(*(b.column(c).to_pylist() for c in ("doc_id", "start", "length", "doc_tokens", "ids"))):
                    bins.put(r)
                if bins.bytes > 1 << 20:
                    yield bins.batch()
            yield bins.end_to_end() if last else bins.remainder()
        return run

    stored = saved(docs.select("doc_id", "text").mapInArrow(tokenise, out), "packed_0")
    rounds, round_ = [stored.where("sequence_id IS NOT NULL")], 0
    parts = (stored.agg(F.max("part")).first()[0] or 0) + 1
    left = stored.where("sequence_id IS NULL")
    while True:
        round_ += 1
        groups = math.ceil(parts / fan)
        dealt = left.repartitionById(groups, F.floor(F.col("part") / fan).cast("int")) \
            .sortWithinPartitions("part", "rank")
        stored = saved(dealt.mapInArrow(refill(round_, groups == 1), out), f"packed_{round_}")
        rounds.append(stored.where("sequence_id IS NOT NULL"))
        if groups == 1:
            break
        left, parts = stored.where("sequence_id IS NULL"), groups
    whole = rounds[0]
    for r in rounds[1:]:
        whole = whole.unionAll(r)
    return whole.drop("part", "rank")


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad: int = END) -> DataFrame:
    """sequence_id, n_tokens, doc_ids, lengths, tokens per sequence of
    :func:`packed`; ``tokens`` is padded to the capacity unless its length is
    a power of two."""
    row = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    seq = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), row.alias("p"))
    blank = F.lit(int(pad).to_bytes(4, "little") * capacity)
    fill = F.when(F.expr("bit_count(n_tokens) = 1"), F.lit(b"")) \
        .otherwise(F.substring(blank, F.lit(1), (4 * (capacity - F.col("n_tokens"))).cast("int")))
    body = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return seq.select("sequence_id", "n_tokens", F.col("p.doc_id").alias("doc_ids"),
                      F.col("p.length").alias("lengths"), F.concat(body, fill).alias("tokens"))


def op11_packing(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The pieces of :func:`packed`, their ids as CRC-32."""
    return packed(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                               "sequence_id", "offset")
