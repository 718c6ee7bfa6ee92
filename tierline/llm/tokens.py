"""Training-order materialisation of token ids as fixed-stride shards.

Texts are tokenised with a public byte-level BPE, each document is closed by
an end-of-text id, and the stream of every input partition is cut into
sequences of ``SEQUENCE`` ids (the last one padded with end-of-text).  Every
partition owns a run of numbers that is surely long enough (an id takes at
least one byte, so its bytes bound its sequences), and a keyed Feistel
permutation with cycle walking maps the numbers of its sequences to places of
one global order.  Places are cut into ranges; a range partition writes its
sequences in order of place, as one shard.  The slots of the training order
are the places in use, counted through: a sequence's slot is the number of
records in earlier shards plus its place in its own.  So texts are tokenised
once, moved once, and no count has to be known before.

A shard is a file of equal records: a little-endian uint32 count of real ids,
then ``SEQUENCE`` ids of two bytes (four if the vocabulary needs it).  With
the manifest's record counts a reader seeks straight to any step of training.
Beside each shard an Arrow file names the documents of every record.  Files
appear under their final name only when complete; a rerun into the same folder
with the same plan skips the shards that are there.

What a place holds depends on how the input is split.  The settings that
decide it are written into the folder's manifest with a fingerprint of every
partition's documents, and a rerun reads the input by the manifest's settings,
whatever its own cluster's cores and split sizes are; an input that still
differs is refused.  Nothing with a row per shard comes to the driver.
"""

from __future__ import annotations

import base64
import hashlib
import json
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard as zs
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.store import saved, width
from tierline.session import fresh_folder

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's published pre-tokenisation pattern (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEQUENCE = 2048
#: Places of one shard; about two fifths of them are in use, as an id of the
#: default vocabulary takes some two and a half bytes.
SHARD_PLACES = 8192
KEY = 0x7F4A7C15
_ROUNDS = 6
#: Shards whose records are counted through together.
_SHARD_RUN = 4096
_SPLIT_BYTES, _OPEN_COST, _MIN_SPLITS = (
    f"spark.sql.files.{x}" for x in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"))


class Encoder:
    """Text to ids; ``end`` is the first id that the vocabulary leaves free."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.end = max(table.values()) + 1
        self.dtype = np.dtype("<u2") if self.end < 1 << 16 else np.dtype("<u4")
        self.encode = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=table,
                                        special_tokens={}).encode_ordinary

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of a text and the end mark; nothing for null and empty texts."""
        if not text:
            return np.zeros(0, self.dtype)
        found = self.encode(text)
        found.append(self.end)
        return np.array(found, self.dtype)


def places(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Keyed permutation of 0..n-1: a balanced Feistel network on the next
    even power of two, walked on until the value is below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)

    def once(x):
        left, right = x >> shift, x & mask
        for r in range(_ROUNDS):
            f = (right + np.uint64((key + r * 0x9E3779B97F4A7C15) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0x94D049BB133111EB)
            f ^= f >> np.uint64(32)
            left, right = right, left ^ (f & mask)
        return (left << shift) | right

    out = once(index.astype(np.uint64))
    while (out_of := np.flatnonzero(out >= np.uint64(n))).size:
        out[out_of] = once(out[out_of])
    return out.astype(np.int64)


def _splits(spark: SparkSession) -> dict[str, str]:
    """The settings by which a file scan is split now, all of them explicit."""
    least = spark.conf.get(_MIN_SPLITS, None) or spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) \
        or spark.sparkContext.defaultParallelism
    return {_SPLIT_BYTES: spark.conf.get(_SPLIT_BYTES), _OPEN_COST: spark.conf.get(_OPEN_COST),
            _MIN_SPLITS: str(least)}


@contextmanager
def _split_by(spark: SparkSession, settings: dict[str, str]):
    """Scans planned inside are split by ``settings``."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _capacity(docs: DataFrame, length: int) -> tuple[list[int], str]:
    """First number of every input partition (and their end), and a
    fingerprint of the documents of each partition in their order."""
    rows = docs.select(F.octet_length("text").alias("bytes"), F.spark_partition_id().alias("part"),
                       F.xxhash64(F.monotonically_increasing_id(), "doc_id", F.octet_length("text"),
                                  F.xxhash64("text")).alias("mark"))
    # One row per input partition.
    room = rows.groupBy("part").agg(F.sum(F.coalesce("bytes", F.lit(0)) + 1).alias("n"),
                                    F.expr("bit_xor(mark)").alias("mark")).orderBy("part").collect()
    first = [0] * (1 + max((r["part"] + 1 for r in room), default=0))
    for r in room:
        first[r["part"] + 1] = -(-r["n"] // length)
    seen = hashlib.sha256(repr([tuple(r) for r in room]).encode()).hexdigest()
    return np.cumsum(first).tolist(), seen


def _id_type(docs: DataFrame) -> tuple[str, pa.DataType]:
    """Whole-number ids are kept as long, any other kind as its string."""
    whole = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    return ("long", pa.int64()) if whole else ("string", pa.string())


def _sequences(docs: DataFrame, ranks: bytes, first: list[int], total: int, length: int, key: int) -> DataFrame:
    """(place, n, body, doc_ids, lengths): body is the zstd-packed ids."""
    kind, id_type = _id_type(docs)

    def run(batches):
        enc = Encoder(ranks)
        part = TaskContext.get().partitionId()
        done, room = 0, first[part + 1] - first[part] if part + 1 < len(first) else 0
        held, owners, sizes, n = [], [], [], 0
        pack = zs.ZstdCompressor(level=3)

        def cut(all_of: bool):
            """Complete sequences of what is held, the rest stays."""
            nonlocal held, owners, sizes, n, done
            stream = np.concatenate(held) if held else np.zeros(0, enc.dtype)
            k = -(-n // length) if all_of else n // length
            if done + k > room:
                raise ValueError(f"partition {part} has more than {room} sequences: the input "
                                 "must be a stored table that is read the same way twice")
            start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            place = places(np.arange(first[part] + done, first[part] + done + k), total, key) \
                if k else np.zeros(0, np.int64)
            bodies, real, ids, lens = [], [], [], []
            for i in range(k):
                lo, hi = i * length, min((i + 1) * length, n)
                body = stream[lo:hi]
                if hi - lo < length:
                    body = np.concatenate([body, np.full(length - (hi - lo), enc.end, enc.dtype)])
                a = int(np.searchsorted(start, lo, "right")) - 1
                z = int(np.searchsorted(start, hi, "left"))
                bodies.append(pack.compress(body.tobytes()))
                real.append(hi - lo)
                ids.append(owners[a:z])
                lens.append((np.minimum(start[a + 1:z + 1], hi) - np.maximum(start[a:z], lo)).tolist())
            done += k
            used = min(k * length, n)
            a = int(np.searchsorted(start, used, "right")) - 1
            held, n = ([stream[used:]] if used < n else []), n - used
            owners, sizes = (owners[a:], sizes[a:]) if n else ([], [])
            if n:
                sizes[0] -= used - int(start[a])
            return pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array(real, pa.int32()), pa.array(bodies, pa.binary()),
                 pa.array(ids, pa.list_(id_type)), pa.array(lens, pa.list_(pa.int32()))],
                names=["place", "n", "body", "doc_ids", "lengths"])

        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                got = enc.ids(text)
                if len(got):
                    held.append(got), owners.append(doc), sizes.append(len(got))
                    n += len(got)
                if n >= 256 * length:
                    yield cut(False)
        yield cut(True)
    return docs.select(F.col("doc_id").cast(kind).alias("doc_id"), "text").mapInArrow(
        run, f"place long, n int, body binary, doc_ids array<{kind}>, lengths array<int>")


def _open(uri: str):
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else \
        (pafs.LocalFileSystem(), uri)


def _shard_path(path: str, shard: int) -> str:
    return f"{path}/shard-{shard:08d}"


def _shard_numbers(spark: SparkSession, shards: int) -> DataFrame:
    return spark.range(0, shards, 1, max(1, min(width(spark), shards)))


def _finished(spark: SparkSession, folder: str, shards: int, stride: int) -> DataFrame:
    """(shard, records) of the shards that are complete in ``folder``; each
    task asks for the files of its own shards."""
    def run(batches):
        fs, path = _open(folder)
        for b in batches:
            ids = b.column("id").to_pylist()
            for lo in range(0, len(ids), 1024):
                part = ids[lo:lo + 1024]
                info = fs.get_file_info([_shard_path(path, s) + end for s in part for end in (".bin", ".arrow")])
                both = [(s, x.size // stride) for s, x, y in zip(part, info[::2], info[1::2])
                        if x.type == y.type == pafs.FileType.File]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in both], pa.int64()) for i in (0, 1)], names=["shard", "records"])
    return _shard_numbers(spark, shards).mapInArrow(run, "shard long, records long")


def _write_shards(rows: DataFrame, folder: str, shards: int, parts: int) -> DataFrame:
    """(shard, records, ids) of the shards written."""
    id_type = pa.int64() if rows.schema["doc_ids"].dataType.elementType == T.LongType() else pa.string()
    dealt = rows.repartitionById(parts, F.floor(F.col("shard") * parts / shards).cast("int")) \
        .sortWithinPartitions("place")

    def run(batches):
        fs, path = _open(folder)
        unpack, attempt = zs.ZstdDecompressor(), TaskContext.get().taskAttemptId()
        out, at, last, names, ids_in = None, None, -1, [], 0

        def close():
            base = _shard_path(path, at)
            out.close()
            side = pa.table({"doc_ids": pa.array([x[0] for x in names], pa.list_(id_type)),
                             "lengths": pa.array([x[1] for x in names], pa.list_(pa.int32()))})
            with fs.open_output_stream(f"{base}.arrow.{attempt}") as sink, \
                    pa.ipc.new_file(sink, side.schema) as w:
                w.write_table(side)
            fs.move(f"{base}.arrow.{attempt}", f"{base}.arrow")
            fs.move(f"{base}.bin.{attempt}", f"{base}.bin")
            return pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int64()) for v in (at, len(names), ids_in)], names=["shard", "records", "ids"])
        for b in batches:
            cols = [b.column(c) for c in ("shard", "place", "n", "body", "doc_ids", "lengths")]
            for shard, place, n, body, ids, lens in zip(*(c.to_pylist() for c in cols)):
                if shard != at:
                    if out:
                        yield close()
                    at, names, ids_in = shard, [], 0
                    out = fs.open_output_stream(f"{_shard_path(path, at)}.bin.{attempt}")
                if place <= last:
                    raise ValueError(f"place {place} is given twice or out of order")
                last = place
                out.write(int(n).to_bytes(4, "little") + unpack.decompress(body))
                names.append((ids, lens))
                ids_in += n
        if out:
            yield close()
    return dealt.mapInArrow(run, "shard long, records long, ids long")


def materialise(docs: DataFrame, folder: str | None = None, vocabulary: str = VOCABULARY,
                length: int = SEQUENCE, shard_places: int = SHARD_PLACES, key: int = KEY) -> dict:
    """Write the shards of ``docs`` (a stored table with doc_id, text).

    Returns the manifest, which is also written as ``manifest.json``.  Null and
    empty texts give no ids; repeated rows are separate documents; ids that are
    not whole numbers are written as strings; other columns are ignored; an
    empty table gives no shard.  ``folder``: a shared folder, by default a new
    one; given the folder of an unfinished run over the same rows, only missing
    shards are written, also where this session splits files otherwise.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:  # on the driver; tasks get the bytes
        ranks = f.read()
    enc = Encoder(ranks)
    folder = folder or fresh_folder(spark, "llm", "token_shards")
    fs, path = _open(folder)
    fs.create_dir(path, recursive=True)
    known = None
    if fs.get_file_info(f"{path}/manifest.json").type != pafs.FileType.NotFound:
        with fs.open_input_stream(f"{path}/manifest.json") as f:
            known = json.loads(f.read())
    splits = (known or {}).get("splits") or _splits(spark)
    with _split_by(spark, splits):
        first, seen = _capacity(docs, length)
        total, stride = first[-1], 4 + length * enc.dtype.itemsize
        plan = {"places": total, "sequence_ids": length, "shard_places": shard_places, "stride": stride,
                "id_bytes": enc.dtype.itemsize, "id_type": _id_type(docs)[0], "end_id": enc.end, "key": key,
                "shards": -(-total // shard_places), "splits": splits, "documents": seen,
                "vocabulary": hashlib.sha256(ranks).hexdigest()}
        if known is not None and {k: known.get(k) for k in plan} != plan:
            raise ValueError(f"{folder} holds shards of another plan")
        _note(fs, path, plan)
        if plan["shards"]:
            rows = _sequences(docs, ranks, first, total, length, key) \
                .withColumn("shard", F.floor(F.col("place") / shard_places))
            if known is not None:
                done = saved(_finished(spark, folder, plan["shards"], stride), "token_finished")
                rows = rows.join(done, "shard", "left_anti")
            parts = max(1, min(width(spark), plan["shards"]))
            saved(_write_shards(rows, folder, plan["shards"], parts), "token_written")
    ends = _finished(spark, folder, plan["shards"], stride)
    plan["sequences"] = ends.agg(F.sum("records")).first()[0] or 0
    _note(fs, path, plan)
    return plan | {"folder": folder}


def _note(fs, path: str, plan: dict) -> None:
    with fs.open_output_stream(f"{path}/manifest.json") as f:
        f.write(json.dumps(plan).encode())


def _slots(spark: SparkSession, plan: dict) -> DataFrame:
    """(shard, before) of the shards that hold records; ``before`` counts the
    records of all earlier ones, by runs of shards and then inside a run."""
    ends = _finished(spark, plan["folder"], plan["shards"], plan["stride"]) \
        .where("records > 0").withColumn("run", F.floor(F.col("shard") / _SHARD_RUN))
    # One row per run of shards: some hundreds for 100 TB.
    runs = ends.groupBy("run").agg(F.sum("records").alias("n"))
    runs = runs.select("run", (F.sum("n").over(W.orderBy("run")) - F.col("n")).alias("start"))
    inside = F.sum("records").over(W.partitionBy("run").orderBy("shard")) - F.col("records")
    return ends.withColumn("inside", inside).join(runs, "run") \
        .select("shard", (F.col("start") + F.col("inside")).alias("before"))


def read_shards(spark: SparkSession, plan: dict) -> DataFrame:
    """slot, shard, n_tokens, doc_ids, lengths, tokens of all shards, read in
    slot order inside a shard; ``tokens`` are the real ids as raw bytes."""
    folder, stride, width_of, kind = plan["folder"], plan["stride"], plan["id_bytes"], plan["id_type"]

    def run(batches):
        fs, path = _open(folder)
        for b in batches:
            for shard, before in zip(b.column("shard").to_pylist(), b.column("before").to_pylist()):
                with fs.open_input_file(f"{_shard_path(path, shard)}.arrow") as f:
                    side = pa.ipc.open_file(f).read_all().combine_chunks()
                with fs.open_input_stream(f"{_shard_path(path, shard)}.bin") as f:
                    for lo in range(0, side.num_rows, 512):
                        part = side.slice(lo, 512)
                        raw = f.read(part.num_rows * stride)
                        n = [int.from_bytes(raw[i * stride:i * stride + 4], "little")
                             for i in range(part.num_rows)]
                        body = [raw[i * stride + 4:i * stride + 4 + k * width_of] for i, k in enumerate(n)]
                        slot = before + np.arange(lo, lo + part.num_rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(slot), pa.array(np.full(len(n), shard)), pa.array(n, pa.int32()),
                             part.column("doc_ids").combine_chunks(), part.column("lengths").combine_chunks(),
                             pa.array(body, pa.binary())],
                            names=["slot", "shard", "n_tokens", "doc_ids", "lengths", "tokens"])
    parts = max(1, min(width(spark), plan["shards"]))
    return saved(_slots(spark, plan), "token_slots").repartition(parts, "shard").mapInArrow(
        run, f"slot long, shard long, n_tokens int, doc_ids array<{kind}>, lengths array<int>, tokens binary")


def op3_token_output(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the shards, then return every sequence as read back from them."""
    return read_shards(spark, materialise(docs)) \
        .withColumn("tokens_sha256", F.sha2("tokens", 256))
