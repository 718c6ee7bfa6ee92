"""WARC archives: a record writer and a PySpark data source.

Every record is a gzip member of its own whose extra field ``SL`` holds the
member's length, so a reader can step over it without inflating it.  The
source plans one partition per file (or per run of small files), takes record
type and header predicates as pushed filters, inflates only the front of a
member to parse its headers, and inflates the payload only if the query asks
for it and the record passed.

Archives of other writers are read too: ``.warc.gz`` whose members do not tell
their length (one per record, several records in one, or one for the whole
file) are inflated on from record to record in pieces of bounded size, and in
plain ``.warc`` files unwanted blocks are stepped over.  There the payload of
a block of type application/http is what follows its HTTP header, as stored;
columns whose header a record lacks are null.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from functools import reduce

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, In,
                                    InputPartition)

from tierline.llm.store import saved
from tierline.session import fresh_folder

#: Records whose payload has at least this many bytes may be revisits.
REVISIT_BYTES = 0
#: Records of one archive file.
FILE_RECORDS = 20_000
#: Small files are planned together up to this size.
PARTITION_BYTES = 64 << 20
#: Rows and bytes that a reading task gathers for one batch.
BATCH_ROWS, BATCH_BYTES = 256, 16 << 20
_CHUNK, _PIECE = 64 << 10, 1 << 20
#: Column of the source -> header it is read from.
HEADERS = {"record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
           "page_id": "X-Page-Id", "payload_digest": "WARC-Payload-Digest",
           "refers_to": "X-Refers-To-Page-Id", "payload_length": "X-Payload-Length",
           "record_id": "WARC-Record-ID", "date": "WARC-Date", "content_type": "Content-Type"}
_IDS = ("page_id", "refers_to")
_INTEGER = re.compile(r"-?[0-9]{1,19}")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def member(block: bytes) -> bytes:
    """``block`` as a gzip member whose extra field tells its own length."""
    pack = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = pack.compress(block) + pack.flush()
    total = 10 + 2 + 8 + len(body) + 8
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHI", 8, b"SL", 4, total) \
        + body + struct.pack("<II", zlib.crc32(block), len(block) & 0xFFFFFFFF)


def _escaped(value) -> str:
    """A header is one line: line breaks and percent signs are escaped."""
    return str(value).replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unescaped(value: str | None) -> str | None:
    return value and value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id: int | str | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | str | None) -> bytes:
    """One WARC/1.1 record; a revisit has headers and no payload."""
    kind = "response" if refers_to is None else "revisit"
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest}")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
             f"X-Payload-Length: {len(payload)}", "Content-Type: text/html"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_escaped(url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {_escaped(page_id)}")
    body = payload
    if refers_to is not None:
        lines += [f"X-Refers-To-Page-Id: {_escaped(refers_to)}", f"WARC-Profile: {_PROFILE}"]
        body = b""
    lines.append(f"Content-Length: {len(body)}")
    return member("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(uri: str):
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else \
        (pafs.LocalFileSystem(), uri)


def _id_kind(pages: DataFrame) -> str:
    """Whole-number ids are kept as long, any other kind as its string."""
    return "long" if isinstance(pages.schema["page_id"].dataType, T.IntegralType) else "string"


def _make(uri: str):
    fs, path = _open(uri)
    fs.create_dir(path, recursive=True)
    return fs, path


def write_archives(pages: DataFrame, folder: str | None = None, least: int = REVISIT_BYTES) -> str:
    """Write one record per row of ``pages`` (page_id, url, html); the folder.

    Of the rows with equal payloads of at least ``least`` bytes the one with
    the smallest page_id is the response (the first of equal ids by url), the
    others are revisits of it.  A null html is an empty payload; rows without
    page_id are responses of their own; other columns are ignored.  Ids that
    are not whole numbers are written, and compared, as strings.  Digests
    are grouped apart from the payloads, so a payload that very many pages
    share is aggregated map-side and never gathered.
    """
    spark = pages.sparkSession
    folder = folder or fresh_folder(spark, "llm", "warc")
    _make(folder)  # also without a row to write
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    named = pages.select(F.col("page_id").cast(_id_kind(pages)).alias("page_id"), "url", html.alias("html"))
    # The 160-bit digest and the length stand for the payload.
    light = saved(named.select("page_id", "url", F.sha1("html").alias("sha1"),
                               F.octet_length("html").alias("size")), "warc_digests")
    first = light.where("page_id IS NOT NULL").groupBy("sha1", "size").agg(
        F.min(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n")) \
        .where((F.col("n") > 1) & (F.col("size") >= least))
    again = light.where("page_id IS NOT NULL").join(first, ["sha1", "size"]) \
        .where(~(F.struct("page_id", "url").eqNullSafe(F.col("first")))) \
        .select(F.col("page_id").alias("_id"), F.col("url").alias("_url"), "sha1",
                F.col("first.page_id").alias("refers_to")).distinct()
    # A row repeated whole: one copy is the response, the rest revisit it.
    twice = light.where("page_id IS NOT NULL").groupBy("sha1", "size", "page_id", "url").count() \
        .where((F.col("count") > 1) & (F.col("size") >= least))
    rows = named.withColumn("_sha1", F.sha1("html"))
    rows = rows.join(again, F.col("page_id").eqNullSafe(F.col("_id")) & F.col("url").eqNullSafe(F.col("_url"))
                     & (F.col("_sha1") == F.col("sha1")), "left") \
        .select("page_id", "url", "html", "_sha1", "refers_to")
    if not twice.isEmpty():
        rows = _repeated_rows(rows, twice)

    def run(batches):
        fs, path = _make(folder)
        task, attempt, part, out, n = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, None, 0

        def close():
            out.close()
            name = f"{path}/part-{task:05d}-{part:05d}.warc.gz"
            fs.move(f"{name}.{attempt}", name)
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())],
                                              names=["file", "records"])
        for b in batches:
            cols = [b.column(c) for c in ("page_id", "url", "html", "refers_to")]
            for i in range(b.num_rows):
                page, url, payload, refers = (c[i].as_py() for c in cols)
                if out is None:
                    n = 0
                    out = fs.open_output_stream(f"{path}/part-{task:05d}-{part:05d}.warc.gz.{attempt}",
                                                compression=None)
                out.write(record(page, url, payload, base32_sha1(payload), refers))
                n += 1
                if n >= FILE_RECORDS:
                    yield close()
                    out, part = None, part + 1
        if out is not None:
            yield close()
    saved(rows.select("page_id", "url", "html", "refers_to")
          .mapInArrow(run, "file string, records long"), "warc_written")
    return folder


def _repeated_rows(rows: DataFrame, twice: DataFrame) -> DataFrame:
    """Rows that repeat the response row itself: all but one refer to it."""
    from pyspark.sql import Window as W

    key = ["page_id", "url", "_sha1"]
    t = twice.select(F.col("page_id").alias("tp"), F.col("url").alias("tu"), F.col("sha1").alias("ts"))
    same = (F.col("page_id") == F.col("tp")) & F.col("url").eqNullSafe(F.col("tu")) & (F.col("_sha1") == F.col("ts"))
    others = rows.join(t, same, "left_anti")
    order = W.partitionBy(*key).orderBy("page_id")
    # Numbered without the payload; a page row repeats only a few times.
    inside = rows.join(t, same, "left_semi").withColumn("_n", F.row_number().over(order)) \
        .withColumn("refers_to", F.when(F.col("_n") > 1, F.coalesce("refers_to", "page_id"))
                    .otherwise(F.col("refers_to"))).drop("_n")
    return others.unionByName(inside)


class _Files(InputPartition):
    def __init__(self, files):
        self.files = files


class _Decoded:
    """The decoded bytes of an archive from the place its file stands at."""

    def __init__(self, f, packed: bool):
        self.f, self.packed, self.held = f, packed, bytearray()
        self.raw, self.inflate = b"", None

    def _more(self) -> bytes:
        """The next decoded piece, empty at the end of the file."""
        if not self.packed:
            return self.f.read(_CHUNK)
        while True:
            raw = self.raw or self.f.read(_CHUNK)
            if self.inflate is None:
                if not raw:
                    return b""
                self.raw = raw = raw.lstrip(b"\0")  # padding between members
                if not raw:
                    continue
                self.inflate = zlib.decompressobj(16 + zlib.MAX_WBITS)
            out = self.inflate.decompress(raw, _PIECE)
            if self.inflate.eof:
                self.raw, self.inflate = self.inflate.unused_data, None
            else:
                self.raw = self.inflate.unconsumed_tail
                if not raw and not out:
                    raise ValueError("the archive ends inside a gzip member")
            if out:
                return out

    def header(self) -> bytes | None:
        """The next record's header, without its blank line; None at the end."""
        while True:
            self.held = self.held.lstrip(b"\r\n")
            if self.held:
                break
            self.held += self._more()
            if not self.held:
                return None
        seen = 0
        while (at := self.held.find(b"\r\n\r\n", seen)) < 0:
            seen = max(0, len(self.held) - 3)
            more = self._more()
            if not more:
                raise ValueError("the archive ends inside a header")
            self.held += more
        head = bytes(self.held[:at])
        del self.held[:at + 4]
        return head

    def block(self, length: int, wanted: bool) -> bytes | None:
        """The next ``length`` bytes if wanted; else they are stepped over."""
        parts, left = [], length
        while left:
            part = bytes(self.held[:left])
            del self.held[:left]
            left -= len(part)
            if wanted:
                parts.append(part)
            elif left and not self.packed:
                self.f.seek(self.f.tell() + left)
                break
            if left:
                self.held += self._more()
                if not self.held:
                    raise ValueError("the archive ends inside a block")
        return b"".join(parts) if wanted else None


def _fields(head: bytes) -> dict[str, str]:
    """Header lines by lower-cased name; folded lines are joined."""
    out, last = {}, None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        last = name.strip().lower()
        out[last] = value.removeprefix(" ")
    return out


class WarcReader(DataSourceReader):
    """Reads the archives of a folder; see the module text."""

    def __init__(self, options, columns):
        self.folder = options["path"]
        self.columns = columns
        self.numbers = {c for c, kind in columns if kind == pa.int64()}
        self.payload = next((i for i, (c, _) in enumerate(columns) if c == "payload"), None)
        self.wanted: list[tuple[str, set]] = []

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.wanted.append((f.attribute[0], values))
            else:
                yield f

    def partitions(self):
        fs, path = _open(self.folder)
        found = sorted((f.path, f.size) for f in fs.get_file_info(pafs.FileSelector(path))
                       if f.path.endswith((".warc.gz", ".warc")))
        groups, size = [[]], 0
        for name, n in found:
            if groups[-1] and size + n > PARTITION_BYTES:
                groups.append([])
                size = 0
            groups[-1].append(name)
            size += n
        return [_Files(g) for g in groups]

    def read(self, partition):
        fs, _ = _open(self.folder)
        rows, size = [], 0
        for name in partition.files:
            with fs.open_input_file(name) as f:
                try:
                    for row in self._records(f) if name.endswith(".gz") else self._foreign(f, False):
                        rows.append(row)
                        size += len(row[self.payload]) if self.payload is not None else 0
                        if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                            yield self._batch(rows)
                            rows, size = [], 0
                except (ValueError, zlib.error) as e:
                    raise ValueError(f"{name}: {e}") from e
        yield self._batch(rows)

    def _batch(self, rows):
        cols = []
        for i, (name, kind) in enumerate(self.columns):
            cols.append(pa.array([r[i] for r in rows], kind))
        return pa.RecordBatch.from_arrays(cols, names=[c for c, _ in self.columns])

    def _row(self, fields: dict) -> dict | None:
        """Columns of a record from its header, None if a filter drops it."""
        row = {c: fields.get(h.lower()) for c, h in HEADERS.items()}
        if row["payload_length"] is not None:  # written by ``record``
            for c in ("target_uri", *_IDS):
                row[c] = _unescaped(row[c])
        elif row["target_uri"] is not None:  # some writers put it in angle brackets
            row["target_uri"] = row["target_uri"].strip().removeprefix("<").removesuffix(">")
        for c in self.numbers:
            row[c] = int(row[c]) if row[c] is not None and _INTEGER.fullmatch(row[c]) else None
        if row["payload_digest"] is not None:
            row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
        return row if all(row[c] in values for c, values in self.wanted) else None

    def _foreign(self, f, packed: bool):
        """Records from here to the end, whoever wrote them."""
        data = _Decoded(f, packed)
        while (head := data.header()) is not None:
            if not head.startswith(b"WARC/"):
                raise ValueError(f"no record where {head[:40]!r} stands")
            fields = _fields(head)
            row = self._row(fields)
            needs = row is not None and self.payload is not None
            block = data.block(int(fields["content-length"]), needs)
            if needs:
                http = (fields.get("content-type") or "").strip().lower().startswith("application/http")
                row["payload"] = block.partition(b"\r\n\r\n")[2] if http else block
            if row is not None:
                yield [row[c] for c, _ in self.columns]

    def _records(self, f):
        size, at = f.size(), 0
        while at < size:
            f.seek(at)
            front = f.read(4096)
            if front[:4] != b"\x1f\x8b\x08\x04" or front[12:14] != b"SL":
                f.seek(at)
                yield from self._foreign(f, True)
                return
            total = struct.unpack("<I", front[16:20])[0]
            inflate = zlib.decompressobj(-zlib.MAX_WBITS)
            data = bytearray(inflate.decompress(front[20:], 8192))
            used, seen = 4096, 0
            while data.find(b"\r\n\r\n", seen) < 0:
                seen = max(0, len(data) - 3)
                tail = inflate.unconsumed_tail
                more = b"" if tail or used >= total else f.read(4096)
                if inflate.eof or not (tail or more):
                    raise ValueError(f"no end of the header of the record at byte {at}")
                used += len(more)
                data += inflate.decompress(tail or more, 8192)
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = _fields(bytes(head))
            row = self._row(fields)
            if row is not None:
                if self.payload is not None:
                    length = int(fields["content-length"])
                    tail = inflate.unconsumed_tail + f.read(max(0, total - used))
                    if len(rest) < length:
                        rest += inflate.decompress(tail)
                    row["payload"] = bytes(rest[:length])
                yield [row[c] for c, _ in self.columns]
            at += total


class WarcSource(DataSource):
    """``spark.read.format("warc").option("payload", ...).load(folder)``.

    ``payload``: "true" adds the payload column (inflates what passes the
    filters), "false" leaves payloads unread.  ``ids``: the type of page_id
    and refers_to, "long" (the default) or "string"; a header that is no such
    number is null as a long.
    """

    @classmethod
    def name(cls):
        return "warc"

    def _columns(self):
        numbers = {"payload_length", *(_IDS if self.options.get("ids", "long") == "long" else ())}
        cols = [(c, pa.int64() if c in numbers else pa.string()) for c in HEADERS]
        if self.options.get("payload", "false").lower() == "true":
            cols.append(("payload", pa.binary()))
        return cols

    def schema(self):
        names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
        return ", ".join(f"{c} {names[k]}" for c, k in self._columns())

    def reader(self, schema):
        return WarcReader(dict(self.options), self._columns())


def read_archives(spark: SparkSession, folder: str, payload: bool = False,
                  where: dict | None = None, ids: str = "long") -> DataFrame:
    """Records of the archives in ``folder``; ``where`` (column: value) is
    pushed to the source; ``ids`` is the type of the page ids."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    df = spark.read.format("warc").option("payload", str(payload).lower()) \
        .option("ids", ids).load(folder)
    conds = [F.col(c) == v for c, v in (where or {}).items()]
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32(hex_digest):
    """Bare base32 of a hex SHA-1: 5 hex digits give 4 letters."""
    letters = []
    for i in range(0, 40, 5):
        v = F.conv(F.substring(hex_digest, i + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(_ALPHABET), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1))
                    for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def op9_warc(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the archives, then return the records as read back.

    Responses are read with payload, and their length and digest are taken
    from the bytes; revisits are read by their headers alone.
    """
    folder = write_archives(pages)
    kind, ids = pages.schema["page_id"].dataType, _id_kind(pages)
    whole = read_archives(spark, folder, True, {"record_type": "response"}, ids).select(
        F.col("page_id").cast(kind).alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        _base32(F.sha1("payload")).alias("payload_digest"), "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))
    again = read_archives(spark, folder, False, {"record_type": "revisit"}, ids).select(
        F.col("page_id").cast(kind), F.col("payload_length").alias("payload_bytes"), "payload_digest",
        "record_type", F.col("refers_to").cast(kind))
    return whole.unionAll(again)


OP9_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS d,
  min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{_ALPHABET}',
    CAST((CAST('0x' || substr(d, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT) + 1, 1)), '')
    AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM x
"""
