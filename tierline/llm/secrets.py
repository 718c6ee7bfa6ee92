"""Secret scans that look through nested encodings.

A text is the first layer of a worklist.  Every layer is scanned with the base
patterns, then unwrapped: percent escapes and Unicode escapes (``\\u``, ``\\x``,
``\\U``, numeric character references) are decoded in place, base64 runs and
compressed payloads (gzip, zlib, bzip2, xz, zstandard) become layers of their
own.  A base64 run goes on over line breaks and is decoded at all four places
that its first group of letters may have, so neighbours do not hide it; payloads
are looked for at every byte, in all their members.  Decoded bytes are scanned in
their runs of printable ASCII: neither a match nor an encoding goes beyond one,
and a run shorter than the shortest secret holds none.  Each new layer, text or
compressed, joins the worklist until none is new, however deep they lie in each
other; a layer that has been seen at the same place is not opened again, so
cycles end.  Every
character of a layer knows the stretch of the original text it came from, and
matches are reported there.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import itertools
import lzma
import re
import urllib.parse
import zlib

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KINDS = ("assign", "access", "hex")
#: A compressed layer is held in one piece up to this size; a larger one is
#: counted in n_unopened and scanned in windows, all of it.
LAYER_BYTES = 32 << 20
#: Windows of large layers: their size, and what two neighbours share at least.
#: A base64 run is never cut; a window grows with it.
WINDOW, OVERLAP = 4 << 20, 64 << 10


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAME = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) \
    + "|" + _either_case("api") + "_?" + _either_case("key")
_ASSIGN = re.compile(rf"""(?:{_NAME})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
#: Percent-encoded bytes with those that an encoder leaves as they are.
_QUOTED = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~!*'();:@&=+$,/?-])+")
_ESCAPE = re.compile(
    r"\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\}"
    r"|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[xX][0-9A-Fa-f]{1,6};|&#[0-9]{1,7};")
_LETTER, _WRAP = "[A-Za-z0-9+/_-]", r"[ \t]*+\r?\n[ \t]*+"
_BASE64 = re.compile(rf"(?<!{_LETTER})(?:{_LETTER}{{16,}}+(?:{_WRAP}{_LETTER}++)*+|{_LETTER}++(?:{_WRAP}{_LETTER}++)++)={{0,2}}")
_URL_SAFE = bytes.maketrans(b"-_", b"+/")
#: A base64 run at the end of a window, read backwards.
_TAIL = re.compile(rb"(?:[A-Za-z0-9+/_-]++|[ \t]*+\n\r?[ \t]*+)*+")
_SPACES = re.compile(rb" {65,}")
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00"
                    rb"|\x28\xb5\x2f\xfd|[\x50-\x5f]\x2a\x4d\x18")
#: Decoded bytes that can hold a match: "token=" and eight characters at least.
_RUN = re.compile(rb"[\t\n\r\x20-\x7e]{14,}")
#: Without any of these, bytes have neither matches nor further layers.
_ANY = re.compile(rf"{_NAME}|AKIA|[0-9a-f]{{32}}|%[0-9A-Fa-f]{{2}}|\\[uUx]|&#|{_LETTER}{{16}}|{_LETTER}{_WRAP}{_LETTER}".encode())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost non-overlapping per
    kind.  Runs that fall short of their length are no matches; an assignment
    with a short value still uses up its text."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


class _Layer:
    """Text with the original [start, end) of each of its characters."""

    def __init__(self, text: str, start: np.ndarray, end: np.ndarray):
        self.text, self.start, self.end = text, start, end

    def place(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a]), int(self.end[b - 1])


def _replaced(layer: _Layer, parts: list[tuple[int, int, str, list[int]]]) -> _Layer:
    """The layer with [a, b) replaced by decoded characters; the list gives
    how many characters of [a, b) each decoded one stands for."""
    text, start, end, at = [], [], [], 0
    for a, b, chars, used in parts:
        text.append(layer.text[at:a])
        start.append(layer.start[at:a])
        end.append(layer.end[at:a])
        stop = a + np.cumsum(used)
        start.append(layer.start[stop - np.array(used)])
        end.append(layer.end[stop - 1])
        text.append(chars)
        at = b
    text.append(layer.text[at:])
    start.append(layer.start[at:])
    end.append(layer.end[at:])
    return _Layer("".join(text), np.concatenate(start), np.concatenate(end))


_LONE = re.compile("[\udc80-\udcff]")


def _pieces(raw: bytes, at: int = 0):
    """The bytes from ``at`` on; little first, in case they are no payload."""
    yield bytes(raw[at:at + 1024])
    for a in range(at + 1024, len(raw), 1 << 16):
        yield bytes(raw[a:a + (1 << 16)])


class _Inflate:
    """Content of the compressed members at the start of a byte stream;
    ``used``: length of the complete ones."""

    def __init__(self, source):
        self.source, self.data, self.used = iter(source), b"", 0

    def more(self) -> bool:
        part = next(self.source, None)
        self.data += part or b""
        return part is not None

    def chunks(self):
        """The inflated bytes in pieces; whatever precedes an error counts."""
        while True:
            while len(self.data) < 10 and self.more():
                pass
            m = _MAGIC.match(self.data)
            if m is None:
                return
            try:
                yield from self._member(m.group())
            except (zlib.error, OSError, EOFError, ValueError, MemoryError, lzma.LZMAError, zs.ZstdError):
                return

    def _member(self, magic: bytes):
        if magic[1:] == b"\x2a\x4d\x18":  # a skippable zstandard frame
            left = taken = 8 + int.from_bytes(self.data[4:8], "little")
            while left > 0 and (self.data or self.more()):
                n = min(left, len(self.data))
                self.data, left = self.data[n:], left - n
            self.used += taken - left
            return
        flat = magic[0] in (0x1f, 0x78)
        if flat:
            d = zlib.decompressobj(zlib.MAX_WBITS | 32)
        elif magic[:3] == b"BZh":
            d = bz2.BZ2Decompressor()
        elif magic[0] == 0xfd:
            d = lzma.LZMADecompressor(memlimit=256 << 20)
        else:
            d = zs.ZstdDecompressor().decompressobj()
        taken = 0
        while not d.eof:
            if not self.data and not self.more():
                return
            # zstandard has no bound of its output: little input at a time.
            given = self.data[:1 << 10] if magic[0] == 0x28 else self.data[:1 << 16]
            self.data = self.data[len(given):]
            taken += len(given)
            if flat:
                out = d.decompress(given, 1 << 20)
                while d.unconsumed_tail:
                    yield out
                    out = d.decompress(d.unconsumed_tail, 1 << 20)
            elif magic[0] == 0x28:
                out = d.decompress(given)
            else:
                out = d.decompress(given, 1 << 20)
                while not d.eof and not d.needs_input:
                    yield out
                    out = d.decompress(b"", 1 << 20)
            if d.eof:
                self.data = d.unused_data + self.data
                self.used += taken - len(d.unused_data)
            if out:
                yield out
        # xz streams may be padded.
        while magic[0] == 0xfd and (self.data or self.more()) and self.data[:4] == b"\0\0\0\0":
            self.data, self.used = self.data[4:], self.used + 4


def _as_text(raw: bytes) -> tuple[str, list[int]]:
    """Text and the bytes per character; an undecodable byte is one."""
    text = raw.decode("utf-8", "surrogateescape")
    if len(text) == len(raw):
        size = [1] * len(raw)
    else:
        size = [1 if c < "\x80" or "\udc80" <= c <= "\udcff" else len(c.encode()) for c in text]
    return _LONE.sub("\ufffd", text), size


def _escape_char(s: str) -> str | None:
    if s[0] == "&":
        code = int(s[3:-1], 16) if s[2] in "xX" else int(s[2:-1])
    elif s[1] == "u" and len(s) == 12:
        code = 0x10000 + ((int(s[2:6], 16) - 0xD800) << 10) + int(s[8:], 16) - 0xDC00
    else:
        code = int(s[2:].strip("{}"), 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None


class _Scan:
    def __init__(self, text: str):
        self.base = base_spans(text)
        self.spans = set(self.base)
        self.unopened = 0
        self.seen: set[bytes] = set()
        self.work: list[_Layer] = []
        self.packed: list[tuple[int, int, bytes]] = []  # inflated, not yet looked at
        where = np.arange(len(text) + 1)
        self.open(_Layer(text, where[:-1], where[1:]), root=True)
        self.drain()

    def drain(self) -> None:
        while self.work or self.packed:
            if self.packed:
                self.unpack(*self.packed.pop())
            else:
                self.open(self.work.pop())

    def push(self, layer: _Layer) -> None:
        if not layer.text:
            return
        key = hashlib.sha256(layer.text.encode("utf-8", "surrogatepass"))
        key.update(f"|{layer.start[0]}|{layer.end[-1]}".encode())
        if key.digest() not in self.seen:
            self.seen.add(key.digest())
            self.work.append(layer)

    def content(self, start: int, end: int, chunks) -> None:
        """Take in the bytes of a payload found at original [start, end): as a
        layer of the worklist, or, beyond LAYER_BYTES, in windows at once."""
        chunks, held, size = iter(chunks), [], 0
        while size <= LAYER_BYTES and (c := next(chunks, None)) is not None:
            held.append(c)
            size += len(c)
        raw = b"".join(held)
        if size <= LAYER_BYTES:
            key = hashlib.sha256(raw + b"|%d|%d|bytes" % (start, end)).digest()
            if raw and key not in self.seen:
                self.seen.add(key)
                self.packed.append((start, end, raw))
            return
        self.unopened += 1

        def pieces(first, chunks):
            yield from _pieces(first)
            yield from chunks

        stream = pieces(raw, chunks)
        if _MAGIC.match(raw):
            inner = _Inflate(stream)
            self.content(start, end, inner.chunks())
            stream = pieces(inner.data, inner.source)
        held, need = bytearray(), WINDOW
        for c in stream:
            held += c
            if len(held) < need:
                continue
            held = bytearray(_SPACES.sub(b" " * 64, held))
            self.fixed(start, end, bytes(held))
            while self.work:
                self.open(self.work.pop())
            keep = max(OVERLAP, _TAIL.match(held[::-1]).end())
            del held[:max(0, len(held) - keep)]
            need = max(WINDOW, 2 * len(held))
        self.fixed(start, end, bytes(held))

    def unpack(self, start: int, end: int, raw: bytes) -> None:
        """One inflated layer: what is compressed at its start joins the
        worklist, the rest is text."""
        if _MAGIC.match(raw):
            inner = _Inflate(_pieces(raw))
            self.content(start, end, inner.chunks())
            raw = raw[inner.used:]
        self.fixed(start, end, raw)

    def fixed(self, start: int, end: int, raw: bytes) -> None:
        """Layers whose characters all come from original [start, end)."""
        for m in _RUN.finditer(raw):
            if _ANY.search(m.group()):
                text = m.group().decode("ascii")
                self.push(_Layer(text, np.broadcast_to(start, len(text)), np.broadcast_to(end, len(text))))

    def payloads(self, raw: bytes, place) -> bytes:
        """Open the compressed payloads in ``raw``; ``place`` gives the original
        place of some of its bytes.  Complete ones come back as zeros."""
        at, left = 0, bytearray(raw)
        while (m := _MAGIC.search(raw, at)) is not None:
            at = m.start()
            inner = _Inflate(_pieces(raw, at))
            chunks, held, size = inner.chunks(), [], 0
            # Its length is known at its end; a larger one goes on to the end.
            while size <= LAYER_BYTES and (c := next(chunks, None)) is not None:
                held.append(c)
                size += len(c)
            whole = inner.used and size <= LAYER_BYTES
            if held:
                self.content(*place(at, at + inner.used if whole else len(raw)), itertools.chain(held, chunks))
            left[at:at + inner.used] = bytes(inner.used)
            at += inner.used or 1
        return bytes(left)

    def open(self, layer: _Layer, root: bool = False) -> None:
        text = layer.text
        if not root:
            for a, kind, b in base_spans(text):
                start, end = layer.place(a, b)
                self.spans.add((start, kind, end))
        if "%" in text:
            for m in _QUOTED.finditer(text):
                self.quoted(layer, m)
            parts = []
            for m in _PERCENT.finditer(text):
                raw = binascii.unhexlify(m.group().replace("%", ""))
                try:
                    chars = raw.decode("utf-8")
                    size = [len(c.encode()) for c in chars]
                except UnicodeDecodeError:
                    at = m.start()
                    raw = self.payloads(raw, lambda a, b, at=at: layer.place(at + 3 * a, at + 3 * b))
                    chars, size = _as_text(raw)
                parts.append((*m.span(), chars, [3 * n for n in size]))
            if parts:
                self.push(_replaced(layer, parts))
        if "\\" in text or "&#" in text:
            parts = [(*m.span(), c, [m.end() - m.start()]) for m in _ESCAPE.finditer(text)
                     if (c := _escape_char(m.group())) is not None]
            if parts:
                self.push(_replaced(layer, parts))
        for m in _BASE64.finditer(text):
            run = np.frombuffer(m.group().encode(), np.uint8)
            letters = np.flatnonzero((run > 32) & (run != 61))
            if len(letters) >= 16:
                self.base64(layer, m, run[letters].tobytes().translate(_URL_SAFE), letters + m.start())

    def quoted(self, layer: _Layer, m: re.Match) -> None:
        """Compressed payloads among percent-encoded and plain bytes."""
        raw = urllib.parse.unquote_to_bytes(m.group())
        if len(raw) == len(m.group()) or not _MAGIC.search(raw):
            return
        code = np.frombuffer(m.group().encode(), np.uint8)
        sign = np.flatnonzero(code == 0x25)
        first = np.ones(len(code), bool)
        first[sign + 1] = first[sign + 2] = False
        start = np.flatnonzero(first) + m.start()
        end = np.append(start[1:], m.end())
        self.payloads(raw, lambda a, b: layer.place(int(start[a]), int(end[b - 1])))

    def base64(self, layer: _Layer, m: re.Match, code: bytes, letters: np.ndarray) -> None:
        for skip in range(4):
            n = len(code) - skip
            n -= n % 4 == 1
            raw = base64.b64decode(code[skip:skip + n] + b"=" * (-n % 4))
            where = letters[skip:skip + n]

            def place(a, b, raw=raw, where=where):
                last = m.end() if b == len(raw) else int(where[-(-b * 4 // 3) - 1]) + 1
                return layer.place(int(where[a * 4 // 3]), last)

            if _MAGIC.search(raw):
                raw = self.payloads(raw, place)
            # Text: every decoded character maps to its own code letters.
            for run in _RUN.finditer(raw):
                if _ANY.search(run.group()):
                    i = np.arange(run.start(), run.end())
                    a = where[i * 4 // 3]
                    b = where[np.minimum(-(-(i + 1) * 4 // 3), len(where)) - 1]
                    self.push(_Layer(run.group().decode("ascii"), layer.start[a], layer.end[b]))


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan_text(text: str | None) -> dict:
    """Base and decoded spans of one text (null: empty)."""
    s = _Scan(text or "")
    kinds = [k for _, k, _ in s.base]
    return {"n_assign": kinds.count(0), "n_access": kinds.count(1), "n_hex": kinds.count(2),
            "base_sha256": hashlib.sha256(_joined(s.base).encode()).hexdigest(),
            "spans": _joined(s.spans), "n_decoded": len(s.spans) - len(set(s.base)),
            "n_unopened": s.unopened}


_KINDS_OUT = {"n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(),
              "base_sha256": pa.string(), "spans": pa.string(), "n_decoded": pa.int64(),
              "n_unopened": pa.int64()}


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and the scan of every row of ``docs``; one row per input row.

    Null and empty texts have no spans.  Columns other than doc_id and text
    are never read.
    """
    out = T.StructType([docs.schema["doc_id"]] + [
        T.StructField(k, T.StringType() if v == pa.string() else T.LongType())
        for k, v in _KINDS_OUT.items()])

    def run(batches):
        for b in batches:
            rows = [scan_text(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array([r[k] for r in rows], v) for k, v in _KINDS_OUT.items())],
                names=["doc_id", *_KINDS_OUT])
    return docs.select("doc_id", "text").mapInArrow(run, out)


def op2_secret_scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return scan(docs)
