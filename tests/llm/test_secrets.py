import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib

import pytest
import zstandard

from tierline.llm import secrets as S

KINDS = [("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 8),
         ("access", re.compile("AKIA[A-Z0-9]+"), 16), ("hex", re.compile("[0-9a-f]+"), 32)]


def naive(t):
    found = []
    for k, (name, rx, least) in enumerate(KINDS):
        found += [(m.start(), k, m.end()) for m in rx.finditer(t) if len(m.group(1) if k == 0 else m.group()) >= least]
    return ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in sorted(found))


def test_base_patterns_against_naive():
    rng = random.Random(4)
    bits = ["password", "PassWd", "toKen", "secret", "api_key", "APIKEY", "apiKey", ":", "=", " ", "\"", "'", "abc",
            "AKIA", "AKIAIOSF", "ABCDEFGH1234", "deadbeef" * 4, "0f" * 15, "é", "ſecret", "\n", "x=token: ", "short", "0123456789abcdef0123456789abcdef"]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        r = S.scan_text(t)
        assert r["base_sha256"] == hashlib.sha256(naive(t).encode()).hexdigest(), t
        assert set(filter(None, naive(t).split(","))) <= set(r["spans"].split(","))
        assert r["n_assign"] + r["n_access"] + r["n_hex"] == len(naive(t).split(",")) * bool(naive(t))


SECRET = "password=abcd1234efgh"
B64 = lambda b: base64.b64encode(b).decode()
U = SECRET.encode()
LAYERS = {
    "percent": urllib.parse.quote(SECRET, safe=""),
    "percent twice": urllib.parse.quote(urllib.parse.quote(SECRET, safe=""), safe=""),
    "u": "".join(f"\\u{ord(c):04x}" for c in SECRET), "x": "".join(f"\\x{ord(c):02x}" for c in SECRET),
    "reference": "".join(f"&#{ord(c)};" for c in SECRET),
    "base64": B64(U), "url-safe": base64.urlsafe_b64encode(U + b"???>>>").decode(), "unpadded": B64(U + b"!").rstrip("="),
    "base64 twice": B64(B64(U).encode()), "gzip": B64(gzip.compress(U)), "zlib": B64(zlib.compress(U)),
    "bz2": B64(bz2.compress(U)), "xz": B64(lzma.compress(U)), "zstd": B64(zstandard.compress(U)),
    "gzip in gzip": B64(gzip.compress(gzip.compress(U))),
    "mixed": urllib.parse.quote(B64(gzip.compress(urllib.parse.quote(B64(U), safe="").encode())), safe=""),
    "raw gzip in percent": "".join(f"%{b:02X}" for b in gzip.compress(U))}


@pytest.mark.parametrize("name", LAYERS)
def test_layers_are_unwrapped(name):
    t = "é start " + LAYERS[name] + " end"
    r = S.scan_text(t)
    spans = [x.split(":") for x in r["spans"].split(",")]
    lo, hi = t.index(LAYERS[name]), t.index(" end")
    assert any(k == "assign" and lo <= int(a) < int(b) <= hi for k, a, b in spans)
    assert r["n_decoded"] >= 1


def test_exact_mapping_of_a_layer():
    t = "é x%3Dy password%3D" + "abcd1234" + " z"
    assert S.scan_text(t)["spans"] == f"assign:{t.index('pass')}:{t.index(' z')}"
    inner = "id: 7; token: 0123456789"
    t = "blob " + B64(inner.encode()) + "."
    k, a, b = S.scan_text(t)["spans"].split(":")
    at = inner.index("token")
    assert (k, int(a), int(b)) == ("assign", 5 + at * 4 // 3, 5 + -(-len(inner) * 4 // 3))


def test_cycles_and_large_layers_end(monkeypatch):
    assert S.scan_text("%25" * 2000)["spans"] == ""
    assert S.scan_text("\\u005cu005c" * 500)["n_unopened"] == 0
    monkeypatch.setattr(S, "LAYER_BYTES", 1000)
    assert S.scan_text(B64(zlib.compress(b"a" * 100_000)))["n_unopened"] >= 1


def secrets_of(text):
    return [x for x in S.scan_text(text)["spans"].split(",") if x.startswith("assign")]


LONG = "first line of the text, then password=abcd1234efgh and more to fill up the run!!"
HARD = bytes(random.Random(9).randbytes(90)) + U + b" "


def wrapped(code, width, sep="\n"):
    return sep.join(code[i:i + width] for i in range(0, len(code), width))


@pytest.mark.parametrize("text", [
    B64((LONG + "!").encode()[:81]) + "\nNext words", B64(gzip.compress(HARD)).rstrip("=") + "\nNexts words",
    "https://host.tld/cb/" + B64(U), "token-" + B64(U), "x_" + B64(U), "abc/" + B64(gzip.compress(U)), "ab-" + B64(zlib.compress(U)),
    wrapped(B64(U), 20), wrapped(B64(U), 8), wrapped(B64(gzip.compress(U)), 32), wrapped(B64(lzma.compress(U)), 50, "\r\n"),
    "key: |\n    " + wrapped(B64(bz2.compress(U)), 40, "\n    "), "id\n" + wrapped(B64(U), 24) + "\nend"])
def test_runs_and_their_neighbours(text):
    assert secrets_of(text)


def test_place_of_a_run_beside_others():
    t = "https://host.tld/cb/" + B64(U) + "\nNext"
    k, a, b = secrets_of(t)[0].split(":")  # the next word may go on with the value
    assert int(a) == 20 and 0 <= int(b) - 20 - len(B64(U)) <= 3
    code = B64(gzip.compress(U + b"!")).rstrip("=")
    k, a, b = secrets_of("ab-" + code + "\nNext")[0].split(":")
    assert int(a) == 3 and 0 <= 3 + len(code) - int(b) <= 1


OTHER = b"nothing of interest in this one. "
MEMBERS = {"gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress, "zstd": zstandard.compress}


@pytest.mark.parametrize("name", MEMBERS)
def test_all_members_and_large_layers(name, monkeypatch):
    pack = MEMBERS[name]
    assert secrets_of(B64(pack(OTHER) + pack(U)))
    assert secrets_of(B64(pack(pack(OTHER) + pack(U))))
    monkeypatch.setattr(S, "LAYER_BYTES", 1000)
    monkeypatch.setattr(S, "WINDOW", 5000)
    monkeypatch.setattr(S, "OVERLAP", 100)
    rng = random.Random(2)
    for at in range(4900, 5100, 7):
        big = (OTHER * 1000)[:at] + U + b" " + OTHER * 1000
        r = S.scan_text(B64(pack(big)))
        assert r["spans"].startswith("assign") and r["n_unopened"] == 1
    deep = b" ".join([OTHER * 200, base64.b64encode(gzip.compress(rng.randbytes(20_000) + U)), OTHER * 200])
    assert secrets_of(B64(pack(deep))) and secrets_of(B64(pack(pack(deep) + pack(OTHER))))


def test_bytes_that_are_no_text():
    for raw in (b"\0A=1\0" + U + b"\0", "Schlüssel: ".encode("latin-1") + U, b"x^2 \xff\xfe" + U):
        code = "".join(f"%{b:02X}" for b in raw)
        assert secrets_of(B64(raw)) and secrets_of(code) and secrets_of(B64(gzip.compress(raw)))
        a = raw.index(U)
        assert f"assign:{3 * a}:{3 * a + 3 * len(U)}" in secrets_of(code)


def test_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, SECRET), (3, SECRET), (None, "AKIA" + "A" * 16), (5, "w " * 200_000 + LAYERS["gzip"])]
    out = S.op2_secret_scan(spark, docs_of(rows, clash=["spans", "n_hex"])).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[1].spans == by[2].spans == "" and by[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[3].n_assign == 1 and by[3].spans == f"assign:0:{len(SECRET)}"
    assert by[None].n_access == 1 and by[5].n_decoded == 1
    assert S.op2_secret_scan(spark, docs_of(rows).limit(0)).count() == 0


PACKERS = [gzip.compress, zlib.compress, bz2.compress, zstandard.compress, lambda b: lzma.compress(b, preset=0)]


def test_thousands_of_nested_layers():
    raw = b"x " + U
    for i in range(5000):
        raw = (gzip.compress if i % 2 else zlib.compress)(raw, 1)
    t = f"a {B64(raw)} b"
    assert secrets_of(t) and S.scan_text(t)["n_unopened"] == 0


TEXTUAL = [lambda b: base64.b64encode(b), lambda b: base64.urlsafe_b64encode(b).rstrip(b"="),
           lambda b: urllib.parse.quote_from_bytes(b, safe="").encode(),
           lambda b: "".join(f"%{c:02x}" for c in b).encode(), lambda b: base64.encodebytes(b)]
ESCAPES = [lambda t: "".join(f"\\u{ord(c):04x}" for c in t), lambda t: "".join(f"\\x{ord(c):02x}" for c in t),
           lambda t: "".join(f"&#x{ord(c):X};" for c in t), lambda t: t]


@pytest.mark.parametrize("seed", range(60))
def test_random_orders_of_layers_are_unwrapped(seed):
    """Every secret is found below any chain of encodings, at its place."""
    rng = random.Random(seed)
    kind, secret = rng.choice([("assign", "api_key: '%s'" % "".join(rng.choices("abcXYZ019+/_", k=rng.randint(8, 40)))),
                               ("access", "AKIA" + "".join(rng.choices("ABCXYZ0189", k=16))),
                               ("hex", "".join(rng.choices("0123456789abcdef", k=40)))])
    raw = rng.choice([b"", "é ".encode(), b"\xff\x00 ", b"text before "]) + rng.choice(ESCAPES)(secret).encode() \
        + rng.choice([b"", b" after", b"\xfe"])
    for _ in range(rng.randint(1, 5)):
        if rng.random() < 0.6:
            raw = rng.choice(PACKERS)(raw)
        raw = rng.choice(TEXTUAL)(raw)
    before = rng.choice(["", "some words, ", "größe "])
    text = f"{before}{raw.decode()}\n end"
    spans = [s.split(":") for s in S.scan_text(text)["spans"].split(",") if s]
    assert any(k == kind and len(before) <= int(a) < int(b) <= len(text) for k, a, b in spans), text[:300]


def test_noise_is_cheap_and_holds_the_secret_beside_it():
    import time
    noise = random.Random(1).randbytes(3 << 20)
    t0 = time.process_time()
    r = S.scan_text(f"{B64(noise)} {B64(U)} {B64(noise[:1000] + U + noise[1000:2000])}")
    assert r["n_decoded"] >= 2 and time.process_time() - t0 < 60
