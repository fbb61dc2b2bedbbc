"""Base findings against the plain patterns; decoded ones against planted spans."""

import base64
import bz2
import gzip
import hashlib
import lzma
import re
import urllib.parse
import zlib

import pytest
import zstandard
from hypothesis import given
from hypothesis import strategies as st

from labelmill.llm.queries import op1_secret_scan
from labelmill.llm.secret_scan import KINDS, matches, scan, scan_secrets

PATTERNS = {
    "assign": re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def plain(text):
    out = []
    for i, kind in enumerate(KINDS):
        for m in PATTERNS[kind].finditer(text):
            if {"assign": len(m[m.lastindex or 0]) >= 8, "access": len(m[0]) >= 16, "hex": len(m[0]) >= 32}[kind]:
                out.append((m.start(), i, m.end()))
    return sorted(out)


parts = st.sampled_from(["secret", "Token", "api_key", "APIKEY", "passwd", "=", ":", " ", '"', "AKIA", "ABCDEF0123456789", "abcdef01", "0" * 31, "=x-y/z_w.", "é", "ſecret", "\n", "K"])


@given(st.lists(parts, max_size=14))
def test_base_findings_equal_plain_patterns(some):
    text = "".join(some)
    base, spans, _, _ = scan(text)
    assert base == plain(text) == matches(text)
    assert set(base) <= set(spans)


SECRET = 'token = "abcdefgh12345"'
zstd = lambda b: zstandard.ZstdCompressor().compress(b)
b64 = lambda b: base64.b64encode(b).decode()
ENCODINGS = {
    "url": lambda s: "".join(f"%{b:02x}" for b in s.encode()),
    "url twice": lambda s: urllib.parse.quote(urllib.parse.quote(s, safe=""), safe=""),
    "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    "references": lambda s: "".join(f"&#{ord(c)};" for c in s),
    "base64": lambda s: b64(s.encode()),
    "url-safe base64": lambda s: base64.urlsafe_b64encode(f"ÿþ {s}".encode()).decode(),
    "base64 of base64 in url": lambda s: urllib.parse.quote(b64(b64(s.encode()).encode()), safe=""),
    **{f"base64 of {f.__name__ if hasattr(f, '__name__') else f}": lambda s, f=f: b64(f(s.encode())) for f in (zlib.compress, gzip.compress, bz2.compress, lzma.compress)},
    "base64 of zstd": lambda s: b64(zstd(s.encode())),
    "gzip in gzip": lambda s: b64(gzip.compress(gzip.compress(s.encode()))),
    "percent-encoded gzip": lambda s: "".join(f"%{b:02X}" for b in gzip.compress(s.encode())),
}


@pytest.mark.parametrize("name", ENCODINGS)
def test_findings_of_decoded_layers_lie_in_their_part(name):
    part = ENCODINGS[name](SECRET)
    text = f"日本 😀 {part} tail"
    _, spans, layers, cut = scan(text)
    found = [(a, b) for a, k, b in spans if KINDS[k] == "assign"]
    assert found and layers and not cut
    assert all(5 <= a < b <= 5 + len(part) for a, b in found)


UNCLEAN = {
    "NUL": lambda s: b"name\x00\x00" + s,
    "latin-1": lambda s: "é ".encode("latin-1") + s,
    "coloured": lambda s: b"\x1b[31m" + s + b"\x1b[0m",
    "utf-16": lambda s: s.decode().encode("utf-16"),
    "utf-16 be": lambda s: s.decode().encode("utf-16-be"),
}
COMPRESSED = {"gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress, "zstd": zstd}


def assigned(text):
    _, spans, _, cut = scan(text)
    return any(KINDS[k] == "assign" for _, k, _ in spans) and not cut


@pytest.mark.parametrize("name", UNCLEAN)
def test_unclean_layers_are_scanned(name):
    assert assigned(b64(gzip.compress(UNCLEAN[name](SECRET.encode()))))


@pytest.mark.parametrize("name", COMPRESSED)
def test_all_members_are_read(name):
    pack = COMPRESSED[name]
    assert assigned(b64(pack(b"first words") + pack(b"second words") + pack(SECRET.encode())))
    assert assigned(b64(pack(pack(b"first words") + pack(SECRET.encode()))))


def test_long_layers_are_read_to_their_end():
    lines = b"some words, and more of them\n" * 3_000_000
    assert assigned(b64(gzip.compress(lines + SECRET.encode(), 1)))


def test_nested_layers_beyond_the_stack():
    raw = SECRET.encode()
    for _ in range(1200):
        raw = zlib.compress(raw, 0)
    assert assigned(b64(raw))


@pytest.mark.parametrize("name", COMPRESSED)
def test_usual_percent_encoding_and_glued_prefixes(name):
    raw = COMPRESSED[name](SECRET.encode())
    assert assigned("x=" + urllib.parse.quote(raw)) and assigned("x=" + urllib.parse.quote(raw, safe="")) and assigned("x=" + urllib.parse.quote_plus(raw))
    for prefix in ("host/path/", "/", "some-name_", "a/" + b64(gzip.compress(b"other")).rstrip("=") + "/"):
        assert assigned(prefix + b64(raw)), prefix


def test_spans_are_exact_through_text_encodings():
    part = ENCODINGS["url"]("é " + SECRET)
    text = "x " + part
    _, spans, _, _ = scan(text)
    assert (2 + 9, 0, 2 + 9 + 3 * (len(SECRET) - 1)) in spans


def test_layers_that_lead_back_end():
    quine = base64.b64decode("H4sIAAAAAAAAAwMAAAAAAAAAAAA=")  # gzip of nothing
    for text in ("%25" * 50, b64(gzip.compress(gzip.compress(quine))), "%2525252525252541", "\\u005cu005cu0041"):
        scan(text)


def test_rows(spark, odd, nothing):
    got = {(r.doc_id, len(r.spans)) for r in scan_secrets(odd).collect()}
    assert len(got) >= 9 and all(n == 0 for _, n in got)
    assert scan_secrets(odd).count() == odd.count()
    assert scan_secrets(nothing).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op1_secret_scan(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r.doc_id])
        said = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))
