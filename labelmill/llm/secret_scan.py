"""Secret scans with a worklist of decoded layers.

The text is scanned, then every encoded part of it is decoded (percent escapes,
Unicode escapes and character references, base64, compressed bytes), and each
decoded layer is scanned and decoded in turn until nothing new appears. A layer is
known by its content and the part of the text it came from, so encodings that lead
back to themselves end. Each character of a layer remembers which characters of the
original text it stands for, so every finding is reported as a span of the original.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import itertools
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import map_rows, texts

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Every match of ASSIGN has one of these, in any case.
STEMS = ("passw", "secret", "token", "api")
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"(?:\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2})|\\u\{([0-9a-fA-F]{1,6})\}|\\u([0-9a-fA-F]{4})"
    r"|\\U([0-9a-fA-F]{8})|\\x([0-9a-fA-F]{2})|%u([0-9a-fA-F]{4})|&#[xX]([0-9a-fA-F]{1,6});|&#([0-9]{1,7});"
)
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"[A-Za-z0-9+/]{32,}(?:\r?\n[A-Za-z0-9+/]{4,})+={0,2}")
ASCII_RUN = re.compile(rb"[\t\n\r\x20-\x7e]{12,}")
URL_SAFE = str.maketrans("-_", "+/")
#: Binary content may hold ASCII text two bytes a character.
WIDE = re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){11,}[\t\n\r\x20-\x7e]")
HEADS = re.compile(rb"\x1f\x8b|\x78[\x01\x5e\x9c\xda]|BZh|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
#: Percent escapes with the characters that URL encoders leave as they are.
STRETCH = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9._~/!'()*+-])+")
STRETCH_PART = re.compile(r"%[0-9A-Fa-f]{2}|.", re.S)
#: Compressed bytes are fed in pieces so small that no piece gives much at once.
FEED = 1024
#: Unpacked bytes are scanned in blocks of about so many, cut after a byte that no finding and no encoding goes across.
BLOCK = 4 << 20
JOINING = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-\"': %\\&#;{}~!()*\r\n\x00"
#: A block without such a byte grows up to so many bytes; what goes on is scanned in the next, with an overlap, and counted in n_cut.
MAX_LAYER = 64 << 20
OVERLAP = 1 << 20


@dataclass
class Layer:
    """A text and, per character, the span of the original it stands for (None: itself)."""

    text: str
    start: np.ndarray | None = None
    end: np.ndarray | None = None

    def span(self, a: int, b: int) -> tuple[int, int]:
        if self.start is None:
            return a, b
        return int(self.start[a:b].min()), int(self.end[a:b].max())

    def key(self) -> tuple[bytes, tuple[int, int]]:
        whole = self.span(0, len(self.text)) if self.text else (0, 0)
        return hashlib.sha256(self.text.encode("utf-8", "surrogatepass")).digest(), whole


def matches(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost and without overlap per kind."""
    out = []
    low = text.lower()
    if any(s in low for s in STEMS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


@dataclass
class Packed:
    """Bytes that may hold compressed ones; all stand for start…end. ``seen`` tells those they came out of."""

    raw: bytes
    start: int
    end: int
    seen: frozenset = frozenset()
    more: bool = False  # the content goes on in another block


def engine(head: bytes):
    """A new decompressor by the first bytes; None if they are not compressed."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and head[1:2] in (b"\x01", b"\x5e", b"\x9c", b"\xda"):
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    if head[:4] == b"\x28\xb5\x2f\xfd":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj()
    return None


def fed(raw: bytes, at: int = 0) -> Iterator[bytes]:
    return (raw[i : i + FEED] for i in range(at, len(raw), FEED))


def content(source: Iterator[bytes], state: dict) -> Iterator[bytes]:
    """What compressed members hold, one after another; bytes behind the last follow after a NUL.

    ``state`` gets "broken" if a member has an error and "short" if one does not end.
    """
    held = b""
    while True:
        while len(held) < 6 and (more := next(source, b"")):
            held += more
        tool = engine(held)
        if tool is None:
            break
        try:
            while not tool.eof:
                held = held or next(source, b"")
                if not held:
                    state["short"] = True
                    return
                out, held = tool.decompress(held), b""
                if out:
                    yield out
            held = tool.unused_data
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
            state["broken"] = True
            return
        except Exception as e:  # zstandard's own error has no public base
            if type(e).__name__ != "ZstdError":
                raise
            state["broken"] = True
            return
        while not (held := held.lstrip(b"\x00")) and (held := next(source, b"")):
            pass
    if held:
        yield b"\x00" + held
        yield from source


def blocks(parts: Iterator[bytes]) -> Iterator[tuple[bytes, bool]]:
    """The bytes in blocks, and whether a block had to end inside what may belong together."""
    held, ask = bytearray(), BLOCK
    for part in parts:
        held += part
        if len(held) < ask:
            continue
        at = len(held.rstrip(JOINING))
        if at:
            yield bytes(held[:at]), False
            del held[:at]
            ask = len(held) + BLOCK
        elif len(held) >= MAX_LAYER:
            yield bytes(held), True
            del held[:-OVERLAP]
            ask = BLOCK
        else:
            ask = 2 * len(held)
    if held:
        yield bytes(held), False


def readable(raw: bytes) -> str | None:
    """The text of bytes that are one: UTF-8 without control characters but white space."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    return text if text and not any(c < " " and c not in "\t\n\r\f\v" for c in text) else None


def flat(text: str, start: int, end: int) -> Layer:
    """A layer all of whose characters stand for start…end."""
    return Layer(text, np.broadcast_to(np.int64(start), len(text)), np.broadcast_to(np.int64(end), len(text)))


def wide_runs(raw: bytes) -> Iterator[tuple[int, int]]:
    return (m.span() for m in WIDE.finditer(raw))


def from_bytes(raw: bytes, start: np.ndarray, end: np.ndarray) -> Iterator[Layer | Packed]:
    """What decoded bytes are, byte i of which stands for start[i]…end[i]: a text, or ASCII runs and compressed parts.

    Characters before an encoded run may belong to its encoding as well; they decode to noise.
    """
    text = readable(raw)
    if text is None:
        if engine(raw) is None:
            for a, b in (m.span() for m in ASCII_RUN.finditer(raw)):
                yield Layer(raw[a:b].decode(), start[a:b], end[a:b])
            for a, b in wide_runs(raw):
                yield Layer(raw[a:b:2].decode(), start[a:b:2], end[a:b:2])
        for m in HEADS.finditer(raw):
            at = m.start()
            done = yield from unpacked(Packed(raw[at:], int(start[at:].min()), int(end[at:].max())))
            if done:
                break
            if at == 0:  # not compressed after all
                for a, b in (m.span() for m in ASCII_RUN.finditer(raw)):
                    yield Layer(raw[a:b].decode(), start[a:b], end[a:b])
    elif len(text) == len(raw):
        yield Layer(text, start, end)
    else:
        lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
        first = np.flatnonzero(lead)
        yield Layer(text, start[first], np.maximum.reduceat(end, first))


def unpacked(packed: Packed) -> Iterator[Layer | Packed | int]:
    """The content of bytes with a compressed head, in blocks; returns whether all of it could be read.

    Numbers among the results are cuts.
    """
    key = hashlib.sha256(packed.raw[:BLOCK]).digest()
    if key in packed.seen:  # unpacks to itself
        return True
    seen, state = packed.seen | {key}, {}
    parts = content(fed(packed.raw), state)
    while True:
        stream = blocks(parts)
        block, hard = next(stream, (b"", False))
        follow = next(stream, None)
        if follow is None or engine(block) is None:
            break
        # compressed again, and long: unpack as it comes
        parts = content((x for whole in rejoined(block, hard, follow, stream) for x in fed(whole)), {})
    if follow is None:
        if len(block) >= 12 or not state:
            yield Packed(block, packed.start, packed.end, seen)
    else:
        for raw, cut in rejoined(block, hard, follow, stream, marks=True):
            if cut:
                yield 1
            yield Packed(raw, packed.start, packed.end, seen, more=True)
    if "short" in state and packed.more:
        yield 1
    return not state


def rejoined(block: bytes, hard: bool, follow: tuple[bytes, bool], rest: Iterator[tuple[bytes, bool]], marks: bool = False) -> Iterator:
    """Blocks in a row; without ``marks`` as bytes in which nothing overlaps."""
    before = False
    for raw, cut in itertools.chain([(block, hard), follow], rest):
        if marks:
            yield raw, cut
        else:
            yield raw[OVERLAP:] if before else raw
        before = cut


def read_packed(packed: Packed) -> Iterator[Layer | Packed | int]:
    """Layers of unpacked bytes: their text, in any encoding that has ASCII, and what is compressed in them."""
    raw, a, b = packed.raw, packed.start, packed.end
    text = readable(raw)
    if text is not None:
        yield flat(text, a, b)
        return
    if engine(raw) is not None and not packed.more:
        done = yield from unpacked(packed)
        if done:
            return
    if raw:
        yield flat(raw.decode("latin-1"), a, b)
    for x, y in wide_runs(raw):
        yield flat(raw[x:y:2].decode(), a, b)
    for m in HEADS.finditer(raw, 1):
        done = yield from unpacked(Packed(raw[m.start() :], a, b, packed.seen, packed.more))
        if done and not packed.more:
            break


def decoded(layer: Layer) -> Iterator[Layer | Packed | int]:
    """All layers one step below, one at a time; numbers among them are cuts."""
    text = layer.text
    identity = np.arange(len(text) + 1) if layer.start is None else None
    start = identity[:-1] if layer.start is None else layer.start
    end = identity[1:] if layer.end is None else layer.end

    def rewritten(pieces: list[tuple[int, int, str, np.ndarray, np.ndarray]]) -> Layer:
        """The text with parts replaced: (from, to, new text, its starts, its ends)."""
        parts, starts, ends, last = [], [], [], 0
        for a, b, new, s, e in pieces:
            parts += [text[last:a], new]
            starts += [start[last:a], s]
            ends += [end[last:a], e]
            last = b
        return Layer("".join([*parts, text[last:]]), np.concatenate([*starts, start[last:]]), np.concatenate([*ends, end[last:]]))

    if "%" in text:
        for m in STRETCH.finditer(text) if PERCENT.search(text) else ():
            if "%" not in m.group():
                continue
            some = STRETCH_PART.findall(m.group())
            size = np.array([len(x) for x in some])
            at = m.start() + np.cumsum(size) - size
            for blank in ("+", " ") if "+" in some else ("+",):
                raw = bytes(int(x[1:], 16) if len(x) > 1 else ord(blank if x == "+" else x) for x in some)
                if readable(raw) is None and HEADS.search(raw):
                    yield from from_bytes(raw, start[at], end[at + size - 1])
        pieces = []
        for m in PERCENT.finditer(text):
            raw, at = bytes.fromhex(m.group().replace("%", "")), np.arange(m.start(), m.end(), 3)
            new = raw.decode("utf-8", "replace")
            if len(new) == len(raw):
                pieces.append((m.start(), m.end(), new, start[at], end[at + 2]))
            else:
                sizes = np.array([len(c.encode()) if c != "\ufffd" else 1 for c in new])
                if sizes.sum() == len(raw):
                    first = np.cumsum(sizes) - sizes
                    pieces.append((m.start(), m.end(), new, start[at[first]], end[at[first + sizes - 1] + 2]))
                else:  # bytes that are no text stand for the run as a whole
                    a, b = int(start[at].min()), int(end[at + 2].max())
                    pieces.append((m.start(), m.end(), new, np.full(len(new), a), np.full(len(new), b)))
        if pieces:
            yield rewritten(pieces)
    if "\\" in text or "&#" in text or "%u" in text:
        pieces = []
        for m in ESCAPE.finditer(text):
            digits = next((g for g in m.groups()[:-1] if g), None)
            if digits:
                code = int(digits, 16)
            elif m.group(m.lastindex or 0) and m.lastindex:
                code = int(m.group(m.lastindex))
            else:  # a surrogate pair
                hi, lo = int(m.group()[2:6], 16), int(m.group()[8:12], 16)
                code = 0x10000 + ((hi - 0xD800) << 10) + (lo - 0xDC00)
            new = chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd"
            a, b = int(start[m.start() : m.end()].min()), int(end[m.start() : m.end()].max())
            pieces.append((m.start(), m.end(), new, np.array([a]), np.array([b])))
        if pieces:
            yield rewritten(pieces)
    for pattern in (BASE64, WRAPPED):
        for m in pattern.finditer(text) if pattern is BASE64 or "\n" in text else ():
            body = m.group()
            places = np.array([i for i, c in enumerate(body) if c not in "\r\n="], np.int64) + m.start()
            plain = "".join(c for c in body if c not in "\r\n=").translate(URL_SAFE)
            # what stands before the run may belong to it by its characters
            for skip in range(4):
                part = plain[skip:]
                part = part[: len(part) - (len(part) % 4 == 1)]
                if len(part) < 12:
                    break
                raw = base64.b64decode(part + "=" * (-len(part) % 4))
                j = np.arange(len(raw)) * 8
                spots = places[skip:]
                yield from from_bytes(raw, start[spots[j // 6]], end[spots[np.minimum((j + 7) // 6, len(part) - 1)]])


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int, int]:
    """Base findings, all findings as sorted (start, kind, end), number of layers, layers cut."""
    base = matches(text)
    found, seen, layers, cut = set(base), set(), 0, 0
    work: list[Iterator[Layer | Packed | int]] = [iter([Layer(text)])]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
        elif isinstance(layer, int):
            cut += layer
        elif isinstance(layer, Packed):
            work.append(read_packed(layer))
        else:
            if layer.start is not None:
                key = layer.key()
                if key in seen:
                    continue
                seen.add(key)
                layers += 1
                for a, kind, b in matches(layer.text):
                    x, y = layer.span(a, b)
                    found.add((x, kind, y))
            work.append(decoded(layer))
    return base, sorted(found), layers, cut


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, base and spans (sorted arrays of kind, start, end), n_layers, n_cut.

    Offsets are code points, ends exclusive. A null text is empty and has none; every
    row is scanned by itself, repeated rows too; other columns are not read.
    """
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    shown = lambda spans: [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]

    def rows(ids: list, bodies: list) -> Iterator[tuple]:
        for doc_id, body in zip(ids, bodies):
            base, spans, layers, cut = scan(body)
            yield doc_id, shown(base), shown(spans), layers, cut

    base = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    kinds = "doc_id long, base array<struct<kind:string,start:long,end:long>>, spans array<struct<kind:string,start:long,end:long>>, n_layers long, n_cut long"
    return map_rows(base, rows, kinds, ["doc_id", "base", "spans", "n_layers", "n_cut"], [pa.int64(), span, span, pa.int64(), pa.int64()])


def span_list(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
