"""Secret scans with a recursive decoding worklist.

A text is a layer.  Every layer is searched for the secret kinds; encoded runs in it (URL escapes, Unicode,
octal and character-reference escapes, base64, and gzip or zlib streams anywhere in it, all members) are
decoded to further layers until nothing new comes up.  Base64 that goes on over line ends is one run.  As
other characters of its alphabet may stand before a payload, a run is decoded from each of its first four
characters, which covers every place where a payload can begin.  Layers are bytes, text or not.  A layer seen before (same 128-bit hash) is not
searched again for the same place, which ends cycles.  Spans of
a decoded layer are mapped character by character to the text where the decoding keeps places (URL and
Unicode escapes), and to the whole encoded run otherwise.

A stream is unpacked to its end.  Beyond `PIECE` bytes it is a layer piece by piece, cut behind bytes that no
pattern and no encoding of text holds, so memory follows the depth and not the stream.  A document is marked
`truncated` where this leaves something out: a token longer than a piece, a stream that ends short of its
data after `NOTED` bytes (chance bytes look like the head of a stream, but seldom yield so many), or layers nested deeper than `DEEPEST`.

Defined results: NULL text is empty; repeated rows get a row each; other columns are kept, those named like
a result are replaced.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.llm.frames import bounded_batches

KINDS = ("assign", "access", "hex")
PIECE, OVERLAP = 8 << 20, 1 << 20
DEEPEST = 100
NOTED = 64

# The patterns and least lengths of the three kinds.
ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}

HEX_RUN = np.zeros(256, bool)
HEX_RUN[list(b"0123456789abcdef")] = True
BASE64_RUN = np.zeros(256, bool)
BASE64_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_=")] = True
BASE64_LEAST = 16
BASE64 = re.compile(rb"""[A-Za-z0-9+/_-]{16,}(?:\r?\n[ \t]{0,8}[A-Za-z0-9+/_-]{2,})*={0,2}""")
WHITE = re.compile(rb"[\r\n \t]+")
STREAM = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
BREAK = np.ones(256, bool)  # bytes that no pattern above or below holds
BREAK[32:127] = BREAK[list(b"\x01\x08\x1f\x8b\x9c\xda")] = False
URL_ESCAPE = re.compile(rb"%([0-9A-Fa-f]{2})")
UNICODE_ESCAPE = re.compile(rb"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});|\\u\{([0-9A-Fa-f]{1,6})\}|\\([0-3][0-7]{2})")


def long_runs(data: bytes, marks: np.ndarray, least: int) -> np.ndarray:
    """(start, end) of the maximal runs of marked bytes that are long enough."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = marks[np.frombuffer(data, np.uint8)]
    change = np.diff(inside)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    keep = ends - starts >= least
    return np.stack([starts[keep], ends[keep]], axis=1)


def base_spans(data: bytes) -> list[tuple[int, int, str]]:
    """The secrets of one layer, as byte spans."""
    found = []
    if b":" in data or b"=" in data:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(data) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if b"AKIA" in data:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(data) if m.end() - m.start() >= LEAST["access"]]
    return found + [(int(a), int(b), "hex") for a, b in long_runs(data, HEX_RUN, LEAST["hex"])]


def substituted(data: bytes, pattern: re.Pattern, value) -> tuple[bytes, np.ndarray, np.ndarray] | None:
    """`data` with its escapes replaced, and for each new byte where its source starts and ends."""
    parts, begin, end, at = [], [], [], 0
    for m in pattern.finditer(data):
        new = value(m)
        if new is None:
            continue
        plain = np.arange(at, m.start())
        parts += [data[at:m.start()], new]
        begin += [plain, np.full(len(new), m.start())]
        end += [plain + 1, np.full(len(new), m.end())]
        at = m.end()
    if not parts:
        return None
    plain = np.arange(at, len(data))
    return b"".join([*parts, data[at:]]), np.concatenate([*begin, plain]), np.concatenate([*end, plain + 1])


def character(m: re.Match) -> bytes | None:
    if m[7]:  # octal escapes are bytes
        return bytes([int(m[7], 8)])
    groups = m.groups()
    code = int(next(g for g in groups if g is not None), 10 if groups[4] else 16)
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return chr(code).encode()


def members(data: bytes, at: int) -> Iterator[tuple[bytes, int, bool]]:
    """The streams that follow each other from `at`: output, end of the last whole stream (or 0), out of data."""
    end, view = 0, memoryview(data)
    while STREAM.match(data, at):
        unpack, rest = zlib.decompressobj(47), view[at:]
        while not unpack.eof:
            try:
                out = unpack.decompress(rest, PIECE)
            except zlib.error:
                return
            rest = unpack.unconsumed_tail
            short = not out and not rest and not unpack.eof
            yield out, end, short
            if short:
                return
        end = at = len(data) - len(unpack.unused_data)
        yield b"", end, False
        while at < len(data) and not data[at]:  # padding between members
            at += 1


def unpacked(data: bytes, at: int) -> Iterator[tuple[bytes, int, bool, bool]]:
    """Content of the streams from `at` in pieces: bytes, end of the streams (or 0), cut or out of data, more to come."""
    held, end, last, short = b"", 0, 0, False
    for out, end, short in members(data, at):
        held += out
        while len(held) >= 2 * PIECE:
            if not last:
                *_, (_, last, _) = members(data, at)
            stops = np.flatnonzero(BREAK[np.frombuffer(held, np.uint8, PIECE)])
            stop = int(stops[-1]) + 1 if len(stops) else PIECE
            yield held[:stop], last, not len(stops), True
            held = held[stop if len(stops) else stop - OVERLAP:]
    if held or short:
        yield held, end, short, False


def decoded_base64(run: bytes) -> bytes | None:
    """The bytes of a run; a last character that is no whole byte is left out."""
    body = run.rstrip(b"=").replace(b"-", b"+").replace(b"_", b"/")
    body = body[:-1] if len(body) % 4 == 1 else body
    try:
        return base64.b64decode(body + b"=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def same(place: int, n: int) -> np.ndarray:
    return np.broadcast_to(np.int64(place), n)


def through(places: np.ndarray, at: np.ndarray) -> np.ndarray:
    """places[at], without writing out what is the same everywhere."""
    if not places.strides[0]:
        return same(places[0], len(at))
    return places[at] if at.strides[0] else same(places[at[0]], len(at))


def layers(data: bytes, more: bool) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, bool, bool]]:
    """Further layers of one layer: bytes, start and end of each byte's source in it, cut, more to come.

    `more`: the layer is a piece that another follows.
    """
    if b"%" in data and (new := substituted(data, URL_ESCAPE, lambda m: bytes([int(m[1], 16)]))):
        yield *new, False, more
    if (b"\\" in data or b"&#" in data) and (new := substituted(data, UNICODE_ESCAPE, character)):
        yield *new, False, more
    at = 0
    for low, high in long_runs(data, BASE64_RUN, BASE64_LEAST).tolist():
        at = max(at, low)
        while at < high and (m := BASE64.search(data, at)) and m.start() < high:
            at, run = m.end(), WHITE.sub(b"", m[0])
            for skip in range(4):
                if out := decoded_base64(run[skip:]):
                    yield out, same(m.start() + skip, len(out)), same(m.end(), len(out)), False, False
    at = 0
    while m := STREAM.search(data, at):
        at, end = m.start() + 1, 0
        for piece, end, cut, goes_on in unpacked(data, m.start()):
            yield piece, same(m.start(), len(piece)), same(end or len(data), len(piece)), cut and (more or goes_on or len(piece) >= NOTED), goes_on
        at = max(at, end)


def scan_text(data: bytes) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]], bool]:
    """Byte spans of the text itself, byte spans of all layers, and whether anything was left out."""
    def mark(layer, place):
        return hashlib.blake2b(layer, digest_size=16).digest(), place

    base = base_spans(data)
    found, truncated = set(base), False
    work, seen = [(layers(data, False), None, None)], {mark(data, 0)}
    while work:
        further, begin, end = work[-1]
        step = next(further, None)
        if step is None:
            work.pop()
            continue
        new, b, e, cut, more = step
        truncated |= cut
        if begin is not None:
            b, e = through(begin, b), through(end, e - 1)
        if not new or mark(new, int(b[0])) in seen:
            continue
        seen.add(mark(new, int(b[0])))
        found |= {(int(b[s]), int(e[t - 1]), kind) for s, t, kind in base_spans(new)}
        if len(work) < DEEPEST:
            work.append((layers(new, more), b, e))
        else:
            truncated |= next(layers(new, more), None) is not None
    return base, sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1])), truncated


def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        base_out, all_out, cut_out = [], [], []
        for text in batch.column(0):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            base, every, cut = scan_text(data)
            if every and not data.isascii():
                place = np.r_[0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)]
                base, every = ([(int(place[s]), int(place[e]), k) for s, e, k in x] for x in (base, every))
            for spans, out in ((base, base_out), (every, all_out)):
                out.append([{"kind": k, "start": s, "end": e} for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))])
            cut_out.append(cut)
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(base_out, pa.list_(span)), pa.array(all_out, pa.list_(span)), pa.array(cut_out)],
            ["row", "base_spans", "spans", "truncated"])


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of `docs` with `base_spans`, `spans` (kind, start, end in code points) and `truncated`."""
    results = ("base_spans", "spans", "truncated")
    rest = [c for c in docs.columns if c != text and c not in results]
    rows = bounded_batches(docs).select(F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    out = rows.mapInArrow(scanned, f"row {rows.schema['row'].dataType.simpleString()}, base_spans {span}, spans {span}, truncated boolean")
    return out.select(*[F.col(f"row.`{c}`") for c in rest], *results)


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts per kind, the spans as text, and whether anything was left out."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(doc_id, *[count(k) for k in KINDS], F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"), "truncated")
