"""Secret scans with a recursive decoding worklist.

Every text is a layer. A layer is scanned for secrets, and its encoded parts are
unwrapped into further layers until nothing new turns up: lines with URL escapes,
lines with Unicode escapes (``\\uXXXX``, ``\\UXXXXXXXX``, ``\\xXX``, ``&#N;``, some named
references, escaped quotes), base64 runs (both alphabets, also over line ends and indented) and compressed bytes (gzip,
zlib, bzip2, xz, zstd). A layer is remembered by its content and its place, so a
cycle or a second way to the same layer ends there.

Each layer byte keeps the range of the text it came from: exact for escapes, the
covering characters for base64, the whole run for compressed bytes. A secret
found in a layer is reported as the span of the original text it came from.
A base64 run is read at each of its four alignments; where the whole is no text, its
readable stretches are layers. Compressed data are looked for anywhere in a layer that is no
text and unpacked with all their members, piece by piece: ``PIECE`` bytes or more, and an
encoded run that is open at a piece's end is held and read whole, up to ``HELD`` bytes. Only
a longer run inside one unpacked layer is read in parts; zstd frames that ask for a window
beyond 2**27 bytes, and deflate data without a header, are not unpacked.

Kinds (base patterns, leftmost non-overlapping): ``assign``, ``access``, ``hex``.
Spans are in code points, end exclusive, and cover the whole match.

Defined cases: null text is empty and gives no spans; a span found in several
layers counts once; repeated rows are scanned each on their own; an empty table
gives no rows; other columns are ignored (``scan_secrets``) or kept as they are
(``redact_secrets``).
"""

from __future__ import annotations

import base64
import bz2
import lzma
import re
import zlib
from collections.abc import Callable, Generator, Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.tables import table
from farelake.llm.textscan import cuts, text_buffers

# Kinds in their order, patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32

MIN_BASE64 = 16
PIECE, OVERLAP = 8 << 20, 1 << 16
HELD = 64 << 20  # of one encoded run inside an unpacked layer
STEP = 1 << 16  # compressed bytes given to a decompressor at once
REDACTED = "[SECRET]"

SPANS = "array<struct<kind:string,start:bigint,end:bigint,depth:int>>"

_URL = re.compile(rb"%([0-9A-Fa-f]{2})")
#: Named references of the signs that patterns look for.
NAMED = {b"equals": b"=", b"colon": b":", b"quot": b'"', b"apos": b"'", b"amp": b"&", b"lowbar": b"_", b"sol": b"/",
         b"plus": b"+", b"period": b".", b"hyphen": b"-", b"dash": b"-", b"num": b"#", b"percnt": b"%", b"bsol": b"\\"}
_UNICODE = re.compile(
    rb"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
    rb"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});|\\([\"'/\\])|&(" + b"|".join(NAMED) + rb");")
#: Runs of lines that may be indented, 16 characters or more in all (``_base64`` counts them);
#: the last line has any length.
_BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{4,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]{4,})*(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)?={0,2}")
#: Readable text in decoded bytes, from the length of the shortest secret (token=, 8 characters).
_STRETCH = re.compile(
    rb"(?:[\t-\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
    rb"|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){14,}")
#: Where a compressed stream may begin (zlib: _compressed tests its second byte).
_MAGIC = re.compile(rb"\x1f\x8b|BZh|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|[\x08\x18\x28\x38\x48\x58\x68\x78]")
_DAMAGE = (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError)
_LINE_END = re.compile(rb"[\r\n]")
_CONTROL = bytes([*range(9), *range(14, 32), 127])

#: Bytes of a run that can hold a base64 layer, for the first look at a whole slice.
_RUN = np.zeros(256, bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True


def matches(data: bytes) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns in a layer, byte offsets."""
    if b"=" in data or b":" in data:
        for m in ASSIGN.finditer(data):
            if len(m[2]) >= MIN_ASSIGN:
                yield "assign", m.start(), m.end()
    if b"AKIA" in data:
        for m in ACCESS.finditer(data):
            if len(m[0]) >= MIN_ACCESS:
                yield "access", m.start(), m.end()
    for m in HEX.finditer(data):
        yield "hex", m.start(), m.end()


class Layer:
    """Bytes, and for each byte the range of the original text it came from."""

    __slots__ = ("data", "lo", "hi", "depth")

    def __init__(self, data: bytes, lo: np.ndarray, hi: np.ndarray, depth: int):
        self.data, self.lo, self.hi, self.depth = data, lo, hi, depth

    def key(self) -> tuple:
        return (self.data, int(self.lo[0]), int(self.hi[-1])) if self.data else (b"",)


def _unescape(layer: Layer, a: int, b: int, pattern: re.Pattern, value: Callable[[re.Match], bytes]) -> Layer:
    """layer.data[a:b] with every match of pattern replaced by its value."""
    if _one_origin(layer):
        got = unquote_to_bytes(layer.data[a:b]) if pattern is _URL else pattern.sub(value, layer.data[a:b])
        return _covering(got, int(layer.lo[0]), int(layer.hi[0]), layer.depth + 1)
    out, lo, hi, at = [], [], [], a
    for m in pattern.finditer(layer.data, a, b):
        s, e = m.span()
        got = value(m)
        out += [layer.data[at:s], got]
        lo += [layer.lo[at:s], np.full(len(got), layer.lo[s])]
        hi += [layer.hi[at:s], np.full(len(got), layer.hi[e - 1])]
        at = e
    out.append(layer.data[at:b])
    lo.append(layer.lo[at:b])
    hi.append(layer.hi[at:b])
    return Layer(b"".join(out), np.concatenate(lo), np.concatenate(hi), layer.depth + 1)


def _code_point(m: re.Match) -> bytes:
    if m[4]:
        return bytes([int(m[4], 16)])
    if m[7] or m[8]:
        return m[7] or NAMED[m[8]]
    code = int(m[6]) if m[6] else int(next(x for x in m.groups()[:5] if x), 16)
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return m[0]
    return chr(code).encode()


def _lines_with(data: bytes, pattern: re.Pattern) -> Iterator[tuple[int, int]]:
    """Lines with a match of pattern, as byte ranges."""
    done = 0  # end of the last line given, 0 at first: later lines begin behind it
    for m in pattern.finditer(data):
        if m.start() >= done:
            a = max(data.rfind(b"\n", done, m.start()), data.rfind(b"\r", done, m.start())) + 1
            end = _LINE_END.search(data, m.start())
            done = end.start() if end else len(data)
            yield a, done


def _readable(data: bytes) -> bool:
    """Text: valid UTF-8 with hardly any control characters."""
    try:
        data.decode()
    except UnicodeDecodeError:
        return False
    return (len(data) - len(data.translate(None, _CONTROL))) * 20 <= len(data)


def _compressed(data: bytes) -> str:
    """The format that data begin like, or an empty string."""
    if data[:2] == b"\x1f\x8b":
        return "gzip"
    if data[:3] == b"BZh":
        return "bzip2"
    if data[:6] == b"\xfd7zXZ\0":
        return "xz"
    if data[:4] == b"\x28\xb5\x2f\xfd":
        return "zstd"
    if len(data) > 6 and data[0] & 15 == 8 and data[0] >> 4 <= 7 and (data[0] * 256 + data[1]) % 31 == 0:
        return "zlib"
    return ""


def _member(data: bytes, at: int, kind: str) -> Generator[bytes, None, int]:
    """What one member of a compressed stream holds; returns where it ends."""
    data = memoryview(data)
    if kind in ("gzip", "zlib"):
        tool, rest = zlib.decompressobj(31 if kind == "gzip" else 15), b""
        while not tool.eof:
            if not rest:
                rest = data[at:at + STEP]
                at += len(rest)
                if not rest:
                    yield tool.flush()
                    break
            yield tool.decompress(rest, PIECE)
            rest = tool.unconsumed_tail
    else:
        tool = bz2.BZ2Decompressor() if kind == "bzip2" else lzma.LZMADecompressor()
        while not tool.eof:
            rest = data[at:at + STEP] if tool.needs_input else b""
            at += len(rest)
            if tool.needs_input and not rest:
                break
            yield tool.decompress(rest, PIECE)
    return at - len(tool.unused_data)


def _behind(data: bytes, at: int, kind: str) -> int:
    """Where the next member may begin: padding of xz streams is skipped."""
    while kind == "xz" and data[at:at + 4] == bytes(4):
        at += 4
    return at


def _stream(data: bytes) -> Iterator[bytes]:
    """What a compressed stream holds, all its members, PIECE bytes at a time."""
    kind, at = _compressed(data), 0
    if kind == "zstd":
        with zstandard.ZstdDecompressor(max_window_size=1 << 27).stream_reader(data, read_across_frames=True) as reader:
            while got := reader.read(PIECE):
                yield got
        return
    while kind and _compressed(data[at:at + 8]) == kind:
        for got in (member := _Ending(_member(data, at, kind))):
            if got:
                yield got
        at = _behind(data, member.end, kind)


class _Ending:
    """An iteration that keeps what its generator returns."""

    def __init__(self, made: Generator[bytes, None, int]):
        self.made = made

    def __iter__(self) -> Iterator[bytes]:
        self.end = yield from self.made


def _zstd_end(data: bytes, at: int) -> int:
    """Where zstd frames end, skippable ones among them, told by their block headers."""
    while True:
        if data[at + 1:at + 4] == b"\x2a\x4d\x18" and data[at] >> 4 == 5:
            at += 8 + int.from_bytes(data[at + 4:at + 8], "little")
        elif data[at:at + 4] == b"\x28\xb5\x2f\xfd":
            try:
                sums = zstandard.get_frame_parameters(data[at:at + 32]).has_checksum
                at += zstandard.frame_header_size(data[at:at + 32])
            except zstandard.ZstdError:
                return at
            last = False
            while not last and at + 3 <= len(data):
                head = int.from_bytes(data[at:at + 3], "little")
                last = bool(head & 1)
                at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
            at += 4 * sums
        else:
            return min(at, len(data))


def _stream_end(data: bytes, at: int) -> int:
    """Where the compressed stream at a place ends: the place itself if nothing can be
    read there, the end of data if its first member is damaged or cut off."""
    kind, begin, some = _compressed(data[at:at + 8]), at, False
    if kind == "zstd":
        return _zstd_end(data, at)
    try:
        while kind and _compressed(data[at:at + 8]) == kind:
            for got in (member := _Ending(_member(data, at, kind))):
                some = some or bool(got)
            at = _behind(data, member.end, kind)
    except _DAMAGE:
        at = at if at > begin else len(data)
    return at if some else begin


def _streams(data: bytes) -> Iterator[tuple[int, int]]:
    """Ranges of data that hold compressed streams, wherever they begin."""
    done = 0
    for m in _MAGIC.finditer(data):
        at = m.start()
        if at >= done and _compressed(data[at:at + 8]):
            end = _stream_end(data, at)
            if end > at:
                yield at, end
                done = end


#: Base64 lines, indented ones too, read from their end.
_BACKWARDS = re.compile(rb"(?:[A-Za-z0-9+/_=-]+|[ \t]*\n\r?)*")


def _open_run(piece: bytes) -> int:
    """Where the encoded run that reaches the end of a piece begins: base64 lines, a line with
    escapes, or bytes that are no text (a stream may go on in them)."""
    begin = len(piece) - _BACKWARDS.match(piece[::-1]).end()
    line = max(piece.rfind(b"\n"), piece.rfind(b"\r")) + 1
    if any(sign in piece[line:] for sign in (b"%", b"\\", b"&")):
        begin = min(begin, line)
    tail = piece[-OVERLAP:]
    if not _readable(tail[next((i for i in range(4) if tail[i:i + 1] and tail[i] & 0xC0 != 0x80), 0):]):
        begin = 0  # a stream may begin anywhere in such a piece
    return begin


def _unpacked(data: bytes) -> Iterator[bytes]:
    """Pieces of a compressed stream, PIECE bytes or more each; ends quietly at damaged data.

    A piece begins OVERLAP bytes before the end of the last one, and at the begin of an encoded
    run that was open there: such a run is held whole, up to HELD bytes.
    """
    held, size = [], 0
    try:
        for got in _stream(data):
            held.append(got)
            size += len(got)
            if size >= PIECE:
                piece = b"".join(held)
                begin = _open_run(piece)
                if len(piece) - begin < HELD and begin < PIECE // 2:
                    held = [piece]  # most of it is open: go on until the run ends
                    if size < HELD:
                        continue
                yield piece
                held = [piece[min(len(piece) - OVERLAP, begin if len(piece) - begin < HELD else len(piece)):]]
                size = len(held[0])
    except _DAMAGE:
        pass
    if held:
        yield b"".join(held)


def _covering(piece: bytes, lo: int, hi: int, depth: int) -> Layer:
    """A layer whose bytes all came from one range, which is held once."""
    return Layer(piece, np.broadcast_to(lo, len(piece)), np.broadcast_to(hi, len(piece)), depth)


def _one_origin(layer: Layer) -> bool:
    """Whether all bytes of a layer came from one range (held once)."""
    return layer.lo.strides == (0,)


def _base64(layer: Layer, s: int, e: int) -> Iterator[Layer]:
    """Layers that a base64 run holds, read at each of the four alignments: what stands
    before an encoded part in the run may have any length."""
    text = layer.data[s:e].translate(None, b"\r\n\t =")
    if len(text) < MIN_BASE64:
        return
    if _one_origin(layer):
        keep, first, last = None, int(layer.lo[0]), int(layer.hi[0])
    else:
        first = last = 0
        keep = np.flatnonzero(_RUN[np.frombuffer(layer.data, np.uint8)[s:e]])
    text = text.replace(b"-", b"+").replace(b"_", b"/")
    for skip in range(min(4, len(text))):
        part = text[skip:len(text) - ((len(text) - skip) % 4 == 1)]
        got = base64.b64decode(part + b"=" * (-len(part) % 4))

        def layer_of(data: bytes, at: np.ndarray | range) -> Layer:
            """data, whose bytes are those of ``got`` at the places ``at``."""
            if keep is None:
                return _covering(data, first, last, layer.depth + 1)
            at = np.asarray(at)
            return Layer(data, layer.lo[s + keep[skip + at * 8 // 6]],  # noqa: B023
                         layer.hi[s + keep[np.minimum(skip + (at * 8 + 7) // 6, len(keep) - 1)]], layer.depth + 1)  # noqa: B023

        if not skip and _readable(got):
            yield layer_of(got, range(len(got)))
            continue
        if got.count(0) * 3 > len(got):  # text in two bytes a letter
            some = np.flatnonzero(np.frombuffer(got, np.uint8))
            narrow = got.replace(b"\0", b"")
            for m in _STRETCH.finditer(narrow):
                yield layer_of(m[0], some[m.start():m.end()])
        for m in _STRETCH.finditer(got):
            yield layer_of(m[0], range(*m.span()))
        for a, b in _streams(got):
            ends = layer_of(got[a:a + 1] + got[b - 1:b], [a, b - 1])
            for piece in _unpacked(got[a:b]):
                yield _covering(piece, ends.lo[0], ends.hi[-1], layer.depth + 2)


def _inner(layer: Layer) -> Iterator[Layer]:
    """The layers encoded in a layer."""
    data = layer.data
    if b"%" in data:
        for a, b in _lines_with(data, _URL):
            yield _unescape(layer, a, b, _URL, lambda m: bytes([int(m[1], 16)]))
    if b"\\" in data or b"&" in data:
        for a, b in _lines_with(data, _UNICODE):
            yield _unescape(layer, a, b, _UNICODE, _code_point)
    for m in _BASE64.finditer(data):
        yield from _base64(layer, *m.span())
    if layer.depth and not (plain := _readable(data)) or layer.depth and _compressed(data[:8]):
        # Text is a stream as a whole or not at all; other bytes may hold one anywhere.
        for a, b in ([(0, _stream_end(data, 0))] if plain else _streams(data)):
            if b <= a:
                continue
            for piece in _unpacked(data[a:b]):
                yield _covering(piece, layer.lo[a], layer.hi[b - 1], layer.depth + 1)


def decoded_matches(data: bytes) -> Iterator[tuple[str, int, int, int]]:
    """(kind, start, end, depth) found in the layers under a text, as byte ranges of it.

    The worklist holds what is left of each open layer, the innermost last: one layer
    of each depth is in memory, however many pieces an unpacked one has.
    """
    at = np.arange(len(data), dtype=np.int64)
    work, seen = [_inner(Layer(data, at, at + 1, 0))], set()
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        key = hash(layer.key()), len(layer.data)
        if not layer.data or key in seen:
            continue
        seen.add(key)
        for kind, s, e in matches(layer.data):
            yield kind, int(layer.lo[s:e].min()), int(layer.hi[s:e].max()), layer.depth
        work.append(_inner(layer))


def find_secrets(data: bytes, encoded: bool = True) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, depth) in code points, by start, kind, end; depth 0 is
    the text itself. encoded=False: the text is known to hold no encoded part."""
    found = {(k, s, e): 0 for k, s, e in matches(data)}
    if encoded:
        for k, s, e, depth in decoded_matches(data):
            found[k, s, e] = min(found.get((k, s, e), depth), depth)
    if not found:
        return []
    point = np.zeros(len(data) + 1, np.int64)
    np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80, out=point[1:])
    return [(k, int(point[s]), int(point[e]), depth) for (k, s, e), depth in sorted(
        found.items(), key=lambda x: (x[0][1], KINDS.index(x[0][0]), x[0][2]))]


def _has_encoded(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts may hold an encoded part: an escape sign or a long base64 run."""
    sign = (data == 0x25) | (data == 0x5C) | (data == 0x26)
    run = _RUN[data]
    edge = np.flatnonzero(np.diff(run.astype(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    # Wrapped runs: two of four characters or more with a line end and blanks between them.
    blank = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data == 0x20) | (data == 0x09) | (data == 0x0A) | (data == 0x0D), out=blank[1:])
    wide = ends - starts >= 4
    wrapped = np.flatnonzero(wide[:-1] & wide[1:] & (starts[1:] - ends[:-1] == blank[starts[1:]] - blank[ends[:-1]]))
    after = data[ends[wrapped]]
    wrapped = wrapped[(after == 0x0A) | (after == 0x0D)]
    at = np.concatenate([np.flatnonzero(sign), starts[ends - starts >= MIN_BASE64], starts[wrapped]])
    out = np.zeros(len(offsets) - 1, bool)
    out[np.searchsorted(offsets, at, "right") - 1] = True
    return out


def _texts(column: pa.Array) -> Iterator[tuple[bytes, bool]]:
    """(text, may hold an encoded part) of every row."""
    data, offsets = text_buffers(column)
    for a, b in cuts(offsets):
        part, off = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        encoded, raw = _has_encoded(part, off), part.tobytes()
        for i in range(b - a):
            yield raw[off[i]:off[i + 1]], bool(encoded[i])


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, found): every row's secrets as structs (kind, start, end, depth)."""
    rows = docs.select(F.col(key), F.col(text).cast("string").alias("__text"))
    kind = rows.schema[0].dataType.simpleString()
    found = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int32())]))

    def scan(batches):
        for batch in batches:
            got = [[dict(zip(("kind", "start", "end", "depth"), x, strict=True)) for x in find_secrets(*t)]
                   for t in _texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, found)], [key, "found"])

    return rows.mapInArrow(scan, f"`{key}` {kind}, found {SPANS}")


def redact_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every secret of a text, also an encoded one, replaced by REDACTED.
    Overlapping spans become one; a null text stays null."""
    at = docs.columns.index(text)

    def redact(batches):
        for batch in batches:
            column, out = batch.column(at), []
            for (raw, encoded), null in zip(_texts(column), column.is_null().to_pylist(), strict=True):
                found = [] if null else find_secrets(raw, encoded)
                if not found:
                    out.append(None if null else raw.decode())
                    continue
                t, done, parts = raw.decode(), 0, []
                for _, s, e, _ in found:
                    if s >= done:
                        parts += [t[done:s], REDACTED]
                    done = max(done, e)
                out.append("".join([*parts, t[done:]]))
            arrays = list(batch.columns)
            arrays[at] = pa.array(out, column.type)
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    return docs.mapInArrow(redact, docs.schema)


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    found = scan_secrets(table(spark, sf_dir, "documents", ("doc_id", "text")))
    base = F.filter("found", lambda x: x["depth"] == 0)
    said = lambda spans: F.array_join(F.transform(
        spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS],
                        F.sha2(said(base), 256).alias("base_sha256"), said(F.col("found")).alias("spans"))
