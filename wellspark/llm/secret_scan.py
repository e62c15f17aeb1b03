"""Secrets in texts and in what is encoded there: a worklist of layers, unwrapped until nothing is new."""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import io
import lzma
import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
SHORTEST = 12  # bytes of text that base64 digits have to begin with, to be taken for a layer
MAX_UNPACKED = 64 << 20  # bytes that the compressed layers of a document may come to

_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
# A run that is too short holds no run that is long enough, so the length can stand in the pattern.
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(rb"[0-9a-f]{32,}")

# A percent sign that is encoded many times over is one escape: no pattern holds a percent sign, so
# the layers in between show nothing else. So are backslashes that were doubled on the way.
_ESCAPE = re.compile(rb"""%(?:25)*([0-9A-Fa-f]{2})
    |\\+(?:u\{([0-9A-Fa-f]{1,6})\}|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))
    |&\#(?:[xX]([0-9A-Fa-f]{1,6})|([0-9]{1,7}));""", re.X)
_DIGITS = rb"A-Za-z0-9+/_-"
_LINES = rb"(?:(?:[%b]{76}\r?\n)+|(?:[%b]{64}\r?\n)+)" % (_DIGITS, _DIGITS)
_RUN = re.compile(rb"(?<![%b])(?:%b[%b]*|[%b]{16,})={0,2}" % (_DIGITS, _LINES, _DIGITS, _DIGITS))
_PART = re.compile(rb"[A-Za-z0-9]{16,}={0,2}")
_URL_SAFE = bytes.maketrans(b"-_", b"+/")
_PACKED = re.compile(rb"\x1f\x8b\x08|x[\x01\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
_PACKED_START = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")


class _Itself:
    """Places of a text's own layer, where a byte stands for the code point there."""

    def __init__(self, size: int, shift: int):
        self.size, self.shift = size, shift

    def __getitem__(self, at):
        if isinstance(at, slice):
            return np.arange(at.start, at.stop) + self.shift
        return (self.size - 1 if isinstance(at, int) and at < 0 else at) + self.shift


class Layer(NamedTuple):
    """Bytes, where in the text each comes from, and the steps that led here.

    In the first layer a byte is a code point; those beyond Latin-1 are question marks, which are
    in no pattern and in no encoding.
    """

    data: bytes
    starts: np.ndarray | _Itself
    ends: np.ndarray | _Itself
    path: str


def matches(data: bytes) -> list[tuple[int, int, int]]:
    """(kind, start, end) of every secret, leftmost and non-overlapping per kind."""
    found = []
    low = data.lower()
    if any(w in low for w in _WORDS):
        found += [(0, m.start(), m.end()) for m in _ASSIGN.finditer(data) if len(m[2]) >= 8]
    if b"AKIA" in data:
        found += [(1, m.start(), m.end()) for m in _ACCESS.finditer(data)]
    found += [(2, m.start(), m.end()) for m in _HEX.finditer(data)]
    return found


def _unescaped(layer: Layer):
    """Every line with an escape, all its escapes taken off once."""
    data = layer.data
    if not (b"%" in data or b"\\" in data or b"&#" in data):
        return
    line, end = [], -1
    for m in _ESCAPE.finditer(data):
        if line and m.start() >= end:
            yield _line(layer, line, end)
            line = []
        if not line:
            end = data.find(b"\n", m.end())
            end = len(data) if end < 0 else end
        line.append(m)
    if line:
        yield _line(layer, line, end)


def _line(layer: Layer, escapes: list[re.Match], end: int) -> Layer:
    begin = layer.data.rfind(b"\n", 0, escapes[0].start()) + 1
    first = np.array([m.start() for m in escapes]) - begin
    last = np.array([m.end() for m in escapes]) - begin
    codes = [int(m[m.lastindex], 10 if m.lastindex == 7 else 16) for m in escapes]
    data = np.frombuffer(layer.data, np.uint8)[begin:end].copy()
    starts, ends = layer.starts[begin:end], layer.ends[begin:end].copy()
    data[first] = [c if c < 256 else 63 for c in codes]
    ends[first] = ends[last - 1]
    inside = np.zeros(end - begin + 1, np.int8)
    inside[first + 1] += 1
    inside[last] -= 1
    kept = np.cumsum(inside[:-1]) == 0
    return Layer(data[kept].tobytes(), starts[kept], ends[kept], layer.path + ">escape")


def _decoded(layer: Layer):
    """What base64 runs hold, if it is text or compressed."""
    for m in _RUN.finditer(layer.data):
        if layer.path.endswith(">escape") and (layer.ends[m.start():m.end()] - layer.starts[m.start():m.end()] == 1).all():
            continue  # the layer before had it too
        last = layer.data.rfind(b"\n", m.start(), m.end())
        places = [(m.start(), m.end())] + [(m.start(), last)] * (last > 0)  # the last line may be none of the run
        found = [x for x in (_of_base64(layer, *p) for p in places) if x]
        if not found:  # a path or a name may stand before it
            found = [x for x in (_of_base64(layer, p.start(), p.end()) for p in _PART.finditer(layer.data, m.start(), m.end())) if x]
        yield from found


def _of_base64(layer: Layer, start: int, end: int) -> Layer | None:
    digits = layer.data[start:end].rstrip(b"=").translate(_URL_SAFE, b"\r\n")
    digits = digits[:len(digits) - (len(digits) % 4 == 1)]
    try:
        data = base64.b64decode(digits + b"=" * (-len(digits) % 4))
    except binascii.Error:
        return None
    if not _PACKED_START.match(data):
        try:
            data.decode()
        except UnicodeDecodeError as wrong:  # what follows may be none of the run
            if wrong.start < SHORTEST:
                return None
            data = data[:wrong.start]
    # Byte k is made of the digits that bits 8k to 8k + 7 fall into.
    raw = np.frombuffer(layer.data, np.uint8)[start:end]
    place = start + np.flatnonzero((raw != 10) & (raw != 13) & (raw != 61))
    k = np.arange(len(data))
    return Layer(data, layer.starts[place[8 * k // 6]], layer.ends[place[(8 * k + 7) // 6]], layer.path + ">base64")


def _unpacked(layer: Layer, room: int):
    """(layer, bytes) for what is compressed in a layer; (None, 0) where it would need more than ``room``."""
    data, at = memoryview(layer.data), 0
    while m := (_PACKED_START.match(layer.data) if at == 0 else None) or _PACKED.search(layer.data, at):
        at = m.start() + 1
        try:
            out, used = _inflate(data[m.start():], room + 1)
        except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError):
            continue
        if len(out) > room:
            yield None, 0
        elif out:
            # A byte can depend on all that came before it, so the whole stream stands for it.
            start, end = layer.starts[m.start()], layer.ends[m.start() + used - 1]
            yield Layer(out, np.broadcast_to(start, len(out)), np.broadcast_to(end, len(out)), layer.path + ">packed"), len(out)
            room -= len(out)


def _inflate(data: memoryview, most: int) -> tuple[bytes, int]:
    """The first ``most`` bytes that a compressed stream holds, and the length of the stream."""
    if data[0] == 0x28:
        return zstandard.ZstdDecompressor(max_window_size=1 << 27).stream_reader(io.BytesIO(data)).read(most), len(data)
    if data[0] == 0xFD:
        stream = lzma.LZMADecompressor(memlimit=1 << 28)
    elif data[0] == 0x42:
        stream = bz2.BZ2Decompressor()
    else:
        stream = zlib.decompressobj(wbits=47)
    return stream.decompress(data, most), len(data) - len(stream.unused_data)


def scan(text: str, max_unpacked: int = MAX_UNPACKED) -> tuple[list[tuple], int]:
    """((start, kind, end, path, secret), ...) of a text and all its layers, and how many layers were too large.

    The worklist holds layers; each is searched and then unwrapped by all three ways. A layer
    that was seen at its place before is not entered again, so what unpacks to itself ends.
    """
    data = text.encode("latin-1", "replace")
    work, seen, found, unread = [Layer(data, _Itself(len(data), 0), _Itself(len(data), 1), "")], set(), {}, 0
    while work:
        layer = work.pop()
        for kind, i, j in matches(layer.data):
            start, end = int(layer.starts[i]), int(layer.ends[j - 1])
            known = found.get((start, kind, end, layer.data[i:j]))
            if known is None or len(layer.path) < len(known):
                found[start, kind, end, layer.data[i:j]] = layer.path
        inner = [*_unescaped(layer), *_decoded(layer)]
        for new, size in _unpacked(layer, max_unpacked):
            if new is None:
                unread += 1
            else:
                max_unpacked -= size
                inner.append(new)
        for new in inner:
            if len(new.data) >= 8:
                key = hashlib.blake2b(new.data, digest_size=16).digest(), int(new.starts[0]), int(new.ends[-1])
                if key not in seen:
                    seen.add(key)
                    work.append(new)
    out = [(s, k, e, path[1:], x.decode("utf-8", "replace")) for (s, k, e, x), path in found.items()]
    return sorted(out, key=lambda f: (f[0], f[1], f[2], len(f[3]), f[3], f[4])), unread


def find_secrets(docs: DataFrame, max_unpacked: int = MAX_UNPACKED) -> DataFrame:
    """doc_id, found (array of kind, start, end, path, secret), unread; a row per row of ``docs``.

    start and end (exclusive) are code points of the text. ``path`` is empty for what stands in
    the text itself; otherwise it names the layers (escape, base64, packed), and the span is what
    the secret was decoded from, for a compressed layer the whole of it. A secret that several
    layers show at one place has its shortest path. ``unread`` counts compressed layers that would
    take a document beyond ``max_unpacked`` bytes: these alone are not searched.

    Escapes are percent signs, ``\\u``, ``\\U`` and ``\\x`` escapes and numeric references; base64
    is of either alphabet, with or without padding or line ends; compressed means gzip, zlib,
    bzip2, xz and Zstandard. Null and empty texts have nothing; repeated rows have equal results;
    other columns are not read. No shuffle.
    """
    kind = dict(docs.dtypes)["doc_id"]
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("path", pa.string()), ("secret", pa.string())]))

    def searched(batches):
        for batch in batches:
            found, unread = [], []
            for text in batch.column(1):  # one at a time: a text and its layers are all that is held
                hits, n = scan(text.as_py() or "", max_unpacked)
                found.append([{"kind": KINDS[k], "start": s, "end": e, "path": p, "secret": x} for s, k, e, p, x in hits])
                unread.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, spans), pa.array(unread, pa.int64())],
                                             ["doc_id", "found", "unread"])

    return docs.select("doc_id", "text").mapInArrow(
        searched, f"doc_id {kind}, found array<struct<kind: string, start: bigint, end: bigint, path: string, secret: string>>, unread bigint")


def spans(found: Column) -> Column:
    """kind:start:end of each, joined by commas; what has one span and several values is there once."""
    return F.array_join(F.array_distinct(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))), ",")


def in_text(found: Column, kind: str | None = None) -> Column:
    """Those that stand in the text itself, of one kind or all."""
    return F.filter(found, lambda x: (x["path"] == "") & ((x["kind"] == kind) if kind else F.lit(True)))
