"""Secret scan with a recursive decoding worklist.

The patterns run over the whole text. Then every encoded part is unwrapped (percent encoding, Unicode escapes,
base64, and gzip, zlib, bzip2, xz or Zstandard data inside any of them), the decoded layer is scanned again, and so
on until nothing new appears; a layer seen before in the document is not entered again, so cycles end. Two arrays
per layer say where each character begins and ends in the document, so a finding in any layer is reported as a
span of the document: exact for character encodings, the whole encoded run for compressed data.

Base64 is decoded at all four alignments, since a blob may follow other characters of its alphabet; lines are joined, also
short or indented ones and breaks written as escapes, but not words between spaces. Bytes
that are not UTF-8 are taken as one character each, and as UTF-16 where they have a NUL; the patterns decide. Compressed
data may begin anywhere in decoded bytes, and all its members are read.

The scan is one narrow pass; a task holds one Arrow batch and the layers of one document.

Defined results: a null or empty text has no spans; overlapping findings of different kinds all stay; equal
spans of a kind found in several layers are one; repeated documents are scanned one by one; an undecodable
run is plain text; a compressed layer longer than `layer_bytes` is scanned whole, in pieces of that size of which each
repeats half of the one before (`cut` says so; only an encoded run of more than half a piece can be split); `layers`
counts decoded texts that are readable, hold a finding or are decoded further; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import spread_out
from shelfwise.sources.tables import table

KINDS = ("assign", "access", "hex")
LAYER_BYTES = 64 << 20


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The patterns of the contract.
_KEYWORDS = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = re.compile(rf"(?:{_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPED = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
ONE_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|\\u\{([0-9A-Fa-f]{1,6})\}")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[A-Za-z0-9+/_-]+)*={0,2}")
# Line breaks inside base64: indented, repeated, or written as escapes.
GAP = re.compile(r"[\t ]*+(?:(?:\r?\n|\r|\\r\\n|\\n|\\r)[\t ]*+)+")
WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{4,}}+(?:{GAP.pattern}[A-Za-z0-9+/_-]++)+={{0,2}}")
BASE64_LEAST = 16
URL_SAFE = bytes.maketrans(b"-_", b"+/")
PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")


class Layer(NamedTuple):
    """Decoded text; character i comes from begins[i]:ends[i] of the document (None: from i itself). Neither decreases."""

    text: str
    begins: np.ndarray | None
    ends: np.ndarray | None

    def source(self, start: int, end: int) -> tuple[int, int]:
        if self.begins is None:
            return start, end
        return int(self.begins[start]), int(self.ends[end - 1])

    def sources(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (starts, ends) if self.begins is None else (self.begins[starts], self.ends[ends - 1])


def find(text: str) -> Iterator[tuple[str, int, int]]:
    """Base findings of one text: kind, start, end."""
    for match in ASSIGN.finditer(text):
        if len(match[1]) >= 6:
            yield "assign", *match.span()
    if "AKIA" in text:
        for match in ACCESS.finditer(text):
            if match.end() - match.start() >= 20:
                yield "access", *match.span()
    for match in HEX.finditer(text):
        yield "hex", *match.span()


def _characters(data: bytes) -> tuple[str, np.ndarray, np.ndarray] | None:
    """UTF-8 bytes as characters, with the first byte of each and the one after its last; None if not UTF-8."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    starts = np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)
    return text, starts, np.append(starts[1:], len(data))


def _replaced(layer: Layer, runs: list[tuple[int, int, str, Iterable[int], Iterable[int]]]) -> Layer:
    """The layer with runs (start, end, text, begins, ends in the layer) decoded in place."""
    lows, highs = [0, *(run[1] for run in runs)], [*(run[0] for run in runs), len(layer.text)]
    plain, decoded = np.subtract(highs, lows), np.array([*(len(run[2]) for run in runs), 0])
    counts = np.stack([plain, decoded], axis=1).ravel()
    in_run = np.repeat(np.arange(len(counts)) % 2 == 1, counts)
    kept = np.repeat(np.array(lows) - np.cumsum(plain) + plain, plain) + np.arange(plain.sum())
    begins, ends = np.empty(len(in_run), np.int64), np.empty(len(in_run), np.int64)
    begins[~in_run], ends[~in_run] = kept, kept + 1
    begins[in_run] = np.fromiter(chain.from_iterable(run[3] for run in runs), np.int64)
    ends[in_run] = np.fromiter(chain.from_iterable(run[4] for run in runs), np.int64)
    pieces = [piece for low, high, run in zip(lows, highs, runs) for piece in (layer.text[low:high], run[2])]
    return Layer("".join([*pieces, layer.text[lows[-1] :]]), *layer.sources(begins, ends))


def percent_layer(layer: Layer) -> Layer | None:
    if "%" not in layer.text:
        return None
    runs = []
    for match in PERCENT.finditer(layer.text):
        data = binascii.unhexlify(match[0].replace("%", ""))
        decoded = None if data.isascii() else _characters(data)
        if decoded is None:  # one byte each, also of another code page
            text, begins, ends = data.decode("latin-1"), range(len(data)), range(1, len(data) + 1)
        else:
            text, begins, ends = decoded[0], decoded[1].tolist(), decoded[2].tolist()
        first = match.start()
        runs.append((*match.span(), text, [first + 3 * i for i in begins], [first + 3 * i for i in ends]))
    return _replaced(layer, runs) if runs else None


def escape_layer(layer: Layer) -> Layer | None:
    if "\\" not in layer.text:
        return None
    runs = []
    for match in ESCAPED.finditer(layer.text):
        units = [(int(m[1] or m[2] or m[3] or m[4], 16), m.start(), m.end()) for m in ONE_ESCAPE.finditer(layer.text, *match.span())]
        chars, begins, ends, i = [], [], [], 0
        while i < len(units):
            code, begin, end = units[i]
            i += 1
            if 0xD800 <= code < 0xDC00 and i < len(units) and 0xDC00 <= units[i][0] < 0xE000:
                code, end = 0x10000 + ((code - 0xD800) << 10) + units[i][0] - 0xDC00, units[i][2]
                i += 1
            chars.append(chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�")
            begins.append(begin)
            ends.append(end)
        runs.append((*match.span(), "".join(chars), begins, ends))
    return _replaced(layer, runs) if runs else None


def _members(data: bytes | memoryview, step: int) -> Iterator[tuple[bytes, int]]:
    """Decompressed parts of about `step` bytes, of all members one after another, and the bytes of `data` used so far."""
    rest = data
    try:
        while (found := PACKED.match(rest)) is not None:
            if found[0] == b"\x28\xb5\x2f\xfd":
                with zstandard.ZstdDecompressor().stream_reader(rest, read_across_frames=True) as reader:
                    while part := reader.read(step):
                        yield part, 0
                yield b"", len(data)
                return
            if found[0][:1] in b"\x1f\x78":
                worker = zlib.decompressobj(31 if found[0][:1] == b"\x1f" else 15)
                while not worker.eof and rest:
                    part = worker.decompress(rest, step)
                    if not part and len(worker.unconsumed_tail) == len(rest):
                        break
                    rest = worker.unconsumed_tail
                    yield part, 0
            else:
                worker = bz2.BZ2Decompressor() if found[0][:1] == b"B" else lzma.LZMADecompressor()
                yield worker.decompress(rest, step), 0
                while not worker.eof and not worker.needs_input:
                    yield worker.decompress(b"", step), 0
            if not worker.eof:  # the data end within a member
                return
            rest = worker.unused_data
            yield b"", len(data) - len(rest)
    except (OSError, EOFError, zlib.error, lzma.LZMAError, zstandard.ZstdError, MemoryError):
        return


def unpacked(data: bytes | memoryview, limit: int) -> Iterator[tuple[bytes, bool, int]]:
    """Everything `data` hold at their start, in pieces of up to `limit` bytes that repeat half of the one before:
    piece, whether there are others, and the bytes of `data` that were used."""
    held, many, used = b"", False, 0
    for part, end in _members(data, max(1, limit // 2)):
        held, used = held + part, max(used, end)
        while len(held) > limit:
            many = True
            yield held[:limit], True, used
            held = held[max(1, limit // 2) :]
    if held or used:
        yield held, many, used


def packed_layers(data: bytes, begins: np.ndarray, ends: np.ndarray, limit: int, seen: set) -> Iterator[tuple[Layer, bool]]:
    """Layers of compressed data anywhere in bytes, however deep; byte i comes from begins[i]:ends[i] of the document."""
    work: list[tuple[bytes, tuple[int, int] | None]] = [(data, None)]
    while work:
        data, whole = work.pop()
        after = 0
        for match in PACKED.finditer(data):
            if match.start() < after:
                continue
            span = whole or (int(begins[match.start()]), int(ends[-1]))
            for piece, many, used in unpacked(memoryview(data)[match.start() :], limit):
                after = max(after, match.start() + used)
                mark = hashlib.blake2b(piece, digest_size=16).digest(), span
                if piece and mark not in seen:
                    seen.add(mark)
                    for text, _ in _texts(piece):
                        # One range for all characters, without an array of their number.
                        yield Layer(text, *(np.broadcast_to(np.int64(place), len(text)) for place in span)), many
                    work.append((piece, span))


def _texts(data: bytes) -> Iterator[tuple[str, tuple[np.ndarray, np.ndarray] | None]]:
    """Bytes as text, with the bytes of each character unless it is one byte or UTF-8: UTF-8, or else a character a byte;
    UTF-16 of either order and parity where there is a NUL."""
    try:
        yield data.decode(), None
    except UnicodeDecodeError:
        yield data.decode("latin-1"), None
    if b"\0" in data:
        for low in (0, 1):
            for order in "<>":
                units = np.frombuffer(data, f"{order}u2", (len(data) - low) // 2, low).astype("<u4") if len(data) > low + 1 else np.zeros(0, "<u4")
                units[(units >= 0xD800) & (units < 0xE000)] = 0xFFFD
                if len(units):
                    first = low + 2 * np.arange(len(units))
                    yield units.tobytes().decode("utf-32-le"), (first, first + 2)


def _readable(text: str) -> bool:
    return bool(text) and text.replace("\t", "").replace("\n", "").replace("\r", "").isprintable()


def _matters(text: str) -> bool:
    """Whether a text has a finding or is decoded further."""
    return next(find(text), None) is not None or any(p.search(text) for p in (PERCENT, ESCAPED)) or next(base64_runs(text), None) is not None


def base64_runs(text: str) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start, end, places of the base64 characters) of every run, on one line or wrapped over several."""

    def places(start: int, end: int) -> np.ndarray:
        codes = np.frombuffer(text[start:end].encode("ascii"), np.uint8)
        return start + np.flatnonzero(~np.isin(codes, list(b"\r\n=")))

    whole = {match.span() for match in BASE64.finditer(text)}
    for match in WRAPPED.finditer(text):
        ends = [match.start(), *(x for gap in GAP.finditer(text, *match.span()) for x in gap.span()), match.end()]
        at = np.concatenate([places(low, high) for low, high in zip(ends[::2], ends[1::2])])
        if len(at) >= BASE64_LEAST:
            whole.discard(match.span())
            yield *match.span(), at
    for start, end in sorted(whole):
        yield start, end, places(start, end)


def base64_layers(layer: Layer, limit: int, seen: set) -> Iterator[tuple[Layer, bool]]:
    """Layers of the runs of base64, as text and unpacked, and whether each is one of several pieces."""
    for start, end, at in base64_runs(layer.text):
        codes = np.frombuffer(layer.text[start:end].encode("ascii"), np.uint8)
        run = codes[at - start].tobytes().translate(URL_SAFE)
        for shift in range(4):
            part = run[shift:]
            part = part[: len(part) - (len(part) % 4 == 1)]
            data = base64.b64decode(part + b"=" * (-len(part) % 4))

            def place(low: np.ndarray, high: np.ndarray, shift: int = shift) -> tuple[np.ndarray, np.ndarray]:
                """Ranges of the document of the bytes low:high; three bytes are four characters."""
                last = np.minimum(shift - (-high * 8 // 6), len(at)) - 1
                return layer.sources(at[shift + low * 8 // 6], at[last] + 1)

            each = np.arange(len(data))
            if PACKED.search(data):
                begins, ends = place(each, each + 1)
                ends[-1] = layer.source(start, end)[1]
                yield from packed_layers(data, begins, ends, limit, seen)
            for text, ranges in _texts(data):
                if not (_matters(text) or (shift == 0 and ranges is None and _readable(text))):
                    continue
                if ranges is None:
                    decoded = _characters(data)
                    ranges = decoded[1:] if decoded else (each, each + 1)
                yield Layer(text, *place(*ranges)), False


def byte_layers(layer: Layer, limit: int, seen: set) -> Iterator[tuple[Layer, bool]]:
    """Layers of compressed bytes that are written in percent encoding or as escapes."""
    for pattern in (PERCENT, ESCAPED):
        for match in pattern.finditer(layer.text):
            if pattern is PERCENT:
                data = binascii.unhexlify(match[0].replace("%", ""))
            else:
                units = [(int(m[1] or m[2] or m[3] or m[4], 16), *m.span()) for m in ONE_ESCAPE.finditer(layer.text, *match.span())]
                data = bytes(min(unit[0], 255) for unit in units)
            if PACKED.search(data):
                if pattern is PERCENT:
                    begins = match.start() + 3 * np.arange(len(data))
                    ends = begins + 3
                else:
                    begins, ends = np.array(units)[:, 1:].T
                yield from packed_layers(data, *layer.sources(begins, ends), limit, seen)


class Scan(NamedTuple):
    base: list[tuple[str, int, int]]
    spans: list[tuple[str, int, int]]
    layers: int
    cut: bool


def _ordered(spans) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(text: str | None, layer_bytes: int = LAYER_BYTES) -> Scan:
    """Findings of the text itself, findings of all layers as spans of the text, and the number of decoded layers."""
    text = text or ""
    base = list(find(text))
    spans, seen, cut, layers = set(base), {_mark(text)}, False, 0
    unpacked_before: set = set()
    work = [Layer(text, None, None)]
    while work:
        layer = work.pop()
        found: list[tuple[Layer | None, bool]] = [(percent_layer(layer), False), (escape_layer(layer), False)]
        for inner, was_cut in chain(
            found, byte_layers(layer, layer_bytes, unpacked_before), base64_layers(layer, layer_bytes, unpacked_before)
        ):
            cut |= was_cut
            # The same text from another place is another layer, with other spans.
            if inner is None:
                continue
            mark = _mark(inner.text), int(inner.begins[0]) if inner.text else None
            if mark in seen:
                continue
            seen.add(mark)
            layers += 1
            spans.update((kind, *inner.source(start, end)) for kind, start, end in find(inner.text))
            work.append(inner)
    return Scan(_ordered(base), _ordered(spans), layers, cut)


def _mark(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", layer_bytes: int = LAYER_BYTES) -> DataFrame:
    """One row per document: id, `base` and `spans` (kind, start, end in code points), `layers` decoded, `cut`."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(value.as_py(), layer_bytes) for value in batch.column(1)]
            listed = [[[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in pair] for pair in zip(*[(f.base, f.spans) for f in found])]
            base, spans = listed if listed else ([], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, span), pa.array(spans, span),
                 pa.array([f.layers for f in found], pa.int32()), pa.array([f.cut for f in found], pa.bool_())],
                names=[id_col, "base", "spans", "layers", "cut"],
            )

    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, base {spans}, spans {spans}, layers int, cut boolean"
    return spread_out(docs.select(F.col(id_col), F.col(text_col))).mapInArrow(run, schema)


def listed(spans: str):
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_documents(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"), "layers", "cut")


QUERIES = {"op9_secret_scan": op9_secret_scan}
ORACLE: dict[str, str] = {}
