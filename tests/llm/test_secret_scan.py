from __future__ import annotations

import base64
import bz2
import gzip
import lzma
import re
import urllib.parse
import zlib

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import secret_scan as scan

SECRET = 'password = "hunter22x"'
ENCODERS = {
    "percent": lambda s: urllib.parse.quote(s, safe=""),
    "every byte": lambda s: "".join(f"%{b:02X}" for b in s.encode()),
    "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    "hex escape": lambda s: "".join(f"\\x{ord(c):02x}" for c in s),
    "base64": lambda s: base64.b64encode(s.encode()).decode(),
    "url base64": lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    "gzip": lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
    "zlib": lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
    "bzip2": lambda s: base64.b64encode(bz2.compress(s.encode())).decode(),
    "xz": lambda s: base64.b64encode(lzma.compress(s.encode())).decode(),
    "zstd": lambda s: base64.b64encode(zstandard.compress(s.encode())).decode(),
}


@pytest.mark.parametrize("outer", [None, *ENCODERS])
@pytest.mark.parametrize("inner", ENCODERS)
def test_secrets_are_found_through_layers(inner, outer):
    coded = ENCODERS[inner](SECRET)
    coded = ENCODERS[outer](coded) if outer else coded
    text = f"héllo 🙂 {coded} bye"
    found = scan.scan(text)
    start, end = text.index(coded), text.index(coded) + len(coded)
    kinds = [(k, s, e) for k, s, e in found.spans if k == "assign" and s == start]
    assert kinds and all(start < e <= end for _, _, e in kinds)


def test_spans_are_exact_for_character_encodings():
    for name in ("percent", "every byte", "unicode", "hex escape"):
        text = "see " + ENCODERS[name]("x token: abcdef12 y") + " end"
        ((kind, start, end),) = [s for s in scan.scan(text).spans if s[0] == "assign"]
        piece = text[start:end]
        assert piece == ENCODERS[name]("token: abcdef12") and kind == "assign"


def plain(text):
    """Base findings by the patterns as the contract writes them."""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], scan.KINDS.index(s[0])))


PIECES = ["token", "TOKEN", "api_key", "apikey", " ", "=", ":", '"', "'", "abc123", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "x", "é", "%41", "\\u0041", "pass", "word", "wd", "-", "\n"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_base_findings_equal_the_patterns(text):
    found = scan.scan(text)
    assert found.base == plain(text) and set(found.base) <= set(found.spans)


def test_only_ascii_letters_match_in_either_case():
    assert scan.scan("\u017fecret = abcdefgh to\u212aen = abcdefgh").base == []


def test_documents_without_secrets_stay_clean():
    for text in ("", None, "%%% 100% \\u12 base64 of nothing", "z" * 100_000, "thererentionenatinghatheinere " * 50):
        assert scan.scan(text).spans == []


def test_cycles_and_bombs_end():
    text = base64.b64encode(gzip.compress(b"token = abcdefgh " * 200_000)).decode()
    found = scan.scan(text, layer_bytes=10_000)
    assert found.cut and found.spans == [("assign", 0, len(text))]
    assert scan.scan("%2525252525252525").layers == 8


def test_odd_rows(spark, odd, empty):
    found = {r.doc_id: r for r in scan.scan_documents(odd.withColumn("text", odd.text)).collect()}
    assert set(found) == {r.doc_id for r in odd.collect()} and all(r.spans == [] for r in found.values())
    assert scan.scan_documents(empty).count() == 0
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = scan.scan_documents(documents).join(documents.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == documents.count() and any(r.base for r in rows)
    assert all([tuple(s) for s in r.base] == plain(r.text) for r in rows)


def b64(data):
    return base64.b64encode(data).decode()


@pytest.mark.parametrize("data", [
    "\ufeff".encode() + SECRET.encode(), ("x\u3000\u00a0" + SECRET).encode(), ("\u200b\u2028\x0c\x00\x1b" + SECRET).encode(),
    SECRET.encode("utf-16"), SECRET.encode("utf-16-be"), b"caf\xe9 " + SECRET.encode(), gzip.compress(SECRET.encode("utf-16-le")),
])
def test_decoded_bytes_of_any_kind_are_scanned(data):
    text = f"see {b64(data)} end"
    assert any(k == "assign" for k, _, _ in scan.scan(text).spans)
    inner = f"see {b64(b64(data).encode())} end"
    assert any(k == "assign" for k, _, _ in scan.scan(inner).spans)


@pytest.mark.parametrize("before", ["https://host.example/cb/", "v1-", "path/", "key_", "a", "ab", "abc", "abcd/_-"])
@pytest.mark.parametrize("data", [SECRET.encode(), gzip.compress(SECRET.encode()), zstandard.compress(SECRET.encode())])
def test_base64_after_characters_of_its_alphabet(before, data):
    text = before + b64(data)
    assert any(k == "assign" and s >= len(before) - 2 and e <= len(text) for k, s, e in scan.scan(text).spans)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("data", [b"x" * 50 + SECRET.encode() + b"y" * 90, gzip.compress(bytes(range(256)) * 3 + SECRET.encode())])
def test_wrapped_base64_is_one_run(data, end):
    coded = b64(data)
    text = "-----BEGIN-----" + end + end.join(coded[i : i + 76] for i in range(0, len(coded), 76)) + end
    assert any(k == "assign" for k, _, _ in scan.scan(text).spans)


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress])
def test_every_member_is_read(pack):
    data = pack(b"nothing here") + pack(b"nor here") + pack(SECRET.encode())
    for text in (b64(data), "".join(f"%{b:02X}" for b in data), "".join(f"\\x{b:02x}" for b in data)):
        assert scan.scan(f"see {text} end").spans, text
    nested = b64(pack(pack(SECRET.encode())))
    assert ("assign", 0, len(nested)) in scan.scan(nested).spans


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, zstandard.compress])
def test_all_of_a_long_layer_is_scanned(pack):
    filler = b"".join(b"%d " % i for i in range(20_000))
    text = b64(pack(filler + SECRET.encode() + filler))
    found = scan.scan(text, layer_bytes=10_000)
    assert found.cut and ("assign", 0, len(text)) in found.spans


def test_a_layer_that_unpacks_to_itself_ends(monkeypatch):
    monkeypatch.setattr(scan, "_members", lambda data, step: iter([(data, len(data))]))
    assert scan.scan(b64(gzip.compress(b"anything"))).spans == []


@pytest.mark.parametrize("gap", ["\n    ", "\n\t", "\r\n  ", "\\n", "\\r\\n", " \n \n  ", "\n"])
@pytest.mark.parametrize("width", [8, 12, 40])
@pytest.mark.parametrize("data", [b"x = 1; " + SECRET.encode() + b"; end of it", gzip.compress(SECRET.encode() + bytes(range(90)))])
def test_base64_wrapped_in_other_ways(gap, width, data):
    coded = b64(data)
    body = gap.join(coded[i : i + width] for i in range(0, len(coded), width))
    for before in ("key:" + gap, 'data: "', "some words before" + gap):
        text = before + body + '" and more'
        found = [(s, e) for k, s, e in scan.scan(text).spans if k == "assign"]
        assert found and all(len(before) - 20 <= s < e <= len(before) + len(body) for s, e in found)


def test_spans_of_a_wrapped_run_are_those_of_its_characters():
    """A plain decoder of one wrapped run: byte i of the decoded text comes from base64 character i * 8 / 6."""
    data = b"abc; token = hunter22x; more"
    coded = b64(data)
    places, text = [], "k:\n"
    for i, c in enumerate(coded):
        if i and i % 8 == 0:
            text += "\n   "
        places.append(len(text))
        text += c
    start, end = data.index(b"token"), data.index(b";", 5)
    wanted = ("assign", places[start * 8 // 6], places[-(-end * 8 // 6) - 1] + 1)
    assert wanted in scan.scan(text).spans


@pytest.mark.parametrize("text", ["pass\\u{77}ord = hunter22x", "\\u{70}\\u{000061}ssword = hunter22x"])
def test_braced_escapes(text):
    assert [s for s in scan.scan(text).spans if s[0] == "assign"] == [("assign", 0, len(text))]


def test_blank_lines_and_words_take_no_time():
    for text in ("abcd" + " \n" * 50_000 + "!", "word\n" * 50_000, "abcd \t \n" * 20_000):
        scan.scan(text)


ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def plain_layers(text):
    """Spans of all layers, one character with its range after another; no compression, UTF-16 or wrapped lines."""

    def joined(part):
        return min(b for _, b, _ in part), max(e for _, _, e in part)

    def decoded(data, ranges):
        try:
            chars = data.decode()
        except UnicodeDecodeError:
            return [(chr(byte), *place) for byte, place in zip(data, ranges)]
        out, at = [], 0
        for char in chars:
            n = len(char.encode())
            out.append((char, *joined([(char, *place) for place in ranges[at : at + n]])))
            at += n
        return out

    work, seen, spans = [[(c, i, i + 1) for i, c in enumerate(text)]], set(), set()
    while work:
        layer = work.pop()
        chars = "".join(c for c, _, _ in layer)
        if tuple(layer) in seen:
            continue
        seen.add(tuple(layer))
        spans |= {(kind, *joined(layer[start:end])) for kind, start, end in plain(chars)}
        for pattern, size in ((r"(?:%[0-9A-Fa-f]{2})+", 3), (r"(?:\\x[0-9A-Fa-f]{2})+", 4)):
            out, at = [], 0
            for m in re.finditer(pattern, chars):
                places = range(m.start(), m.end(), size)
                codes, ranges = [int(chars[i + size - 2 : i + size], 16) for i in places], [joined(layer[i : i + size]) for i in places]
                as_bytes = decoded(bytes(codes), ranges) if size == 3 else [(chr(c), *r) for c, r in zip(codes, ranges)]
                out, at = out + layer[at : m.start()] + as_bytes, m.end()
            if at:
                work.append(out + layer[at:])
        for m in re.finditer(r"[A-Za-z0-9+/_-]{16,}", chars):
            for shift in range(4):
                run = layer[m.start() + shift : m.end()]
                bits = "".join(format((ALPHABET + "+/").index({"-": "+", "_": "/"}.get(c, c)), "06b") for c, _, _ in run)
                n = len(bits) // 8
                data = bytes(int(bits[8 * i : 8 * i + 8], 2) for i in range(n))
                if n:
                    work.append(decoded(data, [joined(run[8 * i // 6 : -(-8 * (i + 1) // 6)]) for i in range(n)]))
    return spans


PIECES = ["token: abcdef99", "secret=é東x12345", "AKIA" + "A1" * 9, "deadbeef" * 3 + "é", "two words", "ü/path/", 'api_key = "zzzzzz"', "50% off"]
LAYERED = st.recursive(
    st.sampled_from(PIECES),
    lambda inner: st.tuples(
        st.sampled_from(["", "see ", "a/", "%41"]), st.sampled_from(["percent", "every byte", "hex escape", "base64", "url base64"]), inner
    ).map(lambda x: x[0] + (ENCODERS[x[1]](x[2]) if x[1] != "hex escape" else "".join(f"\\x{b:02x}" for b in x[2].encode("latin-1", "replace")))),
    max_leaves=3,
)


@settings(max_examples=150, deadline=None)
@given(st.lists(LAYERED, min_size=1, max_size=3))
def test_spans_of_layers_equal_a_plain_decoder(parts):
    text = " ".join(parts)
    assert set(scan.scan(text).spans) == plain_layers(text)


def test_large_blobs_stay_linear():
    """A secret between a megabyte of plain text and one of random base64, under one encoded space."""
    blob = base64.b64encode(bytes((i * i * 2654435761 >> 13) & 255 for i in range(600_000))).decode()
    coded = base64.b64encode(gzip.compress(("x" * 2_000_000 + SECRET).encode())).decode()
    text = "word " * 200_000 + "%20" + coded + " " + blob
    found = scan.scan(text)
    at = len("word " * 200_000) + 3
    assert ("assign", at, at + len(coded)) in found.spans
