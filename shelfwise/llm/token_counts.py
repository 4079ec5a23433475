"""Edit-aware token counts: pre-token segment trees per document.

A text is cut in pre-tokens by the tokenizer's pattern; merges never cross them, so a text's tokens are the sum over
its pre-tokens. The pre-tokens of a document hang in segments of a binary tree whose nodes hold sums of characters
and tokens. An edit finds its segments from the sums, cuts and encodes anew only the touched region: from a few
pre-tokens before it (what the pattern may have read ahead from) to the first old boundary met again behind it,
and updates the sums on the path to the root. The rest of the document is neither read nor encoded.

Trees are rows: id, text and the packed sizes and token counts of the pre-tokens. `build_trees` makes them, `apply_edits`
changes them; both are narrow, a task holds one Arrow batch and one tree.

Defined results: a null or empty text has no pre-tokens and 0 tokens; edits are (start, end, text) in code points of
the text before any of them, must not overlap, are clipped to the text, and null fields count as 0, 0 and empty;
a null list is no edit; repeated documents have a tree each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import spread_out
from shelfwise.sources.tables import table

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern that belongs to this rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEGMENT = 64
KNOWN = 300_000  # pre-tokens whose counts a worker remembers
# Pre-tokens before the last visible character ahead of an edit, and characters behind a pre-token, that the pattern may look at.
BACK, AHEAD = 2, 3


class Tokenizer:
    """Cuts texts in pre-tokens and counts the tokens of each."""

    def __init__(self, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.pattern, self.merges, self.known = regex.compile(pattern), merges, {}

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = 1 if piece.encode() in self.merges else len(self.encoding.encode_ordinary(piece))
            if len(self.known) >= KNOWN:
                self.known.clear()
            self.known[piece] = n
        return n

    def cut(self, text: str) -> list[str]:
        return self.pattern.findall(text)


@cache
def tokenizer(ranks: str = RANKS, pattern: str = PATTERN) -> Tokenizer:
    """One per worker process."""
    return Tokenizer(ranks, pattern)


class TokenTree:
    """Segments of pre-tokens (text, sizes, tokens) under a binary tree of sums."""

    def __init__(self, own: Tokenizer, text: str, sizes: list[int] | None = None, tokens: list[int] | None = None):
        self.own, self.encoded = own, 0
        if sizes is None:
            pieces = own.cut(text)
            sizes, tokens = list(map(len, pieces)), list(map(own.count, pieces))
            self.encoded = len(pieces)
        self._plant(text, sizes, tokens)

    def _plant(self, text: str, sizes: list[int], tokens: list[int]) -> None:
        self.texts, self.sizes, self.tokens, at = [], [], [], 0
        for low in range(0, max(len(sizes), 1), SEGMENT):
            own = sizes[low : low + SEGMENT]
            self.texts.append(text[at : at + sum(own)])
            self.sizes.append(own)
            self.tokens.append(tokens[low : low + SEGMENT])
            at += sum(own)
        self.width = 1 << max(len(self.texts) - 1, 0).bit_length()
        self.chars = [0] * (2 * self.width)
        self.sums = [0] * (2 * self.width)
        for i, (own, counts) in enumerate(zip(self.sizes, self.tokens)):
            self.chars[self.width + i], self.sums[self.width + i] = sum(own), sum(counts)
        for node in range(self.width - 1, 0, -1):
            self._add_up(node)

    def _add_up(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.sums[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(self.texts)

    def leaves(self) -> tuple[list[int], list[int]]:
        return [n for own in self.sizes for n in own], [n for own in self.tokens for n in own]

    def _segment(self, at: int) -> tuple[int, int]:
        """Segment that holds character `at`, and where it starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at >= start + self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.width, start

    def _restart(self, start: int) -> tuple[int, int, int, int]:
        """Where cutting begins again for an edit at `start`: segment, its start, pre-token in it, its start."""
        if not start:
            return 0, 0, 0, 0
        segment, low = self._segment(start - 1)
        at = start
        while True:  # the last visible character before the edit
            head = self.texts[segment][: at - low].rstrip()
            at = low + len(head)
            if head or not segment:
                break
            segment -= 1
            low -= len(self.texts[segment])
        if at == low and not segment:
            return 0, 0, 0, 0
        piece, begin = 0, low
        while begin + self.sizes[segment][piece] < at:
            begin += self.sizes[segment][piece]
            piece += 1
        for _ in range(BACK):
            while not piece:
                if not segment:
                    return 0, 0, 0, 0
                segment -= 1
                low -= len(self.texts[segment])
                piece = len(self.sizes[segment])
            piece -= 1
            begin -= self.sizes[segment][piece]
        return segment, low, piece, begin

    def edit(self, start: int, end: int, text: str) -> None:
        """Replace the characters start:end by a text."""
        start = min(max(start, 0), self.n_chars)
        end = min(max(end, start), self.n_chars)
        first, low, piece, begin = self._restart(start)
        last, high = self._segment(end) if end < self.n_chars else (len(self.texts) - 1, self.n_chars - len(self.texts[-1]))
        head = "".join(self.texts[first : last + 1])[begin - low :]
        stop = high + len(self.texts[last])  # old text is read up to here
        shift = len(text) - (end - start)
        window = head[: start - begin] + text + head[end - begin :]
        while True:
            done = stop == self.n_chars
            cut = self._recut(window, begin, start + len(text), shift, last, high, done)
            if cut is not None:
                break
            last += 1
            high = stop
            window += self.texts[last]
            stop += len(self.texts[last])
        sizes, kept = cut
        tail_sizes, tail_tokens, tail_text = kept
        own = window[: sum(sizes)]
        tokens, at = [], 0
        for n in sizes:
            tokens.append(self.own.count(own[at : at + n]))
            at += n
        self.encoded += len(sizes)
        self.texts[first] = self.texts[first][: begin - low] + own + tail_text
        self.sizes[first] = self.sizes[first][:piece] + sizes + tail_sizes
        self.tokens[first] = self.tokens[first][:piece] + tokens + tail_tokens
        for i in range(first + 1, last + 1):
            self.texts[i], self.sizes[i], self.tokens[i] = "", [], []
        if len(self.sizes[first]) > 8 * SEGMENT:
            self._plant(self.text(), *self.leaves())
            return
        for i in range(first, last + 1):
            self.chars[self.width + i], self.sums[self.width + i] = len(self.texts[i]), sum(self.tokens[i])
        low_node, high_node = (self.width + first) // 2, (self.width + last) // 2
        while low_node:
            for node in range(low_node, high_node + 1):
                self._add_up(node)
            low_node, high_node = low_node // 2, high_node // 2

    def _recut(self, window: str, begin: int, fresh: int, shift: int, last: int, high: int, done: bool):
        """New pre-token sizes up to the first old boundary at or behind the edit, and what is kept of the last segment.

        None if the window ends too early to tell. `fresh` is the end of the new text, `high` the old start of the
        last segment, both in characters of the document.
        """
        boundaries, at = {}, high
        for i, n in enumerate(self.sizes[last]):
            boundaries.setdefault(at + shift, i)
            at += n
        sizes, position = [], 0
        visible = len(window) if done else len(window.rstrip()) - AHEAD
        for match in self.own.pattern.finditer(window):
            place = begin + position
            if place >= fresh and place in boundaries and position <= visible:
                i = boundaries[place]
                skipped = sum(self.sizes[last][:i])
                return sizes, (self.sizes[last][i:], self.tokens[last][i:], self.texts[last][skipped:])
            if match.end() > visible:
                break
            sizes.append(match.end() - position)
            position = match.end()
        if done and position == len(window):
            return sizes, ([], [], "")
        return None


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones: Python lists take several times the room of Arrow columns."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def _lists(column: pa.Array) -> list[list[int]]:
    """Rows of a list column of numbers; null is empty."""
    values = column.flatten().to_numpy(zero_copy_only=False).tolist()
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)).tolist()
    return [values[low:high] for low, high in zip([0, *ends], ends)]


def _packed(values: list[list[int]]) -> pa.Array:
    return pa.array(values, pa.list_(pa.int32()))


def build_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """(id, text, sizes, tokens): the pre-token tree of every document, as a row to keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(ranks, pattern)
        for batch in _slices(batches):
            texts = [t or "" for t in batch["text"].to_pylist()]
            pieces = [own.cut(t) for t in texts]
            sizes = _packed([list(map(len, p)) for p in pieces])
            tokens = _packed([list(map(own.count, p)) for p in pieces])
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(texts, pa.string()), sizes, tokens], names=["id", "text", "sizes", "tokens"])

    narrow = spread_out(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    return narrow.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, text string, sizes array<int>, tokens array<int>")


def apply_edits(trees: DataFrame, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """Trees (with a column `edits`: array of start, end, text) after their edits, and what it took.

    Adds n_tokens before, n_edited after, n_edits, n_pieces after, and encoded, the pre-tokens that were encoded anew.
    """
    counts = "n_tokens bigint, n_edited bigint, n_edits bigint, n_pieces bigint, encoded bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(ranks, pattern)
        for batch in _slices(batches):
            out = []
            rows = zip(batch["text"].to_pylist(), _lists(batch["sizes"]), _lists(batch["tokens"]), batch["edits"].to_pylist())
            for text, sizes, tokens, edits in rows:
                tree = TokenTree(own, text or "", sizes, tokens)
                before = tree.n_tokens
                for edit in sorted(edits or [], key=lambda e: (e["start"] or 0, e["end"] or 0), reverse=True):
                    tree.edit(edit["start"] or 0, edit["end"] or 0, edit["text"] or "")
                own_sizes, own_tokens = tree.leaves()
                out.append((tree.text(), own_sizes, own_tokens, before, tree.n_tokens, len(edits or []), len(own_sizes), tree.encoded))
            columns = list(zip(*out)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(columns[0], pa.string()), _packed(columns[1]), _packed(columns[2]), *(pa.array(c, pa.int64()) for c in columns[3:])],
                names=["id", "text", "sizes", "tokens", "n_tokens", "n_edited", "n_edits", "n_pieces", "encoded"],
            )

    kind = trees.schema["id"].dataType.simpleString()
    schema = f"id {kind}, text string, sizes array<int>, tokens array<int>, {counts}"
    return trees.select("id", "text", "sizes", "tokens", "edits").mapInArrow(run, schema)


# What the query edits: private data become a mark, and every text ends with a newline.
ADDRESS = re.compile(r"[\w.+-]+@[\w-]+\.[\w.]+")
PRIVATE = re.compile(r"\b(?:\d{1,3}(?:\.\d{1,3}){3}|[0-9a-f]{24,}|AKIA[A-Z0-9]{16,}|\d{12,})\b")
MARK = "[private]"


def redactions(text: str) -> list[dict]:
    """Edits that take private data out of a text."""
    spans = [m.span() for m in PRIVATE.finditer(text)]
    if "@" in text:
        spans = sorted(spans + [m.span() for m in ADDRESS.finditer(text)])
    found, at = [], 0
    for start, end in spans:
        if start >= at:  # an address may hold a number
            found.append({"start": start, "end": end, "text": MARK})
            at = end
    if text and not text.endswith("\n"):
        found.append({"start": len(text), "end": len(text), "text": "\n"})
    return found


def with_redactions(trees: DataFrame) -> DataFrame:
    """Trees with the edits that take private data out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))
        for batch in _slices(batches):
            edits = pa.array([redactions(t or "") for t in batch["text"].to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, edits], names=[*batch.schema.names, "edits"])

    kind = trees.schema["id"].dataType.simpleString()
    schema = f"id {kind}, text string, sizes array<int>, tokens array<int>, edits array<struct<start:int,end:int,text:string>>"
    return trees.select("id", "text", "sizes", "tokens").mapInArrow(run, schema)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = apply_edits(with_redactions(build_trees(table(spark, sf_dir, "documents"))))
    return edited.select(F.col("id").alias("doc_id"), "n_tokens", "n_edited", "n_edits", "n_pieces", "encoded")


QUERIES = {"op6_token_counts": op6_token_counts}
ORACLE: dict[str, str] = {}
