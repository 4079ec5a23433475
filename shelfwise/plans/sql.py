"""SQL fragments shared by the checking queries."""

from __future__ import annotations

NORM = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"


def tokens(expr: str) -> str:
    return rf"[x FOR x IN string_split_regex(lower({expr}), '[^\p{{L}}\p{{N}}]+') IF x <> '']"


def hash_int(*parts: str, seed: str = "42") -> str:
    key = ", '|', ".join([f"'{seed}'", *parts])
    return f"CAST(concat('0x', substr(md5(concat({key})), 1, 8)) AS BIGINT)"


def chunk_ctes(size: int = 500, overlap: int = 50, name: str = "chunks", p: str = "") -> str:
    """Greedy word packing of every document as a hop chain over word offsets."""
    return rf"""
{p}norm AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents),
{p}word AS (SELECT doc_id, unnest(string_split(t, ' ')) AS w, generate_subscripts(string_split(t, ' '), 1) AS i
  FROM {p}norm WHERE t <> ''),
{p}pos AS (SELECT doc_id, i, CAST(sum(length(w) + 1) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) - length(w) - 1 AS s,
    CAST(sum(length(w) + 1) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) - 1 AS e FROM {p}word),
{p}reach AS (SELECT a.doc_id, a.i, a.s, b.i AS j, b.e AS e_end
  FROM {p}pos a ASOF JOIN {p}pos b ON a.doc_id = b.doc_id AND a.s + {size} >= b.e),
{p}nxt AS (SELECT r.*, n.e AS e_next FROM {p}reach r LEFT JOIN {p}pos n ON n.doc_id = r.doc_id AND n.i = r.j + 1),
{p}hop AS (SELECT x.doc_id, x.i, x.s, x.j, x.e_end,
    CASE WHEN x.e_next IS NULL THEN NULL ELSE least(greatest(coalesce(b.i, x.j + 1), x.i + 1), x.j + 1) END AS nx
  FROM (SELECT *, greatest(e_end - {overlap}, coalesce(e_next, 0) - {size}) AS lo FROM {p}nxt) x
  ASOF LEFT JOIN {p}pos b ON b.doc_id = x.doc_id AND x.lo <= b.s),
{p}chain AS (
  SELECT doc_id, 0 AS ordinal, i, s, e_end, nx FROM {p}hop WHERE i = 1
  UNION ALL
  SELECT h.doc_id, c.ordinal + 1, h.i, h.s, h.e_end, h.nx FROM {p}chain c JOIN {p}hop h
    ON h.doc_id = c.doc_id AND h.i = c.nx),
{name} AS (SELECT c.doc_id, CAST(c.ordinal AS INTEGER) AS ordinal, CAST(c.s AS INTEGER) AS start,
    substr(n.t, CAST(c.s + 1 AS BIGINT), CAST(c.e_end - c.s AS BIGINT)) AS text
  FROM {p}chain c JOIN {p}norm n ON n.doc_id = c.doc_id)"""


CHUNKS_CTE = chunk_ctes()
