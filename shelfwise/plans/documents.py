"""Text preparation and chunking queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.functions import text as ft
from shelfwise.operators import chunk, text
from shelfwise.plans.sql import CHUNKS_CTE, NORM
from shelfwise.session import spread_out
from shelfwise.sources.tables import silver_documents, table

QUERIES = {}
ORACLE = {}
BOILERPLATE_MIN_DOCS = 20


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def pages_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as binary files: every tenth page empty of text, as a scanned file would be."""
    blank = F.lit("<html><body><img src='scan.png'></body></html>")
    return spread_out(table(spark, sf, "pages")).select(
        "page_id", F.when(F.length("html") < 1500, blank).otherwise(F.col("html")).cast("binary").alias("content")
    )


SQL_PAGE_TEXT = r"""
page_text AS (
  SELECT page_id, CASE WHEN b = '' THEN '<ERROR: IMAGE_ONLY_NO_TEXT_EXTRACTED>' ELSE b END AS extracted_text
  FROM (
    SELECT page_id, trim(regexp_replace(
      replace(replace(replace(replace(replace(replace(replace(replace(
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(h,
          '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g'),
          '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
        '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&copy;', '©'),
        '&middot;', '·'), '&amp;', '&'), '\s+', ' ', 'g')) AS b
    FROM (SELECT page_id, CASE WHEN length(html) < 1500 THEN '<html><body><img src=''scan.png''></body></html>'
                 ELSE html END AS h FROM pages)))
"""


@query
def extract_text(spark: SparkSession, sf: str) -> DataFrame:
    return text.extract_html(pages_bronze(spark, sf))


ORACLE["extract_text"] = f"WITH {SQL_PAGE_TEXT} SELECT page_id, extracted_text FROM page_text"


@query
def extract_text_with_decoder(spark: SparkSession, sf: str) -> DataFrame:
    """The same extraction through a registered decoder; bytes that are not ASCII fail per row."""
    docs = spread_out(table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("content")))
    return text.extract_with(_strict_ascii, docs).select(
        "doc_id",
        F.when(F.col("extracted_text").startswith(config.ERROR_PREFIX), "failed").otherwise("ok").alias("outcome"),
        F.when(~F.col("extracted_text").startswith(config.ERROR_PREFIX), F.col("extracted_text")).alias("body"),
    )


def _strict_ascii(payload: bytes) -> str:
    return payload.decode("ascii")


ORACLE["extract_text_with_decoder"] = rf"""
SELECT doc_id, CASE WHEN regexp_matches(text, '[^\x00-\x7f]') THEN 'failed' ELSE 'ok' END AS outcome,
       CASE WHEN NOT regexp_matches(text, '[^\x00-\x7f]') THEN {NORM} END AS body
FROM documents"""


@query
def normalize_whitespace(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", ft.normalize_whitespace(F.col("text")).alias("clean_text"))


ORACLE["normalize_whitespace"] = f"SELECT doc_id, {NORM} AS clean_text FROM documents"


@query
def drop_payload_column(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").withColumn("length", F.octet_length("html").cast("bigint"))
    return pages.withColumnRenamed("html", "content").drop("content")


ORACLE["drop_payload_column"] = "SELECT page_id, url, CAST(strlen(html) AS BIGINT) AS length FROM pages"


@query
def filter_extraction_errors(spark: SparkSession, sf: str) -> DataFrame:
    kept = text.drop_extraction_errors(text.extract_html(pages_bronze(spark, sf)))
    return kept.select("page_id", F.length("extracted_text").cast("bigint").alias("n_chars"))


ORACLE["filter_extraction_errors"] = f"""
WITH {SQL_PAGE_TEXT} SELECT page_id, CAST(length(extracted_text) AS BIGINT) AS n_chars
FROM page_text WHERE NOT starts_with(extracted_text, '<ERROR')"""


def marked_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose text is missing, unreadable or fine, by their length."""
    n = F.length("text")
    marked = (
        F.when(n < 60, F.lit(None).cast("string"))
        .when(n < 120, F.lit(config.ERROR_NO_TEXT))
        .when(n < 200, F.lit(config.ERROR_EXCEPTION.format(message="broken xref")))
        .otherwise(F.col("text"))
    )
    return table(spark, sf, "documents").select("doc_id", marked.alias("extracted_text"))


@query
def quarantine_split(spark: SparkSession, sf: str) -> DataFrame:
    kept, rejected = text.quarantine_split(marked_documents(spark, sf))
    return kept.select("doc_id", F.lit("kept").alias("route")).unionByName(
        rejected.select("doc_id", F.col("reject_reason").alias("route"))
    )


ORACLE["quarantine_split"] = """
SELECT doc_id, CASE WHEN length(text) < 60 THEN 'no_content' WHEN length(text) < 120 THEN 'image_only'
  WHEN length(text) < 200 THEN 'extraction_failed' ELSE 'kept' END AS route FROM documents"""


@query
def flag_needs_ocr(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").withColumnRenamed("text", "extracted_text")
    return text.flag_needs_ocr(docs).select("doc_id", "needs_ocr")


ORACLE["flag_needs_ocr"] = "SELECT doc_id, length(text) < 50 AS needs_ocr FROM documents"


@query
def strip_boilerplate_lines(spark: SparkSession, sf: str) -> DataFrame:
    return text.strip_boilerplate_lines(spread_out(table(spark, sf, "documents")), "doc_id", "text", BOILERPLATE_MIN_DOCS)


ORACLE["strip_boilerplate_lines"] = rf"""
WITH l AS (
  SELECT doc_id, i, string_split(t, chr(10))[i] AS line
  FROM (SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g') AS t FROM documents),
       unnest(range(1, len(string_split(t, chr(10))) + 1)) AS u(i)),
f AS (SELECT trim(line) AS line FROM l WHERE trim(line) <> '' GROUP BY 1
      HAVING count(DISTINCT doc_id) >= {BOILERPLATE_MIN_DOCS})
SELECT doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY i) FILTER (f.line IS NULL), '') AS clean_text,
       CAST(count(f.line) AS BIGINT) AS lines_removed
FROM l LEFT JOIN f ON f.line = trim(l.line) GROUP BY doc_id"""


@query
def prompt_format(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(
        "item_id", ft.rag_prompt(F.concat(F.lit("item "), F.col("item_id")), F.col("text")).alias("prompt")
    )


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_prompt(context: str, question: str) -> str:
    head, rest = config.RAG_TEMPLATE.replace("{organization}", config.ORGANIZATION).split("{context}")
    mid, tail = rest.split("{question}")
    return f"concat({sql_text(head)}, {context}, {sql_text(mid)}, {question}, {sql_text(tail)})"


ORACLE["prompt_format"] = f"""
SELECT item_id, {sql_prompt("concat('item ', item_id)", "text")} AS prompt FROM benchmark"""


@query
def preview_text(spark: SparkSession, sf: str) -> DataFrame:
    inputs = F.when(F.col("role") == "user", F.col("text"))
    payload = F.when(F.col("role") == "assistant", F.to_json(F.struct(F.col("role"))))
    return table(spark, sf, "conversations").select("conv_id", "turn", ft.preview(inputs, payload).alias("preview"))


ORACLE["preview_text"] = """
SELECT conv_id, turn, concat(substr(coalesce(CASE WHEN role = 'user' THEN text END,
  CASE WHEN role = 'assistant' THEN '{"role":"assistant"}' END, 'N/A'), 1, 80), '...') AS preview
FROM conversations"""


@query
def token_cost(spark: SparkSession, sf: str) -> DataFrame:
    """Estimated tokens and dollars of every session; user and system text is input, the rest output."""
    estimate = ft.token_estimate(F.col("text"))
    tokens_in = F.sum(F.when(F.col("role") != "assistant", estimate).otherwise(0))
    tokens_out = F.sum(F.when(F.col("role") == "assistant", estimate).otherwise(0))
    cost = (tokens_in * config.PRICE_IN_PER_MILLION + tokens_out * config.PRICE_OUT_PER_MILLION) / 1e6
    return (
        table(spark, sf, "conversations")
        .groupBy("conv_id")
        .agg(tokens_in.alias("tokens_in"), tokens_out.alias("tokens_out"), F.round(cost, 9).alias("cost_usd"))
    )


ORACLE["token_cost"] = f"""
SELECT conv_id, tokens_in, tokens_out,
  round((tokens_in * {config.PRICE_IN_PER_MILLION}::DOUBLE + tokens_out * {config.PRICE_OUT_PER_MILLION}::DOUBLE) / 1e6, 9) AS cost_usd
FROM (SELECT conv_id,
  CAST(sum(CASE WHEN role <> 'assistant' THEN ceil(length(text) / 4.0) ELSE 0 END) AS BIGINT) AS tokens_in,
  CAST(sum(CASE WHEN role = 'assistant' THEN ceil(length(text) / 4.0) ELSE 0 END) AS BIGINT) AS tokens_out
  FROM conversations GROUP BY 1)"""


def document_chunks(spark: SparkSession, sf: str, size: int = config.CHUNK_SIZE) -> DataFrame:
    silver = spread_out(silver_documents(spark, sf))
    return chunk.chunk_documents(silver, "doc_id", "path", "source_system", "region", size=size)


@query
def chunk_recursive(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread_out(silver_documents(spark, sf)).withColumn("t", ft.normalize_whitespace(F.col("extracted_text")))
    return docs.select("doc_id", F.explode(chunk.chunk_array(F.col("t"))).alias("c")).select("doc_id", "c.*")


ORACLE["chunk_recursive"] = f"WITH RECURSIVE {CHUNKS_CTE} SELECT doc_id, ordinal, start, text FROM chunks"


@query
def chunk_recursive_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of the raw text, where line breaks outrank spaces (checked against brute force in tests)."""
    docs = spread_out(table(spark, sf, "documents"))
    return docs.select("doc_id", F.explode(chunk.chunk_array(F.col("text"))).alias("c")).select("doc_id", "c.*")


@query
def explode_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return document_chunks(spark, sf).select("path", "source_system", "region", "ordinal", "chunk_content")


ORACLE["explode_chunks"] = f"""
WITH RECURSIVE {CHUNKS_CTE}
SELECT concat('doc/', doc_id) AS path, d.source AS source_system, d.lang AS region, ordinal, c.text AS chunk_content
FROM chunks c JOIN documents d USING (doc_id)"""


@query
def drop_empty_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as chunks, blank ones dropped, counted per document."""
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("chunk_content"))
    return lines.filter("chunk_content != ''").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


ORACLE["drop_empty_chunks"] = """
SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS c FROM documents)
WHERE c <> '' GROUP BY 1"""


@query
def chunk_paragraph(spark: SparkSession, sf: str) -> DataFrame:
    return chunk.chunk_paragraphs(table(spark, sf, "documents"), "text", "doc_id")


ORACLE["chunk_paragraph"] = """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS ordinal, trim(p[i]) AS chunk_content
FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents), unnest(range(1, len(p) + 1)) AS u(i)
WHERE trim(p[i]) <> ''"""


def pages_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """Page bodies with headings as markdown lines and paragraphs as lines."""
    html = F.regexp_replace("html", r"[\r\n]+", " ")
    html = F.regexp_replace(html, r"(?is)<(?:script|style|title)\b.*?</(?:script|style|title)>", " ")
    html = F.regexp_replace(html, r"(?i)<h[1-6][^>]*>", "\n# ")
    html = F.regexp_replace(html, r"(?i)</h[1-6]>|<p>|</p>|<footer>", "\n")
    return table(spark, sf, "pages").select("page_id", F.regexp_replace(html, r"<[^>]*>", " ").alias("md"))


@query
def chunk_heading(spark: SparkSession, sf: str) -> DataFrame:
    return chunk.chunk_headings(pages_markdown(spark, sf), "md", "page_id")


ORACLE["chunk_heading"] = r"""
WITH m AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
    '[\r\n]+', ' ', 'g'), '(?is)<(?:script|style|title)\b.*?</(?:script|style|title)>', ' ', 'g'),
    '(?i)<h[1-6][^>]*>', chr(10) || '# ', 'g'), '(?i)</h[1-6]>|<p>|</p>|<footer>', chr(10), 'g'),
    '<[^>]*>', ' ', 'g') AS md FROM pages),
l AS (SELECT page_id, i, string_split(md, chr(10))[i] AS line
      FROM m, unnest(range(1, len(string_split(md, chr(10))) + 1)) AS u(i)),
h AS (SELECT *, regexp_matches(line, '^\s*#{1,6}\s') AS is_h,
        trim(regexp_extract(line, '^\s*#{1,6}\s+(.*)$', 1)) AS head FROM l),
s AS (SELECT page_id, i, line, is_h,
        CAST(sum(CASE WHEN is_h THEN 1 ELSE 0 END) OVER w AS BIGINT) AS section,
        last_value(CASE WHEN is_h THEN head END IGNORE NULLS) OVER w AS heading
      FROM h WINDOW w AS (PARTITION BY page_id ORDER BY i))
SELECT page_id, section, heading,
  coalesce(string_agg(trim(line), chr(10) ORDER BY i) FILTER (NOT is_h AND trim(line) <> ''), '') AS chunk_content
FROM s GROUP BY 1, 2, 3 HAVING heading IS NOT NULL OR chunk_content <> ''"""


@query
def chunk_stats(spark: SparkSession, sf: str) -> DataFrame:
    return chunk.chunk_stats(document_chunks(spark, sf), "doc_id")


ORACLE["chunk_stats"] = f"""
WITH RECURSIVE {CHUNKS_CTE}
SELECT doc_id, count(*) AS n_chunks, CAST(min(length(text)) AS INTEGER) AS min_chars,
  CAST(max(length(text)) AS INTEGER) AS max_chars, CAST(sum(length(text)) AS BIGINT) AS sum_chars,
  quantile_cont(length(text), 0.5)::DOUBLE AS median_chars, count(*) FILTER (length(text) > 500) AS over_limit
FROM chunks GROUP BY doc_id"""


@query
def chunk_id_md5(spark: SparkSession, sf: str) -> DataFrame:
    ids = chunk.with_chunk_ids(document_chunks(spark, sf))
    return ids.select("doc_id", "ordinal", "chunk_id", "chunk_key")


ORACLE["chunk_id_md5"] = f"""
WITH RECURSIVE {CHUNKS_CTE}
SELECT doc_id, ordinal, md5(text) AS chunk_id,
  sha256(concat(doc_id, '|', ordinal, '|', md5(text))) AS chunk_key FROM chunks"""
