"""Grounded answers for whole question tables, routing and structured questions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.functions import text as ft
from shelfwise.operators import rag, search, store
from shelfwise.plans.documents import document_chunks, sql_prompt
from shelfwise.plans.retrieval import SQL_EMBED, questions, sql_bm25, text_vectors
from shelfwise.plans.sql import CHUNKS_CTE, tokens
from shelfwise.session import fits, materialize, scratch_dir
from shelfwise.sources.tables import silver_documents, table

QUERIES = {}
ORACLE = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def chunk_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """The chunk layer, written once: id, text, source."""
    chunks = document_chunks(spark, sf).select(
        F.concat_ws("#", "doc_id", F.lpad(F.col("ordinal").cast("string"), 9, "0")).alias("id"),
        F.col("chunk_content").alias("text"),
        F.col("path").alias("source"),
    )
    return materialize(chunks, "chunks")


SQL_CORPUS = f"""{CHUNKS_CTE},
corpus AS (SELECT concat(doc_id, '#', lpad(CAST(ordinal AS VARCHAR), 9, '0')) AS id, text,
  concat('doc/', doc_id) AS source FROM chunks)"""
SQL_TOP3 = f"""{SQL_CORPUS}, {sql_bm25("corpus", "id", config.RAG_TOP_K)},
hits AS (SELECT question_id, rank, text, source, score FROM top JOIN corpus USING (id)),
ctx AS (SELECT question_id, string_agg(concat(chr(10), '--- Document ', rank, ' ---', chr(10), 'Source: ', source,
    chr(10), 'Content: ', text, chr(10)), '' ORDER BY rank) AS context FROM hits GROUP BY 1)"""


@query
def format_context(spark: SparkSession, sf: str) -> DataFrame:
    _, contexts = rag.answer_context(questions(spark, sf), chunk_corpus(spark, sf))
    return contexts.select("question_id", "context")


ORACLE["format_context"] = f"WITH RECURSIVE {SQL_TOP3} SELECT question_id, context FROM ctx"


@query
def batch_rag_prompts(spark: SparkSession, sf: str) -> DataFrame:
    asked = questions(spark, sf)
    _, contexts = rag.answer_context(asked, chunk_corpus(spark, sf))
    return rag.rag_prompts(asked, contexts).select("question_id", "prompt", F.array_join("citations", "|").alias("citations"))


SQL_CITES = """cites AS (SELECT question_id, string_agg(source, '|' ORDER BY first_rank) AS citations
  FROM (SELECT question_id, source, min(rank) AS first_rank FROM hits GROUP BY 1, 2) GROUP BY 1)"""
ORACLE["batch_rag_prompts"] = f"""
WITH RECURSIVE {SQL_TOP3}, {SQL_CITES}
SELECT item_id AS question_id, {sql_prompt("context", "text")} AS prompt, citations
FROM benchmark JOIN ctx ON question_id = item_id JOIN cites USING (question_id)"""


@query
def context_budget(spark: SparkSession, sf: str) -> DataFrame:
    """Estimated tokens of every prompt against the budget of a call."""
    asked = questions(spark, sf)
    _, contexts = rag.answer_context(asked, chunk_corpus(spark, sf))
    tokens_ = ft.token_estimate(F.col("prompt"))
    prompts = rag.rag_prompts(asked, contexts).filter("prompt IS NOT NULL")
    return prompts.select("question_id", tokens_.alias("tokens"), (tokens_ <= config.CONTEXT_BUDGET).alias("within_budget"))


ORACLE["context_budget"] = f"""
WITH RECURSIVE {SQL_TOP3}, p AS (SELECT item_id AS question_id,
  CAST(ceil(length({sql_prompt("context", "text")}) / 4.0) AS BIGINT) AS tokens FROM benchmark JOIN ctx ON question_id = item_id)
SELECT question_id, tokens, tokens <= {config.CONTEXT_BUDGET} AS within_budget FROM p"""


def vector_prompts(asked: DataFrame, chunks: DataFrame) -> DataFrame:
    """Questions and chunks embedded, the nearest chunks as context, prompts with citations."""
    asked_vectors, chunk_vectors = text_vectors(asked), text_vectors(chunks.select("id", "text"))
    hits = search.knn(asked_vectors, chunk_vectors, config.RAG_TOP_K)
    shown = search.attach_text(hits, chunks, "id", "text", "source", few=fits(asked_vectors))
    prompts = rag.rag_prompts(asked, search.format_context(shown))
    return prompts.select("question_id", "prompt", "answer", F.array_join("citations", "|").alias("citations"))


@query
def vector_rag(spark: SparkSession, sf: str) -> DataFrame:
    return vector_prompts(questions(spark, sf), chunk_corpus(spark, sf))


RAG_REGION = "fr"


@query
def vector_rag_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """A caller who may see one region only, and asks for one of its source systems' first half."""
    mine = document_chunks(spark, sf).filter((F.col("region") == RAG_REGION) & F.col("source_system").isin("src0", "src1", "src2"))
    chunks = mine.select(
        F.concat_ws("#", "doc_id", F.lpad(F.col("ordinal").cast("string"), 9, "0")).alias("id"),
        F.col("chunk_content").alias("text"),
        F.col("path").alias("source"),
    )
    return vector_prompts(questions(spark, sf), materialize(chunks, "chunks"))


def sql_vector_rag(corpus: str) -> str:
    return f"""
WITH RECURSIVE {SQL_CORPUS}, seen AS (SELECT * FROM corpus WHERE {corpus}),
embed_input AS (SELECT 'd' AS src, id, text FROM seen UNION ALL SELECT 'q', CAST(item_id AS VARCHAR), text FROM benchmark), {SQL_EMBED},
unit AS (SELECT src, id, dim, CAST(x AS DOUBLE) AS x FROM emb),
lens AS (SELECT src, id, sqrt(sum(x * x)) AS n FROM unit GROUP BY 1, 2),
dots AS (SELECT a.id AS qi, b.id AS di, sum(a.x * b.x) AS s FROM unit a JOIN unit b
  ON a.dim = b.dim AND a.src = 'q' AND b.src = 'd' GROUP BY 1, 2),
pairs AS (SELECT CAST(q.id AS BIGINT) AS question_id, d.id, round(coalesce(dots.s, 0) / (q.n * d.n), 6) AS score
  FROM lens q JOIN lens d ON q.src = 'q' AND d.src = 'd' LEFT JOIN dots ON dots.qi = q.id AND dots.di = d.id),
hits AS (SELECT question_id, rank, text, source FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id) AS rank
  FROM pairs) JOIN seen USING (id) WHERE rank <= {config.RAG_TOP_K}),
ctx AS (SELECT question_id, string_agg(concat(chr(10), '--- Document ', rank, ' ---', chr(10), 'Source: ', source,
    chr(10), 'Content: ', text, chr(10)), '' ORDER BY rank) AS context FROM hits GROUP BY 1), {SQL_CITES}
SELECT item_id AS question_id, CASE WHEN context IS NOT NULL THEN {sql_prompt("context", "text")} END AS prompt,
  CASE WHEN context IS NULL THEN '{config.NO_CONTEXT_ANSWER}' END AS answer, coalesce(citations, '') AS citations
FROM benchmark LEFT JOIN ctx ON question_id = item_id LEFT JOIN cites USING (question_id)"""


ORACLE["vector_rag"] = sql_vector_rag("true")
ORACLE["vector_rag_filtered"] = sql_vector_rag(
    f"source IN (SELECT concat('doc/', doc_id) FROM documents WHERE lang = '{RAG_REGION}' AND source IN ('src0', 'src1', 'src2'))"
)


@query
def rag_citations(spark: SparkSession, sf: str) -> DataFrame:
    _, contexts = rag.answer_context(questions(spark, sf), chunk_corpus(spark, sf))
    return contexts.select("question_id", F.posexplode("citations").alias("position", "source"))


ORACLE["rag_citations"] = f"""
WITH RECURSIVE {SQL_TOP3}
SELECT question_id, source, CAST(row_number() OVER (PARTITION BY question_id ORDER BY min(rank)) - 1 AS INTEGER) AS position
FROM hits GROUP BY question_id, source"""


@query
def rag_no_context(spark: SparkSession, sf: str) -> DataFrame:
    """Customer names as questions over the handbook: most find nothing."""
    asked = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.regexp_replace("c_name", "[#0]", "").alias("text"))
    docs = silver_documents(spark, sf).select(F.col("doc_id").alias("id"), F.col("extracted_text").alias("text"), F.col("path").alias("source"))
    _, contexts = rag.answer_context(asked, docs)
    return rag.rag_prompts(asked, contexts).select(
        "question_id", "answer", F.size("citations").alias("n_citations"), F.col("prompt").isNotNull().alias("has_prompt")
    )


ORACLE["rag_no_context"] = rf"""
WITH q AS (SELECT c_custkey, unnest(list_distinct({tokens("regexp_replace(c_name, '[#0]', '', 'g')")})) AS term FROM customer),
d AS (SELECT DISTINCT doc_id, unnest({tokens("text")}) AS term FROM documents),
n AS (SELECT c_custkey, least(count(DISTINCT doc_id), 3) AS n FROM q LEFT JOIN d USING (term) GROUP BY 1)
SELECT c_custkey AS question_id, CASE WHEN n = 0 THEN '{config.NO_CONTEXT_ANSWER}' END AS answer,
  CAST(n AS INTEGER) AS n_citations, n > 0 AS has_prompt FROM n"""


@query
def batch_answer(spark: SparkSession, sf: str) -> DataFrame:
    asked = questions(spark, sf)
    hits, _ = rag.answer_context(asked, chunk_corpus(spark, sf))
    return rag.extractive_answers(asked, hits)


SQL_ANSWER = rf"""sents AS (SELECT question_id, rank, unnest(parts) AS sentence, generate_subscripts(parts, 1) AS position
  FROM (SELECT question_id, rank, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS parts FROM hits)),
over AS (SELECT s.*, len(list_intersect({tokens("s.sentence")}, {tokens("b.text")})) AS overlap
  FROM sents s JOIN benchmark b ON b.item_id = s.question_id),
answers AS (SELECT question_id, sentence AS answer, CAST(overlap AS INTEGER) AS overlap FROM (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY overlap DESC, rank, position) AS r FROM over) WHERE r = 1)"""
ORACLE["batch_answer"] = f"""
WITH RECURSIVE {SQL_TOP3}, {SQL_ANSWER}
SELECT item_id AS question_id, coalesce(answer, '{config.NO_CONTEXT_ANSWER}') AS answer, coalesce(overlap, 0) AS overlap
FROM benchmark LEFT JOIN answers ON question_id = item_id"""


FIRST_RUN = datetime(2024, 3, 1)


def busy_model(often: bool):
    """Test model: replies with the size of the prompt, and is busy for every seventh size, at first also for the next one."""

    def reply(prompt: str, attempt: int) -> str:
        if len(prompt) % 7 in ((0, 1) if often else (0,)):
            raise RuntimeError("endpoint busy")
        return f"{len(prompt)} characters read"

    return reply


@query
def stored_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Answers from the store after two runs and a third one that finds nothing to do; failures wait a minute and have two tries."""
    asked = questions(spark, sf)
    _, contexts = rag.answer_context(asked, chunk_corpus(spark, sf))
    prompts = materialize(rag.rag_prompts(asked, contexts), "prompts")
    held = store.AnswerStore(spark, scratch_dir(spark, "answers"), "model-1", max_runs=2)
    held.run(prompts, busy_model(True), FIRST_RUN)
    held.run(prompts, busy_model(False), FIRST_RUN + timedelta(minutes=2))
    held.run(prompts, busy_model(False), FIRST_RUN + timedelta(days=1))
    return held.answers(prompts)


ORACLE["stored_answers"] = f"""
WITH RECURSIVE {SQL_TOP3}, p AS (SELECT item_id, length({sql_prompt("context", "text")}) AS n FROM benchmark LEFT JOIN ctx ON question_id = item_id)
SELECT item_id AS question_id,
  CASE WHEN n IS NULL THEN '{config.NO_CONTEXT_ANSWER}' WHEN n % 7 <> 0 THEN concat(n, ' characters read') END AS answer,
  CASE WHEN n IS NULL THEN 'no_context' WHEN n % 7 = 0 THEN 'given_up' ELSE 'done' END AS state,
  CAST(CASE WHEN n IS NULL THEN 0 WHEN n % 7 IN (0, 1) THEN 2 ELSE 1 END AS INTEGER) AS runs,
  CASE WHEN n % 7 = 0 THEN 'endpoint busy' END AS error FROM p"""

PACK_DEPTH, PACK_BUDGET, PACK_FRAME = 10, 500, 12


@query
def packed_context(spark: SparkSession, sf: str) -> DataFrame:
    """The best ten chunks of every question, packed into a budget of tokens; what did not fit is listed too."""
    name = F.concat_ws("#", "doc_id", F.lpad(F.col("ordinal").cast("string"), 9, "0"))
    chunks = materialize(document_chunks(spark, sf).select(name.alias("id"), F.col("chunk_content").alias("text"), F.col("path").alias("source"), "ordinal", "start"), "chunks")
    asked = questions(spark, sf)
    hits = search.bm25(asked, chunks.select("id", "text"), PACK_DEPTH).drop("score")
    found = chunks.join(F.broadcast(hits) if fits(hits) else hits, "id")
    packed = rag.pack_context(found, PACK_BUDGET, PACK_FRAME)
    return packed.select("question_id", "rank", "id", "tokens", "total", "packed")


ORACLE["packed_context"] = f"""
WITH RECURSIVE {CHUNKS_CTE},
corpus AS (SELECT concat(doc_id, '#', lpad(CAST(ordinal AS VARCHAR), 9, '0')) AS id, text, doc_id, ordinal, start FROM chunks),
{sql_bm25("corpus", "id", PACK_DEPTH)},
h AS (SELECT question_id, rank, id, doc_id, ordinal, start, start + length(text) AS stop, length(text) AS n FROM top JOIN corpus USING (id)),
o AS (SELECT a.question_id, a.rank, sum(greatest(least(a.stop, b.stop) - greatest(a.start, b.start), 0)) AS shared
  FROM h a JOIN h b ON a.question_id = b.question_id AND a.doc_id = b.doc_id AND abs(a.ordinal - b.ordinal) = 1 AND b.rank < a.rank GROUP BY 1, 2),
adds AS (SELECT question_id, rank, id, CAST(ceil(greatest(n - coalesce(shared, 0), 0) / 4.0) + {PACK_FRAME} AS BIGINT) AS tokens
  FROM h LEFT JOIN o USING (question_id, rank)),
s AS (SELECT *, CAST(sum(tokens) OVER (PARTITION BY question_id ORDER BY rank) AS BIGINT) AS total FROM adds)
SELECT question_id, rank, id, tokens, total, total <= {PACK_BUDGET} AS packed FROM s"""


@query
def route_questions(spark: SparkSession, sf: str) -> DataFrame:
    """User turns, and one stock question per customer order priority and segment, to their tools."""
    turns = table(spark, sf, "conversations").filter("role = 'user'").select(
        F.concat_ws("-", F.lit("turn"), "conv_id", "turn").alias("id"), "text"
    )
    stock = table(spark, sf, "part").select(
        F.concat(F.lit("part-"), F.col("p_partkey")).alias("id"),
        F.when(F.col("p_size") < 20, F.concat(F.lit("Is SKU-"), F.col("p_partkey"), F.lit(" in stock at any store?")))
        .when(F.col("p_size") < 35, F.concat(F.lit("What is the return policy for a "), F.col("p_name"), F.lit("?")))
        .otherwise(F.concat(F.lit("Hello, about the "), F.col("p_name")))
        .alias("text"),
    )
    return rag.route_questions(turns.unionByName(stock)).select("id", "route")


ORACLE["route_questions"] = rf"""
WITH a AS (SELECT concat('turn-', conv_id, '-', turn) AS id, text FROM conversations WHERE role = 'user'
  UNION ALL SELECT concat('part-', p_partkey), CASE WHEN p_size < 20 THEN concat('Is SKU-', p_partkey, ' in stock at any store?')
    WHEN p_size < 35 THEN concat('What is the return policy for a ', p_name, '?')
    ELSE concat('Hello, about the ', p_name) END FROM part),
m AS (SELECT id, text, regexp_matches(text, '{rag.ROUTES[0][1]}') AS s, regexp_matches(text, '{rag.ROUTES[1][1]}') AS w,
  regexp_matches(text, '{rag.ROUTES[2][1]}') AS d FROM a)
SELECT id, 'sku_inventory' AS route FROM m WHERE s UNION ALL SELECT id, 'warehouse_query' FROM m WHERE w
UNION ALL SELECT id, 'document_search' FROM m WHERE d
UNION ALL SELECT id, CASE WHEN regexp_matches(text, '{rag.CHAT_PATTERN}') THEN 'chat' ELSE 'document_search' END
FROM m WHERE NOT s AND NOT w AND NOT d"""
