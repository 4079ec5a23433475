"""Embedding, vector and keyword search queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.operators import chunk, infer, postings, search, similar, vector_index
from shelfwise.plans.sql import CHUNKS_CTE, chunk_ctes, tokens
from shelfwise.session import materialize, scratch_dir, spread_out
from shelfwise.sources.files import append
from shelfwise.sources.tables import silver_documents, table

QUERIES = {}
ORACLE = {}
DIM = config.EMBEDDING_DIM


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    kept, _ = infer.dimension_guard(spread_out(rows), "vector", DIM)
    return kept


def questions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return spread_out(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"))


# ---------------------------------------------------------------- embedding

SQL_EMBED = rf"""
slots AS (SELECT src, id, CAST(concat('0x', substr(h, 1, 8)) AS BIGINT) % {DIM} AS dim,
    CASE WHEN strpos('13579bdf', substr(h, 9, 1)) > 0 THEN -1 ELSE 1 END AS sign
  FROM (SELECT src, id, md5(unnest({tokens("text")})) AS h FROM embed_input)),
sums AS (SELECT src, id, dim, CAST(sum(sign) AS DOUBLE) AS v FROM slots GROUP BY 1, 2, 3),
norms AS (SELECT src, id, sqrt(sum(v * v)) AS n FROM sums GROUP BY 1, 2 HAVING sum(v * v) > 0),
emb AS (SELECT src, id, dim, CAST(v / n AS FLOAT) AS x FROM sums JOIN norms USING (src, id) WHERE v <> 0)
"""


@query
def batch_embed(spark: SparkSession, sf: str) -> DataFrame:
    docs = infer.embed(spread_out(table(spark, sf, "documents").select("doc_id", "text")), "text", "doc_id")
    return (
        docs.select("doc_id", F.posexplode("embedding_vector").alias("dim", "x"))
        .filter("x != 0")
        .select("doc_id", F.col("dim").cast("bigint").alias("dim"), F.round(F.col("x").cast("double"), 5).alias("x"))
    )


ORACLE["batch_embed"] = f"""
WITH embed_input AS (SELECT 'd' AS src, doc_id AS id, text FROM documents), {SQL_EMBED}
SELECT id AS doc_id, dim, round(CAST(x AS DOUBLE), 5) AS x FROM emb"""


@query
def embedding_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A second model version (the first half of each vector) beside the first."""
    rows = table(spark, sf, "embeddings")
    half = rows.select("vec_id", F.slice("embedding", 1, DIM // 2).alias("embedding"))
    store = scratch_dir(spark, "embeddings")
    append(infer.embedding_versions({"v1": rows, "v2": half}, "vec_id", "embedding"), store, "model_version")
    wide = infer.versions_view(spark.read.parquet(store), "vec_id", ["v1", "v2"])
    return wide.select(
        "vec_id",
        F.size("v1").alias("dim_v1"),
        F.size("v2").alias("dim_v2"),
        F.element_at("v1", 1).cast("double").alias("first_v1"),
        F.element_at("v2", -1).cast("double").alias("last_v2"),
    )


ORACLE["embedding_versions"] = f"""
SELECT vec_id, CAST({DIM} AS INTEGER) AS dim_v1, CAST({DIM // 2} AS INTEGER) AS dim_v2,
  CAST(embedding[1] AS DOUBLE) AS first_v1, CAST(embedding[{DIM // 2}] AS DOUBLE) AS last_v2 FROM embeddings"""


@query
def dimension_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Labels 0 to 4 arrive damaged: short, with NaN, all zero, missing or with an infinity."""
    bad = (
        F.when(F.col("label") == 0, F.slice("embedding", 1, 10))
        .when(F.col("label") == 2, F.transform("embedding", lambda x: x * F.lit(0).cast("float")))
        .when(F.col("label") == 3, F.lit(None).cast("array<float>"))
        .otherwise(F.col("embedding"))
    )
    nan = F.array_repeat(F.lit("NaN").cast("float"), DIM)
    endless = F.array_append(F.slice("embedding", 1, DIM - 1), F.lit("Infinity").cast("float"))
    broken = F.when(F.col("label") == 1, nan).when(F.col("label") == 4, endless).otherwise(bad)
    rows = table(spark, sf, "embeddings").withColumn("embedding", broken)
    kept, rejected = infer.dimension_guard(rows, "embedding", DIM)
    return kept.select("vec_id", F.lit("ok").alias("verdict")).unionByName(
        rejected.select("vec_id", F.col("reject_reason").alias("verdict"))
    )


ORACLE["dimension_guard"] = """
SELECT vec_id, CASE label WHEN 0 THEN 'dimension' WHEN 1 THEN 'not_a_number' WHEN 2 THEN 'zero_norm'
  WHEN 3 THEN 'missing' WHEN 4 THEN 'not_a_number' ELSE 'ok' END AS verdict FROM embeddings"""


@query
def resume_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of sources still to be embedded, after a run that stopped past the English ones."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.md5("text").alias("content_hash"))
    done = docs.filter("lang = 'en'").select("content_hash").distinct()
    return infer.pending(docs, done, ["content_hash"], ["doc_id"]).select("doc_id", "content_hash")


ORACLE["resume_anti_join"] = """
SELECT doc_id, md5(text) AS content_hash FROM documents
WHERE md5(text) NOT IN (SELECT md5(text) FROM documents WHERE lang = 'en')"""


@query
def quantize_vectors(spark: SparkSession, sf: str) -> DataFrame:
    coded = infer.quantize(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return coded.select(
        "vec_id",
        F.aggregate("codes", F.lit(0), lambda a, c: a + c).alias("code_sum"),
        F.col("sign_bits").alias("sign_bits"),
        (F.col("max_error") <= F.col("step") / 2 + 1e-9).alias("within_half_step"),
    )


ORACLE["quantize_vectors"] = """
WITH b AS (SELECT vec_id, embedding AS v, CAST(list_min(embedding) AS DOUBLE) AS lo,
    (CAST(list_max(embedding) AS DOUBLE) - CAST(list_min(embedding) AS DOUBLE)) / 255 AS step FROM embeddings),
x AS (SELECT vec_id, lo, step, CAST(unnest(v) AS DOUBLE) AS e, generate_subscripts(v, 1) AS i FROM b)
SELECT vec_id, CAST(sum(floor((e - lo) / step + 0.5)) AS INTEGER) AS code_sum,
  CAST(sum(CASE WHEN e > 0 THEN CASE WHEN i = 1 THEN -9223372036854775808::HUGEINT ELSE (1::HUGEINT << (64 - i)::INTEGER) END
      ELSE 0 END) AS BIGINT) AS sign_bits,
  max(abs(e - (lo + floor((e - lo) / step + 0.5) * step))) <= any_value(step) / 2 + 1e-9 AS within_half_step
FROM x GROUP BY vec_id"""


def upper_letter(letter: str) -> str:
    """The one upper-case letter of a letter: SQL's `upper` never makes two of one."""
    forms = ("\u1e9e" if letter == "\u00df" else letter.upper(), letter.title(), letter)
    return next(form for form in forms if len(form) == len(letter))


def flaky_model(value: str | None, attempt: int) -> str | None:
    """Test model: fails always for texts of length 0 mod 7, once for 1 mod 7; of no text it makes none."""
    if value is None:
        return None
    fails = {0: 99, 1: 1}.get(len(value) % 7, 0)
    if attempt <= fails:
        raise RuntimeError("endpoint busy")
    return upper_letter(value[:1])


@query
def batch_infer_retry(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread_out(table(spark, sf, "documents").select("doc_id", "text"))
    return infer.infer_with_retry(docs, "text", flaky_model).drop("text")


ORACLE["batch_infer_retry"] = """
SELECT doc_id, CASE WHEN length(text) % 7 = 0 THEN 'ERROR' ELSE 'OK' END AS status,
  CASE WHEN length(text) % 7 <> 0 THEN upper(left(text, 1)) END AS answer,
  CAST(CASE length(text) % 7 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS INTEGER) AS attempts,
  CASE WHEN length(text) % 7 = 0 THEN 'endpoint busy' END AS error FROM documents"""


# ---------------------------------------------------------------- vector search

# Cosine of every question and row; the ranking keeps the best k and breaks ties by id.
SQL_COS = "round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), 6)"


def sql_knn(k: int, where: str = "q.vec_id <> c.vec_id", corpus_where: str = "true") -> str:
    return f"""
SELECT question_id, CAST(rank AS INTEGER) AS rank, id, score FROM (
  SELECT question_id, id, score, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id) AS rank FROM (
    SELECT q.vec_id AS question_id, c.vec_id AS id, {SQL_COS} AS score
    FROM embeddings q JOIN (SELECT * FROM embeddings WHERE {corpus_where}) c ON {where}))
WHERE rank <= {k}"""


@query
def knn_exact(spark: SparkSession, sf: str) -> DataFrame:
    rows = vectors(spark, sf)
    return search.knn(rows, rows, config.TOP_K, skip_same=True)


ORACLE["knn_exact"] = sql_knn(config.TOP_K)


@query
def knn_block_join(spark: SparkSession, sf: str) -> DataFrame:
    """The same search by the block join a question table too large to broadcast takes."""
    rows = vectors(spark, sf)
    return search.knn(rows, rows, config.TOP_K, skip_same=True, question_bytes=0)


ORACLE["knn_block_join"] = sql_knn(config.TOP_K)


@query
def knn_filtered(spark: SparkSession, sf: str) -> DataFrame:
    rows = vectors(spark, sf)
    return search.knn_filtered(rows, rows, {"label": 3}, k=config.TOP_K, skip_same=True)


ORACLE["knn_filtered"] = sql_knn(config.TOP_K, corpus_where="label = 3")


@query
def tenant_isolation(spark: SparkSession, sf: str) -> DataFrame:
    rows = vectors(spark, sf)
    return search.knn_for_tenant(rows, rows, "label", k=config.TOP_K, skip_same=True)


ORACLE["tenant_isolation"] = sql_knn(config.TOP_K, "q.vec_id <> c.vec_id AND q.label = c.label")

# Who is in which group.
MEMBERSHIPS = (
    ("ada", "global_admins"),
    ("bo", "region_fr"),
    ("bo", "region_de"),
    ("cy", "region_es"),
    ("di", "region_it"),
)


def memberships(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MEMBERSHIPS, "user string, group string")


def regional_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with upper-case regions; short ones have none."""
    region = F.when(F.length("extracted_text") >= 100, F.upper("region"))
    return silver_documents(spark, sf).withColumn("region", region)


@query
def row_level_security(spark: SparkSession, sf: str) -> DataFrame:
    rows = regional_documents(spark, sf).select("doc_id", "region")
    return search.rows_for_users(rows, memberships(spark)).select("user", "doc_id")


ORACLE["row_level_security"] = """
WITH d AS (SELECT doc_id, CASE WHEN length(text) >= 100 THEN upper(lang) END AS region FROM documents),
m(u, g) AS (VALUES ('bo', 'region_fr'), ('bo', 'region_de'), ('cy', 'region_es'), ('di', 'region_it'))
SELECT 'ada' AS "user", doc_id FROM d
UNION ALL SELECT u, doc_id FROM d JOIN m ON g = concat('region_', lower(region)) WHERE region IS NOT NULL"""


@query
def policy_violation_report(spark: SparkSession, sf: str) -> DataFrame:
    """Every user is shown every English and French document; what should they not have seen?"""
    rows = regional_documents(spark, sf).select("doc_id", "region")
    users = memberships(spark).select("user").distinct()
    shown = F.when(F.col("region") == "FR", F.array(F.lit("bo"), F.lit("cy"))).otherwise(F.array(F.lit("ada"), F.lit("di")))
    hits = rows.select(F.explode(shown).alias("user"), "doc_id").join(users, "user", "left_semi")
    bad = search.policy_violations(hits, rows, memberships(spark), "doc_id")
    return bad.select("user", "doc_id", "region")


ORACLE["policy_violation_report"] = """
WITH d AS (SELECT doc_id, CASE WHEN length(text) >= 100 THEN upper(lang) END AS region FROM documents)
SELECT 'cy' AS "user", doc_id, region FROM d WHERE region = 'FR'
UNION ALL SELECT 'di', doc_id, region FROM d WHERE region IS NULL OR region <> 'FR'"""


# Recall both approximate searches have to reach on average, and the most pairs they may score by full vectors.
RECALL_FLOOR = 0.9
SCORED_SHARE = 0.15
INDEXES = {"ivf": vector_index.knn_codes, "lsh": vector_index.knn_multiprobe}


@query
def ann_ivf(spark: SparkSession, sf: str) -> DataFrame:
    rows = vectors(spark, sf).select("id", "vector")
    return vector_index.knn_codes(rows, rows, config.TOP_K, skip_same=True)[0]


@query
def ann_lsh(spark: SparkSession, sf: str) -> DataFrame:
    rows = vectors(spark, sf).select("id", "vector")
    return vector_index.knn_multiprobe(rows, rows, config.TOP_K, skip_same=True)[0]


@query
def ann_report(spark: SparkSession, sf: str) -> DataFrame:
    """Recall of both indexes against brute force, the share of pairs scored by full vectors, and what they probed."""
    rows = vectors(spark, sf).select("id", "vector")
    exact = materialize(search.knn(rows, rows, config.TOP_K, skip_same=True), "exact")
    n, out = rows.count(), None
    for name, index in INDEXES.items():
        found, plan, scored = index(rows, rows, config.TOP_K, skip_same=True)
        line = search.recall(exact, found).agg(
            F.lit(name).alias("method"), F.count(F.lit(1)).alias("questions"), F.round(F.avg("recall"), 4).alias("recall"),
            F.lit(round(scored / max(n * n, 1), 4)).alias("scored_share"), F.lit(plan.probes).alias("probes"), F.lit(plan.depth).alias("depth"),
        )
        out = line if out is None else out.unionByName(line)
    return out


@query
def ann_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Do both indexes reach the recall with so few pairs scored? `ann_report` has the figures."""
    report = ann_report(spark, sf)
    reached = (F.col("recall") >= RECALL_FLOOR) & (F.col("scored_share") <= SCORED_SHARE)
    return report.select("method", "questions", reached.alias("reached"))


ORACLE["ann_recall"] = """
SELECT m AS method, count(*) AS questions, true AS reached FROM embeddings, (VALUES ('ivf'), ('lsh')) AS t(m) GROUP BY 1"""


@query
def ann_ivf_all_cells(spark: SparkSession, sf: str) -> DataFrame:
    """With every cell probed the index gives the exact result."""
    rows = vectors(spark, sf)
    cells, _ = search.ivf_size(rows.count())
    return search.knn_ivf(rows, rows, cells, cells, k=config.TOP_K, skip_same=True)


ORACLE["ann_ivf_all_cells"] = sql_knn(config.TOP_K)


@query
def hit_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Hits as text, source and score in rank order; the vector stays behind."""
    rows = vectors(spark, sf)
    hits = search.knn(rows, rows, 3, skip_same=True)
    shown = rows.select("id", F.concat(F.lit("vector "), F.col("id")).alias("t"), F.concat(F.lit("label/"), F.col("label")).alias("s"))
    return search.attach_text(hits, shown, "id", "t", "s", few=search.fits(rows))


ORACLE["hit_projection"] = f"""
SELECT k.question_id, k.rank, concat('vector ', k.id) AS text, concat('label/', e.label) AS source, k.score
FROM ({sql_knn(3)}) k JOIN embeddings e ON e.vec_id = k.id"""


@query
def order_for_context(spark: SparkSession, sf: str) -> DataFrame:
    rows = vectors(spark, sf)
    return search.order_for_context(search.knn(rows, rows, config.TOP_K, skip_same=True)).select("question_id", "rank", "position", "id")


ORACLE["order_for_context"] = f"""
SELECT question_id, rank, id, CAST(CASE rank WHEN 1 THEN 1 WHEN 3 THEN 2 WHEN 5 THEN 3 WHEN 4 THEN 4 ELSE 5 END AS INTEGER) AS position
FROM ({sql_knn(config.TOP_K)})"""

CACHE_THRESHOLD = 0.75


@query
def semantic_cache(spark: SparkSession, sf: str) -> DataFrame:
    """All vectors ask; those of labels 0 to 4 were answered before."""
    rows = vectors(spark, sf).withColumn("content_hash", F.sha2(F.array_join(F.col("vector").cast("array<string>"), ","), 256))
    return similar.semantic_cache(rows, rows.filter("label < 5"), CACHE_THRESHOLD)


ORACLE["semantic_cache"] = f"""
WITH first AS (SELECT embedding, min(vec_id) AS cached_id FROM embeddings WHERE label < 5 GROUP BY 1),
ask AS (SELECT e.vec_id, e.embedding, f.cached_id FROM embeddings e LEFT JOIN first f ON f.embedding = e.embedding),
best AS (SELECT * FROM (
  SELECT q.vec_id AS id, c.vec_id AS cached_id, {SQL_COS} AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY {SQL_COS} DESC, c.vec_id) AS r
  FROM ask q JOIN embeddings c ON c.label < 5 AND q.cached_id IS NULL) WHERE r = 1 AND score >= {CACHE_THRESHOLD})
SELECT vec_id AS id, 'exact' AS outcome, cached_id, 1.0::DOUBLE AS score FROM ask WHERE cached_id IS NOT NULL
UNION ALL
SELECT a.vec_id, CASE WHEN b.cached_id IS NULL THEN 'miss' ELSE 'near' END, b.cached_id, b.score
FROM ask a LEFT JOIN best b ON b.id = a.vec_id WHERE a.cached_id IS NULL"""


# Low enough for pairs of unrelated vectors to be found, so that the check has rows.
PAIR_THRESHOLD = 0.35


@query
def similar_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Every pair of a vector with a label from 5 on and one below with so high a cosine."""
    rows = vectors(spark, sf)
    return similar.similar_pairs(rows.filter("label >= 5"), rows.filter("label < 5"), PAIR_THRESHOLD)


ORACLE["similar_pairs"] = f"""
SELECT * FROM (SELECT q.vec_id AS question_id, c.vec_id AS id, {SQL_COS} AS score
  FROM embeddings q JOIN embeddings c ON q.label >= 5 AND c.label < 5) WHERE score >= {PAIR_THRESHOLD}"""


@query
def similar_pairs_report(spark: SparkSession, sf: str) -> DataFrame:
    """Work of the two joins above: all pairs, pairs bounded, scored in full and found, per threshold."""
    rows = vectors(spark, sf)
    asked, held = rows.filter("label >= 5"), rows.filter("label < 5")
    lines = [similar.similar_work(asked, held, t).withColumn("threshold", F.lit(t)) for t in (PAIR_THRESHOLD, CACHE_THRESHOLD)]
    return lines[0].unionByName(lines[1])

# ---------------------------------------------------------------- keyword and hybrid search


def sql_bm25(source: str, key: str, k: int, prefix: str = "", ties: str | None = None) -> str:
    """CTEs ending in {prefix}top(question_id, rank, {key}, score)."""
    p = prefix
    return rf"""
{p}q AS (SELECT item_id AS question_id, unnest(list_distinct({tokens("text")})) AS term FROM benchmark),
{p}tk AS MATERIALIZED (SELECT {key}, {tokens("text")} AS toks FROM {source}),
{p}dl AS MATERIALIZED (SELECT {key}, len(toks) AS dl FROM {p}tk),
{p}t AS (SELECT {key}, unnest(toks) AS term FROM {p}tk),
{p}st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM {p}dl),
{p}tf AS (SELECT {key}, dl, term, tf FROM (SELECT {key}, term, count(*) AS tf FROM {p}t GROUP BY ALL) JOIN {p}dl USING ({key})),
{p}df AS (SELECT term, count(*) AS df FROM {p}tf GROUP BY 1),
{p}sc AS (SELECT question_id, {key}, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
    / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
  FROM {p}q JOIN {p}tf USING (term) JOIN {p}df USING (term) CROSS JOIN {p}st GROUP BY ALL),
{p}top AS (SELECT * FROM (SELECT question_id, {key}, score,
    CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, {ties or key}) AS INTEGER) AS rank FROM {p}sc)
  WHERE rank <= {k})"""


@query
def bm25_search(spark: SparkSession, sf: str) -> DataFrame:
    return search.bm25(questions(spark, sf), corpus(spark, sf), config.TOP_K)


ORACLE["bm25_search"] = f"""
WITH {sql_bm25("documents", "doc_id", config.TOP_K)} SELECT question_id, rank, doc_id AS id, score FROM top"""


@query
def bm25_join(spark: SparkSession, sf: str) -> DataFrame:
    """The same ranking by the blocks of questions a table too large for one broadcast is cut in."""
    return search.bm25(questions(spark, sf), corpus(spark, sf), config.TOP_K, question_terms=500)


ORACLE["bm25_join"] = ORACLE["bm25_search"]


@query
def bm25_postings(spark: SparkSession, sf: str) -> DataFrame:
    """The same ranking from a stored index, which a second search of the same documents finds written."""
    docs, path = corpus(spark, sf), scratch_dir(spark, "postings")
    postings.write_index(docs, path)
    return postings.search_index(questions(spark, sf), postings.write_index(docs, path), config.TOP_K)[0]


ORACLE["bm25_postings"] = ORACLE["bm25_search"]


@query
def postings_terms(spark: SparkSession, sf: str) -> DataFrame:
    """What the index holds: documents, words and highest weight of every term."""
    index = postings.write_index(corpus(spark, sf), scratch_dir(spark, "postings"))
    return index.tops(index.stored()).groupBy("term").agg(F.sum("n").alias("documents"), F.round(F.max("top"), 6).alias("top"))


ORACLE["postings_terms"] = f"""
WITH tk AS MATERIALIZED (SELECT doc_id, {tokens("text")} AS toks FROM documents),
st AS (SELECT avg(len(toks)) AS avgdl FROM tk),
tf AS (SELECT doc_id, len(toks) AS dl, unnest(toks) AS term FROM tk),
c AS (SELECT doc_id, dl, term, count(*) AS tf FROM tf GROUP BY ALL)
SELECT term, count(*) AS documents, round(max(tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS top FROM c, st GROUP BY 1"""


def text_vectors(df: DataFrame) -> DataFrame:
    embedded = infer.embed(df, "text", "id")
    gold = embedded.filter(infer.points_somewhere("embedding_vector")).select("id", F.col("embedding_vector").alias("vector"))
    return materialize(gold, "vectors")


@query
def hybrid_search(spark: SparkSession, sf: str) -> DataFrame:
    """Keyword and vector rankings of every benchmark item over all documents, fused."""
    asked, docs = questions(spark, sf), corpus(spark, sf)
    return search.hybrid(asked, docs, text_vectors(asked), text_vectors(docs))


ORACLE["hybrid_search"] = f"""
WITH embed_input AS (SELECT 'd' AS src, doc_id AS id, text FROM documents
                     UNION ALL SELECT 'q', item_id, text FROM benchmark), {SQL_EMBED},
{sql_bm25("documents", "doc_id", config.HYBRID_DEPTH)},
unit AS (SELECT src, id, dim, CAST(x AS DOUBLE) AS x FROM emb),
lens AS (SELECT src, id, sqrt(sum(x * x)) AS n FROM unit GROUP BY 1, 2),
pairs AS (SELECT q.id AS question_id, d.id AS id, coalesce(dot.s, 0) / (q.n * d.n) AS c
  FROM lens q JOIN lens d ON q.src = 'q' AND d.src = 'd'
  LEFT JOIN (SELECT a.id AS qi, b.id AS di, sum(a.x * b.x) AS s FROM unit a JOIN unit b
     ON a.dim = b.dim AND a.src = 'q' AND b.src = 'd' GROUP BY 1, 2) dot ON dot.qi = q.id AND dot.di = d.id),
vec AS (SELECT * FROM (SELECT question_id, id, row_number() OVER (PARTITION BY question_id ORDER BY round(c, 6) DESC, id) AS rank
  FROM pairs) WHERE rank <= {config.HYBRID_DEPTH}),
rrf AS (SELECT question_id, id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM (
    SELECT question_id, doc_id AS id, rank FROM top UNION ALL SELECT question_id, id, rank FROM vec) GROUP BY 1, 2)
SELECT question_id, id, score, CAST(r AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id) AS r FROM rrf) WHERE r <= {config.TOP_K}"""

PARENT_SIZE = 2000


def family(spark: SparkSession, sf: str) -> DataFrame:
    return chunk.parent_child(spread_out(silver_documents(spark, sf)), "doc_id", "extracted_text", PARENT_SIZE)


@query
def chunk_parent_child(spark: SparkSession, sf: str) -> DataFrame:
    """Search small chunks, return each enclosing large chunk once."""
    children = materialize(family(spark, sf), "children")
    return search.search_parents(questions(spark, sf), children)


ORACLE["chunk_parent_child"] = f"""
WITH RECURSIVE {CHUNKS_CTE}, {chunk_ctes(PARENT_SIZE, 0, "parents", "p_")},
kids AS (SELECT concat(c.doc_id, '#', c.ordinal) AS id, c.text, concat(c.doc_id, '#', p.ordinal) AS parent_id
  FROM chunks c ASOF JOIN parents p ON c.doc_id = p.doc_id AND c.start >= p.start),
{sql_bm25("kids", "id", config.TOP_K)},
best AS (SELECT question_id, parent_id AS id, max(score) AS score FROM sc JOIN kids USING (id) GROUP BY 1, 2)
SELECT question_id, id, score, CAST(r AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id) AS r FROM best) WHERE r <= {config.TOP_K}"""
