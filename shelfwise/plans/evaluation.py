"""Evaluation queries over answers, rankings, judges and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.operators import evaluate, rag, search
from shelfwise.plans.answers import SQL_ANSWER, SQL_TOP3, chunk_corpus
from shelfwise.plans.documents import sql_text
from shelfwise.plans.retrieval import questions, sql_knn, vectors
from shelfwise.plans.sql import hash_int, tokens
from shelfwise.session import materialize, spread_out
from shelfwise.sources.tables import table

QUERIES = {}
ORACLE = {}
JUDGE_THRESHOLD = 0.5


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def answered(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark item as golden row: truth is the item, prediction the extractive answer."""
    asked = questions(spark, sf)
    hits, _ = rag.answer_context(asked, chunk_corpus(spark, sf))
    hits = materialize(hits, "hits")
    contexts = search.format_context(hits)
    rows = (
        asked.select(F.col("id").alias("question_id"), F.col("text").alias("truth"))
        .join(rag.extractive_answers(asked, hits).select("question_id", F.col("answer").alias("prediction")), "question_id")
        .join(contexts.select("question_id", "context"), "question_id", "left")
        .join(hits.filter("rank = 1").select("question_id", F.col("text").alias("top_hit")), "question_id", "left")
    )
    return materialize(rows, "answered")


SQL_ANSWERED = f"""{SQL_TOP3}, {SQL_ANSWER},
answered AS (SELECT item_id AS question_id, b.text AS truth, coalesce(answer, '{config.NO_CONTEXT_ANSWER}') AS prediction,
    context, h.text AS top_hit
  FROM benchmark b LEFT JOIN answers a ON a.question_id = item_id LEFT JOIN ctx ON ctx.question_id = item_id
  LEFT JOIN hits h ON h.question_id = item_id AND h.rank = 1)"""


def sql_overlap(name: str, left: str, right: str, source: str = "answered", key: str = "question_id", n: int = 1) -> str:
    """CTE {name}: n-gram overlap counts per row."""

    def grams(column: str) -> str:
        if n == 1:
            return tokens(column)
        phrase = " || ' ' || ".join(f"t[i + {j}]" for j in range(n))
        return f"[{phrase} FOR i IN range(1, greatest(len(t) - {n - 2}, 1))]"

    def rows(column: str, l: int) -> str:
        inner = f"(SELECT {key}, {tokens(column)} AS t FROM {source})"
        unnested = "unnest(t)" if n == 1 else f"unnest({grams(column)})"
        return f"SELECT {key}, {unnested} AS g, {l} AS l, {1 - l} AS r FROM {inner}"

    return f"""
{name}_g AS (SELECT {key}, g, sum(l) AS l, sum(r) AS r FROM ({rows(left, 1)} UNION ALL {rows(right, 0)}) GROUP BY 1, 2),
{name} AS (SELECT s.{key}, coalesce(sum(l), 0)::DOUBLE AS nl, coalesce(sum(r), 0)::DOUBLE AS nr, coalesce(sum(least(l, r)), 0)::DOUBLE AS sh,
    coalesce(sum(l * r), 0)::DOUBLE AS dot, coalesce(sum(l * l), 0)::DOUBLE AS sl, coalesce(sum(r * r), 0)::DOUBLE AS sr
  FROM {source} s LEFT JOIN {name}_g g ON g.{key} = s.{key} GROUP BY 1)"""


SQL_PRF = """
round(CASE WHEN nl > 0 THEN sh / nl ELSE 0 END, 6) AS "precision", round(CASE WHEN nr > 0 THEN sh / nr ELSE 0 END, 6) AS recall,
round(CASE WHEN sh > 0 THEN 2 * (sh / nl) * (sh / nr) / (sh / nl + sh / nr) ELSE 0 END, 6) AS f1"""


@query
def eval_exact_match(spark: SparkSession, sf: str) -> DataFrame:
    """Share of the predictions, and of the best hits, that equal the truth."""
    rows = answered(spark, sf)
    by_answer = evaluate.exact_match(rows, "prediction", "truth").withColumn("judged", F.lit("prediction"))
    return by_answer.unionByName(evaluate.exact_match(rows, "top_hit", "truth").withColumn("judged", F.lit("top_hit")))


ORACLE["eval_exact_match"] = f"""
WITH RECURSIVE {SQL_ANSWERED}
SELECT 'prediction' AS judged, count(*) AS n, round(count(*) FILTER (prediction = truth) / count(*)::DOUBLE, 6) AS exact_match FROM answered
UNION ALL SELECT 'top_hit', count(*), round(count(*) FILTER (top_hit = truth) / count(*)::DOUBLE, 6) FROM answered"""


@query
def eval_token_f1(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.f1(answered(spark, sf), "question_id", "prediction", "truth")


ORACLE["eval_token_f1"] = f"""
WITH RECURSIVE {SQL_ANSWERED}, {sql_overlap("o", "prediction", "truth")} SELECT question_id, {SQL_PRF} FROM o"""


@query
def eval_rouge_n(spark: SparkSession, sf: str) -> DataFrame:
    rows = answered(spark, sf)
    one = evaluate.f1(rows, "question_id", "prediction", "truth", 1).withColumn("n", F.lit(1))
    return one.unionByName(evaluate.f1(rows, "question_id", "prediction", "truth", 2).withColumn("n", F.lit(2)))


ORACLE["eval_rouge_n"] = f"""
WITH RECURSIVE {SQL_ANSWERED}, {sql_overlap("o", "prediction", "truth")}, {sql_overlap("p", "prediction", "truth", n=2)}
SELECT question_id, 1 AS n, {SQL_PRF} FROM o UNION ALL SELECT question_id, 2, {SQL_PRF} FROM p"""


@query
def eval_readability(spark: SparkSession, sf: str) -> DataFrame:
    english = spread_out(table(spark, sf, "documents").filter("lang = 'en'").select("doc_id", "text"))
    return english.select("doc_id", evaluate.readability(F.col("text")).alias("grade"))


ORACLE["eval_readability"] = rf"""
WITH w AS (SELECT doc_id, {tokens("text")} AS t, greatest(len(regexp_extract_all(text, '[.!?]+')), 1) AS s FROM documents WHERE lang = 'en'),
c AS (SELECT doc_id, len(t) AS w, s, (SELECT sum(greatest(len(regexp_extract_all(u.x, '[aeiouy]+')), 1)) FROM (SELECT unnest(t) AS x) u)::DOUBLE AS y FROM w)
SELECT doc_id, CASE WHEN w > 0 THEN round(0.39::DOUBLE * w / s + 11.8::DOUBLE * y / w - 15.59::DOUBLE, 6) END AS grade FROM c"""


@query
def eval_judge(spark: SparkSession, sf: str) -> DataFrame:
    """Correctness against the truth and relevance to the context, judged per row, then averaged."""
    rows = answered(spark, sf)
    verdicts = evaluate.judge(rows, "question_id", "prediction", {"correctness": "truth", "relevance": "context"}, JUDGE_THRESHOLD)
    return evaluate.metric_means(verdicts)


SQL_JUDGED = f"""
{sql_overlap("a", "prediction", "truth")}, {sql_overlap("b", "prediction", "context")},
judged AS (SELECT question_id, 'correctness' AS metric, CASE WHEN sl * sr > 0 AND round(dot / sqrt(sl * sr), 6) >= {JUDGE_THRESHOLD} THEN 1.0 ELSE 0.0 END::DOUBLE AS value FROM a
  UNION ALL SELECT question_id, 'relevance', CASE WHEN sl * sr > 0 AND round(dot / sqrt(sl * sr), 6) >= {JUDGE_THRESHOLD} THEN 1.0 ELSE 0.0 END FROM b),
means AS (SELECT metric, count(value) AS n, round(avg(value), 6) AS mean FROM judged GROUP BY 1)"""
ORACLE["eval_judge"] = f"WITH RECURSIVE {SQL_ANSWERED}, {SQL_JUDGED} SELECT metric, n, mean FROM means"


@query
def judge_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Judge prompt per row, and the score of replies in several spellings."""
    rows = answered(spark, sf)
    reply = F.when(F.length("prediction") > 80, " yes, identical").when(F.length("prediction") > 40, "NO").otherwise("cannot say")
    return rows.select(
        "question_id",
        evaluate.judge_prompt(F.col("truth"), F.col("prediction")).alias("prompt"),
        evaluate.judge_score(reply).alias("score"),
    )


def sql_judge_prompt() -> str:
    head, rest = config.JUDGE_TEMPLATE.split("{ground_truth}")
    mid, tail = rest.split("{prediction}")
    return f"concat({sql_text(head)}, truth, {sql_text(mid)}, prediction, {sql_text(tail)})"


ORACLE["judge_prompts"] = f"""
WITH RECURSIVE {SQL_ANSWERED}
SELECT question_id, {sql_judge_prompt()} AS prompt,
  CAST(CASE WHEN length(prediction) > 80 THEN 1 WHEN length(prediction) > 40 THEN 0 END AS DOUBLE) AS score FROM answered"""


@query
def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    rows = answered(spark, sf)
    verdicts = evaluate.judge(rows, "question_id", "prediction", {"correctness": "truth", "relevance": "context"}, JUDGE_THRESHOLD)
    return evaluate.quality_gate(evaluate.metric_means(verdicts))


ORACLE["quality_gate"] = f"""
WITH RECURSIVE {SQL_ANSWERED}, {SQL_JUDGED}
SELECT metric, n, mean, {config.GATE_THRESHOLD}::DOUBLE AS threshold, mean >= {config.GATE_THRESHOLD} AS passed FROM means"""


@query
def retrieval_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector as question; rows of the same label are relevant."""
    rows = vectors(spark, sf)
    labels = rows.select("id", "label")
    hits = search.knn(rows, rows, config.TOP_K, skip_same=True)
    ranked = (
        hits.join(labels, "id")
        .join(labels.select(F.col("id").alias("question_id"), F.col("label").alias("wanted")), "question_id")
        .select("question_id", "rank", (F.col("label") == F.col("wanted")).alias("is_relevant"))
    )
    per_label = labels.groupBy("label").agg((F.count(F.lit(1)) - 1).alias("n_relevant"))
    relevant = labels.join(per_label, "label").select(F.col("id").alias("question_id"), "n_relevant")
    return evaluate.retrieval_metrics(ranked, relevant, config.TOP_K)


ORACLE["retrieval_metrics"] = f"""
WITH k AS ({sql_knn(config.TOP_K)}),
j AS (SELECT k.*, a.label = b.label AS rel FROM k JOIN embeddings a ON a.vec_id = k.question_id JOIN embeddings b ON b.vec_id = k.id),
n AS (SELECT vec_id AS question_id, count(*) OVER (PARTITION BY label) - 1 AS n_rel FROM embeddings),
g AS (SELECT question_id, min(CASE WHEN rel THEN rank END) AS first, count(*) FILTER (rel) AS found,
  sum(CASE WHEN rel THEN 1 / log2(rank + 1) ELSE 0 END) AS dcg FROM j GROUP BY 1)
SELECT question_id, round(coalesce(1.0::DOUBLE / first, 0), 6) AS reciprocal_rank,
  round(CASE WHEN n_rel > 0 THEN found / n_rel::DOUBLE ELSE 0 END, 6) AS recall, round(found / {config.TOP_K}::DOUBLE, 6) AS "precision",
  round(CASE WHEN n_rel > 0 THEN dcg / (SELECT sum(1 / log2(i + 1)) FROM range(1, least(n_rel, {config.TOP_K}) + 1) t(i)) ELSE 0 END, 6) AS ndcg
FROM g JOIN n USING (question_id)"""


@query
def faithfulness(spark: SparkSession, sf: str) -> DataFrame:
    """Is the answer in the context, did retrieval find the item's words, and which part failed."""
    rows = answered(spark, sf).withColumns(
        {
            "retrieval_ok": F.coalesce(evaluate.containment(F.col("truth"), F.col("context")) >= 0.5, F.lit(False)),
            "answer_ok": F.coalesce(evaluate.containment(F.col("prediction"), F.col("truth")) >= 0.5, F.lit(False)),
            "faithful": F.coalesce(evaluate.containment(F.col("prediction"), F.col("context")) >= 0.99, F.lit(False)),
        }
    )
    blamed = evaluate.blame(rows, "retrieval_ok", "answer_ok")
    return blamed.unionByName(rows.groupBy(F.when(F.col("faithful"), "faithful").otherwise("unfaithful").alias("failed_part")).agg(F.count(F.lit(1)).alias("n")))


def sql_containment(answer: str, context: str) -> str:
    def grams(expr: str) -> str:
        return f"list_distinct([t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] FOR i IN range(1, greatest(len(t) - 1, 1))])", expr

    def listed(expr: str) -> str:
        body, source = grams(expr)
        return f"(SELECT {body} FROM (SELECT {tokens(source)} AS t))"

    return f"(len(list_intersect({listed(answer)}, {listed(context)})) / nullif(len({listed(answer)}), 0)::DOUBLE)"


ORACLE["faithfulness"] = f"""
WITH RECURSIVE {SQL_ANSWERED},
f AS (SELECT coalesce(round({sql_containment("truth", "context")}, 6) >= 0.5, false) AS r, coalesce(round({sql_containment("prediction", "truth")}, 6) >= 0.5, false) AS a,
  coalesce(round({sql_containment("prediction", "context")}, 6) >= 0.99, false) AS ok FROM answered)
SELECT CASE WHEN r AND a THEN 'none' WHEN r THEN 'generator' WHEN a THEN 'retriever' ELSE 'both' END AS failed_part, count(*) AS n FROM f GROUP BY 1
UNION ALL SELECT CASE WHEN ok THEN 'faithful' ELSE 'unfaithful' END, count(*) FROM f GROUP BY 1"""


@query
def judge_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """A stand-in quality judge (long enough, no shouting symbols) against the human labels."""
    good = (F.length("text") >= 200) & ~F.col("text").rlike(r"[#$%&*!]{3}|!!")
    scored = table(spark, sf, "documents").select("doc_id", good.cast("int").alias("judge"))
    return evaluate.agreement(scored.join(table(spark, sf, "labels"), "doc_id"), "judge", "quality")


ORACLE["judge_agreement"] = r"""
WITH s AS (SELECT CASE WHEN length(text) >= 200 AND NOT regexp_matches(text, '[#$%&*!]{3}|!!') THEN 1 ELSE 0 END AS j, quality AS h
  FROM documents JOIN labels USING (doc_id)),
c AS (SELECT count(*) AS n, count(*) FILTER (j = 1 AND h = 1) AS yy, count(*) FILTER (j = 0 AND h = 0) AS nn,
  CAST(sum(j) AS BIGINT) AS jy, CAST(sum(h) AS BIGINT) AS hy, round(corr(j, h), 6) AS correlation FROM s),
e AS (SELECT *, (yy + nn) / n::DOUBLE AS po, (jy * hy + (n - jy) * (n - hy)) / (n * n)::DOUBLE AS pe FROM c)
SELECT n, yy AS both_yes, nn AS both_no, jy AS judge_yes, hy AS human_yes, correlation, round(po, 6) AS agreement,
  CASE WHEN pe < 1 THEN round((po - pe) / (1 - pe), 6) END AS kappa FROM e"""


@query
def eval_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """The smoke tier (10) and the full tier (1000) of the golden set."""
    golden = table(spark, sf, "documents").select("doc_id")
    smoke = evaluate.tier(golden, "doc_id", 10).withColumn("tier", F.lit("smoke"))
    return smoke.unionByName(evaluate.tier(golden, "doc_id", 1000).withColumn("tier", F.lit("full")))


SQL_TIER = f"SELECT doc_id, '{{}}' AS tier FROM documents ORDER BY {hash_int('doc_id')}, doc_id LIMIT {{}}"
ORACLE["eval_tiers"] = f"SELECT * FROM ({SQL_TIER.format('smoke', 10)}) UNION ALL SELECT * FROM ({SQL_TIER.format('full', 1000)})"


@query
def eval_compare_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Run one answers with a sentence, run two with the whole top hit."""
    rows = answered(spark, sf)
    one = evaluate.f1(rows, "question_id", "prediction", "truth")
    two = evaluate.f1(rows, "question_id", "top_hit", "truth")
    return evaluate.compare_runs(one, two, "question_id", "f1")


ORACLE["eval_compare_runs"] = f"""
WITH RECURSIVE {SQL_ANSWERED}, {sql_overlap("o", "prediction", "truth")}, {sql_overlap("p", "top_hit", "truth")},
a AS (SELECT question_id, {SQL_PRF} FROM o), b AS (SELECT question_id, {SQL_PRF} FROM p),
d AS (SELECT b.f1 - a.f1 AS d FROM a JOIN b USING (question_id))
SELECT CASE WHEN d > 0 THEN 'win' WHEN d < 0 THEN 'loss' ELSE 'tie' END AS outcome, count(*) AS n, round(avg(d), 6) AS mean_delta FROM d GROUP BY 1"""
