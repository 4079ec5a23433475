"""Trace, inference-log and drift queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.operators import evaluate, frequent, monitor
from shelfwise.plans.evaluation import sql_overlap
from shelfwise.plans.ingestion import timed_events
from shelfwise.plans.sql import hash_int, tokens
from shelfwise.session import materialize, scratch_dir
from shelfwise.sources import files
from shelfwise.sources.tables import inference_log, table

QUERIES = {}
ORACLE = {}
AS_OF = date(2024, 1, 9)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def span_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One trace per user and day; every event is a span."""
    trace = F.concat_ws("/", "user_id", F.date_format("ts", "yyyy-MM-dd"))
    attributes = F.create_map(
        F.lit("user_id"), F.col("user_id").cast("string"),
        F.lit("tier"), F.when(F.col("user_id") < 20, "premium").otherwise("standard"),
        F.lit("tokens"), F.get_json_object("props", "$.k"),
    )
    return monitor.spans(timed_events(spark, sf), trace, "event_type", "value", F.col("event_type") == "error", attributes)


SQL_SPANS = """
sp AS (SELECT event_id, concat(user_id, '/', strftime(ts, '%Y-%m-%d')) AS trace_id, event_type AS name, value AS latency,
  CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'OK' END AS status,
  CASE WHEN event_type = 'error' THEN 'error failed' END AS error_message,
  CASE WHEN user_id < 20 THEN 'premium' ELSE 'standard' END AS tier, CAST(json_extract(props, '$.k') AS BIGINT) AS tokens FROM events)"""


@query
def trace_spans(spark: SparkSession, sf: str) -> DataFrame:
    return span_rows(spark, sf).select("event_id", "trace_id", "name", "status", "error_message", F.col("attributes")["tier"].alias("tier"))


ORACLE["trace_spans"] = f"WITH {SQL_SPANS} SELECT event_id, trace_id, name, status, error_message, tier FROM sp"


@query
def trace_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.trace_rollup(span_rows(spark, sf)).withColumn("latency", F.col("latency").cast("double"))


ORACLE["trace_rollup"] = f"""
WITH {SQL_SPANS},
x AS (SELECT trace_id, name AS slowest FROM (SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY latency DESC, event_id) AS r FROM sp) WHERE r = 1)
SELECT trace_id, count(*) AS spans, CAST(sum(CAST(latency AS DECIMAL(18,2))) AS DOUBLE) AS latency, count(*) FILTER (status = 'ERROR') AS errors,
  CAST(sum(tokens) AS BIGINT) AS tokens, round(CAST(sum(tokens) AS BIGINT) * {config.PRICE_IN_PER_MILLION}::DOUBLE / 1e6, 9) AS cost_usd, any_value(slowest) AS slowest
FROM sp JOIN x USING (trace_id) GROUP BY 1"""


@query
def trace_filter(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.trace_filter(span_rows(spark, sf), "ERROR", tier="premium").select("trace_id", "event_id", "latency")


ORACLE["trace_filter"] = f"WITH {SQL_SPANS} SELECT trace_id, event_id, latency FROM sp WHERE status = 'ERROR' AND tier = 'premium'"


@query
def trace_sample(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.trace_sample(span_rows(spark, sf), "event_id").select("event_id", "status")


ORACLE["trace_sample"] = f"""
WITH {SQL_SPANS} SELECT event_id, status FROM sp WHERE status = 'ERROR' OR {hash_int('event_id')} % 10 = 0"""


def log(spark: SparkSession, sf: str) -> DataFrame:
    return inference_log(table(spark, sf, "conversations"))


SQL_LOG = """
lg AS (SELECT concat(q.conv_id, '-', q.turn) AS request_id, q.text AS question, a.text AS answer,
    TIMESTAMP '2024-01-01' + CAST(q.conv_id * 7 % 720 AS INTEGER) * INTERVAL 1 HOUR AS asked_at
  FROM conversations q JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
  WHERE q.role = 'user' AND a.role = 'assistant')"""
SQL_YESTERDAY = "asked_at >= TIMESTAMP '2024-01-08' AND asked_at < TIMESTAMP '2024-01-09'"


@query
def logs_yesterday(spark: SparkSession, sf: str) -> DataFrame:
    """A log partitioned by day, read for the day before."""
    path = scratch_dir(spark, "log")
    files.append(log(spark, sf).withColumn("date_utc", F.to_date("timestamp")), path, "date_utc")
    stored = spark.read.parquet(path).filter(F.col("date_utc") == F.date_sub(F.lit(AS_OF), 1))
    return monitor.logs_yesterday(stored, AS_OF, config.LOG_ROW_CAP).select("request_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm").alias("logged_at"))


ORACLE["logs_yesterday"] = f"""
WITH {SQL_LOG} SELECT request_id, strftime(asked_at, '%Y-%m-%d %H:%M') AS logged_at FROM (
  SELECT * FROM lg WHERE {SQL_YESTERDAY} ORDER BY asked_at, request_id LIMIT {config.LOG_ROW_CAP})"""


@query
def parse_payloads(spark: SparkSession, sf: str) -> DataFrame:
    parsed = monitor.parse_payloads(log(spark, sf))
    return parsed.select(F.col("request_metadata.client_request_id").alias("request_id"), "question", "answer")


ORACLE["parse_payloads"] = f"WITH {SQL_LOG} SELECT request_id, question, answer FROM lg"


def parsed_log(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.parse_payloads(log(spark, sf)).select(
        F.col("request_metadata.client_request_id").alias("request_id"), "timestamp", "question", "answer"
    )


@query
def sample_n(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.sample_n(parsed_log(spark, sf), "request_id", 10).select("request_id")


ORACLE["sample_n"] = f"WITH {SQL_LOG} SELECT request_id FROM lg ORDER BY {hash_int('request_id')}, request_id LIMIT 10"


@query
def sample_fraction(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.sample_fraction(parsed_log(spark, sf), "request_id", 0.1).select("request_id")


ORACLE["sample_fraction"] = f"WITH {SQL_LOG} SELECT request_id FROM lg WHERE {hash_int('request_id')} < {int(0.1 * 2**32)}"


@query
def nightly_judge(spark: SparkSession, sf: str) -> DataFrame:
    """Yesterday's log, a sample of it judged; the metric rows replace those of their day, so a rerun adds nothing."""
    rows = monitor.logs_yesterday(log(spark, sf), AS_OF)
    sampled = materialize(
        monitor.sample_fraction(monitor.parse_payloads(rows), "request_id", 0.5).select("request_id", "question", "answer"), "sampled"
    )
    verdicts = evaluate.judge(sampled, "request_id", "answer", {"relevance": "question"}, 0.1)
    means = evaluate.metric_means(verdicts).withColumn("day", F.date_format(F.date_sub(F.lit(AS_OF), 1), "yyyy-MM-dd"))
    path = scratch_dir(spark, "metrics")
    for _ in range(2):
        files.replace_partitions(means, path, "day")
    stored = spark.read.schema(means.schema).parquet(path)
    return stored.select("metric", F.col("n").alias("records_sampled"), "mean", F.col("day").cast("string").alias("day"))


ORACLE["nightly_judge"] = f"""
WITH {SQL_LOG}, answered AS (SELECT request_id, question, answer FROM lg WHERE {SQL_YESTERDAY} AND {hash_int('request_id')} < {int(0.5 * 2**32)}),
{sql_overlap("o", "answer", "question", key="request_id")}
SELECT 'relevance' AS metric, count(*) AS records_sampled, '2024-01-08' AS day,
  round(avg(CASE WHEN sl * sr > 0 AND round(dot / sqrt(sl * sr), 6) >= 0.1 THEN 1.0 ELSE 0.0 END::DOUBLE), 6) AS mean FROM o HAVING count(*) > 0"""


def feedback(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases vote up and errors vote down, on the request their user and payload name."""
    k = F.get_json_object("props", "$.k").cast("int")
    vote = F.when(F.col("event_type") == "purchase", "up").when(F.col("event_type") == "error", "down")
    request = F.concat_ws("-", "user_id", (k % 4 * 2).cast("string"))
    return table(spark, sf, "events").select(request.alias("request_id"), vote.alias("vote")).filter("vote IS NOT NULL")


SQL_FEEDBACK = """
fb AS (SELECT concat(user_id, '-', CAST(json_extract(props, '$.k') AS INTEGER) % 4 * 2) AS request_id, event_type FROM events
  WHERE event_type IN ('purchase', 'error')),
votes AS (SELECT request_id, count(*) FILTER (event_type = 'purchase') AS up, count(*) FILTER (event_type = 'error') AS down FROM fb GROUP BY 1),
voted AS (SELECT lg.*, coalesce(up, 0) AS up, coalesce(down, 0) AS down FROM lg LEFT JOIN votes USING (request_id))"""


@query
def feedback_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = monitor.feedback_join(parsed_log(spark, sf), feedback(spark, sf))
    return joined.select("request_id", "up", "down", "down_rate")


ORACLE["feedback_join"] = f"""
WITH {SQL_LOG}, {SQL_FEEDBACK}
SELECT request_id, up, down, CASE WHEN up + down > 0 THEN round(down / (up + down)::DOUBLE, 6) END AS down_rate FROM voted"""


@query
def failing_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations at least half of whose votes are down."""
    log = parsed_log(spark, sf).withColumn("conversation", F.substring_index("request_id", "-", 1))
    return monitor.failing_conversations(log, feedback(spark, sf), "conversation")


ORACLE["failing_conversations"] = f"""
WITH {SQL_LOG}, {SQL_FEEDBACK},
c AS (SELECT split_part(request_id, '-', 1) AS conversation, count(*) AS requests, CAST(sum(up) AS BIGINT) AS up, CAST(sum(down) AS BIGINT) AS down
  FROM voted GROUP BY 1 HAVING sum(up + down) > 0)
SELECT *, round(down / (up + down)::DOUBLE, 6) AS down_rate, round(down / (up + down)::DOUBLE, 6) >= 0.5 AS failing FROM c"""


@query
def golden_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Questions voted down at least as often as up, unless the golden set has them."""
    voted = monitor.feedback_join(parsed_log(spark, sf), feedback(spark, sf))
    return monitor.golden_candidates(voted.filter("down > 0 AND down >= up"), table(spark, sf, "benchmark"), "question", "text")


ORACLE["golden_candidates"] = f"""
WITH {SQL_LOG}, {SQL_FEEDBACK}
SELECT md5(question) AS content_hash, min(request_id) AS request_id, count(*) AS times FROM voted
WHERE down > 0 AND down >= up AND md5(question) NOT IN (SELECT md5(text) FROM benchmark) GROUP BY 1"""


def daily_questions(spark: SparkSession, sf: str) -> DataFrame:
    return parsed_log(spark, sf).select(F.date_format("timestamp", "yyyy-MM-dd").alias("day"), "question")


@query
def top_topics(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.topics(daily_questions(spark, sf), "day", "question")


ORACLE["top_topics"] = f"""
WITH {SQL_LOG},
w AS (SELECT strftime(asked_at, '%Y-%m-%d') AS day, unnest({tokens("question")}) AS topic FROM lg),
c AS (SELECT day, topic, count(*) AS n FROM w WHERE topic NOT IN ({", ".join(f"'{s}'" for s in monitor.STOP_WORDS)}) GROUP BY 1, 2)
SELECT day, topic, n, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY n DESC, topic) AS r FROM c) WHERE r <= 10"""


FIRST_DAY, LAST_DAY = "2024-01-05", "2024-01-22"


@query
def topics_of_range(spark: SparkSession, sf: str) -> DataFrame:
    """The ten most common words of some weeks, from summaries stored per day."""
    asked = daily_questions(spark, sf)
    words = materialize(monitor.topic_words(asked, "day", "question"), "words")
    path = scratch_dir(spark, "summaries")
    frequent.store_days(words, "day", "topic", path)
    stored = spark.read.schema("words array<string>, counts array<bigint>, error bigint, total bigint, day string").parquet(path)
    return frequent.most_frequent(words, stored, "day", "topic", FIRST_DAY, LAST_DAY).withColumnRenamed("word", "topic")


ORACLE["topics_of_range"] = f"""
WITH {SQL_LOG},
w AS (SELECT strftime(asked_at, '%Y-%m-%d') AS day, unnest({tokens("question")}) AS topic FROM lg),
c AS (SELECT topic, count(*) AS n FROM w WHERE topic NOT IN ({", ".join(f"'{s}'" for s in monitor.STOP_WORDS)})
  AND day BETWEEN '{FIRST_DAY}' AND '{LAST_DAY}' GROUP BY 1)
SELECT topic, n, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (ORDER BY n DESC, topic) AS r FROM c) WHERE r <= 10"""


@query
def quality_trend(spark: SparkSession, sf: str) -> DataFrame:
    trend = monitor.quality_trend(timed_events(spark, sf), "event_type", "ts", "value")
    return trend.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


ORACLE["quality_trend"] = """
WITH d AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, sum(CAST(value AS DECIMAL(18,2))) AS total FROM events GROUP BY 1, 2),
m AS (SELECT *, CAST(total AS DOUBLE) / n AS mean FROM d),
w AS (SELECT *, mean - lag(mean) OVER (PARTITION BY event_type ORDER BY day) AS change,
  CAST(sum(total) OVER k AS DOUBLE) / sum(n) OVER k AS rolling FROM m
  WINDOW k AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT event_type, day, n, round(mean, 6) AS mean, round(change, 6) AS change, round(rolling, 6) AS rolling,
  abs(mean - rolling) > 0.05::DOUBLE * rolling AS drifted FROM w"""


@query
def question_drift(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.question_drift(daily_questions(spark, sf), table(spark, sf, "documents"), "day", "question", "text")


ORACLE["question_drift"] = f"""
WITH {SQL_LOG},
w AS (SELECT strftime(asked_at, '%Y-%m-%d') AS day, unnest({tokens("question")}) AS term FROM lg),
v AS (SELECT DISTINCT unnest({tokens("text")}) AS term FROM documents)
SELECT day, count(*) AS words, count(*) FILTER (v.term IS NULL) AS new_words,
  round(count(*) FILTER (v.term IS NULL) / count(*)::DOUBLE, 6) AS new_share FROM w LEFT JOIN v USING (term) GROUP BY 1"""


@query
def user_retention(spark: SparkSession, sf: str) -> DataFrame:
    kept = monitor.retention(timed_events(spark, sf), "user_id", "ts")
    return kept.withColumn("cohort", F.date_format("cohort", "yyyy-MM-dd"))


ORACLE["user_retention"] = """
WITH a AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
f AS (SELECT user_id, min(day) AS cohort FROM a GROUP BY 1),
b AS (SELECT DISTINCT user_id FROM a JOIN f USING (user_id) WHERE day > cohort AND day <= cohort + 30)
SELECT strftime(cohort, '%Y-%m-%d') AS cohort, count(*) AS users, count(b.user_id) AS returned,
  round(count(b.user_id) / count(*)::DOUBLE, 6) AS retention FROM f LEFT JOIN b USING (user_id) GROUP BY 1"""


@query
def active_users(spark: SparkSession, sf: str) -> DataFrame:
    events = timed_events(spark, sf)
    return events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count_distinct("user_id").alias("users"))


ORACLE["active_users"] = "SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT user_id) AS users FROM events GROUP BY 1"
