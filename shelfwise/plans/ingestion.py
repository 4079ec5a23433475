"""Sources, sinks, streams and change tracking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.config import TableNames
from shelfwise.operators import changes, chunk, ingest, text
from shelfwise.operators.store import DeadLetters
from shelfwise.plans.build import DocumentBuild
from shelfwise.plans.documents import SQL_PAGE_TEXT, document_chunks
from shelfwise.plans.sql import CHUNKS_CTE, tokens
from shelfwise.session import materialize, scratch_dir
from shelfwise.sources import files
from shelfwise.sources.tables import silver_documents, table
from shelfwise.sources.versions import VersionedTable
from shelfwise.streaming import ingest as stream
from shelfwise.streaming import monitor as live
from shelfwise.streaming.build import LiveIndex
from shelfwise.streaming.evolve import EvolvingFeed

QUERIES = {}
ORACLE = {}
AS_OF = "2024-03-01 02:00:00"
PAGE = "page_id bigint, url string, html string"
EVENT = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def timed_events(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def two_drops(spark: SparkSession, df: DataFrame, first: Column, run) -> tuple[str, str]:
    """Land the rows in two drops and call run(landing, checkpoint) after each, and once more."""
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "checkpoint")
    files.land_json(df.filter(first), landing)
    run(landing, checkpoint)
    files.land_json(df.filter(~first), landing)
    run(landing, checkpoint)
    run(landing, checkpoint)
    return landing, checkpoint


def pages_bronze_stream(spark: SparkSession, sf: str) -> str:
    """Bronze table of landed page files, filled by three runs over two drops."""
    bronze = scratch_dir(spark, "bronze")

    def run(landing: str, checkpoint: str) -> None:
        stream.ingest_files(spark, landing, bronze, checkpoint, as_of=F.lit(AS_OF).cast("timestamp"))

    two_drops(spark, table(spark, sf, "pages"), F.col("url").startswith("https"), run)
    return bronze


@query
def ingest_files_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Landed files reach bronze exactly once, whatever the number of runs."""
    bronze = spark.read.parquet(pages_bronze_stream(spark, sf))
    kept = files.file_lines(bronze, PAGE)
    return kept.select("page_id", "url", F.md5("html").alias("html_md5"))


ORACLE["ingest_files_stream"] = "SELECT page_id, url, md5(html) AS html_md5 FROM pages"


@query
def table_stream_source(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze as the input stream of silver: extraction, errors dropped, payload gone."""
    bronze = pages_bronze_stream(spark, sf)
    silver, checkpoint = scratch_dir(spark, "silver"), scratch_dir(spark, "checkpoint")

    def step(rows: DataFrame) -> DataFrame:
        pages = files.file_lines(rows, PAGE).select("page_id", F.col("html").cast("binary").alias("content"))
        return text.drop_extraction_errors(text.extract_html(pages))

    stream.refine(spark, bronze, silver, checkpoint, step)
    stream.refine(spark, bronze, silver, checkpoint, step)
    return spark.read.parquet(silver)


ORACLE["table_stream_source"] = (
    "WITH " + SQL_PAGE_TEXT.replace("CASE WHEN length(html) < 1500 THEN '<html><body><img src=''scan.png''></body></html>'\n                 ELSE html END", "html")
    + " SELECT page_id, extracted_text FROM page_text WHERE NOT starts_with(extracted_text, '<ERROR')"
)


@query
def ingest_glob_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Pages land as JSON beside documents as text; the glob only lets the pages in."""
    landing = scratch_dir(spark, "landing")
    files.land_json(table(spark, sf, "pages"), landing)
    table(spark, sf, "documents").select(F.to_json(F.struct("doc_id", "text"))).write.mode("append").text(landing)
    return files.file_lines(files.read_binary(spark, landing, "*.json"), PAGE).select("page_id", "url")


ORACLE["ingest_glob_filter"] = "SELECT page_id, url FROM pages"


@query
def bronze_audit_columns(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    audited = ingest.with_audit(docs, F.lit(AS_OF).cast("timestamp"))
    return audited.withColumn("ingestion_timestamp", F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss"))


ORACLE["bronze_audit_columns"] = f"""
SELECT doc_id, n_chars, '{AS_OF}' AS ingestion_timestamp, '{config.SOURCE_SYSTEM}' AS source_system FROM documents"""


@query
def append_available_now(spark: SparkSession, sf: str) -> DataFrame:
    target = scratch_dir(spark, "events")

    def run(landing: str, checkpoint: str) -> None:
        stream.drain(stream.good_rows(stream.json_rows(spark, landing, EVENT)), target, checkpoint)

    two_drops(spark, timed_events(spark, sf), F.col("event_type") == "view", run)
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", "value")


ORACLE["append_available_now"] = "SELECT event_id, user_id, event_type, value FROM events"


@query
def batch_table_scan(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.concat(F.lit("doc/"), F.col("doc_id")).alias("path"), "source", "n_chars")


ORACLE["batch_table_scan"] = "SELECT concat('doc/', doc_id) AS path, source, n_chars FROM documents"


@query
def overwrite_table(spark: SparkSession, sf: str) -> DataFrame:
    """A full refresh leaves nothing of the version before it."""
    target = scratch_dir(spark, "chunks")
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    files.overwrite(docs.withColumn("version", F.lit(1)), target, "lang")
    files.overwrite(docs.filter("lang != 'es'").withColumn("version", F.lit(2)), target, "lang")
    return spark.read.parquet(target).select("doc_id", "lang", "source", "version")


ORACLE["overwrite_table"] = "SELECT doc_id, lang, source, CAST(2 AS INTEGER) AS version FROM documents WHERE lang <> 'es'"


@query
def seed_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Seed the store table twice; the second load finds nothing to add."""
    target = scratch_dir(spark, "store_inventory")
    stores = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"), F.floor("s_acctbal").alias("in_stock")
    )
    files.append(stores.filter("in_stock >= 0"), target)
    for _ in range(2):
        files.append(changes.missing_rows(stores, spark.read.parquet(target), "store_id"), target)
    return spark.read.parquet(target)


ORACLE["seed_tables"] = """
SELECT s_suppkey AS store_id, s_name AS store_name, CAST(floor(s_acctbal) AS BIGINT) AS in_stock FROM supplier"""


def versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Documents before the Spanish feed came, and after source 7 left and French was extracted again."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    before = docs.filter("lang != 'es'")
    again = F.when(F.col("lang") == "fr", F.trim(F.regexp_replace("text", r"[ \t\n]+", " "))).otherwise(F.col("text"))
    return before, docs.filter("source != 'src7'").withColumn("text", again)


SQL_VERSIONS = r"""
v1 AS (SELECT doc_id, lang, source, text FROM documents WHERE lang <> 'es'),
v2 AS (SELECT doc_id, lang, source, CASE WHEN lang = 'fr' THEN trim(regexp_replace(text, '[ \t\n]+', ' ', 'g')) ELSE text END AS text
  FROM documents WHERE source <> 'src7')"""


@query
def change_feed(spark: SparkSession, sf: str) -> DataFrame:
    feed = changes.change_feed(*versions(spark, sf), "doc_id")
    return feed.select("doc_id", "change_type", "source", F.md5("text").alias("text_md5"))


ORACLE["change_feed"] = f"""
WITH {SQL_VERSIONS}
SELECT v2.doc_id, 'insert' AS change_type, v2.source, md5(v2.text) AS text_md5 FROM v2 ANTI JOIN v1 USING (doc_id)
UNION ALL SELECT v1.doc_id, 'delete', v1.source, md5(v1.text) FROM v1 ANTI JOIN v2 USING (doc_id)
UNION ALL SELECT v1.doc_id, 'update_pre', v1.source, md5(v1.text) FROM v1 JOIN v2 USING (doc_id) WHERE v1.text <> v2.text
UNION ALL SELECT v2.doc_id, 'update_post', v2.source, md5(v2.text) FROM v1 JOIN v2 USING (doc_id) WHERE v1.text <> v2.text"""


def versioned(spark: SparkSession, sf: str) -> VersionedTable:
    """Both versions as one table: the second one as an upsert that leaves the English and German files alone but for deletes."""
    before, after = versions(spark, sf)
    held = VersionedTable(spark, scratch_dir(spark, "versions"), "lang")
    held.overwrite(before)
    gone = before.filter("source = 'src7' OR lang = 'fr'")
    held.upsert(gone, after.filter("lang IN ('fr', 'es')"), "doc_id", "second")
    held.upsert(gone, after.filter("lang IN ('fr', 'es')"), "doc_id", "second")  # delivered again
    return held


@query
def versioned_change_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Changes between two versions of one table; partitions both share are not read."""
    feed = versioned(spark, sf).change_feed(0, 1, "doc_id")
    return feed.select("doc_id", "change_type", "source", F.md5("text").alias("text_md5"))


ORACLE["versioned_change_feed"] = ORACLE["change_feed"]


@query
def versioned_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per language of every version that can still be read."""
    held, out = versioned(spark, sf), None
    for version in held.history():
        part = held.read(version.number).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        part = part.select(F.lit(version.number).alias("version"), F.lit(version.operation).alias("operation"), "lang", "n")
        out = part if out is None else out.unionByName(part)
    return out


ORACLE["versioned_counts"] = f"""
WITH {SQL_VERSIONS}
SELECT 0 AS version, 'overwrite' AS operation, lang, count(*) AS n FROM v1 GROUP BY lang
UNION ALL SELECT 1, 'upsert', lang, count(*) FROM v2 GROUP BY lang"""


@query
def live_index(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks and vectors after three drops: drafts without the Spanish documents, final texts, and one source withdrawn."""
    docs = silver_documents(spark, sf).select("doc_id", "extracted_text", "source_system", "region")
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "checkpoint")
    index = LiveIndex(spark, scratch_dir(spark, "live"), keep=("region",), buckets=16)
    draft = F.when(F.col("region") == "fr", F.concat(F.lit("draft: "), "extracted_text")).otherwise(F.col("extracted_text"))
    drops = (
        docs.filter("NOT region <=> 'es'").withColumn("extracted_text", draft),
        docs.filter("region IN ('fr', 'es')"),
        docs.filter("source_system = 'src7'"),
    )
    for number, drop in enumerate(drops):
        arriving = drop.drop("source_system").withColumns({"deleted": F.lit(number == 2), "arrived": F.lit(number)})
        arriving.write.mode("append").parquet(landing)
        index.follow(spark.readStream.schema(arriving.schema).parquet(landing), checkpoint)
    return index.table.read().select("doc_id", "ordinal", "chunk_id", F.size("embedding_vector").alias("dim"))


ORACLE["live_index"] = f"""
WITH RECURSIVE {CHUNKS_CTE}
SELECT doc_id, CAST(ordinal AS INTEGER) AS ordinal, md5(text) AS chunk_id,
  CASE WHEN len({tokens("text")}) > 0 THEN CAST({config.EMBEDDING_DIM} AS INTEGER) END AS dim FROM chunks
WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE source = 'src7')"""


@query
def dead_letter_replay(spark: SparkSession, sf: str) -> DataFrame:
    """A decoder that fails for every fifth size, tried twice, then one that fails for every fifteenth only."""
    bronze = table(spark, sf, "documents").select("doc_id", "text", "n_chars")
    silver = VersionedTable(spark, scratch_dir(spark, "silver"), "part")
    letters = DeadLetters(spark, scratch_dir(spark, "letters"), max_attempts=3)

    def decoder(size: int):
        def step(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
            bad = F.coalesce(F.col("n_chars") % size == 0, F.lit(False))
            failed = rows.filter(bad).select(F.col("doc_id").alias("key"), F.col("doc_id").alias("pointer"), F.lit("unknown codec").alias("reason"))
            return rows.filter(~bad).select("doc_id", F.md5("text").alias("text_md5"), (F.col("doc_id") % 8).alias("part")), failed

        return step

    def sink(rows: DataFrame, batch: str) -> None:
        silver.upsert(rows, rows, "doc_id", batch)

    good, failed = decoder(5)(bronze)
    sink(good, "first")
    for _ in range(2):  # delivered twice
        letters.record("parse", failed, "first")
    for name, size in (("second", 5), ("third", 15), ("fourth", 15)):
        letters.replay("parse", bronze, "doc_id", decoder(size), sink, name)
    told = letters.letters("parse").select(F.col("pointer").cast("bigint").alias("doc_id"), "state", "attempts")
    return silver.read().select("doc_id", "text_md5").join(told, "doc_id", "full_outer")


ORACLE["dead_letter_replay"] = """
SELECT doc_id, CASE WHEN n_chars % 15 <> 0 THEN md5(text) END AS text_md5,
  CASE WHEN n_chars % 15 = 0 THEN 'given_up' WHEN n_chars % 5 = 0 THEN 'done' END AS state,
  CAST(CASE WHEN n_chars % 15 = 0 THEN 3 WHEN n_chars % 5 = 0 THEN 2 END AS INTEGER) AS attempts FROM documents"""


@query
def index_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Build the vector index from one version, then apply the changes to the next one.

    Label 9 is new, label 0 is withdrawn and label 5 is embedded again; only the partitions
    those touch are rewritten.
    """
    index = scratch_dir(spark, "index")
    rows = table(spark, sf, "embeddings")
    flipped = F.when(F.col("label") == 5, F.transform("embedding", lambda x: -x)).otherwise(F.col("embedding"))
    before, after = rows.filter("label != 9"), rows.filter("label != 0").withColumn("embedding", flipped)
    files.overwrite(before, index, "label")
    feed = materialize(changes.change_feed(spark.read.parquet(index), after, "vec_id"), "feed")
    touched = changes.touched_partitions(feed, "label")
    files.rewrite_partitions(
        spark, index, "label", touched, lambda current: changes.apply_changes(current, feed.select("vec_id", "change_type", *[c for c in current.columns if c != "vec_id"]), "vec_id")
    )
    return spark.read.parquet(index).select("vec_id", "label", F.element_at("embedding", 1).cast("double").alias("first"))


ORACLE["index_sync"] = """
SELECT vec_id, label, CAST(CASE WHEN label = 5 THEN -embedding[1] ELSE embedding[1] END AS DOUBLE) AS first
FROM embeddings WHERE label <> 0"""


@query
def erasure_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Erase the documents of one source from every layer; nothing may be left."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    chunks = materialize(chunk.with_chunk_ids(document_chunks(spark, sf)).select("doc_id", "chunk_key", "chunk_id"), "chunks")
    layers = {"documents": docs, "chunks": chunks, "vectors": chunks.select("doc_id", "chunk_id").distinct()}
    erased = docs.filter("source = 'src3'")
    after = changes.erase(layers, erased, "doc_id")
    kept = None
    for name, df in after.items():
        part = df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows_kept"))
        kept = part if kept is None else kept.unionByName(part)
    return kept.join(changes.residue(after, erased, "doc_id"), "layer")


ORACLE["erasure_cascade"] = f"""
WITH RECURSIVE {CHUNKS_CTE},
c AS (SELECT doc_id, md5(text) AS h FROM chunks WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE source = 'src3'))
SELECT 'documents' AS layer, count(*) AS rows_kept, CAST(0 AS BIGINT) AS rows_left FROM documents WHERE source <> 'src3'
UNION ALL SELECT 'chunks', count(*), 0 FROM c UNION ALL SELECT 'vectors', count(DISTINCT (doc_id, h)), 0 FROM c"""


@query
def ingest_json_csv(spark: SparkSession, sf: str) -> DataFrame:
    """JSON feed of events with broken sign-up lines, beside a CSV feed of customers."""
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    broken = F.when(F.col("event_type") == "signup", F.substring(line, 1, 12)).otherwise(line)
    json_in, csv_in = scratch_dir(spark, "json"), scratch_dir(spark, "csv")
    table(spark, sf, "events").select(broken.alias("value")).write.text(json_in)
    table(spark, sf, "customer").select("c_custkey", "c_mktsegment").write.option("header", "true").csv(csv_in)
    json_out, csv_out = scratch_dir(spark, "table"), scratch_dir(spark, "table")
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    stream.drain(stream.json_rows(spark, json_in, schema), json_out, scratch_dir(spark, "checkpoint"))
    stream.drain(stream.csv_rows(spark, csv_in, "c_custkey bigint, c_mktsegment string"), csv_out, scratch_dir(spark, "checkpoint"))
    kind = F.when(F.col("_corrupt").isNull(), "ok").otherwise("corrupt")
    landed = spark.read.parquet(json_out).select(F.lit("json").alias("feed"), kind.alias("state"), F.coalesce("event_type", F.lit("-")).alias("kind"))
    rows = spark.read.parquet(csv_out).select(F.lit("csv").alias("feed"), kind.alias("state"), F.col("c_mktsegment").alias("kind"))
    return landed.unionByName(rows).groupBy("feed", "state", "kind").agg(F.count(F.lit(1)).alias("n"))


ORACLE["ingest_json_csv"] = """
SELECT 'json' AS feed, CASE WHEN event_type = 'signup' THEN 'corrupt' ELSE 'ok' END AS state,
  CASE WHEN event_type = 'signup' THEN '-' ELSE event_type END AS kind, count(*) AS n FROM events GROUP BY 2, 3
UNION ALL SELECT 'csv', 'ok', c_mktsegment, count(*) FROM customer GROUP BY 3"""


@query
def evolve_schema(spark: SparkSession, sf: str) -> DataFrame:
    """A feed that gains the `props` column halfway; older rows read it as NULL."""
    events = timed_events(spark, sf)
    old = events.filter("ts < '2024-01-15'").select("event_id", "event_type")
    new = events.filter("ts >= '2024-01-15'").select("event_id", "event_type", "props")
    path = scratch_dir(spark, "evolving")
    files.append(old, path)
    files.append(new, path)
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    rows = ingest.evolve(old, new).select("event_id", "event_type", "props")
    extra = F.try_variant_get(F.try_parse_json("s.props"), "$.k", "int")
    return rows.join(stored.select("event_id", F.struct("props").alias("s")), "event_id").select(
        "event_id", "event_type", "props", extra.alias("k")
    )


ORACLE["evolve_schema"] = """
SELECT event_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN props END AS props,
  CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k FROM events"""

SIZE_LIMIT = 10_000


@query
def size_gate(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    gated = ingest.size_gate(docs, F.col("n_chars"), SIZE_LIMIT)
    return gated.select("doc_id", "queue", F.sha2("text", 256).alias("file_hash"))


ORACLE["size_gate"] = f"""
SELECT doc_id, CASE WHEN n_chars > {SIZE_LIMIT} THEN 'oversize' ELSE 'process' END AS queue, sha256(text) AS file_hash
FROM documents"""


@query
def ingest_audit(spark: SparkSession, sf: str) -> DataFrame:
    audit = ingest.ingest_audit(timed_events(spark, sf), "ts", "event_type")
    return audit.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "arrived",
        F.date_format("freshest", "yyyy-MM-dd HH:mm:ss").alias("freshest"),
    )


ORACLE["ingest_audit"] = """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS arrived, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS freshest
FROM events GROUP BY 1, 2"""


@query
def partitioned_log_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A log partitioned by day, read for one week through its partition column."""
    path = scratch_dir(spark, "log")
    files.append(timed_events(spark, sf).withColumn("date_utc", F.to_date("ts")), path, "date_utc")
    week = spark.read.parquet(path).filter("date_utc >= DATE'2024-01-08' AND date_utc < DATE'2024-01-15'")
    return week.groupBy(F.date_format("date_utc", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    )


ORACLE["partitioned_log_scan"] = """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' GROUP BY 1, 2"""


@query
def schema_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of two tables that break their contract, counted per rule."""
    k = F.from_json("props", "k int")["k"]
    events = ingest.violations(
        table(spark, sf, "events"),
        {"positive_value": F.col("value") > 1, "payload": ingest.payload_matches(F.col("props"), "k int", "k"), "small_k": k < 50},
    )
    docs = ingest.violations(
        table(spark, sf, "documents"),
        {"length": F.length("text") == F.col("n_chars"), "language": F.col("lang").isin("en", "fr"), "long": F.col("n_chars") >= 100},
    )

    def long_form(df: DataFrame, name: str) -> DataFrame:
        return df.unpivot(["rows_checked"], [c for c in df.columns if c != "rows_checked"], "rule", "broken").select(
            F.lit(name).alias("table_name"), "rule", "rows_checked", "broken"
        )

    return long_form(events, "events").unionByName(long_form(docs, "documents"))


ORACLE["schema_contract"] = """
SELECT 'events' AS table_name, 'positive_value' AS rule, count(*) AS rows_checked, count(*) FILTER (NOT value > 1) AS broken FROM events
UNION ALL SELECT 'events', 'payload', count(*), count(*) FILTER (json_extract(props, '$.k') IS NULL) FROM events
UNION ALL SELECT 'events', 'small_k', count(*), count(*) FILTER (NOT CAST(json_extract(props, '$.k') AS INTEGER) < 50) FROM events
UNION ALL SELECT 'documents', 'length', count(*), count(*) FILTER (length(text) <> n_chars) FROM documents
UNION ALL SELECT 'documents', 'language', count(*), count(*) FILTER (lang NOT IN ('en', 'fr')) FROM documents
UNION ALL SELECT 'documents', 'long', count(*), count(*) FILTER (n_chars < 100) FROM documents"""


CONTRACTS = {
    "events": {"event_id": "bigint", "ts": "timestamp", "user_id": "string", "event_type": "string", "value": "double", "country": "string"},
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string"},
}


@query
def schema_report(spark: SparkSession, sf: str) -> DataFrame:
    """Missing, extra and wrongly typed columns of two tables, with the rows that are affected."""
    out = None
    for name, contract in CONTRACTS.items():
        rows = timed_events(spark, sf) if name == "events" else table(spark, sf, name)
        found = ingest.schema_problems(rows, contract).withColumn("table_name", F.lit(name))
        out = found if out is None else out.unionByName(found)
    return out


ORACLE["schema_report"] = """
SELECT 'events' AS table_name, 'country' AS column_name, 'missing' AS problem, count(*) AS rows_affected FROM events
UNION ALL SELECT 'events', 'props', 'extra', count(props) FROM events
UNION ALL SELECT 'events', 'user_id', 'type bigint', count(user_id) FROM events
UNION ALL SELECT 'documents', 'n_chars', 'extra', count(n_chars) FROM documents"""


@query
def evolving_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Events in three drops: plain, with `props` and values that are no numbers, and with lines cut short."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    landing, target, checkpoint = (scratch_dir(spark, name) for name in ("landing", "evolving", "checkpoint"))
    odd = F.col("event_id") % 11 == 0
    plain = F.to_json(F.struct("event_id", "value"))
    text_value = F.to_json(F.struct("event_id", F.lit("n/a").alias("value"), "props"))
    wide = F.when(odd, text_value).otherwise(F.to_json(F.struct("event_id", "value", "props")))
    drops = (
        events.filter("user_id % 3 = 0").select(plain.alias("line")),
        events.filter("user_id % 3 = 1").select(wide.alias("line")),
        events.filter("user_id % 3 = 2").select(F.when(odd, F.concat(F.lit("{"), F.col("event_id").cast("string"))).otherwise(wide).alias("line")),
    )
    for drop in drops:
        drop.write.mode("append").text(landing)
        feed = EvolvingFeed(spark, landing, target, checkpoint, {"event_id": "bigint", "value": "double"})
        feed.follow()
    rows = feed.read()
    return rows.select("event_id", F.round("value", 6).alias("value"), F.md5("props").alias("props_md5"), F.try_variant_get("_rescued", "$.value", "string").alias("aside"), "_bad_line")


ORACLE["evolving_feed"] = """
SELECT CASE WHEN NOT bad THEN event_id END AS event_id, CASE WHEN NOT bad AND NOT odd THEN round(value, 6) END AS value,
  CASE WHEN NOT bad AND user_id % 3 <> 0 THEN md5(props) END AS props_md5, CASE WHEN odd AND NOT bad THEN 'n/a' END AS aside,
  CASE WHEN bad THEN concat('{', event_id) END AS _bad_line
FROM (SELECT *, user_id % 3 <> 0 AND event_id % 11 = 0 AS odd, user_id % 3 = 2 AND event_id % 11 = 0 AS bad FROM events)"""


DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def silver_step(bronze: DataFrame) -> DataFrame:
    """Documents packed in landed files, extracted; a document's path is its own."""
    rows = files.file_lines(bronze.select("path", "content"), DOCUMENT).withColumnRenamed("path", "file")
    cleaned = rows.withColumn("extracted_text", text.extracted_or_marker(F.col("text")))
    return text.drop_extraction_errors(cleaned).select(
        "doc_id", F.concat(F.lit("doc/"), F.col("doc_id")).alias("path"), F.col("source").alias("source_system"),
        F.col("lang").alias("region"), "extracted_text",
    )


@query
def document_build(spark: SparkSession, sf: str) -> DataFrame:
    """The whole build over catalog tables, run after each of two drops of documents."""
    root = scratch_dir(spark, "build")
    build = DocumentBuild(spark, TableNames(schema=f"build_{root[-32:]}"), root).create()
    docs = table(spark, sf, "documents")
    for drop in (docs.filter("lang = 'en'"), docs.filter("NOT lang <=> 'en'")):
        files.land_json(drop, f"{root}/landing")
        build.ingest(f"{root}/landing")
        build.parse(silver_step)
        build.chunk()
        build.embed()
    gold = spark.read.table(build.names.vectors)
    return gold.groupBy("path", "source_system", "region").agg(
        F.count(F.lit(1)).alias("chunks"), F.count_distinct("chunk_key").alias("keys"), F.count("embedding_vector").alias("vectors")
    )


ORACLE["document_build"] = f"""
WITH RECURSIVE {CHUNKS_CTE}
SELECT concat('doc/', doc_id) AS path, source AS source_system, lang AS region, count(*) AS chunks, count(*) AS keys,
  count(*) FILTER (regexp_matches(c.text, '[\\p{{L}}\\p{{N}}]')) AS vectors
FROM chunks c JOIN documents d USING (doc_id) GROUP BY 1, 2, 3"""


# ---------------------------------------------------------------- live monitoring streams


@query
def monitor_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Daily figures from a stream that was stopped and restarted halfway."""
    target = scratch_dir(spark, "kpis")

    def run(landing: str, checkpoint: str) -> None:
        stream.drain(live.kpis(stream.json_rows(spark, landing, EVENT)), target, checkpoint)

    two_drops(spark, timed_events(spark, sf), F.col("ts") < "2024-01-16", run)
    return spark.read.parquet(target).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "requests", "errors", F.col("latency").cast("double").alias("latency")
    )


SQL_KPIS = """
SELECT strftime(d, '%Y-%m-%d') AS day, count(*) AS requests, count(*) FILTER (event_type = 'error') AS errors,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS latency
FROM (SELECT *, date_trunc('day', ts) AS d FROM events)
WHERE d + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1"""
ORACLE["monitor_stream"] = SQL_KPIS


@query
def monitor_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The batch twin of the stream, restricted to closed windows."""
    events = timed_events(spark, sf)
    closed = live.closed_windows(live.kpis(events, delay=None), events)
    return closed.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "requests", "errors", F.col("latency").cast("double").alias("latency")
    )


ORACLE["monitor_batch"] = SQL_KPIS


@query
def stream_exactly_once(spark: SparkSession, sf: str) -> DataFrame:
    """The last day before a restart is delivered again afterwards; every event still lands once."""
    target, landing, checkpoint = (scratch_dir(spark, n) for n in ("events", "landing", "checkpoint"))
    events = timed_events(spark, sf)

    def run() -> None:
        stream.drain(live.once_each(stream.good_rows(stream.json_rows(spark, landing, EVENT)), "event_id", "2 days"), target, checkpoint)

    files.land_json(events.filter("ts < '2024-01-16'"), landing)
    run()
    files.land_json(events.filter("ts >= '2024-01-15'"), landing)
    run()
    return spark.read.parquet(target).select("event_id", "user_id", "event_type")


ORACLE["stream_exactly_once"] = "SELECT event_id, user_id, event_type FROM events"
