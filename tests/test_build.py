"""The document build: restartable, incremental, filterable."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.config import TableNames
from shelfwise.plans.build import DocumentBuild
from shelfwise.plans.ingestion import silver_step
from shelfwise.session import scratch_dir
from shelfwise.sources import files

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_names_are_quoted():
    names = TableNames("a-b", "c`d")
    assert names.bronze == "`a-b`.`c``d`.`bronze_raw_documents`"


def test_build(spark):
    root = scratch_dir(spark, "build")
    build = DocumentBuild(spark, TableNames(schema=f"build_{root[-32:]}"), root).create()
    landing = f"{root}/landing"

    def land(*docs):
        rows = [(i, t, lang, "src", len(t)) for i, t, lang in docs]
        files.land_json(spark.createDataFrame(rows, SCHEMA), landing)
        build.ingest(landing)
        build.parse(silver_step)
        build.chunk()

    land((1, "espresso machine return policy", "en"), (2, " \n ", "en"), (3, "blender warranty " * 60, "en"))
    silver = spark.read.table(build.names.silver)
    assert sorted(r.doc_id for r in silver.collect()) == [1, 3]
    assert set(silver.columns) == {"doc_id", "path", "source_system", "region", "extracted_text"}
    first = build.embed()
    assert first == spark.read.table(build.names.chunks).count() > 2
    assert build.embed() == 0

    land((4, "espresso machine return policy", "fr"))
    assert build.embed() == 1  # same text, another document: its own row
    gold = spark.read.table(build.names.vectors)
    assert gold.select("chunk_key").distinct().count() == gold.count() == first + 1
    assert gold.filter("doc_id IN (1, 4)").select("chunk_id").distinct().count() == 1

    asked = spark.createDataFrame([(7, "return policy of the espresso machine"), (8, "???")], "id long, text string")
    hits = build.retrieve(asked, k=2).orderBy("rank").collect()
    assert {h.source for h in hits} == {"doc/1", "doc/4"} and {h.question_id for h in hits} == {7}
    assert [h.source for h in build.retrieve(asked, k=2, filters={"region": "fr"}).collect()] == ["doc/4"]

    spark.read.table(build.names.silver).filter(F.col("doc_id") != 3).write.parquet(f"{root}/kept")
    spark.read.parquet(f"{root}/kept").withColumn("n", F.lit(0)).drop("n").write.mode("overwrite").saveAsTable(build.names.silver)
    build.chunk()
    assert build.embed() == 0
    assert sorted(r.doc_id for r in spark.read.table(build.names.vectors).collect()) == [1, 4]
