"""Versioned tables and the index that follows a stream of documents."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfwise.session import scratch_dir
from shelfwise.sources.versions import CommitConflict, VersionedTable
from shelfwise.streaming.build import LiveIndex

DOC = "doc_id long, extracted_text string, deleted boolean, arrived long, lang string"


def listed(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def people(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, city string, n long")


def test_versions_stay_readable_and_files_stay(spark):
    table = VersionedTable(spark, scratch_dir(spark, "table"), "city")
    first = people(spark, (1, "a", 1), (2, "b/c d", 1), (3, None, 1), (4, "", 1))
    table.overwrite(first)
    old = table.read()
    before = table.version().parts
    table.upsert(people(spark, (2, "b/c d", 0)), people(spark, (2, "b/c d", 9), (5, "new", 5)), "id")
    assert listed(table.read()) == listed(people(spark, (1, "a", 1), (2, "b/c d", 9), (3, None, 1), (4, "", 1), (5, "new", 5)))
    assert listed(table.read(0)) == listed(first) == listed(old)
    after = table.version().parts
    assert {p for p in before if before[p] != after[p]} == {"v" + "b/c d".encode().hex().upper()}
    table.upsert(people(spark, (3, None, 0)), first.limit(0), "id")
    assert table.read().filter("city IS NULL").isEmpty() and "null" not in table.version().parts
    table.append(people(spark, (6, "a", 6)))
    assert [v.operation for v in table.history()] == ["overwrite", "upsert", "upsert", "append"]
    assert table.read().filter("city = 'a'").count() == 2
    feed = table.change_feed(0, 3, "id").select("id", "change_type", "n")
    assert listed(feed) == listed(spark.createDataFrame(
        [(2, "update_pre", 1), (2, "update_post", 9), (3, "delete", 1), (5, "insert", 5), (6, "insert", 6)], "id long, t string, n long"))
    with pytest.raises(LookupError):
        table.read(17)


def test_a_killed_writer_leaves_the_version_before(spark):
    table = VersionedTable(spark, scratch_dir(spark, "table"), "city")
    table.overwrite(people(spark, (1, "a", 1), (2, "b", 1)))
    broken = F.udf(lambda n: 1 // 0, "long")

    with pytest.raises(Exception, match="ZeroDivision|division"):
        table.rewrite(people(spark, (1, "a", 1)).select("city"), lambda held: held.withColumn("n", broken("n")))
    assert table.numbers() == [0] and listed(table.read()) == listed(people(spark, (1, "a", 1), (2, "b", 1)))
    table._write(people(spark, (9, "z", 9)))  # data written, killed before the rename
    assert listed(table.read()) == listed(people(spark, (1, "a", 1), (2, "b", 1)))


def test_one_of_two_writers_is_refused(spark):
    table = VersionedTable(spark, scratch_dir(spark, "table"), "city")
    base = table.overwrite(people(spark, (1, "a", 1)))
    table.append(people(spark, (2, "a", 2)))
    with pytest.raises(CommitConflict):
        table._next("append", base.parts, base.schema, None, base)
    assert table.read().count() == 2


def test_expiry_keeps_what_newer_versions_use(spark):
    table = VersionedTable(spark, scratch_dir(spark, "table"), "city")
    table.overwrite(people(spark, (1, "a", 1), (2, "b", 1)))
    for n in (2, 3, 4):
        table.upsert(people(spark, (1, "a", 0)), people(spark, (1, "a", n)), "id")
    assert table.expire(2) == 2  # two older folders of "a"; "b" is still the first one
    assert table.numbers() == [2, 3]
    assert listed(table.read(2)) == listed(people(spark, (1, "a", 3), (2, "b", 1)))
    assert listed(table.read()) == listed(people(spark, (1, "a", 4), (2, "b", 1)))


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, gone, at, "en") for i, t, gone, at in rows], DOC)


def test_index_follows_three_drops(spark):
    root = scratch_dir(spark, "live")
    index = LiveIndex(spark, f"{root}/index", buckets=8, keep=("lang",))
    landing = f"{root}/landing"

    def drop(*rows):
        docs(spark, *rows).coalesce(1).write.mode("append").parquet(landing)
        index.follow(spark.readStream.schema(DOC).parquet(landing), f"{root}/checkpoint")
        return {p: f for p, f in index.table.version().parts.items()}

    long_ = "espresso machine warranty card. " * 60
    one = drop(*[(i, f"return policy {i}", False, 1) for i in range(20)], (20, long_, False, 1), (21, "   ", False, 1))
    assert index.table.read().filter("doc_id = 20").count() > 2 and index.table.read().filter("doc_id = 21").isEmpty()
    two = drop((3, "a changed policy", False, 2), (4, "return policy 4", False, 2), (30, "a new one", False, 2))
    where = {r.doc_id: r.b for r in docs(spark, (3, "", False, 0), (30, "", False, 0)).select("doc_id", index.bucket(F.col("doc_id")).alias("b")).collect()}
    touched = {"v" + str(b).encode().hex().upper() for b in where.values()}
    assert {p for p in {*one, *two} if one.get(p) != two.get(p)} == touched
    three = drop((5, None, True, 3), (99, None, True, 3), (6, "last wins", False, 4), (6, "not this", False, 3))
    assert three != two
    rows = index.table.read()
    assert {r.chunk_content for r in rows.filter("doc_id IN (3, 6, 30)").collect()} == {"a changed policy", "last wins", "a new one"}
    assert rows.filter("doc_id IN (5, 99)").isEmpty() and rows.filter("embedding_vector IS NULL OR lang <> 'en'").isEmpty()
    assert rows.select("doc_id").distinct().count() == 21
    numbers = index.table.numbers()
    index.follow(spark.readStream.schema(DOC).parquet(landing), f"{root}/checkpoint")
    assert index.table.numbers() == numbers


def test_a_replayed_batch_is_applied_once(spark):
    index = LiveIndex(spark, scratch_dir(spark, "live"), buckets=4)
    batch = docs(spark, (1, "one text", False, 1), (2, "two texts", False, 1))
    assert index.apply(batch, 0) == 2
    assert index.apply(batch, 0) == 0 and index.table.numbers() == [0]
    assert index.apply(batch, 1) == 0  # delivered again under another number: nothing differs
    assert index.table.read().count() == 2


def test_an_upsert_leaves_no_scratch_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("shelfwise.session.scratch_root", lambda _: f"{tmp_path}/scratch")
    held = VersionedTable(spark, f"{tmp_path}/table", "p")
    rows = spark.createDataFrame([(i, i % 3) for i in range(30)], "k long, p long")
    held.overwrite(rows)
    held.upsert(rows.filter("k < 5"), rows.filter("k < 3"), "k", "one")
    assert sorted(r.k for r in held.read().collect()) == [0, 1, 2, *range(5, 30)]
    assert list((tmp_path / "scratch").rglob("*.parquet")) == []


def test_a_live_index_leaves_no_scratch_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("shelfwise.session.scratch_root", lambda _: f"{tmp_path}/scratch")
    index = LiveIndex(spark, f"{tmp_path}/index", buckets=2)
    schema = "doc_id long, extracted_text string, deleted boolean, arrived long"
    assert index.apply(spark.createDataFrame([(1, "red mat", False, 0), (2, "blue mat", False, 0)], schema), "a") == 2
    assert index.apply(spark.createDataFrame([(1, "red rug", False, 1), (2, None, True, 1)], schema), "b") == 1
    assert [r.chunk_content for r in index.table.read().collect()] == ["red rug"]
    left = {path.parent.name.split("-")[0] for path in (tmp_path / "scratch").rglob("*.parquet")}
    assert left <= {"hot"}  # the few keys of a join are kept
