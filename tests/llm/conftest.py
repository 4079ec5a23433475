from __future__ import annotations

import pytest
from pyspark.sql import DataFrame

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark) -> DataFrame:
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark) -> DataFrame:
    """Nulls in every column, empty and wordless texts, a very long text, ties, repeated rows and extra columns."""
    long_ = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 30_000
    rows = [
        (1, "one two three four five six seven eight nine ten eleven", "en", "a", 1),
        (1, "one two three four five six seven eight nine ten eleven", "en", "a", 1),
        (2, "One, two three FOUR five six seven eight nine ten eleven!", "en", "b", 1),
        (3, None, "en", "a", None),
        (4, "", "en", "a", 0),
        (5, " \n\t ", None, None, 4),
        (6, "###", "en", None, 3),
        (7, "###", "en", "b", 3),
        (None, "a document without an id and nothing else to say here", "en", "b", None),
        (None, None, None, None, None),
        (8, long_, "en", "c", len(long_)),
        (9, "zażółć gęślą jaźń 日本語 🙂 \x00 end", "pl", "c", 1),
        (10, "hi", "en", "c", 2),
    ]
    wide = spark.createDataFrame(rows, SCHEMA)
    # Names the operators use themselves.
    names = "id key n mark node size score rank before spans held_out level cell block word row text_crc32 target whole cut base".split()
    return wide.selectExpr("*", *[f"cast(doc_id as string) AS {name}" for name in names])


@pytest.fixture(scope="session")
def empty(spark) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
