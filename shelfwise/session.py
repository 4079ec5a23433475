"""Session settings, shared scratch space and the size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import cache, reduce
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows, and bytes of text, a side may have before it is no longer broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 128 * 1024 * 1024
# What a Python worker gets at a time: kernels hold a few times as much.
ARROW_BATCH_BYTES = 8 * 1024 * 1024
# A key with more rows than this is spread over several tasks.
HOT_ROWS = 1_000_000
# Groups of the first count: at most so many rows reach the driver.
HASH_BUCKETS = 65_536


def build_session(cpus: int | str = "*", app: str = "shelfwise", **conf: str) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own session."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every query relies on, and the package on every Python worker."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")  # layers are mostly text
    _ship_package(spark.sparkContext.applicationId)
    return spark


@cache
def _ship_package(application_id: str) -> None:
    """Hand the package to Spark, which serves it to the executors; once per application."""
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="run-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for module in sorted(package.rglob("*.py")):
            target.write(module, module.relative_to(package.parent))
    SparkContext.getOrCreate().addPyFile(str(archive))


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a fresh /tmp folder only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def scratch_dir(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write a layer to the shared folder and read it back, so later steps do not recompute it."""
    path = scratch_dir(df.sparkSession, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*layers: DataFrame) -> None:
    """Delete what `materialize` wrote without partitions, once nothing reads it any more."""
    for df in layers:
        spark = df.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fits(df: DataFrame, rows: int = BROADCAST_ROWS, text_bytes: int = BROADCAST_BYTES) -> bool:
    """True when df has at most `rows` rows, with at most `text_bytes` in text and binary columns; reads no further."""
    wide = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)).cast("bigint") for c, kind in df.dtypes if kind in ("string", "binary")]
    sizes = df.select(reduce(lambda a, b: a + b, wide, F.lit(0).cast("bigint")).alias("size")).limit(rows + 1)
    found = sizes.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    return found.n <= rows and (found.size or 0) <= text_bytes


def spread_out(scan: DataFrame) -> DataFrame:
    """Give a scan of fewer files than cores one partition per core, ahead of Python work.

    A scan with enough splits is returned as it is, so large inputs are never shuffled here.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def hot_keys(df: DataFrame, on: list[str], rows: int = HOT_ROWS) -> DataFrame:
    """Keys holding more than `rows` rows: at most one key per `rows` input rows.

    Rows are counted per hash bucket first, which combines before the shuffle also when keys are near
    unique; only the keys of heavy buckets are counted one by one.
    """
    bucket = F.pmod(F.xxhash64(*on), F.lit(HASH_BUCKETS))
    heavy = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows).collect()
    if not heavy:
        return df.select(*on).limit(0)
    kept = df if len(heavy) == HASH_BUCKETS else df.filter(bucket.isin([row["_bucket"] for row in heavy]))
    return kept.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows).select(*on)


def spread_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "inner",
    small_fits: bool = False,
    salts: int = 64,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join that survives hot keys.

    A small side that passed a size check is broadcast. Otherwise the rows of each hot key of `big`
    are spread over `salts` tasks by the hash of `spread_by`, and only the hot rows of `small` are
    repeated, once per salt. Without hot keys it is a plain join.
    """
    if small_fits:
        return big.join(F.broadcast(small), on, how)
    hot = materialize(hot_keys(big, on, hot_rows).withColumn("_hot", F.lit(True)), "hot-keys")
    if hot.isEmpty():
        return big.join(small, on, how)
    if fits(hot):
        hot = F.broadcast(hot)
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts))
    salted = big.join(hot, on, "left").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(F.lit(0)))
    every = F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")
    only = F.array(F.lit(0)).cast("array<bigint>")
    repeated = small.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(only))
    )
    return salted.drop("_hot").join(repeated.drop("_hot"), [*on, "_salt"], how).drop("_salt")
