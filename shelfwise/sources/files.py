"""File landing zones, table sinks and partition rewrites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import fits, materialize, scratch_dir

BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def land_json(df: DataFrame, folder: str) -> None:
    """Add rows to a landing folder as JSON-lines files."""
    df.write.mode("append").json(folder)


def read_binary(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)


def _parsed_lines(bronze: DataFrame, schema: str) -> DataFrame:
    """(path, line, r): every line of landed JSON-lines files; malformed bytes become U+FFFD, `r._corrupt` marks bad lines."""
    body = F.make_valid_utf8(F.col("content").cast("binary").cast("string"))
    lines = bronze.select("path", F.explode(F.split(body, "\n")).alias("line")).filter("trim(line) != ''")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    return lines.withColumn("r", F.from_json("line", f"{schema}, _corrupt string", options))


def file_lines(bronze: DataFrame, schema: str) -> DataFrame:
    """Rows packed in landed JSON-lines files; lines that are no JSON are left to `bad_lines`."""
    return _parsed_lines(bronze, schema).filter("r._corrupt IS NULL").select("path", "r.*").drop("_corrupt")


def bad_lines(bronze: DataFrame, schema: str) -> DataFrame:
    """(path, line) of the lines `file_lines` cannot read, for quarantine."""
    return _parsed_lines(bronze, schema).filter("r._corrupt IS NOT NULL").select("path", "line")


def _write(df: DataFrame, path: str, mode: str, partition_by: tuple[str, ...], **options: str) -> None:
    """Partitioned tables are rebalanced by partition first: few files each, hot partitions split."""
    placed = df.hint("rebalance", *partition_by) if partition_by else df
    writer = placed.write.mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite(df: DataFrame, path: str, *partition_by: str) -> None:
    _write(df, path, "overwrite", partition_by)


def append(df: DataFrame, path: str, *partition_by: str) -> None:
    _write(df, path, "append", partition_by)


def replace_partitions(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write df in place of the partitions it has rows for; other partitions stay. Running it again changes nothing."""
    _write(df, path, "overwrite", partition_by, partitionOverwriteMode="dynamic")


def rewrite_partitions(spark: SparkSession, path: str, partition: str, touched: DataFrame, rebuild) -> None:
    """Replace only the touched partitions of a table by rebuild(their current rows).

    `partition` holds numbers, dates or names, NULL included. New content is written aside first, so the
    overwrite never reads what it replaces; running it again gives the same table.
    """
    touched = materialize(touched.distinct(), "touched")  # may come from the table itself
    table = spark.read.parquet(path)
    values = F.broadcast(touched) if fits(touched) else touched
    same = table[partition].eqNullSafe(values[partition])  # a table may have a NULL partition
    current = table.join(values, same, "left_semi").select(*table.columns)
    aside = scratch_dir(spark, "rewrite")
    rebuild(current).select(*table.columns).write.parquet(aside)
    staged = spark.read.schema(table.schema).parquet(aside)
    _write(staged, path, "overwrite", (partition,), partitionOverwriteMode="dynamic")
    # Dynamic overwrite leaves a partition that lost its last row; its folder is removed by name.
    filled = staged.select(F.col(partition).alias("_filled")).distinct()
    emptied = touched.join(filled, F.col(partition).eqNullSafe(F.col("_filled")), "left_anti")
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for row in emptied.toLocalIterator():
        value = names.DEFAULT_PARTITION_NAME() if row[0] is None else names.escapePathName(str(row[0]))
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
