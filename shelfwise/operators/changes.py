"""Row-level changes between two snapshots of a table, and tables kept in step with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.session import fits, materialize, spread_join


def fingerprint(df: DataFrame, columns: list[str]) -> Column:
    """Two hashes of a row's values; which values are NULL counts too."""
    nulls = [F.col(c).isNull() for c in columns]
    return F.struct(F.xxhash64(*columns, *nulls), F.hash(*columns, *nulls))


def change_feed(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Changes as rows: `change_type` is insert, delete, update_pre or update_post.

    The outer join compares fingerprints, so only keys and hashes of unchanged rows travel; the
    images are fetched for the changed keys, which are broadcast when they are few.
    """
    columns = [c for c in before.columns if c != key]
    pre = before.select(key, fingerprint(before, columns).alias("pre"))
    post = after.select(key, fingerprint(after, columns).alias("post"))
    kind = (
        F.when(F.col("pre").isNull(), "insert")
        .when(F.col("post").isNull(), "delete")
        .when(F.col("pre") != F.col("post"), "update")
    )
    changed = materialize(
        pre.join(post, key, "full_outer").select(key, kind.alias("kind")).filter("kind IS NOT NULL"), "changed"
    )
    few = F.broadcast(changed) if fits(changed) else changed

    def images(df: DataFrame, gone: str, suffix: str) -> DataFrame:
        name = F.when(F.col("kind") == "update", f"update_{suffix}").otherwise(F.col("kind"))
        return df.join(few, key).filter(F.col("kind") != gone).select(key, name.alias("change_type"), *columns)

    return images(before, "insert", "pre").unionByName(images(after, "delete", "post"))


def apply_changes(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Target with deletes removed and post-images put in place."""
    images = changes.filter("change_type IN ('insert', 'update_post')").drop("change_type")
    untouched = target.join(changes.select(key).distinct(), key, "left_anti")
    return untouched.unionByName(images)


def touched_partitions(changes: DataFrame, partition: str) -> DataFrame:
    """Partition values a sync has to rewrite."""
    return changes.select(partition).distinct()


def erase(layers: dict[str, DataFrame], erased: DataFrame, key: str) -> dict[str, DataFrame]:
    """Every layer without the rows that descend from an erased document.

    A short list of erasures is broadcast; with a long one the rows of a large document are spread.
    """
    gone = erased.select(key).distinct()
    few = fits(gone)
    return {name: spread_join(df, gone, [key], df.columns, "left_anti", small_fits=few) for name, df in layers.items()}


def residue(layers: dict[str, DataFrame], erased: DataFrame, key: str) -> DataFrame:
    """Rows per layer that still descend from an erased document: all zero after `erase`."""
    parts = [
        df.join(erased.select(key).distinct(), key, "left_semi").agg(
            F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows_left")
        )
        for name, df in layers.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def missing_rows(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of source whose key is not in target: what an idempotent load appends."""
    return source.join(target.select(key), key, "left_anti").dropDuplicates([key])
