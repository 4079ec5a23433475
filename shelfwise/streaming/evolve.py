"""A feed of JSON lines whose schema grows: nothing stops, nothing is lost.

The columns known so far are a log beside the checkpoint, one file per generation. A micro-batch is read with the newest
generation; what does not fit it, fields it has no column for and values its types cannot hold, stays with the
row in one VARIANT column, and a line that is no JSON object stays as it is. New fields make the next generation, which
later micro-batches and runs use. A reader sees all generations at once: rows from before a column existed give it
from what was kept aside.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESCUED, BAD = "_rescued", "_bad_line"
SIMPLE = {"STRING": "string", "BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean"}


def new_columns(described: str | None) -> dict[str, str]:
    """Columns of a described object, `OBJECT<name: TYPE, ...>`; anything but plain values stays a variant."""
    if not described or not described.startswith("OBJECT<"):
        return {}
    inside, depth, quoted, parts, start = described[len("OBJECT<") : -1], 0, False, [], 0
    for i, letter in enumerate(inside):
        quoted ^= letter == "`"
        depth += 0 if quoted else (letter in "<(") - (letter in ">)")
        if letter == "," and not depth and not quoted:
            parts.append(inside[start:i])
            start = i + 1
    named = [part.strip().rpartition(": ") if "<" not in part else part.strip().partition(": ") for part in [*parts, inside[start:]] if part.strip()]
    return {name.strip("`"): "double" if kind.startswith("DECIMAL") else SIMPLE.get(kind, "variant") for name, _, kind in named}


@dataclass(frozen=True)
class EvolvingFeed:
    """Lines of `landing` in a parquet table at `table`; `first` are the columns (name to type) known from the start."""

    spark: SparkSession
    landing: str
    table: str
    checkpoint: str
    first: dict[str, str]

    def _log(self, *name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.checkpoint, "columns", *name)))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def generations(self) -> list[dict[str, str]]:
        folder, fs = self._log()
        if not fs.exists(folder):
            return [self.first]
        names = sorted(status.getPath().getName() for status in fs.listStatus(folder))
        found = []
        for name in names:
            stream = fs.open(self._log(name)[0])
            found.append(json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
            stream.close()
        return [self.first, *found]

    def _add(self, columns: dict[str, str]) -> None:
        known = self.generations()
        path, fs = self._log(f"{len(known):09d}.json")
        out = fs.create(path, False)  # of two writers of one generation one is refused
        out.write(bytearray(json.dumps(known[-1] | columns).encode()))
        out.close()

    def parsed(self, lines: DataFrame, columns: dict[str, str]) -> DataFrame:
        """A column per known field, what did not fit in RESCUED, and the line itself in BAD if it is no object."""
        fields = F.from_json("_line", "map<string,variant>")
        held = lines.select(F.col("value").alias("_line")).filter("trim(_line) <> ''")  # a field may be named `value`
        held = held.withColumn("_fields", F.when(F.json_object_keys("_line").isNotNull(), fields))
        values = {name: F.try_variant_get(F.col("_fields")[name], "$", kind) if kind != "variant" else F.col("_fields")[name] for name, kind in columns.items()}
        wide = held.withColumns(values)
        known = F.create_map(*[x for name in columns for x in (F.lit(name), F.col(f"`{name}`").isNotNull())])
        lost = F.map_filter("_fields", lambda name, value: ~F.is_variant_null(value) & ~F.coalesce(F.try_element_at(known, name), F.lit(False)))
        rescued = F.when(F.size(lost) > 0, F.to_variant_object(lost))
        bad = F.when(F.col("_fields").isNull(), F.col("_line"))
        return wide.select(*[F.col(f"`{name}`") for name in columns], rescued.alias(RESCUED), bad.alias(BAD))

    def _take(self, lines: DataFrame, number: int) -> None:
        columns = self.generations()[-1]
        folder = f"{self.table}/batch={number}"
        self.parsed(lines, columns).write.mode("overwrite").parquet(folder)  # a replayed batch takes its own place
        stored = self.spark.read.parquet(folder)
        described = stored.agg(F.schema_of_variant_agg(RESCUED)).first()[0]
        fresh = {name: kind for name, kind in new_columns(described).items() if name not in columns}
        if fresh:
            self._add(fresh)

    def follow(self) -> None:
        """Take everything that waits, then return."""
        lines = self.spark.readStream.text(self.landing)
        query = lines.writeStream.option("checkpointLocation", f"{self.checkpoint}/stream").foreachBatch(self._take).trigger(availableNow=True).start()
        query.awaitTermination()

    def read(self) -> DataFrame:
        """Every row with the columns of the newest generation; RESCUED and BAD as they were kept."""
        columns = self.generations()[-1]
        schema = ", ".join([f"`{name}` {kind}" for name, kind in columns.items()] + [f"{RESCUED} variant", f"{BAD} string"])
        rows = self.spark.read.schema(schema).parquet(self.table)
        later = {name for name in columns if name not in self.first}
        aside = {name: F.try_variant_get(RESCUED, f"$['{name}']", columns[name]) for name in later}
        return rows.select(*[F.coalesce(F.col(f"`{n}`"), aside[n]).alias(n) if n in later else F.col(f"`{n}`") for n in columns], RESCUED, BAD)
