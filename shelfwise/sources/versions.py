"""Tables with versions: immutable data folders, a manifest per version, and a commit that is one rename.

A version is a JSON file that names the folders of every partition; its number is its name. Writers fill a new folder
that nobody sees, then publish the next number by a rename that fails if the number is taken, so a killed writer
leaves the version before, and of two writers one is refused. Readers take the highest number once and keep reading
its folders. Only partitions that change get new folders; a manifest grows with the partitions, not with the rows.

Files of the partitions lie under a name made of the partition's value (a column like any other, NULL included).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import changes
from shelfwise.session import discard, fits, materialize

NULL_PARTITION = "null"
_PART = "_part"


class CommitConflict(RuntimeError):
    """Another writer published this version first: read again and retry."""


@dataclass(frozen=True)
class Version:
    number: int
    operation: str
    batch: str | None
    schema: str
    parts: dict[str, list[str]]
    written: float


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    path: str
    partition: str

    # ------------------------------------------------------------ files

    def _hadoop(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _fs(self):
        return self._hadoop().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        folder = self._hadoop("versions")
        if not self._fs().exists(folder):
            return []
        names = [status.getPath().getName() for status in self._fs().listStatus(folder)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith("."))

    def version(self, number: int | None = None) -> Version:
        known = self.numbers()
        number = known[-1] if number is None and known else number
        if number not in known:
            raise LookupError(f"{self.path} has no version {number}")
        return self._manifest(number)

    def _manifest(self, number: int) -> Version:
        stream = self._fs().open(self._hadoop("versions", f"{number:020d}.json"))
        try:
            return Version(**json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def history(self) -> list[Version]:
        return [self._manifest(n) for n in self.numbers()]

    def _publish(self, version: Version) -> Version:
        jvm = self.spark._jvm
        aside = self._hadoop("versions", f".{uuid.uuid4().hex}")
        out = self._fs().create(aside, True)
        out.write(bytearray(json.dumps(version.__dict__).encode()))
        out.close()
        keep = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        keep[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(aside, self._hadoop("versions", f"{version.number:020d}.json"), keep)
        except Exception as caught:
            self._fs().delete(aside, False)
            if "FileAlreadyExists" in str(caught):
                raise CommitConflict(f"version {version.number} of {self.path} is taken") from caught
            raise
        return version

    def _name(self, column: str) -> Column:
        return F.coalesce(F.concat(F.lit("v"), F.hex(F.col(column).cast("string").cast("binary"))), F.lit(NULL_PARTITION))

    def _write(self, rows: DataFrame) -> dict[str, list[str]]:
        """Fill a new folder; the folders of the partitions that have rows."""
        folder = f"data/{uuid.uuid4().hex}"
        named = rows.withColumn(_PART, self._name(self.partition))
        named.hint("rebalance", _PART).write.partitionBy(_PART).parquet(f"{self.path}/{folder}")
        found = self._fs().listStatus(self._hadoop(folder))
        names = [status.getPath().getName() for status in found if status.isDirectory()]
        return {name.split("=", 1)[1]: [f"{folder}/{name}"] for name in names if name.startswith(f"{_PART}=")}

    # ------------------------------------------------------------ reading

    def _rows(self, version: Version, parts: list[str] | None = None) -> DataFrame:
        names = version.parts if parts is None else [p for p in parts if p in version.parts]
        folders = [f"{self.path}/{folder}" for p in names for folder in version.parts[p]]
        if not folders:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*folders)

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version, by default the newest; later commits do not touch what is being read."""
        return self._rows(self.version(number))

    def change_feed(self, before: int, after: int, key: str) -> DataFrame:
        """Changes between any two versions: only partitions whose folders differ are read."""
        old, new = self.version(before), self.version(after)
        moved = [p for p in {*old.parts, *new.parts} if old.parts.get(p) != new.parts.get(p)]
        return changes.change_feed(self._rows(old, moved), self._rows(new, moved), key)

    # ------------------------------------------------------------ writing

    def _next(self, operation: str, parts: dict[str, list[str]], schema: str, batch: str | None, base: Version | None) -> Version:
        number = base.number + 1 if base else 0
        return self._publish(Version(number, operation, batch, schema, dict(sorted(parts.items())), time.time()))

    def _newest(self) -> Version | None:
        return self.version() if self.numbers() else None

    def overwrite(self, rows: DataFrame, batch: str | None = None) -> Version:
        base = self._newest()
        return self._next("overwrite", self._write(rows), rows.schema.toDDL(), batch, base)

    def append(self, rows: DataFrame, batch: str | None = None) -> Version:
        base = self._newest()
        if base is None:
            return self.overwrite(rows, batch)
        added, parts = self._write(rows), dict(base.parts)
        for name, folders in added.items():
            parts[name] = parts.get(name, []) + folders
        return self._next("append", parts, base.schema, batch, base)

    def rewrite(self, touched: DataFrame, rebuild: Callable[[DataFrame], DataFrame], operation: str = "rewrite", batch: str | None = None) -> Version:
        """Put rebuild(rows of the touched partitions) in place of those partitions; the others keep their files.

        `touched` lists values of the partition column, as many as there are partitions at most.
        """
        base = self._newest()
        if base is None:
            raise LookupError(f"{self.path} has no version yet")
        names = [row[0] for row in touched.select(self._name(touched.columns[0])).distinct().collect()]
        parts = {name: folders for name, folders in base.parts.items() if name not in names}
        columns = self._rows(base, []).columns
        return self._next(operation, parts | self._write(rebuild(self._rows(base, names)).select(*columns)), base.schema, batch, base)

    def upsert(self, gone: DataFrame, rows: DataFrame, key: str, batch: str | None = None) -> Version | None:
        """Drop the rows of the keys in `gone` (key, partition) and add `rows`, in one version.

        A batch that was applied before changes nothing, so a replay after a crash is safe.
        """
        base = self._newest()
        if base is None:
            return self.overwrite(rows, batch)
        if batch is not None and self.applied(batch):
            return None
        gone, rows = materialize(gone.select(*dict.fromkeys((key, self.partition))).distinct(), "gone"), materialize(rows, "new-rows")
        touched = gone.select(self.partition).unionByName(rows.select(self.partition)).distinct()
        keys = gone.select(key).distinct()
        few = F.broadcast(keys) if fits(keys) else keys
        version = self.rewrite(touched, lambda held: held.join(few, key, "left_anti").unionByName(rows), "upsert", batch)
        discard(gone, rows)
        return version

    def applied(self, batch: str) -> bool:
        """Whether a kept version came from this batch; the newest ones are looked at first."""
        return any(self._manifest(n).batch == batch for n in reversed(self.numbers()))

    def expire(self, keep: int) -> int:
        """Forget all but the newest `keep` versions and delete the folders no kept version names; how many folders went.

        Folders of writers that died or have not published yet are left alone.
        """
        past = self.history()
        old, kept = past[:-keep], past[-keep:]
        used = {folder for v in kept for folders in v.parts.values() for folder in folders}
        dead = {folder for v in old for folders in v.parts.values() for folder in folders} - used
        for v in old:
            self._fs().delete(self._hadoop("versions", f"{v.number:020d}.json"), False)
        for folder in dead:
            self._fs().delete(self._hadoop(folder), True)
        return len(dead)
