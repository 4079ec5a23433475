"""Work that is done once: a content-addressed store of model answers, and dead letters that can be replayed.

Both are versioned tables. Model calls go out in slices of bounded size; the results of a slice are written
aside before they are published, so a run that dies loses no answer it has paid for: the next run first adopts
what finished slices left behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.infer import infer_with_retry
from shelfwise.session import fits, materialize, spread_join
from shelfwise.sources.versions import VersionedTable

PARTS = 16
# Prompts per slice: what a crash can have in flight.
SLICE_ROWS = 100_000
MAX_RUNS = 5
BACKOFF_SECONDS = 60
DONE, WAITING, GIVEN_UP = "done", "waiting", "given_up"
ANSWERS = "key string, part int, model_version string, answer string, state string, runs int, error string, retry_at timestamp"
LETTERS = "key string, part int, stage string, pointer string, reason string, attempts int, state string"


def _part(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")


def answer_key(model_version: str, prompt: Column) -> Column:
    """The address of an answer: the model's version and the whole prompt."""
    return F.sha2(F.concat_ws("\n", F.lit(model_version), prompt), 256)


def _among(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    return df.join(F.broadcast(keys) if fits(keys) else keys, "key", how)


@dataclass(frozen=True)
class AnswerStore:
    spark: SparkSession
    path: str
    model_version: str
    max_runs: int = MAX_RUNS
    backoff_seconds: int = BACKOFF_SECONDS
    slice_rows: int = SLICE_ROWS

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.path}/answers", "part")

    def held(self) -> DataFrame:
        return self.table.read() if self.table.numbers() else self.spark.createDataFrame([], ANSWERS)

    def _folder(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/slices")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def adopt(self) -> int:
        """Publish finished slices of earlier runs that are not in the table yet; how many."""
        path, fs = self._folder()
        if not fs.exists(path):
            return 0
        applied = {v.batch for v in self.table.history()}
        names = sorted(status.getPath().getName() for status in fs.listStatus(path))
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        names = [n for n in names if n not in applied and fs.exists(done(f"{self.path}/slices/{n}/_SUCCESS"))]
        for name in names:
            self._publish(name)
        return len(names)

    def _publish(self, name: str) -> None:
        rows = self.spark.read.schema(ANSWERS).parquet(f"{self.path}/slices/{name}")
        self.table.upsert(rows.select("key", "part"), rows, "key", name)

    def due(self, prompts: DataFrame, now: datetime) -> DataFrame:
        """(key, prompt, runs) of distinct prompts without an answer whose waiting time is over."""
        keyed = prompts.filter("prompt IS NOT NULL").select(answer_key(self.model_version, F.col("prompt")).alias("key"), "question_id", "prompt")
        first = keyed.groupBy("key").agg(F.min("question_id").alias("question_id"))
        known = self.held().select("key", "state", "runs", "retry_at")
        wanted = first.join(known, "key", "left").filter(
            F.col("state").isNull() | ((F.col("state") == WAITING) & (F.col("retry_at") <= F.lit(now)))
        )
        wanted = materialize(wanted.select("key", "question_id", F.coalesce("runs", F.lit(0)).alias("runs")), "due")
        # A prompt is read from the row that stands for it; equal rows of one question are one.
        return keyed.join(F.broadcast(wanted) if fits(wanted) else wanted, ["key", "question_id"]).dropDuplicates(["key"])

    def run(self, prompts: DataFrame, model: Callable[[str, int], str], now: datetime, **options) -> int:
        """Answer what is due; `model(prompt, attempt)` may raise. How many prompts were sent.

        A failure waits `backoff_seconds`, doubled with every run, and is given up after `max_runs` runs.
        """
        self.adopt()
        todo = materialize(self.due(prompts, now).select("key", "prompt", "runs"), "todo")
        total = todo.count()
        slices = max(1, -(-total // self.slice_rows))
        for number in range(slices if total else 0):
            part = todo.filter(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(slices)) == number)
            replied = infer_with_retry(part, "prompt", model, max_attempts=1, **options)
            runs = (F.col("runs") + 1).cast("int")
            state = F.when(F.col("status") == "OK", DONE).when(runs >= self.max_runs, GIVEN_UP).otherwise(WAITING)
            wait = F.make_dt_interval(secs=F.lit(self.backoff_seconds) * F.pow(F.lit(2), runs - 1))
            rows = replied.select(
                "key", _part(F.col("key")).alias("part"), F.lit(self.model_version).alias("model_version"), "answer", state.alias("state"),
                runs.alias("runs"), "error", F.when(state == WAITING, F.lit(now) + wait).alias("retry_at"),
            )
            name = uuid.uuid4().hex
            rows.write.parquet(f"{self.path}/slices/{name}")
            self._publish(name)
        return total

    def answers(self, prompts: DataFrame) -> DataFrame:
        """(question_id, answer, state, runs, error) of every prompt; a question without one keeps its fixed answer."""
        named = prompts.select("question_id", F.col("answer").alias("fixed"), F.when(F.col("prompt").isNotNull(), answer_key(self.model_version, F.col("prompt"))).alias("key"))
        known = self.held().select("key", "answer", "state", "runs", "error")
        found = spread_join(named, known, ["key"], ["question_id"], "left", small_fits=fits(known))
        return found.select(
            "question_id", F.coalesce("answer", "fixed").alias("answer"),
            F.when(F.col("key").isNull(), "no_context").otherwise(F.coalesce("state", F.lit("new"))).alias("state"),
            F.coalesce("runs", F.lit(0)).alias("runs"), "error",
        )


@dataclass(frozen=True)
class DeadLetters:
    """Rows that some stage could not handle: where their payload lies, why they failed and how often."""

    spark: SparkSession
    path: str
    max_attempts: int = 3

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(self.spark, self.path, "part")

    def letters(self, stage: str | None = None) -> DataFrame:
        held = self.table.read() if self.table.numbers() else self.spark.createDataFrame([], LETTERS)
        return held if stage is None else held.filter(F.col("stage") == stage)

    def record(self, stage: str, failures: DataFrame, batch: str) -> None:
        """Take failures (key, pointer, reason) of a stage; a batch counts once however often it is delivered."""
        if self.table.numbers() and self.table.applied(batch):
            return
        address = F.sha2(F.concat_ws("\n", F.lit(stage), F.col("key").cast("string")), 256)
        new = failures.select(address.alias("key"), F.lit(stage).alias("stage"), F.col("pointer").cast("string").alias("pointer"), "reason").dropDuplicates(["key"])
        attempts = (F.coalesce("attempts", F.lit(0)) + 1).cast("int")
        state = F.when(attempts >= self.max_attempts, GIVEN_UP).otherwise(WAITING)
        rows = new.join(_among(self.letters().select("key", "attempts"), new.select("key"), "left_semi"), "key", "left").select(
            "key", _part(F.col("key")).alias("part"), "stage", "pointer", "reason", attempts.alias("attempts"), state.alias("state")
        )
        rows = materialize(rows, "letters")
        self.table.upsert(rows.select("key", "part"), rows, "key", batch)

    def replay(self, stage: str, bronze: DataFrame, key: str, step: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
               sink: Callable[[DataFrame, str], None], batch: str) -> int:
        """Run `step` again over the bronze rows whose letters wait; how many were tried.

        `step` gives (good rows, failures with key, pointer, reason). Good rows go to `sink(rows, batch)`, which has to
        apply a batch once; their letters become `done`. Failures count another attempt. A replay that was cut off can
        be run again under the same batch.
        """
        if self.table.applied(f"{batch}/done"):
            return 0
        waiting = materialize(self.letters(stage).filter(F.col("state") == WAITING).select(F.col("pointer").alias("_pointer")), "waiting")
        if waiting.isEmpty():
            return 0
        few = F.broadcast(waiting) if fits(waiting) else waiting
        held = materialize(bronze.join(few, F.col(key).cast("string") == F.col("_pointer"), "left_semi"), "replayed")
        good, failed = step(held)
        good, failed = materialize(good, "good"), materialize(failed, "failed")
        sink(good, batch)
        bad = failed.select(F.col("pointer").cast("string").alias("pointer"))
        ok = waiting.join(held.select(F.col(key).cast("string").alias("_pointer")), "_pointer", "left_semi").join(bad, F.col("_pointer") == bad["pointer"], "left_anti")
        self.record(stage, failed, f"{batch}/failed")
        solved = materialize(self.letters(stage).join(ok, F.col("pointer") == ok["_pointer"], "left_semi").withColumn("state", F.lit(DONE)), "solved")
        self.table.upsert(solved.select("key", "part"), solved, "key", f"{batch}/done")
        return held.count()
