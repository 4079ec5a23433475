"""Answers are paid for once; dead letters are replayed once."""

from __future__ import annotations

import glob
import tempfile
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import store
from shelfwise.operators.store import AnswerStore, DeadLetters
from shelfwise.session import scratch_dir
from shelfwise.sources.versions import VersionedTable

NOW = datetime(2024, 3, 1)
PROMPTS = "question_id long, prompt string, answer string"


def prompts(spark, n=12):
    rows = [(i, f"prompt {i % 8}", None) for i in range(n)] + [(100, None, "nothing found"), (101, "", None)]
    return spark.createDataFrame(rows, PROMPTS)


def counting(bad=(), folder=None):
    """A model that fails for some prompts, and the folder that holds a file per call."""
    folder = folder or tempfile.mkdtemp(prefix="calls-")

    def model(prompt: str, attempt: int) -> str:
        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        if prompt in bad:
            raise RuntimeError("busy")
        return prompt.upper()

    return model, lambda: len(glob.glob(f"{folder}/*"))


def states(answers):
    return {r.question_id: (r.answer, r.state, r.runs) for r in answers.collect()}


def test_a_second_run_calls_nothing(spark):
    held = AnswerStore(spark, scratch_dir(spark, "answers"), "m1", slice_rows=3)
    model, calls = counting()
    assert held.run(prompts(spark), model, NOW) == 9 == calls()
    assert held.run(prompts(spark), model, NOW) == 0 and calls() == 9
    found = states(held.answers(prompts(spark)))
    assert found[9] == found[1] == ("PROMPT 1", "done", 1) and found[100] == ("nothing found", "no_context", 0) and found[101] == ("", "done", 1)
    other = AnswerStore(spark, held.path, "m2")
    assert states(other.answers(prompts(spark)))[1] == (None, "new", 0)
    assert other.run(prompts(spark).filter("question_id = 1"), model, NOW) == 1
    assert states(held.answers(prompts(spark)))[1] == ("PROMPT 1", "done", 1)


def test_failures_wait_and_are_given_up(spark):
    held = AnswerStore(spark, scratch_dir(spark, "answers"), "m1", max_runs=3, backoff_seconds=60)
    model, calls = counting(bad=("prompt 2", "prompt 5"))
    few = prompts(spark, 8).filter("question_id < 8")
    assert held.run(few, model, NOW) == 8
    assert states(held.answers(few))[2] == (None, "waiting", 1)
    assert held.run(few, model, NOW + timedelta(seconds=59)) == 0
    fixed, _ = counting(bad=("prompt 2",))
    assert held.run(few, fixed, NOW + timedelta(seconds=61)) == 2
    assert states(held.answers(few))[5] == ("PROMPT 5", "done", 2)
    assert held.run(few, fixed, NOW + timedelta(seconds=61 + 119)) == 0  # the waiting time doubles
    assert held.run(few, fixed, NOW + timedelta(seconds=61 + 121)) == 1
    assert states(held.answers(few))[2] == (None, "given_up", 3)
    assert held.run(few, fixed, NOW + timedelta(days=9)) == 0


def test_a_crash_loses_no_answer(spark, monkeypatch):
    held = AnswerStore(spark, scratch_dir(spark, "answers"), "m1", slice_rows=4)
    model, calls = counting()
    seen = []

    def die(self, name):
        seen.append(name)
        if len(seen) == 2:
            raise KeyboardInterrupt
        return publish(self, name)

    publish = AnswerStore._publish
    monkeypatch.setattr(AnswerStore, "_publish", die)
    with pytest.raises(KeyboardInterrupt):
        held.run(prompts(spark), model, NOW)
    paid = calls()
    assert 0 < paid < 9
    monkeypatch.setattr(AnswerStore, "_publish", publish)
    assert held.run(prompts(spark), model, NOW) == 9 - paid
    assert calls() == 9 and all(s[1] in ("done", "no_context") for s in states(held.answers(prompts(spark))).values())


def split(fails):
    """A step whose decoder cannot handle some keys."""

    def step(rows):
        bad = F.col("id").isin(*fails) if fails else F.lit(False)
        return rows.filter(~bad), rows.filter(bad).select(F.col("id").alias("key"), F.col("id").alias("pointer"), F.lit("no codec").alias("reason"))

    return step


def test_replay_empties_the_table_and_repeats_nothing(spark):
    bronze = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "id long, body string")
    letters = DeadLetters(spark, scratch_dir(spark, "letters"))
    silver = VersionedTable(spark, scratch_dir(spark, "silver"), "id")

    def sink(rows, batch):
        silver.upsert(rows, rows, "id", batch)

    good, bad = split((3, 4, 5))(bronze)
    sink(good, "first")
    letters.record("parse", bad, "first")
    letters.record("parse", bad, "first")  # delivered again
    assert {r.attempts for r in letters.letters().collect()} == {1}
    assert letters.replay("parse", bronze, "id", split((4, 5)), sink, "r1") == 3
    assert {(r.pointer, r.state, r.attempts) for r in letters.letters().collect()} == {("3", "done", 1), ("4", "waiting", 2), ("5", "waiting", 2)}
    assert letters.replay("parse", bronze, "id", split((4, 5)), sink, "r1") == 0
    assert letters.replay("parse", bronze, "id", split((5,)), sink, "r2") == 2
    assert {(r.pointer, r.state) for r in letters.letters().collect()} == {("3", "done"), ("4", "done"), ("5", "given_up")}
    assert letters.replay("parse", bronze, "id", split(()), sink, "r3") == 0
    assert sorted(r.id for r in silver.read().collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 9]
    letters.record("chunk", bad, "other stage")
    assert letters.letters("chunk").count() == 3 and letters.letters("parse").filter("state = 'waiting'").isEmpty()


def test_a_replay_cut_off_before_its_end_can_run_again(spark, monkeypatch):
    bronze = spark.createDataFrame([(i, f"t{i}") for i in range(4)], "id long, body string")
    letters = DeadLetters(spark, scratch_dir(spark, "letters"))
    silver = VersionedTable(spark, scratch_dir(spark, "silver"), "id")
    letters.record("parse", split((0, 1, 2, 3))(bronze)[1], "first")

    def sink(rows, batch):
        silver.upsert(rows, rows, "id", batch)

    with monkeypatch.context() as patch:
        patch.setattr(DeadLetters, "record", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            letters.replay("parse", bronze, "id", split((2,)), sink, "r1")
    assert letters.replay("parse", bronze, "id", split((2,)), sink, "r1") == 4
    assert sorted(r.id for r in silver.read().collect()) == [0, 1, 3]
    assert {(r.pointer, r.state) for r in letters.letters().collect()} == {("0", "done"), ("1", "done"), ("2", "waiting"), ("3", "done")}
    assert store.DONE == "done"
