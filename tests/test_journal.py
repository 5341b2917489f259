"""Calls that survive lost tasks, and a rate that all tasks share."""

import os
import time

import pytest

from litsieve.operators.journal import ReplyJournal, ask_once, call_journalled
from litsieve.operators.providers import CallPolicy, call_records

RESULT = "n long, note string"
TEXTS = ["a", "bb", "bb", "", None, "ccc", "dddd", "é<>\n", "a"]


def records(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "seq long, text string")


def counted(calls: str, stop: str | None = None, kill: str | None = None):
    """A callable that notes every call in a file of its own process."""

    def call(record):
        text = record["text"]
        with open(calls, "a") as out:
            out.write(f"{text!r} {time.time()}\n")
        if stop and text == stop:
            raise ValueError("refused")
        if kill and text == kill:
            os._exit(1)
        return {"n": len(text or ""), "note": text}

    return call


def noted(calls) -> list[str]:
    return [line.rsplit(" ", 1)[0] for line in calls.read_text().splitlines()]


def test_equal_requests_are_asked_once(spark, tmp_path):
    journal, calls = ReplyJournal(str(tmp_path / "replies")), tmp_path / "calls"
    got = call_journalled(records(spark), "reply", ["text"], RESULT, counted(str(calls)), journal)
    rows = {r.seq: (r.text, r.reply.n, r.reply.note) for r in got.collect()}
    assert rows == {i: (t, len(t or ""), t) for i, t in enumerate(TEXTS)}
    assert sorted(noted(calls)) == sorted(map(repr, set(TEXTS)))
    # New texts alone are asked for in a later run; columns of the records may bear any name.
    more = records(spark, [*TEXTS, "new"]).withColumnRenamed("seq", "bucket")
    again = call_journalled(more, "reply", ["text"], RESULT, counted(str(calls)), journal)
    assert again.count() == len(TEXTS) + 1 and again.columns == ["bucket", "text", "reply"]
    assert noted(calls).count("'new'") == 1 and len(noted(calls)) == len(set(TEXTS)) + 1
    assert ask_once(records(spark, []), ["text"], counted(str(calls)), ReplyJournal(str(tmp_path / "none"))) == 0


@pytest.mark.parametrize("how, batch", [("stop", 16), ("kill", 1)])
def test_lost_task_asks_nothing_twice(spark, tmp_path, how, batch):
    texts = [f"t{i}" for i in range(40)]
    journal, calls = ReplyJournal(str(tmp_path / "replies"), batch), tmp_path / "calls"
    one = CallPolicy(concurrency=1)
    with pytest.raises(Exception):
        ask_once(records(spark, texts), ["text"], counted(str(calls), **{how: "t20"}), journal, one)
    before = noted(calls)
    assert "'t20'" in before
    ask_once(records(spark, texts), ["text"], counted(str(calls)), journal, one)
    after = noted(calls)
    assert set(after) == set(map(repr, texts))
    # Only the call that ended the first attempt is made again.
    assert len(after) == len(texts) + 1 and after.count("'t20'") == 2


def test_attempt_reads_its_buckets_first(spark, tmp_path):
    """What an earlier attempt of the same task has written is seen inside the task."""
    from litsieve.operators import journal as module

    journal, calls = ReplyJournal(str(tmp_path / "replies")), tmp_path / "calls"
    ask_once(records(spark), ["text"], counted(str(calls)), journal)
    digest = module.request_digest(["text"])
    rows = records(spark).select(digest.alias("digest"), "text", module.F.pmod(module.F.xxhash64("digest"), module.F.lit(64)).cast("int").alias("bucket"))
    asked = rows.mapInArrow(module._asked(counted(str(calls)), ["text"], CallPolicy(), journal), "asked long")
    assert sum(r.asked for r in asked.collect()) == 0
    assert len(noted(calls)) == len(set(TEXTS))


def test_rate_over_all_tasks(spark, tmp_path):
    calls, policy = tmp_path / "calls", CallPolicy(concurrency=4, rate=20.0)
    call_records(records(spark, [str(i) for i in range(24)]), "reply", ["text"], RESULT, counted(str(calls)), policy).collect()
    times = sorted(float(line.rsplit(" ", 1)[1]) for line in calls.read_text().splitlines())
    assert len(times) == 24
    # Tasks start together within some tenths of a second; a second never holds twice its share.
    assert max(sum(t <= x < t + 1 for x in times) for t in times) <= 30
    assert policy.interval == 0.2 and CallPolicy(min_interval=0.1).interval == 0.1
    with pytest.raises(ValueError):
        CallPolicy(rate=1.0)
