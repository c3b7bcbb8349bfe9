"""The task queue as an event log: state is a fold over events, not rows that are overwritten.

Events are (task_id, seq, at, action, token, answer) with action lease or submit.  A lease is
granted when the task is queued or its lease ran out; a submission counts when the task is
leased, the token is the lease's and the lease has not run out.
"""

from __future__ import annotations

import hashlib
import hmac
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.errors import GateError
from sparkloom.functions.identifiers import found_among
from sparkloom.operators.splits import expand_questions

LEASE_SECONDS = 900
LONGEST_QUESTION = 16384
TASKS = "task_id string, run_id string, seed_id string, candidate_index int, question string, state string"


def guard(rows: DataFrame, question: str, identifiers: list[str]) -> DataFrame:
    """``rows`` with ``allowed``: within the length limit, and no private identifier to be seen."""
    shown = found_among(rows.sparkSession, F.col(question), identifiers)
    return rows.withColumn("allowed", (F.length(question) <= LONGEST_QUESTION) & (F.size(shown) == 0))


def plan(seeds: DataFrame, run_id: str, candidates: int, identifiers: list[str]) -> DataFrame:
    """The tasks of a collection: every seed under its transforms; raises if one may not be shown."""
    rows = guard(expand_questions(seeds, "question", candidates), "prompt", identifiers)
    if not rows.where("not allowed").isEmpty():
        raise GateError("a question is too long or shows a private identifier")
    id = F.concat(F.lit("task_"), F.substring(F.sha2(F.concat_ws("|", F.lit(run_id), "seed_id", "candidate_index"), 256), 1, 24))
    return rows.select(id.alias("task_id"), F.lit(run_id).alias("run_id"), "seed_id", "candidate_index", F.col("prompt").alias("question"), F.lit("queued").alias("state"))


def binding_differences(tasks: DataFrame, expected: DataFrame) -> DataFrame:
    """Tasks on one side only: empty when the collection still matches its plan."""
    names = ["seed_id", "candidate_index", "question"]
    a, b = tasks.select(*names), expected.select(*names)
    return a.exceptAll(b).withColumn("side", F.lit("unplanned")).unionByName(b.exceptAll(a).withColumn("side", F.lit("lost")))


def latest(events: DataFrame, key: str, state: str, order: list[str]) -> DataFrame:
    """The last state of each key, by a combined maximum."""
    return events.groupBy(key).agg(F.max_by(state, F.struct(*order)).alias("state"))


def status(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("state").agg(F.count("*").alias("n"))


def lease_report(events: DataFrame, seconds: int) -> DataFrame:
    """By task: leases, submissions, those within ``seconds`` of the lease before, and leases of a
    task whose lease had run out.  One window by task."""
    before = Window.partitionBy("task").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = events.withColumn("last", F.max(F.when(F.col("action") == "lease", F.col("at"))).over(before))
    late = F.col("at") > F.col("last") + seconds
    return rows.groupBy("task").agg(
        F.count_if(F.col("action") == "lease").alias("leases"), F.count_if(F.col("action") == "submit").alias("submits"),
        F.count_if((F.col("action") == "submit") & F.col("last").isNotNull() & ~late).alias("in_time"), F.count_if((F.col("action") == "lease") & late).alias("expired"),
    )


def token_digest(token: str) -> str:
    return hashlib.sha256(token.encode()).hexdigest()


def same_token(token: str, digest: str | None) -> bool:
    """Whether a token is the one of a digest, in a time that does not tell how much of it is right."""
    return digest is not None and hmac.compare_digest(token_digest(token), digest)


class Task:
    """One task's state machine, for the batch fold and for the stream alike."""

    def __init__(self, state: str = "queued", digest: str | None = None, expires: float = 0.0, leases: int = 0, rejected: int = 0, answer: str | None = None):
        self.state, self.digest, self.expires, self.leases, self.rejected, self.answer = state, digest, expires, leases, rejected, answer

    def expire(self, now: float) -> None:
        if self.state == "leased" and self.expires < now:
            self.state, self.digest = "queued", None

    def apply(self, action: str, at: float, token: str | None, answer: str | None, seconds: float) -> bool:
        """Whether the event took effect."""
        self.expire(at)
        if action == "lease" and self.state == "queued":
            self.state, self.digest, self.expires = "leased", token_digest(token or ""), at + seconds
            self.leases += 1
            return True
        if action == "submit" and self.state == "leased" and self.expires >= at and same_token(token or "", self.digest):
            self.state, self.answer, self.digest = "submitted", answer, None
            return True
        self.rejected += 1
        return False

    def row(self) -> tuple:
        return self.state, self.digest, self.expires, self.leases, self.rejected, self.answer


#: A task's state; ``at`` and ``seq`` are those of its last event.
FOLDED = "task_id string, state string, digest string, expires double, leases int, rejected int, answer string, at double, seq long"
RESUME = "resume"


def resumed(start: DataFrame) -> DataFrame:
    """Folded states as events that come before all others of their tasks."""
    held = F.to_json(F.struct("state", "digest", "expires", "leases", "rejected", "answer", "at", "seq"))
    return start.select("task_id", F.lit(float("-inf")).alias("at"), F.lit(-1).cast("long").alias("seq"), F.lit(RESUME).alias("action"), F.lit(None).cast("string").alias("token"), held.alias("answer"))


def fold(events: DataFrame, seconds: float = LEASE_SECONDS, now: float | None = None, start: DataFrame | None = None) -> DataFrame:
    """The state of every task after its events in order of (at, seq), and at the time ``now``, when
    leases may have run out since.  ``start`` holds states (FOLDED) that events are applied to.

    Sorted partitions are streamed, so a task with many events needs no more memory than one
    with few."""
    names = [c.split()[0] for c in FOLDED.split(", ")]

    def run(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, id, last, out = None, None, (0.0, 0), []

        def row() -> tuple:
            if now is not None:
                task.expire(now)
            return id, *task.row(), *last

        for pdf in source:
            for key, at, seq, action, token, answer in zip(pdf.task_id, pdf["at"], pdf.seq, pdf.action, pdf.token, pdf.answer):
                if task is None or key != id:
                    if task is not None:
                        out.append(row())
                    task, id = Task(), key
                if action == RESUME:
                    held = json.loads(answer)
                    last = held.pop("at"), held.pop("seq")
                    task = Task(**held)
                else:
                    task.apply(action, at, token, answer, seconds)
                    last = at, seq
            yield pd.DataFrame(out, columns=names)
            out = []
        if task is not None:
            yield pd.DataFrame([row()], columns=names)

    rows = events.select("task_id", "at", "seq", "action", "token", "answer")
    if start is not None:
        rows = rows.unionByName(resumed(start))
    # dealt by a hash of the id: by the id itself Spark may trust that the sides of the union, joined by it before,
    # are dealt alike already, which adaptive execution can have changed
    return rows.repartition(F.xxhash64("task_id")).sortWithinPartitions("task_id", "at", "seq").mapInPandas(run, FOLDED)


def claim(tasks: DataFrame, n: int = 1) -> DataFrame:
    """Queued tasks at random: what the next leases are for."""
    return tasks.where("state = 'queued'").orderBy(F.rand()).limit(n)


def complete(tasks: DataFrame) -> bool:
    return tasks.where("state <> 'submitted'").isEmpty()
