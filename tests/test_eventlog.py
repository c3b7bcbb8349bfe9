"""The log of events: snapshots, tails, late events, and deaths between the steps of a snapshot."""

import random

import pytest

from sparkloom.errors import ImmutableArtifactError
from sparkloom.operators import broker
from sparkloom.plans import eventlog
from sparkloom.sources.sinks import Files


def made(r, n, start, tasks=12):
    """Events of times in order from ``start`` on; leases of some tokens, and submissions with right and wrong ones."""
    return [(f"t{r.randrange(tasks)}", start + i, float(100 * (start + i)), r.choice(("lease", "lease", "submit")), f"k{r.randrange(2)}", f"a{i}") for i in range(n)]


def states(df):
    return {x.task_id: (x.state, x.leases, x.rejected, x.answer) for x in df.collect()}


def model(rows, seconds=900, now=None):
    out = {}
    for id, seq, at, action, token, answer in sorted(rows, key=lambda e: (e[2], e[1])):
        out.setdefault(id, broker.Task()).apply(action, at, token, answer, seconds)
    for t in out.values():
        if now is not None:
            t.expire(now)
    return {k: (t.state, t.leases, t.rejected, t.answer) for k, t in out.items()}


@pytest.fixture
def log(spark, tmp_path):
    return eventlog.EventLog(spark, Files(spark, str(tmp_path)), 900)


def put(log, rows):
    log.append(log.spark.createDataFrame(rows, eventlog.EVENTS))


def test_snapshots_and_tails(spark, log):
    """After every part, with and without a snapshot, late events among them, the state is that of the whole history."""
    r, all_ = random.Random(1), []
    assert states(log.folded()) == {} and log.snapshot(0) is None
    for part in range(5):
        rows = made(r, 40, 40 * part)
        if part in (2, 4):  # half an hour late, and for a task of which nobody has heard
            rows += [(f"t{r.randrange(12)}", 10_000 + part * 10 + i, float(100 * (40 * part - 18 - i)), "lease", "late", None) for i in range(3)] + [(f"new{part}", 0, 5.0, "lease", "k", None)]
        put(log, rows)
        all_ += rows
        assert states(log.folded()) == model(all_) and states(log.folded(now=1e6)) == model(all_, now=1e6)
        if part != 3:
            assert log.snapshot(grace=0) and log.pending() == []
            assert states(log.folded()) == model(all_)
    assert len(log.names("snapshots")) == eventlog.KEPT and len(log.names("archive")) == 3
    assert log.history().count() == len(all_)


def test_young_folders_wait(spark, log):
    put(log, made(random.Random(2), 20, 0))
    assert log.snapshot(grace=60) is None and len(log.pending()) == 1


def test_another_rule_does_not_use_a_snapshot(spark, log):
    r = random.Random(3)
    rows = made(r, 60, 0)
    for lo in (0, 30):
        put(log, rows[lo : lo + 30])
        log.snapshot(grace=0)
    from pyspark.sql import functions as F

    leases = eventlog.EventLog(spark, log.files, 900, "leases", F.expr("action = 'lease'"))
    assert len(leases.pending()) == 2 and states(leases.folded()) == model([x for x in rows if x[3] == "lease"])


@pytest.mark.parametrize("dies_at", [1, 2, 3])
def test_death_between_the_steps(spark, log, monkeypatch, dies_at):
    """The renames of a snapshot: two folders to the archive, then the snapshot itself.  A death at any leaves the state as it
    was, and the next snapshot goes through."""
    r, all_ = random.Random(4), []
    for part in range(2):
        put(log, rows := made(r, 20, 20 * part))
        all_ += rows
    log.snapshot(grace=0)
    put(log, rows := made(r, 20, 40))
    all_ += rows
    calls, rename = [], Files.rename

    def dying(self, old, new):
        calls.append(new)
        if len(calls) == dies_at:
            raise OSError("died")
        return rename(self, old, new)

    monkeypatch.setattr(Files, "rename", dying)
    with pytest.raises(OSError, match="died"):
        log.snapshot(grace=0)
    monkeypatch.setattr(Files, "rename", rename)
    assert len(calls) == dies_at and states(log.folded()) == model(all_) and len(log.pending()) == 1
    assert log.snapshot(grace=0) == 2 and states(log.folded()) == model(all_)
    put(log, rows := made(r, 20, 60))
    all_ += rows
    assert log.snapshot(grace=0) == 3 and states(log.folded()) == model(all_) and log.history().count() == len(all_)


def test_of_two_snapshots_at_once_one_fails(spark, log, monkeypatch):
    put(log, rows := made(random.Random(5), 20, 0))
    other, rename, inside = eventlog.EventLog(spark, log.files, 900), Files.rename, []

    def slow(self, old, new):
        if new.startswith("snapshots/") and not inside:
            inside.append(new)
            assert other.snapshot(grace=0) == 1
        return rename(self, old, new)

    monkeypatch.setattr(Files, "rename", slow)
    with pytest.raises(ImmutableArtifactError):
        log.snapshot(grace=0)
    assert states(log.folded()) == model(rows) and log.names("snapshots") == ["000000000001"]


def test_what_a_read_opens_does_not_grow(spark, log):
    r = random.Random(6)
    for part in range(6):
        put(log, made(r, 5, 5 * part))
        log.snapshot(grace=0)
        put(log, made(r, 5, 1000 + 5 * part))
        assert len(log.pending()) == 1 and len(log.folded().inputFiles()) <= 1 + 2 * spark.sparkContext.defaultParallelism
