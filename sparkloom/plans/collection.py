"""A collection: the tasks of a run handed out to workers and taken back, until the run is compiled.

A collection is a folder: its state, the sealed tasks, and an append-only log of events with snapshots, from which
the state of every task is folded.  States: collecting, ready (all tasks are submitted), finalizing,
finalized, failed.  Each change of state is one file replaced as a whole, so that a finalization
that died can be told from one that ended, and taken up again by ``recover``.
"""

from __future__ import annotations

import secrets
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.config import safe_identifier
from sparkloom.errors import ConfigurationError, EngineError, GateError, ImmutableArtifactError
from sparkloom.operators import broker, doctor
from sparkloom.plans import compile as runs
from sparkloom.plans.eventlog import EVENTS, EventLog
from sparkloom.sources import providers
from sparkloom.sources.jsonl import read_jsonl
from sparkloom.sources.sinks import Files

SUBMISSIONS = "task_id string, token string, derivation array<string>, answer string"
#: What a submission holds: the older one had no derivation.
CONTRACT, OLDER_CONTRACT = "derivation-and-answer", "answer-only"
#: Events that a driver writes as one file.
MOST_LEASES = 100_000


def folder(spark: SparkSession, root: str, run_id: str) -> Files:
    return Files(spark, f"{root}/collections/{safe_identifier(run_id, 'run id')}")


def identifiers(ws: doctor.Workspace) -> list[str]:
    """All that a worker must not see: ids of sources, teachers, anchors."""
    names = {s["source_id"] for s in ws.rows("sources")} | {t["teacher_id"] for t in ws.rows("teachers")}
    return sorted(names | {i for v in doctor.private_identifiers(ws.rows("anchors")).values() for i in v})


def shown_ids(ws: doctor.Workspace, tasks: DataFrame) -> DataFrame:
    """Tasks whose question shows an id of a seed, lineage or protected item; a join on words, as these
    ids are many."""
    ids = ws.seeds.select(F.explode(F.array("seed_id", "lineage_id")).alias("id")).union(ws.benchmarks.select("benchmark_id"))
    ids = ids.select(F.lower("id").alias("id")).distinct()
    words = tasks.select("task_id", F.explode(F.array_distinct(F.split(F.lower("question"), r"[^\w.:-]+"))).alias("w"))
    words = words.select("task_id", F.explode(F.array_distinct(F.array("w", F.regexp_replace("w", r"^[.:-]+|[.:-]+$", "")))).alias("w"))
    return words.join(ids, F.col("w") == F.col("id"), "left_semi").select("task_id").distinct()


def create(ws: doctor.Workspace, root: str, run_id: str) -> dict:
    """Seal a workspace's inputs and write the tasks of a new collection."""
    spark = ws.seeds.sparkSession
    files = folder(spark, root, run_id)
    failed = [f"{x['gate']}: {x['detail']}" for x in doctor.doctor(ws) if x["status"] == "fail"]
    if failed:
        raise ConfigurationError("the workspace fails its checks: " + "; ".join(failed))
    if Files(spark, f"{root}/runs").exists(run_id):
        raise ImmutableArtifactError(f"there is a run of this id: {run_id}")
    inputs = runs.input_hashes(ws)
    tasks = broker.plan(ws.seeds, run_id, ws.config.generation.candidates_per_seed, identifiers(ws))
    if not shown_ids(ws, tasks).isEmpty():
        raise GateError("a question shows the id of a seed, a lineage or a protected item")
    files.make(fresh=True)
    tasks.write.parquet(f"{files.root}/tasks.parquet")
    if runs.input_hashes(ws) != inputs:
        files.delete()
        raise GateError("the inputs changed while the collection was made")
    count = spark.read.parquet(f"{files.root}/tasks.parquet").count()
    state = {"run_id": run_id, "state": "collecting", "expected": count, "created_at": runs.utc_now(), "finalized_at": None, "failure": None, "inputs": inputs, "contract": CONTRACT}
    files.write_json("state.json", state)
    return status(spark, root, run_id)


def state_of(spark: SparkSession, root: str, run_id: str) -> dict:
    files = folder(spark, root, run_id)
    if not files.exists("state.json"):
        raise ConfigurationError(f"unknown collection: {run_id}")
    return files.read_json("state.json")


def change(spark: SparkSession, root: str, run_id: str, **values) -> dict:
    state = state_of(spark, root, run_id) | values
    folder(spark, root, run_id).write_json("state.json", state)
    return state


def log(spark: SparkSession, root: str, run_id: str, seconds: float = broker.LEASE_SECONDS) -> EventLog:
    """The collection's events; under the current contract, submissions of the older one do not count."""
    contract = state_of(spark, root, run_id)["contract"]
    accepts = None if contract == OLDER_CONTRACT else F.expr("action <> 'submit' or get_json_object(answer, '$.derivation') is not null")
    return EventLog(spark, folder(spark, root, run_id), seconds, contract, accepts)


def events(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """The whole history of events that count."""
    return log(spark, root, run_id).history()


def append(spark: SparkSession, root: str, run_id: str, rows: DataFrame) -> None:
    log(spark, root, run_id).append(rows)


def tasks(spark: SparkSession, root: str, run_id: str, seconds: float = broker.LEASE_SECONDS, now: float | None = None) -> DataFrame:
    """The tasks with their state, leases, rejected events and answer, as of ``now``."""
    folded = log(spark, root, run_id, seconds).folded(time.time() if now is None else now)
    folded = folded.select(F.col("task_id").alias("__t"), F.col("state").alias("__s"), "leases", "rejected", F.col("answer").alias("submitted"))
    rows = spark.read.parquet(f"{folder(spark, root, run_id).root}/tasks.parquet")
    rows = rows.join(folded, F.col("task_id") == F.col("__t"), "left").withColumn("state", F.coalesce("__s", "state"))
    return rows.drop("__t", "__s")


def lease(spark: SparkSession, root: str, run_id: str, n: int = 1, seconds: float = broker.LEASE_SECONDS, now: float | None = None) -> list[dict]:
    """Up to ``n`` queued tasks, drawn at random: task_id, question, token and the time it ends.

    A worker sees the question alone.  Of two leases of a task at once, the earlier event holds,
    and the other's submission is refused."""
    now = time.time() if now is None else now
    if n > MOST_LEASES:
        raise ConfigurationError(f"at most {MOST_LEASES} leases at a time")
    if state_of(spark, root, run_id)["state"] != "collecting":
        return []
    log(spark, root, run_id, seconds).snapshot_if_due()
    got = broker.claim(tasks(spark, root, run_id, seconds, now), n).select("task_id", "question").collect()
    out = [{"task_id": r.task_id, "question": r.question, "token": secrets.token_urlsafe(32), "expires_at": now + seconds} for r in got]
    if out:
        rows = [(x["task_id"], time.time_ns(), now, "lease", x["token"], None) for x in out]
        append(spark, root, run_id, spark.createDataFrame(rows, EVENTS))
    return out


def submit(spark: SparkSession, root: str, run_id: str, submissions: DataFrame, seconds: float = broker.LEASE_SECONDS, now: float | None = None) -> dict:
    """Take submissions (task_id, token, derivation, answer) in: how many came and how many count now.

    Blank ones, ones for unknown tasks and ones without a valid lease do not count, and are told
    apart by nothing.  The collection is ready when all its tasks are submitted."""
    now = time.time() if now is None else now
    steps = F.transform("derivation", lambda s: F.trim(s))
    rows = submissions.select("task_id", "token", steps.alias("derivation"), F.trim("answer").alias("answer"))
    rows = rows.where((F.col("answer") != "") & (F.size("derivation") > 0) & F.forall("derivation", lambda s: s != ""))
    answer = F.to_json(F.struct("answer", "derivation"))
    rows = rows.select("task_id", F.lit(time.time_ns()).alias("seq"), F.lit(now).alias("at"), F.lit("submit").alias("action"), "token", answer.alias("answer"))
    before = submitted_count(spark, root, run_id, seconds, now)
    append(spark, root, run_id, rows)
    after = submitted_count(spark, root, run_id, seconds, now)
    state = state_of(spark, root, run_id)
    if state["state"] == "collecting" and after == state["expected"]:
        change(spark, root, run_id, state="ready")
    return {"submitted": after, "accepted": after - before}


def submitted_count(spark: SparkSession, root: str, run_id: str, seconds: float, now: float) -> int:
    return tasks(spark, root, run_id, seconds, now).where("state = 'submitted'").count()


def status(spark: SparkSession, root: str, run_id: str, now: float | None = None) -> dict:
    """The collection's state, its tasks by state, and the run's state where there is one."""
    state = {k: v for k, v in state_of(spark, root, run_id).items() if k != "inputs"}
    counts = {r.state: r.n for r in broker.status(tasks(spark, root, run_id, now=now)).collect()}
    run = Files(spark, f"{root}/runs/{run_id}")
    return state | {s: counts.get(s, 0) for s in ("queued", "leased", "submitted")} | {"run": run.read_json("state.json") if run.exists("state.json") else None}


def binding(ws: doctor.Workspace, root: str, run_id: str, state: dict) -> None:
    """The inputs and the tasks are those that were sealed."""
    spark = ws.seeds.sparkSession
    if state["inputs"] != runs.input_hashes(ws):
        raise GateError("the inputs differ from those of the collection")
    held = spark.read.parquet(f"{folder(spark, root, run_id).root}/tasks.parquet")
    expected = broker.plan(ws.seeds, run_id, ws.config.generation.candidates_per_seed, [])
    if held.count() != state["expected"] or not broker.binding_differences(held, expected).isEmpty():
        raise GateError("the tasks differ from the plan of the seeds")


def finalize(ws: doctor.Workspace, root: str, run_id: str) -> dict:
    """Compile the run of a ready collection.  Whatever stops it is written down with the state."""
    spark = ws.seeds.sparkSession
    state = state_of(spark, root, run_id)
    if state["state"] != "ready":
        raise ConfigurationError(f"the collection is {state['state']}, not ready")
    if state["contract"] != CONTRACT:
        raise ConfigurationError("the collection is of an older contract: migrate it")
    try:
        binding(ws, root, run_id, state)
        change(spark, root, run_id, state="finalizing", failure=None)
        rows = tasks(spark, root, run_id)
        body = F.from_json("submitted", "answer string, derivation array<string>")
        responses = rows.select("seed_id", "candidate_index", body.alias("b")).select("seed_id", "candidate_index", "b.derivation", "b.answer")
        outputs = providers.collected(ws.seeds, responses, ws.config.generation.candidates_per_seed)
        manifest = runs.generate(ws, root, run_id, outputs)
        if manifest["inputs"] != state["inputs"]:
            raise GateError("the run was made from other inputs than the collection")
        runs.assert_sealed(ws, root, run_id)
    except Exception as e:
        change(spark, root, run_id, state="failed", failure=f"{type(e).__name__}: {str(e)[:500]}")
        raise
    change(spark, root, run_id, state="finalized", finalized_at=runs.utc_now())
    return status(spark, root, run_id)


def names(spark: SparkSession, root: str) -> list[str]:
    files = Files(spark, f"{root}/collections")
    return [n for n in files.names() if files.exists(f"{n}/state.json")] if files.exists() else []


def recover(ws: doctor.Workspace, root: str) -> dict[str, str]:
    """Settle finalizations that died: with whole and sealed artifacts they are done, with none they
    are ready again, with anything between they have failed.  The new state of each."""
    spark, out = ws.seeds.sparkSession, {}
    for run_id in names(spark, root):
        if state_of(spark, root, run_id)["state"] != "finalizing":
            continue
        run = Files(spark, f"{root}/runs/{run_id}")
        if not run.exists():
            values = {"state": "ready", "failure": None}
        elif not run.exists("state.json"):
            values = {"state": "failed", "failure": "the finalization left artifacts of a part of the run"}
        else:
            try:
                runs.assert_sealed(ws, root, run_id)
                runs.load_state(spark, root, run_id)
                values = {"state": "finalized", "finalized_at": runs.utc_now(), "failure": None}
            except (EngineError, OSError, ValueError, KeyError) as e:
                values = {"state": "failed", "failure": f"the finalization left invalid artifacts: {e}"}
        out[run_id] = change(spark, root, run_id, **values)["state"]
    return out


def migrate(spark: SparkSession, root: str) -> dict[str, int]:
    """Bring collections of older layouts to the current one; how many tasks of each are queued again.

    Missing fields get their defaults.  Open collections of the older contract move to the
    current one, and their tasks whose submission has no derivation are open once more.  A second
    run changes nothing."""
    out = {}
    for run_id in names(spark, root):
        state = state_of(spark, root, run_id)
        full = {"failure": None, "finalized_at": None, "inputs": None, "contract": OLDER_CONTRACT} | state
        if full["contract"] == OLDER_CONTRACT and full["state"] in ("collecting", "ready"):
            folder(spark, root, run_id).write_json("state.json", full)
            bare = tasks(spark, root, run_id).where("state = 'submitted'").select("task_id")
            full |= {"state": "collecting", "contract": CONTRACT, "failure": None}
            folder(spark, root, run_id).write_json("state.json", full)
            still = tasks(spark, root, run_id).where("state <> 'submitted'")
            out[run_id] = still.join(bare, "task_id", "left_semi").count()
        elif full != state:
            folder(spark, root, run_id).write_json("state.json", full)
            out[run_id] = 0
    return out


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, SUBMISSIONS)

