"""The command line: ``python -m sparkloom COMMAND``.  Results go to standard output as JSON, errors to
standard error with exit code 1."""

from __future__ import annotations

import argparse
import contextlib
import json
import sys
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sparkloom import service
from sparkloom.errors import EngineError
from sparkloom.functions.canonical import canonical_json
from sparkloom.operators import calibration, doctor
from sparkloom.plans import collection, release
from sparkloom.plans import compile as runs
from sparkloom.sources import fixtures, workspace
from sparkloom.sources.jsonl import read_jsonl
from sparkloom.sources.sinks import Files

#: Review packets as they come back from people.
PACKETS = (
    "record_id string, candidate_sha256 string, question string, derivation array<string>, final_answer string, category string, "
    "behavior_anchors array<struct<anchor_id:string,domain:string,principle:string,source_ref:string,source_sha256:string>>, decision string, reviewer string, "
    "rationale string, derivation_verified boolean, behavior_alignment_verified boolean, reviewed_at string"
)


def say(value: object) -> None:
    print(value if isinstance(value, str) else json.dumps(value, indent=2, sort_keys=True, default=str))


def init(spark: SparkSession, a: argparse.Namespace) -> bool:
    say(f"initialized {workspace.scaffold(spark, a.path)}")
    say("the teacher's authorization is open by design: edit registry/teachers.yaml")
    return True


def check(spark: SparkSession, a: argparse.Namespace) -> bool:
    checks = doctor.doctor(workspace.load(spark, a.path), a.provider)
    for x in checks:
        say(f"{x['status'].upper():4} {x['gate']}: {x['detail']}")
    return doctor.passed(checks)


def generate(spark: SparkSession, a: argparse.Namespace) -> bool:
    runs.generate(workspace.load(spark, a.path), a.path, a.run_id, provider_id=a.provider)
    say(runs.load_state(spark, a.path, a.run_id))
    return True


def review_export(spark: SparkSession, a: argparse.Namespace) -> bool:
    packets = runs.export_review(workspace.load(spark, a.path), a.path, a.run_id)
    head, _, tail = a.destination.rpartition("/")
    rows = packets.select("record_id", canonical_json(F.struct(*sorted(packets.columns)), keep_nulls=True).alias("line"))
    Files(spark, head or ".").write_lines(tail, rows, "line", "record_id")
    say(a.destination)
    return True


def review_import(spark: SparkSession, a: argparse.Namespace) -> bool:
    runs.import_review(workspace.load(spark, a.path), a.path, a.run_id, read_jsonl(spark, a.decisions, PACKETS))
    say(runs.load_state(spark, a.path, a.run_id))
    return True


def review_all(spark: SparkSession, a: argparse.Namespace) -> bool:
    ws = workspace.load(spark, a.path)
    runs.approve_all(ws, a.path, a.run_id, a.reviewer, a.rationale, a.acknowledge_manual_review, a.acknowledge_derivation_verification, a.acknowledge_behavior_alignment)
    say(runs.load_state(spark, a.path, a.run_id))
    return True


def build(spark: SparkSession, a: argparse.Namespace) -> bool:
    path = release.build(workspace.load(spark, a.path), a.path, a.run_id)
    say({"release": path, "anchor_sha256": release.anchor(Files(spark, path))})
    return True


def verify(spark: SparkSession, a: argparse.Namespace) -> bool:
    out = release.verify(spark, f"{a.path}/releases/{a.version}", a.expected_sha256, a.allow_unanchored)
    say(out)
    return out["passed"]


def status(spark: SparkSession, a: argparse.Namespace) -> bool:
    root = Files(spark, a.path)
    listed = lambda name: [n for n in root.names(name) if not n.startswith(".")] if root.exists(name) else []
    states = [root.read_json(f"runs/{n}/state.json") for n in listed("runs") if root.exists(f"runs/{n}/state.json")]
    say({"runs": states, "releases": listed("releases"), "collections": [collection.status(spark, a.path, n) for n in collection.names(spark, a.path)]})
    return True


def collect(spark: SparkSession, a: argparse.Namespace) -> bool:
    """The queue, step by step: create, lease, submit, status, finalize, recover, migrate."""
    need = {"create": (), "lease": (), "submit": ("submissions",), "status": (), "finalize": (), "recover": (), "migrate": ()}[a.step]
    if lost := [n for n in need if getattr(a, n) is None]:
        raise EngineError(f"{a.step} needs --{lost[0]}")
    ws = lambda: workspace.load(spark, a.path)
    steps: dict[str, Callable[[], object]] = {
        "create": lambda: collection.create(ws(), a.path, a.run_id), "lease": lambda: collection.lease(spark, a.path, a.run_id, a.count, a.seconds),
        "submit": lambda: collection.submit(spark, a.path, a.run_id, collection.read_submissions(spark, a.submissions), a.seconds),
        "status": lambda: collection.status(spark, a.path, a.run_id), "finalize": lambda: collection.finalize(ws(), a.path, a.run_id),
        "recover": lambda: collection.recover(ws(), a.path), "migrate": lambda: collection.migrate(spark, a.path),
    }
    say(steps[a.step]())
    return True


def serve(spark: SparkSession, a: argparse.Namespace) -> bool:
    """One plane, until it is interrupted; its token comes from the environment."""
    agent = a.plane == "agent"
    token = service.token_of(service.AGENT_TOKEN if agent else service.CONTROL_TOKEN)
    settings = service.Settings(a.path, token if agent else None, None if agent else token, a.lease_seconds)
    with service.server(spark, a.plane, settings, a.host, a.port) as s:
        say(f"serving the {a.plane} plane on {s.server_address[0]}:{s.server_address[1]}")
        with contextlib.suppress(KeyboardInterrupt):
            s.serve_forever()
    return True


def pilot(spark: SparkSession, a: argparse.Namespace) -> bool:
    """The calibration: tasks leased blind, solved, submitted and compiled; it stops before review."""
    say(calibrate(spark, a.path, a.size, a.run_id))
    return True


def calibrate(spark: SparkSession, root: str, size: int, run_id: str) -> dict:
    """Create a calibration workspace, send all its tasks through the queue, and report."""
    workspace.save(fixtures.calibration_workspace(spark, size), root)
    ws = workspace.load(spark, root)
    expected = collection.create(ws, root, run_id)["expected"]
    while (left := expected - collection.submitted_count(spark, root, run_id, collection.broker.LEASE_SECONDS, collection.time.time())) > 0:
        leased = collection.lease(spark, root, run_id, min(left, collection.MOST_LEASES))
        rows = spark.createDataFrame([(x["task_id"], x["token"], x["question"]) for x in leased], "task_id string, token string, question string")
        rows = rows.withColumn("answer", calibration.solve(F.col("question")))
        collection.submit(spark, root, run_id, rows.select("task_id", "token", calibration.blind_derivation(F.col("answer")).alias("derivation"), "answer"))
    collection.finalize(ws, root, run_id)
    read = lambda n: spark.read.parquet(f"{root}/runs/{run_id}/{n}.parquet")
    return calibration.report(read("raw"), read("evaluated"), read("selected")) | {"run_id": run_id, "tasks": expected, "stage": runs.load_state(spark, root, run_id)["stage"]}


def demo(spark: SparkSession, a: argparse.Namespace) -> bool:
    """All steps of the demonstration corpus, its marked review included."""
    workspace.scaffold(spark, a.path, demo=True)
    ws = workspace.load(spark, a.path)
    manifest = runs.generate(ws, a.path, "demo-run")
    runs.approve_all(ws, a.path, "demo-run", "demo-fixture", "fixture rows, approved for the demonstration")
    path = release.build(ws, a.path, "demo-run", allow_test_fixture=True)
    checked = release.verify(spark, path, allow_unanchored=True)
    say({"workspace": a.path, "release": path, "anchor_sha256": release.anchor(Files(spark, path)), "selected": manifest["counts"]["selected"], "verification": checked})
    return checked["passed"]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sparkloom", description="Compile governed question/answer candidates into auditable training releases.")
    p.add_argument("--master", help="Spark master (the environment's by default)")
    sub = p.add_subparsers(required=True, metavar="COMMAND")

    def add(name: str, f: Callable, help: str, *names: str) -> argparse.ArgumentParser:
        q = sub.add_parser(name, help=help)
        q.set_defaults(run=f)
        for n in names:
            q.add_argument(n)
        return q

    def here(q: argparse.ArgumentParser) -> argparse.ArgumentParser:
        q.add_argument("path", nargs="?", default=".")
        return q

    add("init", init, "a new production workspace", "path")
    here(add("doctor", check, "check a workspace")).add_argument("--provider")
    q = here(add("generate", generate, "generate, verify, decontaminate and select"))
    q.add_argument("--run-id", default="run-001")
    q.add_argument("--provider")
    add("review-export", review_export, "write a packet for every selected row", "path", "run_id", "destination")
    add("review-import", review_import, "take complete decisions in", "path", "run_id", "decisions")
    q = add("review-all", review_all, "one decision for every selected row", "path", "run_id")
    q.add_argument("--reviewer", required=True)
    q.add_argument("--rationale", required=True)
    for flag in ("manual-review", "derivation-verification", "behavior-alignment"):
        q.add_argument(f"--acknowledge-{flag}", action="store_true")
    add("release", build, "run all gates again and write the bundle", "path", "run_id")
    q = add("verify-release", verify, "check a bundle", "path", "version")
    q.add_argument("--expected-sha256")
    q.add_argument("--allow-unanchored", action="store_true")
    here(add("status", status, "runs, releases and collections"))
    q = add("collect", collect, "the task queue", "path")
    q.add_argument("step", choices=("create", "lease", "submit", "status", "finalize", "recover", "migrate"))
    q.add_argument("--run-id", default="run-001")
    q.add_argument("--count", type=int, default=1)
    q.add_argument("--seconds", type=float, default=collection.broker.LEASE_SECONDS)
    q.add_argument("--submissions")
    for plane, port in (("agent", 8411), ("control", 8412)):
        q = add(f"serve-{plane}", serve, f"the {plane} plane of the queue", "path")
        q.set_defaults(plane=plane)
        q.add_argument("--host", default="127.0.0.1")
        q.add_argument("--port", type=int, default=port)
        q.add_argument("--lease-seconds", type=int, default=collection.broker.LEASE_SECONDS)
    q = add("calibration-pilot", pilot, "the blind calibration, up to review", "path")
    q.add_argument("--size", type=int, default=1000)
    q.add_argument("--run-id", default="calibration-run")
    add("demo", demo, "the whole demonstration", "path")
    return p


def session(master: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName("sparkloom").config("spark.sql.session.timeZone", "UTC")
    spark = (builder.master(master) if master else builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    try:
        return 0 if a.run(spark or session(a.master), a) else 1
    except (EngineError, OSError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
