"""A demonstration corpus from seeds to a verified release, and what must stop it."""

import json

import pytest
from pyspark.sql import functions as F

from sparkloom.errors import AuthorizationError, ConfigurationError, GateError, ImmutableArtifactError
from sparkloom.operators import broker, calibration, doctor
from sparkloom.plans import compile as run
from sparkloom.plans import release
from sparkloom.sources import fixtures, jsonl, providers
from sparkloom.sources.sinks import Files
from sparkloom.streaming import leases


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("demo"))
    ws = fixtures.demo(spark)
    manifest = run.generate(ws, root, "run-001")
    run.approve_all(ws, root, "run-001", "demo-fixture", "checked", True)
    path = release.build(ws, root, "run-001", allow_test_fixture=True)
    return ws, root, manifest, path


def test_counts(built):
    _, _, manifest, _ = built
    assert manifest["counts"] == {"raw": 24, "failed_gates": 0, "failed_verification": 0, "contaminated": manifest["counts"]["contaminated"], "selected": 8}


def test_release_verifies(spark, built):
    _, root, _, path = built
    top = release.anchor(Files(spark, path))
    out = release.verify(spark, path, top)
    assert out["passed"], out
    assert release.verify(spark, path)["failures"] == ["missing-external-anchor"]
    assert release.verify(spark, path, allow_unanchored=True)["passed"]
    assert release.verify(spark, path, "0" * 64)["failures"] == ["external-anchor"]
    lines = [json.loads(x) for s in ("train", "validation", "test") for x in Files(spark, path).read(f"{s}.jsonl").decode().split("\n")[:-1]]
    assert len(lines) == 8 and all(set(x) == {"messages"} for x in lines)
    assert run.load_state(spark, root, "run-001")["stage"] == "released"


def test_written_once(built):
    ws, root, _, _ = built
    with pytest.raises(ImmutableArtifactError):
        run.generate(ws, root, "run-001")
    with pytest.raises(ImmutableArtifactError):
        release.build(ws, root, "run-001", allow_test_fixture=True)
    with pytest.raises(GateError):
        release.build(ws, root, "run-001")


def test_tampering_is_seen(spark, built, tmp_path):
    import shutil

    _, _, _, path = built
    top = release.anchor(Files(spark, path))
    copy = str(tmp_path / "copy")
    shutil.copytree(path, copy)
    for crc in (tmp_path / "copy").glob(".*.crc"):
        crc.unlink()
    data = (tmp_path / "copy" / "train.jsonl").read_text()
    (tmp_path / "copy" / "train.jsonl").write_text(data.replace("Final answer", "Last answer", 1))
    bad = release.verify(spark, copy, top)["failures"]
    assert {"train.jsonl", "manifest-file-hash", "trainer-schema", "content-hash"} <= set(bad)
    (tmp_path / "copy" / "train.jsonl").write_text("".join(data.splitlines(True)[1:]))
    bad = release.verify(spark, copy, top)["failures"]
    assert {"sidecar-count", "manifest-counts", "content-hash"} <= set(bad)
    (tmp_path / "copy" / "extra.txt").write_text("x")
    assert "checksum-file-set" in release.verify(spark, copy, top)["failures"]


def test_review_binds(spark, built, tmp_path):
    ws, _, _, _ = built
    root = str(tmp_path)
    run.generate(ws, root, "r2")
    packets = run.export_review(ws, root, "r2")
    good = packets.withColumns({"decision": F.lit("approved"), "reviewer": F.lit("demo-fixture"), "rationale": F.lit("ok"), "reviewed_at": F.lit("now"), "derivation_verified": F.lit(True), "behavior_alignment_verified": F.lit(True)}).persist()
    cases = [
        (good.limit(7), "missing"), (good.union(good.limit(1)), "duplicate"), (good.withColumn("decision", F.lit("pending")), "pending"), (good.withColumn("candidate_sha256", F.lit("0")), "digest"),
        (good.withColumn("final_answer", F.lit("changed")), "displayed"), (good.withColumn("rationale", F.lit(" ")), "rationale"),
    ]
    for rows, what in cases:
        with pytest.raises(GateError, match=what):
            run.import_review(ws, root, "r2", rows)
    with pytest.raises(AuthorizationError):
        run.import_review(ws, root, "r2", good.withColumn("reviewer", F.lit("stranger")))
    from sparkloom.operators.review import acknowledgements

    acknowledgements("test_fixture", False, False, False)
    for said in ((False, True, True), (True, False, True), (True, True, False)):
        with pytest.raises(GateError, match="acknowledges"):
            acknowledgements("production", *said)
    with pytest.raises(GateError, match="manual review"):
        acknowledgements("calibration", False, True, True)
    acknowledgements("calibration", True, False, False)
    one = good.withColumn("decision", F.when(F.col("category") == "logic", "rejected").otherwise("approved"))
    assert run.import_review(ws, root, "r2", one) == {"approved": 7, "rejected": 1}
    with pytest.raises(GateError, match="below target_size"):
        release.build(ws, root, "r2", allow_test_fixture=True)


def failed(ws, **options):
    return {x["gate"] for x in doctor.doctor(ws, **options) if x["status"] == "fail"}


def test_doctor(spark):
    ws = fixtures.demo(spark)
    checks = doctor.doctor(ws)
    assert len(checks) == 27 and doctor.passed(checks)
    assert failed(ws, provider_id="nobody") == {"teacher_exists", "teacher_authorized", "teacher_target_use_compatible"}
    own = fixtures.source(fixtures.ANCHOR_SOURCE, fixtures.registry_digest(fixtures.behavior_anchors()))
    demo = lambda **c: fixtures.source("SRC-DEMO", "a" * 64, **c)
    for change, gate in (({"authorization_status": "blocked"}, "seed_sources_authorized"), ({"redistribution_allowed": False}, "seed_sources_redistributable"), ({"allowed_target_uses": []}, "source_target_use_compatible"), ({"compatible_release_licenses": ["MIT"]}, "source_release_license_compatible")):
        assert failed(fixtures.demo(spark, all_sources=[demo(**change), own])) == {gate}
    assert failed(fixtures.demo(spark, all_sources=[own])) == {"seed_sources_exist"}
    assert failed(fixtures.demo(spark, all_sources=[demo(), demo(), own])) == {"unique_sources"}
    assert failed(fixtures.demo(spark, all_sources=[demo()])) == {"behavior_anchor_sources_exist", "behavior_anchor_snapshot"}
    anchors = fixtures.behavior_anchors()
    anchors[0] = anchors[0] | {"principle": "Other."}
    assert failed(fixtures.demo(spark, anchors=anchors)) == {"behavior_anchor_canonical", "behavior_anchor_snapshot"}
    narrow = {"reviewer_id": "r", "authorization_status": "approved", "allowed_categories": ["logic"]}
    assert failed(fixtures.demo(spark, reviewers=[narrow])) == {"reviewer_category_coverage"}
    ws = fixtures.demo(spark)
    ws.taxonomy["domains"] = ["other"]
    ws.seeds = ws.seeds.withColumn("generation_depth", F.lit(1))
    assert failed(ws) == {"taxonomy_membership", "generation_depth"}


def test_production_policy(spark, monkeypatch):
    """Each floor by one record too few, and all of them met."""
    from sparkloom.config import BEHAVIOR_DOMAINS, DIFFICULTIES

    monkeypatch.setattr(release, "POLICY_FLOORS", [(d, v, min(n, 12 if d == "split" else 10)) for d, v, n in release.POLICY_FLOORS])
    rows = [(s, f"c{i % 10}", [*DIFFICULTIES][i % 3], [BEHAVIOR_DOMAINS[i % 10]]) for s in ("train", "validation", "test") for i in range(12)]
    deficits = lambda rows: {(x.dimension, x.value): x.deficit for x in release.policy_deficits(spark.createDataFrame(rows, "split string, category string, difficulty string, domains array<string>")).collect()}
    assert deficits(rows) == {}
    assert deficits(rows[1:]) == {("split", "train"): 1}
    short = [(s, c.replace("c9", "c8"), d if d != "advanced" else None, [x for x in a if x != BEHAVIOR_DOMAINS[4]]) for s, c, d, a in rows]
    assert deficits(short) == {("distinct", "category"): 1, ("difficulty", "advanced"): 1, ("domain", BEHAVIOR_DOMAINS[4]): 1}
    assert len(deficits([])) == len(release.POLICY_FLOORS)


def test_calibration_through_the_queue(spark, tmp_path):
    ws = fixtures.calibration_workspace(spark, 50)
    tasks = broker.plan(ws.seeds, "cal", 3, ["SRC-PILOT-AUTHORED"])
    assert tasks.count() == 150
    answers = tasks.withColumn("answer", calibration.solve(F.col("question"))).withColumn("derivation", calibration.blind_derivation(F.col("answer")))
    outputs = providers.collected(ws.seeds, answers, 3)
    out = run.generate(ws, str(tmp_path), "cal", outputs)
    assert out["counts"]["raw"] == 150 and out["counts"]["selected"] == 50 and out["counts"]["failed_verification"] == 0
    r = lambda n: spark.read.parquet(f"{tmp_path}/runs/cal/{n}.parquet")
    report = calibration.report(r("raw"), r("evaluated"), r("selected"))
    assert report["categories"] == dict.fromkeys(sorted(calibration.CATEGORIES), 5)
    run.approve_all(ws, str(tmp_path), "cal", "demo-fixture", "ok", True)
    with pytest.raises(GateError, match="non-releasable"):
        release.build(ws, str(tmp_path), "cal")
    with pytest.raises(GateError, match="incomplete"):
        providers.collected(ws.seeds, answers.where("candidate_index < 2"), 3)


def test_strict_jsonl(spark, tmp_path):
    path = tmp_path / "rows.jsonl"
    schema = "id string, n bigint, more struct<x:array<string>>"
    path.write_text('{"id":"a b","n":1,"other":2}\n\n{"id":"c","n":2,"more":{"x":["y"]}}\n')
    assert [tuple(r)[:2] for r in jsonl.read_jsonl(spark, str(path), schema).collect()] == [("a b", 1), ("c", 2)]
    for bad in ('{"id":1,"n":1}\n', '{"id":"a","n":"1"}\n', '{"id":"a","n":true}\n', "[]\n", '{"id":"a"\n', '{"id":"a","more":{"x":[1]}}\n'):
        path.write_text(bad)
        with pytest.raises(Exception, match=r"not|line"):
            jsonl.read_jsonl(spark, str(path), schema).collect()
    with pytest.raises(ConfigurationError):
        jsonl.read_jsonl(spark, str(tmp_path / "none"), schema)
    path.write_text("x" * (jsonl.MAX_LINE_CHARS + 1))
    with pytest.raises(ConfigurationError):
        jsonl.read_jsonl(spark, str(path), schema)


def test_remote_teacher(spark):
    seeds = spark.createDataFrame([("s1", "What?")], "seed_id string, question string")
    reply = json.dumps({"candidates": [{"derivation": [" step "], "answer": "a", "citation_ids": ["SRC-X"]}] * 3})
    got = providers.remote(seeds, 3, lambda q, n: reply).select("outputs").first().outputs
    assert [(o.derivation, o.answer, o.citation_ids) for o in got] == [(["step"], "a", [])] * 3
    with pytest.raises(ValueError):
        providers.parse_outputs(reply, 4)
    with pytest.raises(ConfigurationError):
        providers.remote(seeds, 2, lambda q, n: reply)
    here = lambda a: lambda h, p: [(0, 0, 0, "", (a, p))]
    providers.check_endpoint("https://api.example.com/v1", resolve=here("93.184.216.34"))
    for url, address, error in (("http://api.example.com", "93.184.216.34", ConfigurationError), ("https://u:p@example.com", "93.184.216.34", ConfigurationError), ("https://x.example", "10.0.0.1", AuthorizationError)):
        with pytest.raises(error):
            providers.check_endpoint(url, resolve=here(address))


def test_lease_stream_over_time(spark, tmp_path):
    """A lease ends without another event of its task, a finished task is forgotten, and late events are dropped; what is held
    between is read from the checkpoint."""
    steps = [
        [("t1", 1, 0.0, "lease", "k", None), ("t2", 2, 10.0, "lease", "k", None), ("t2", 3, 20.0, "submit", "k", "x"), ("t3", 4, 30.0, "lease", "k", None)],
        [("t3", 5, 40.0, "submit", "no", "x"), ("t4", 6, 2000.0, "lease", "k", None)],
        [("t1", 7, 3000.0, "lease", "l", None), ("t5", 8, 9000.0, "lease", "k", None)],
        [("t6", 9, 100.0, "lease", "k", None), ("t2", 10, 9001.0, "lease", "m", None)],
    ]
    held = []
    for n, rows in enumerate(steps):
        spark.createDataFrame(rows, leases.EVENTS).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{n}"))
        stream = spark.readStream.schema(leases.EVENTS).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        leases.drain(leases.receipts(stream, 900, "1 second", 5000), str(tmp_path / "out"), str(tmp_path / "ckpt"))
        held.append({x.task_id: (x.state, x.leases, x.rejected) for x in leases.held(spark, str(tmp_path / "ckpt")).collect()})
    open_, done = ("queued", 1, 0), ("submitted", 1, 0)
    assert held[0] == {"t1": ("leased", 1, 0), "t2": done, "t3": ("leased", 1, 0)}
    assert held[1] == {"t1": open_, "t2": done, "t3": ("queued", 1, 1), "t4": ("leased", 1, 0)}
    assert held[2] == {"t1": ("queued", 2, 0), "t3": ("queued", 1, 1), "t4": open_, "t5": ("leased", 1, 0)}
    assert held[3] == held[2] | {"t2": ("leased", 1, 0)}
    got = {(x.task_id, x.seq, x.action): (x.accepted, x.state) for x in spark.read.parquet(str(tmp_path / "out")).collect()}
    timers = {k[::2]: v for k, v in got.items() if k[1] == -1}
    assert timers == {("t1", "expire"): (True, "queued"), ("t3", "expire"): (True, "queued"), ("t4", "expire"): (True, "queued"), ("t2", "forget"): (True, "submitted")}
    assert {k[1]: v for k, v in got.items() if k[1] > 0} == {
        1: (True, "leased"), 2: (True, "leased"), 3: (True, "submitted"), 4: (True, "leased"), 5: (False, "leased"), 6: (True, "leased"), 7: (True, "leased"), 8: (True, "leased"), 10: (True, "leased"),
    }


def test_lease_stream(spark, tmp_path):
    events = [("t1", 1, 0.0, "lease", "a", None), ("t1", 2, 5.0, "submit", "b", "x"), ("t1", 3, 6.0, "submit", "a", "x"), ("t2", 4, 0.0, "submit", "a", "x")]
    spark.createDataFrame(events, leases.EVENTS).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(leases.EVENTS).parquet(str(tmp_path / "in"))
    leases.drain(leases.receipts(stream), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    got = {(r.task_id, r.seq): (r.accepted, r.state) for r in spark.read.parquet(str(tmp_path / "out")).where("seq >= 0").collect()}
    assert got == {("t1", 1): (True, "leased"), ("t1", 2): (False, "leased"), ("t1", 3): (True, "submitted"), ("t2", 4): (False, "queued")}
