"""Workspaces on disk, the command line, and the life of a collection."""

import json
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import sparkloom
from sparkloom import cli
from sparkloom.config import Generation
from sparkloom.errors import AuthorizationError, ConfigurationError, GateError, ImmutableArtifactError
from sparkloom.operators import broker, calibration, doctor
from sparkloom.plans import collection
from sparkloom.plans import compile as runs
from sparkloom.sources import fixtures, providers, workspace
from sparkloom.sources.sinks import Files


def test_public_names():
    assert {"Workspace", "build_release", "generate_run", "verify_release"} <= set(sparkloom.__all__)
    assert sparkloom.generate_run is runs.generate and sparkloom.Workspace is doctor.Workspace
    with pytest.raises(AttributeError):
        sparkloom.nothing  # noqa: B018


def test_saved_workspace_reads_back(spark, tmp_path):
    ws = fixtures.demo(spark)
    root = workspace.save(ws, str(tmp_path / "w"))
    back = workspace.load(spark, root)
    assert back.config == ws.config and back.taxonomy == ws.taxonomy
    for name in ("sources", "teachers", "reviewers", "anchors"):
        assert back.rows(name) == ws.rows(name)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(back.seeds) == key(ws.seeds) and key(back.benchmarks) == key(ws.benchmarks)
    assert doctor.passed(doctor.doctor(back)) and runs.input_hashes(back) == runs.input_hashes(ws)
    with pytest.raises(ConfigurationError):
        workspace.save(ws, root)
    assert workspace.teacher(back, "deterministic-teacher")["provider"] == "deterministic"
    assert workspace.reviewer(back, "demo-fixture", "logic")["reviewer_id"] == "demo-fixture"
    for call in (lambda: workspace.teacher(back, "x"), lambda: workspace.reviewer(back, "x", "logic")):
        with pytest.raises(ConfigurationError):
            call()


def test_older_schema_and_missing_files(spark, tmp_path):
    root = workspace.save(fixtures.demo(spark), str(tmp_path / "w"))
    (tmp_path / "w/registry/protected-benchmarks.jsonl").unlink()
    assert workspace.load(spark, root).benchmarks.isEmpty()
    anchors = tmp_path / "w/registry/behavior-anchors.yaml"
    kept = anchors.read_text()
    anchors.unlink()
    with pytest.raises(ConfigurationError):
        workspace.load(spark, root)
    settings = tmp_path / "w/config.yaml"
    settings.write_text(settings.read_text().replace("'1.1'", "'1.0'").replace('"1.1"', '"1.0"'))
    for crc in (tmp_path / "w").rglob(".*.crc"):
        crc.unlink()
    old = workspace.load(spark, root)
    assert old.config.schema_version == "1.0" and old.anchors.isEmpty()
    assert "schema_current" in {x["gate"] for x in doctor.doctor(old) if x["status"] == "fail"}
    anchors.write_text(kept)
    (tmp_path / "w/registry/taxonomy.yaml").write_text("categories: logic\n")
    with pytest.raises(ConfigurationError):
        workspace.load(spark, root)


def test_command_line(spark, tmp_path, capsys):
    do = lambda *a: cli.main([str(x) for x in a], spark)
    root = tmp_path / "p"
    assert do("init", root) == 0 and do("init", root) == 1
    assert "there is a workspace already" in capsys.readouterr().err
    assert do("doctor", root) == 1
    said = capsys.readouterr().out
    assert "FAIL teacher_authorized" in said and "PASS unique_seeds" in said and "FAIL production_split_capacity" in said
    assert do("generate", root) == 1 and "doctor failed" in capsys.readouterr().err
    demo = tmp_path / "d"
    assert do("demo", demo) == 0
    out = json.loads(capsys.readouterr().out)
    assert out["selected"] == 8 and out["verification"]["passed"]
    assert do("verify-release", demo, "1.0.0", "--expected-sha256", out["anchor_sha256"]) == 0
    assert do("verify-release", demo, "1.0.0") == 1
    capsys.readouterr()
    assert do("status", demo) == 0
    assert json.loads(capsys.readouterr().out)["releases"] == ["1.0.0"]
    assert do("generate", demo, "--run-id", "r2") == 0
    packets = tmp_path / "packets.jsonl"
    assert do("review-export", demo, "r2", packets) == 0
    rows = [json.loads(x) for x in packets.read_text().splitlines()]
    assert len(rows) == 8 and do("review-import", demo, "r2", packets) == 1
    for r in rows:
        r |= {"decision": "approved", "reviewer": "demo-fixture", "rationale": "ok", "reviewed_at": "now", "derivation_verified": True, "behavior_alignment_verified": True}
    decided = tmp_path / "decided.jsonl"
    decided.write_text("".join(json.dumps(r) + "\n" for r in rows))
    assert do("review-import", demo, "r2", decided) == 0
    assert runs.load_state(spark, str(demo), "r2")["stage"] == "approved"
    assert do("review-all", demo, "r2", "--reviewer", "demo-fixture", "--rationale", "again") == 0
    assert do("release", demo, "r2") == 1 and "internal demo workflow" in capsys.readouterr().err
    with pytest.raises(SystemExit):
        do("unknown")


def test_module_runs():
    out = subprocess.run([sys.executable, "-m", "sparkloom", "--help"], capture_output=True, text=True, timeout=120, check=True)
    assert "verify-release" in out.stdout


def test_calibration_pilot(spark, tmp_path):
    out = cli.calibrate(spark, str(tmp_path / "c"), 20, "cal")
    assert out["tasks"] == 60 and out["selected"] == 20 and out["stage"] == "awaiting_review" and out["verification_failures"] == 0
    assert set(out["categories"]) == set(calibration.CATEGORIES)
    assert collection.status(spark, str(tmp_path / "c"), "cal")["state"] == "finalized"


@pytest.fixture
def cal(spark, tmp_path):
    root = workspace.save(fixtures.calibration_workspace(spark, 10), str(tmp_path / "c"))
    return workspace.load(spark, root), root


def answers(spark, leased):
    rows = spark.createDataFrame([(x["task_id"], x["token"], x["question"]) for x in leased], "task_id string, token string, question string")
    rows = rows.withColumn("answer", calibration.solve(F.col("question")))
    return rows.select("task_id", "token", calibration.blind_derivation(F.col("answer")).alias("derivation"), "answer")


def test_collection_life(spark, cal):
    ws, root = cal
    assert collection.create(ws, root, "r")["queued"] == 30
    with pytest.raises(ImmutableArtifactError):
        collection.create(ws, root, "r")
    with pytest.raises(ConfigurationError):
        collection.status(spark, root, "other")
    first = collection.lease(spark, root, "r", 5, 900, now=1000.0)
    assert len({x["task_id"] for x in first}) == 5 and set(first[0]) == {"task_id", "question", "token", "expires_at"}
    wrong = [x | {"token": "guess"} for x in first[:2]]
    assert collection.submit(spark, root, "r", answers(spark, wrong), 900, now=1001.0)["accepted"] == 0
    assert collection.submit(spark, root, "r", answers(spark, first[:2]), 900, now=1002.0) == {"submitted": 2, "accepted": 2}
    assert collection.submit(spark, root, "r", answers(spark, first[2:4]), 900, now=1900.5)["accepted"] == 0  # too late
    blank = spark.createDataFrame([(first[4]["task_id"], first[4]["token"], [" "], "x")], collection.SUBMISSIONS)
    assert collection.submit(spark, root, "r", blank, 900, now=1003.0)["accepted"] == 0
    with pytest.raises(ConfigurationError, match="not ready"):
        collection.finalize(ws, root, "r")
    rest = collection.lease(spark, root, "r", 100, 900, now=5000.0)
    assert len(rest) == 28 and collection.lease(spark, root, "r", 1, 900, now=5001.0) == []
    assert collection.submit(spark, root, "r", answers(spark, rest), 900, now=5002.0) == {"submitted": 30, "accepted": 28}
    assert collection.status(spark, root, "r")["state"] == "ready"
    out = collection.finalize(ws, root, "r")
    assert out["state"] == "finalized" and out["run"]["stage"] == "awaiting_review" and out["run"]["counts"]["raw"] == 30
    # a finalization that died after its artifacts were sealed, and one that left a part of them
    collection.change(spark, root, "r", state="finalizing")
    assert collection.recover(ws, root) == {"r": "finalized"}
    collection.change(spark, root, "r", state="finalizing")
    run = Files(spark, f"{root}/runs/r")
    run.write("selected.jsonl", "changed")
    assert collection.recover(ws, root) == {"r": "failed"} and "invalid artifacts" in collection.state_of(spark, root, "r")["failure"]
    collection.change(spark, root, "r", state="finalizing")
    run.delete("state.json")
    assert collection.recover(ws, root) == {"r": "failed"}
    collection.change(spark, root, "r", state="finalizing")
    run.delete()
    assert collection.recover(ws, root) == {"r": "ready"} and collection.recover(ws, root) == {}


def test_changed_inputs_stop_a_finalization(spark, cal):
    ws, root = cal
    collection.create(ws, root, "r")
    leased = collection.lease(spark, root, "r", 30)
    collection.submit(spark, root, "r", answers(spark, leased))
    ws.seeds = ws.seeds.withColumn("question", F.concat("question", F.lit(" ")))
    with pytest.raises(GateError, match="differ"):
        collection.finalize(ws, root, "r")
    state = collection.state_of(spark, root, "r")
    assert state["state"] == "failed" and "GateError" in state["failure"]


def test_migration_queues_older_answers_again(spark, cal):
    ws, root = cal
    collection.create(ws, root, "r")
    files = collection.folder(spark, root, "r")
    state = files.read_json("state.json")
    leased = collection.lease(spark, root, "r", 2)
    old = [(x["task_id"], 10, collection.time.time(), "submit", x["token"], json.dumps({"answer": "1"})) for x in leased]
    files.write_json("state.json", {k: v for k, v in state.items() if k not in ("contract", "inputs", "failure")})
    assert collection.migrate(spark, root) == {"r": 0}
    collection.change(spark, root, "r", contract=collection.OLDER_CONTRACT)
    collection.append(spark, root, "r", spark.createDataFrame(old, collection.EVENTS))
    assert collection.status(spark, root, "r")["submitted"] == 2
    assert collection.migrate(spark, root) == {"r": 2} and collection.migrate(spark, root) == {}
    after = collection.status(spark, root, "r")
    assert after["submitted"] == 0 and after["state"] == "collecting" and after["contract"] == collection.CONTRACT


def test_questions_show_no_ids(spark, cal):
    ws, root = cal
    ws.benchmarks = spark.createDataFrame([("bench-7", "What?", None)], doctor.BENCHMARKS)
    ws.seeds = ws.seeds.withColumn("question", F.concat("question", F.lit(" (see BENCH-7.)")))
    with pytest.raises(GateError, match="shows the id"):
        collection.create(ws, root, "r")


def test_chat_client():
    teacher = {"base_url": "https://t.example/v1/", "model": "m", "api_key_env": None, "allow_private_endpoint": False}
    sent = []

    def send(url, headers, body, timeout, most):
        sent.append((url, json.loads(body), timeout))
        return json.dumps({"choices": [{"message": {"content": "reply"}}]}).encode()

    at = lambda address: lambda h, p: [(0, 0, 0, "", (address, p))]
    ask = providers.chat_client(teacher, Generation("t"), at("93.184.216.34"), send)
    assert ask("What?", 3) == "reply" and sent[0][0] == "https://t.example/v1/chat/completions" and sent[0][1]["messages"][1]["content"] == "What?"
    with pytest.raises(AuthorizationError):
        providers.chat_client(teacher, Generation("t"), at("169.254.169.254"), send)("What?", 3)
    with pytest.raises(ConfigurationError):
        providers.chat_client(teacher | {"api_key_env": "NO_SUCH_KEY"}, Generation("t"), at("93.184.216.34"), send)("What?", 3)
    with pytest.raises(ValueError, match="limit"):
        providers.chat_client(teacher, Generation("t", max_response_bytes=1024), at("93.184.216.34"), lambda *a: b"x" * 2000)("What?", 3)


def test_tokens_compare():
    assert broker.same_token("a", broker.token_digest("a")) and not broker.same_token("b", broker.token_digest("a")) and not broker.same_token("a", None)


def call(server, method, path, token=None, body=None, raw=None):
    import http.client

    c = http.client.HTTPConnection(*server.server_address, timeout=120)
    data = raw if raw is not None else None if body is None else json.dumps(body).encode()
    c.request(method, path, data, {"Authorization": f"Bearer {token}"} if token else {})
    r = c.getresponse()
    text = r.read()
    c.close()
    return r.status, json.loads(text) if text else None


def test_planes(spark, cal):
    import threading

    from sparkloom import service

    ws, root = cal
    agent, control = "a" * 40, "c" * 40
    settings = service.Settings(root, agent, control)
    planes = {name: service.server(spark, name, settings) for name in ("agent", "control")}
    for s in planes.values():
        threading.Thread(target=s.serve_forever, daemon=True).start()
    try:
        a, c = planes["agent"], planes["control"]
        assert call(a, "GET", "/healthz") == (200, {"status": "ok"})
        assert call(a, "POST", "/v1/tasks/lease")[0] == 401 and call(a, "POST", "/v1/tasks/lease", control)[0] == 401
        assert call(a, "POST", "/v1/tasks/lease", agent) == (204, None) and call(a, "POST", "/v1/runs", agent, {"run_id": "r"})[0] == 404
        assert call(c, "POST", "/v1/runs", control, {"run_id": "../x"})[0] == 422
        status, made = call(c, "POST", "/v1/runs", control, {"run_id": "r"})
        assert (status, made["state"], made["queued"]) == (201, "collecting", 30) and "inputs" not in made
        assert call(c, "POST", "/v1/runs", control, {"run_id": "r"})[0] == 409 and "/v1/runs" in call(c, "GET", "/openapi.json", control)[1]["paths"]
        status, task = call(a, "POST", "/v1/tasks/lease", agent)
        assert status == 200 and set(task) == {"task_id", "lease_token", "expires_at_unix", "messages"} and len(task["messages"]) == 1
        path, reply = f"/v1/tasks/{task['task_id']}/responses", {"lease_token": task["lease_token"], "derivation": ["a step"], "answer": "1"}
        assert call(a, "POST", path, agent, reply | {"lease_token": "x" * 43})[0] == 404 and call(a, "POST", "/v1/tasks/task_0/responses", agent, reply)[0] == 404
        for bad in (reply | {"derivation": []}, reply | {"more": 1}, reply | {"answer": ""}, [1]):
            assert call(a, "POST", path, agent, bad)[0] == 422
        assert call(a, "POST", path, agent, raw=b"{")[0] == 422 and call(a, "POST", path, agent, raw=b"x" * (service.MOST_BODY + 1))[0] == 413
        assert call(a, "POST", path, agent, reply) == (202, {"status": "recorded"}) and call(a, "POST", path, agent, reply)[0] == 404
        assert call(c, "GET", "/v1/runs/r", control)[1]["submitted"] == 1 and call(c, "POST", "/v1/runs/r/finalize", control)[0] == 409
        assert call(c, "GET", "/v1/runs/other", control)[0] == 409
    finally:
        for s in planes.values():
            s.shutdown()
            s.server_close()


def test_service_settings(monkeypatch):
    from sparkloom import service

    for kwargs in ({}, {"agent_token": "short"}, {"agent_token": " " + "a" * 40}, {"agent_token": "changeme" * 8}, {"agent_token": "a" * 40, "control_token": "a" * 40}, {"agent_token": "a" * 40, "lease_seconds": 10}):
        with pytest.raises(ConfigurationError):
            service.Settings("x", **kwargs)
    monkeypatch.delenv(service.AGENT_TOKEN, raising=False)
    with pytest.raises(ConfigurationError):
        service.token_of(service.AGENT_TOKEN)
    monkeypatch.setenv(service.AGENT_TOKEN, "a" * 40)
    assert service.token_of(service.AGENT_TOKEN) == "a" * 40
