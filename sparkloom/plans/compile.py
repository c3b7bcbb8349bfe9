"""The run: seeds to reviewed selection.  One narrow stage up to the gates, one similarity join,
one choice, and artifacts that are written once."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.config import safe_identifier
from sparkloom.errors import GateError
from sparkloom.functions.canonical import canonical_json, canonical_python, content_digest, record_id, sha256_text
from sparkloom.operators import dedup, doctor, gates, review, selection, splits, verifiers
from sparkloom.sources import providers
from sparkloom.sources.sinks import Files

TEMPLATE_ID = "structured-derivation-v1"
TEMPLATE = "Answer the task with numbered derivation steps and a final answer."
#: Fields of a candidate that are written to artifacts, in alphabetical order.
FIELDS = (
    "answer", "behavior_anchor_ids", "citation_ids", "content_sha256", "contamination", "coverage_score", "derivation", "dimensions", "generated_at", "generation_depth",
    "generation_run_id", "lineage_id", "parent_record_ids", "prompt_template_id", "prompt_template_sha256", "quality_score", "question", "question_transform_id", "record_id",
    "rejection_reasons", "review", "sampling", "schema_version", "seed_id", "seed_question", "selected", "source_ids", "split", "teacher_id", "teacher_model", "teacher_provider",
    "teacher_terms_snapshot_id", "validation", "verification", "verifier",
)


def utc_now() -> str:
    return datetime.now(UTC).isoformat()


def candidates(seeds: DataFrame, outputs: DataFrame, config, run_id: str, teacher: dict, at: str) -> DataFrame:
    """Raw candidates of seeds with their ``outputs``: split, transform, ids and digests."""
    g = config.generation
    names = F.array(*[F.lit(t) for t in splits.TRANSFORMS])
    rows = outputs.withColumn("split", splits.assign_split(F.col("lineage_id"), config.split))
    rows = rows.select("*", F.posexplode("outputs").alias("candidate_index", "output")).drop("outputs")
    rows = rows.withColumn("question_transform_id", F.get(names, F.col("candidate_index"))).withColumn("seed_question", F.col("question"))
    rows = rows.withColumn("question", splits.transform_question(F.col("seed_question"), F.col("question_transform_id")))
    rows = rows.withColumns({"derivation": F.col("output.derivation"), "answer": F.col("output.answer"), "citation_ids": F.col("output.citation_ids")}).drop("output")
    rows = rows.withColumn("content_sha256", content_digest(F.col("question"), F.col("derivation"), F.col("answer")))
    rows = rows.withColumn("record_id", record_id(F.col("content_sha256"), F.col("candidate_index"), F.lit(run_id), F.col("seed_id")))
    texts = {
        "schema_version": "1.1", "generation_run_id": run_id, "generated_at": at, "teacher_id": teacher["teacher_id"], "teacher_provider": teacher["provider"], "teacher_model": teacher["model"],
        "teacher_terms_snapshot_id": teacher["terms_snapshot_id"], "prompt_template_id": TEMPLATE_ID, "prompt_template_sha256": sha256_text(TEMPLATE),
    }
    rows = rows.withColumns({k: F.lit(v) for k, v in texts.items()})
    return rows.withColumns(
        {
            "generation_depth": F.col("generation_depth") + 1, "parent_record_ids": F.array().cast("array<string>"),
            "sampling": F.struct(F.col("candidate_index"), F.lit(g.max_tokens).alias("max_tokens"), F.lit(float(g.temperature)).alias("temperature")),
        }
    ).drop("candidate_index", "reference_answer")


def evaluate(raw: DataFrame, benchmarks: DataFrame, config, private: dict[str, list[str]]) -> DataFrame:
    rows = gates.validate(raw, config.quality, config.generation.max_generation_depth, private)
    rows = verifiers.verify(rows)
    return dedup.decontaminate(rows, benchmarks, config.quality)


def artifact(rows: DataFrame) -> DataFrame:
    """record_id and ``line``, canonical JSON of the known fields."""
    fields = [c for c in FIELDS if c in rows.columns]
    return rows.select("record_id", canonical_json(F.struct(*fields)).alias("line"))


def generate(ws: doctor.Workspace, root: str, run_id: str, outputs: DataFrame | None = None, provider_id: str | None = None) -> dict:
    """Compile a run under ``root``/runs/``run_id`` and return its manifest.

    ``outputs`` are seeds with a column of that name, from a provider; without it the
    deterministic teacher is asked.  Tables go to Parquet for the later stages, and as ordered
    JSON Lines for people; the folder is claimed first and written once."""
    safe_identifier(run_id, "run id")
    checks = doctor.doctor(ws, provider_id)
    if not doctor.passed(checks):
        raise GateError("workspace doctor failed: " + ", ".join(x["gate"] for x in checks if x["status"] == "fail"))
    spark = ws.seeds.sparkSession
    files = Files(spark, f"{root}/runs/{run_id}")
    files.make(fresh=True)
    wanted = provider_id or ws.config.generation.provider_id
    teacher = next(t for t in ws.rows("teachers") if t["teacher_id"] == wanted)
    if outputs is None:
        count = ws.config.generation.candidates_per_seed
        if teacher["provider"] == "remote":
            hidden = {i for v in doctor.private_identifiers(ws.rows("anchors")).values() for i in v} | {s["source_id"] for s in ws.rows("sources")}
            outputs = providers.remote(ws.seeds, count, providers.chat_client(teacher, ws.config.generation), tuple(sorted(hidden)), ws.config.generation.max_response_bytes)
        else:
            outputs = providers.provider_for(teacher["provider"])(ws.seeds, count)
    at = utc_now()
    read = lambda name: spark.read.parquet(f"{files.root}/{name}.parquet")
    candidates(ws.seeds, outputs, ws.config, run_id, teacher, at).write.parquet(f"{files.root}/raw.parquet")
    raw = read("raw")
    evaluate(raw, ws.benchmarks, ws.config, doctor.private_identifiers(ws.rows("anchors"))).write.parquet(f"{files.root}/evaluated.parquet")
    evaluated = read("evaluated")
    selection.select(evaluated, ws.config.quality).write.parquet(f"{files.root}/selected.parquet")
    selected = read("selected")
    ledger = selection.ledger(evaluated, selected)
    ledger = ledger.select("record_id", canonical_json(F.struct("lineage_id", "reasons", "record_id", "seed_id")).alias("line"))
    for name, rows in (("raw", artifact(raw)), ("evaluated", artifact(evaluated)), ("selected", artifact(selected)), ("rejection-ledger", ledger)):
        files.write_lines(f"{name}.jsonl", rows, "line", "record_id")
    counts = evaluated.agg(
        F.count("*").alias("raw"), F.count_if(F.exists("validation", lambda g: g["status"] == "fail")).alias("failed_gates"), F.count_if(~F.col("verification.passed")).alias("failed_verification"),
        F.count_if(~F.col("contamination.passed")).alias("contaminated"),
    ).first().asDict() | {"selected": selected.count()}
    manifest = {
        "run_id": run_id, "created_at": at, "teacher_id": wanted, "counts": counts, "inputs": input_hashes(ws),
        "artifacts": {n: files.sha256(n) for n in ("raw.jsonl", "evaluated.jsonl", "selected.jsonl", "rejection-ledger.jsonl")},
    }
    files.write_json("manifest.json", manifest)
    files.write_json("state.json", {"run_id": run_id, "stage": "awaiting_review", "updated_at": utc_now(), "counts": counts})
    return manifest


def input_hashes(ws: doctor.Workspace) -> dict[str, str]:
    """A digest of each input table, whatever its row order: for small registries of their
    canonical rows, for seeds and protected items an additive hash."""
    out = {n: sha256_text(canonical_python(sorted(map(canonical_python, ws.rows(n))))) for n in ("sources", "teachers", "reviewers", "anchors")}
    for name in ("seeds", "benchmarks"):
        rows = getattr(ws, name)
        total = rows.agg(F.count("*"), F.sum(F.xxhash64(F.to_json(F.struct(*sorted(rows.columns)))).cast("decimal(38,0)"))).first()
        out[name] = sha256_text(f"{total[0]}|{total[1]}")
    return out


def load_state(spark, root: str, run_id: str) -> dict:
    return Files(spark, f"{root}/runs/{safe_identifier(run_id)}").read_json("state.json")


def assert_sealed(ws: doctor.Workspace, root: str, run_id: str) -> None:
    """Artifacts and inputs are still those of the manifest."""
    files = Files(ws.seeds.sparkSession, f"{root}/runs/{run_id}")
    manifest = files.read_json("manifest.json")
    changed = [n for n, d in manifest["artifacts"].items() if not files.exists(n) or files.sha256(n) != d]
    if changed or manifest["inputs"] != input_hashes(ws):
        raise GateError(f"run artifacts or inputs have changed: {changed}")


def export_review(ws: doctor.Workspace, root: str, run_id: str) -> DataFrame:
    spark = ws.seeds.sparkSession
    return review.packets(spark.read.parquet(f"{root}/runs/{run_id}/selected.parquet"), ws.rows("anchors"))


def import_review(ws: doctor.Workspace, root: str, run_id: str, decided: DataFrame) -> dict:
    """Take decisions in, and move the run to approved."""
    spark = ws.seeds.sparkSession
    assert_sealed(ws, root, run_id)
    files = Files(spark, f"{root}/runs/{run_id}")
    selected = spark.read.parquet(f"{files.root}/selected.parquet")
    reviewed = review.import_decisions(decided, selected, ws.reviewers, ws.rows("anchors"), ws.config.release.corpus_class == "production")
    if files.exists("reviewed.parquet"):
        files.delete("reviewed.parquet")
    reviewed.write.parquet(f"{files.root}/reviewed.parquet")
    counts = review.counts(spark.read.parquet(f"{files.root}/reviewed.parquet"))
    files.write_json("state.json", load_state(spark, root, run_id) | {"stage": "approved", "updated_at": utc_now(), "review": counts})
    return counts


def approve_all(ws: doctor.Workspace, root: str, run_id: str, reviewer: str, rationale: str, manual: bool = False, derivations: bool = False, alignment: bool = False) -> dict:
    """One approval for all selected rows, with the acknowledgements that the corpus class asks for."""
    kind = ws.config.release.corpus_class
    review.acknowledgements(kind, manual, derivations, alignment)
    fixture = kind == "test_fixture"
    selected = ws.seeds.sparkSession.read.parquet(f"{root}/runs/{run_id}/selected.parquet")
    decided = review.decide_all(selected, ws.rows("anchors"), reviewer, rationale, utc_now(), derivations or fixture, alignment or fixture)
    return import_review(ws, root, run_id, decided)
