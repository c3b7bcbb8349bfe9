"""Workspaces to start from: a small demonstration with all verifier kinds, and the calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.config import BEHAVIOR_DOMAINS, Config, Generation, Quality, Release
from sparkloom.functions.canonical import canonical_python, sha256_text
from sparkloom.operators import calibration, doctor
from sparkloom.operators.splits import Split

ANCHOR_SOURCE = "SRC-BEHAVIOR-PROFILE"
AT = "2026-01-01T00:00:00Z"


def behavior_anchors(framework: str = "house") -> list[dict]:
    """A canonical anchor for each behaviour domain; principle and reference are placeholders that
    a deployment replaces by its own reviewed profile."""
    return [
        {
            "anchor_id": f"{framework}.{d}", "framework": framework, "domain": d, "principle": f"Reviewed principle for {d.replace('-', ' ')}.", "source_ref": f"profile:{d}-reference",
            "source_sha256": sha256_text(d), "source_version": "1", "source_ids": [ANCHOR_SOURCE], "authorization_status": "approved", "latent_training": True, "reviewed_at": AT, "reviewer": "project-team",
        }
        for d in BEHAVIOR_DOMAINS
    ]


def registry_digest(anchors: list[dict]) -> str:
    return sha256_text(canonical_python(anchors))


def source(id: str, snapshot: str, **changes) -> dict:
    return {
        "source_id": id, "uri": f"https://example.org/{id.lower()}", "retrieved_at": AT, "snapshot_sha256": snapshot, "authorization_status": "approved", "license_basis": "authored", "redistribution_allowed": True,
        "allowed_target_uses": ["supervised fine-tuning"], "compatible_release_licenses": ["CC-BY-4.0"], "attribution": "project", "reviewer": "project-team",
    } | changes


def teacher(id: str, provider: str = "deterministic", **changes) -> dict:
    return {
        "teacher_id": id, "provider": provider, "model": "fixture", "base_url": None, "api_key_env": None, "allow_private_endpoint": False, "authorization_status": "approved", "terms_snapshot_id": "terms-1",
        "authorization_basis": "authored", "allowed_target_uses": ["supervised fine-tuning"], "reviewed_at": AT, "reviewer": "project-team",
    } | changes


def table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    names = [f.name for f in spark.createDataFrame([], schema).schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def workspace(spark: SparkSession, seeds: DataFrame, config: Config, sources: list[dict], taxonomy: dict[str, list[str]], benchmarks: list[tuple] = (), **changes) -> doctor.Workspace:
    anchors = behavior_anchors()
    rows = {
        "sources": changes.get("all_sources") or [*sources, source(ANCHOR_SOURCE, registry_digest(anchors))], "teachers": [teacher(config.generation.provider_id)],
        "reviewers": [{"reviewer_id": "demo-fixture", "authorization_status": "approved", "allowed_categories": ["*"], "authorization_basis": "fixture", "reviewed_at": AT, "authorized_by": "project-team"}], "anchors": anchors,
    } | changes
    return doctor.Workspace(
        config, seeds, table(spark, rows["sources"], doctor.SOURCES), table(spark, rows["teachers"], doctor.TEACHERS), table(spark, rows["reviewers"], doctor.REVIEWERS), table(spark, rows["anchors"], doctor.ANCHORS),
        spark.createDataFrame(list(benchmarks), doctor.BENCHMARKS), taxonomy, anchors, ANCHOR_SOURCE,
    )


#: category, question, answer, verifier kind, expected, pattern, required citations, evidence mode
DEMO = [
    ("arithmetic", "What is 17 multiplied by 6?", "102", "numeric", "102", None, [], "deterministic"),
    ("logic", "All finches are birds, and Pip is a finch. Is Pip a bird? Answer yes or no.", "yes", "exact", "yes", None, [], "deterministic"),
    ("code", "Return a JSON object whose key total is the sum of 3, 4 and 5.", '{"total":12}', "json", '{"total":12}', None, [], "deterministic"),
    ("format", "Write the first day of March 2024 as an ISO date.", "2024-03-01", "regex", None, r"\d{4}-03-01", [], "deterministic"),
    ("grounding", "Which unit does the style note require for lengths? Cite it.", "Lengths are given in metres [1].", "citation", None, None, ["SRC-DEMO"], "source_grounded"),
    ("safety", "Should a lab share an unreviewed pathogen protocol? Answer yes or no.", "no", "exact", "no", None, [], "deterministic"),
    ("planning", "Task A takes 3 hours and task B, after it, takes 4. When do both end?", "7", "numeric", "7", None, [], "deterministic"),
    ("geometry", "How many degrees do the angles of a triangle add up to?", "180", "numeric", "180", None, [], "deterministic"),
]


def demo(spark: SparkSession, **changes) -> doctor.Workspace:
    """Eight seeds, eight lineages, all five verifiers; three candidates for each seed."""
    seeds = []
    for i, (category, question, answer, kind, expected, pattern, cited, evidence) in enumerate(DEMO):
        dims = {"answer_form": "concise", "category": category, "difficulty": ("introductory", "intermediate", "advanced")[i % 3], "domain": "general", "evidence_mode": evidence, "reasoning": "direct", "risk": "sensitive" if category == "safety" else "ordinary", "task": "answer"}
        seeds.append(
            {
                "seed_id": f"seed-{category}", "lineage_id": f"family-{category}", "question": question, "reference_answer": answer, "dimensions": dims,
                "verifier": {"kind": kind, "expected": expected, "tolerance": 1e-6, "pattern": pattern, "required_citation_ids": cited}, "source_ids": ["SRC-DEMO"],
                "behavior_anchor_ids": [behavior_anchors()[i]["anchor_id"]], "generation_depth": 0,
            }
        )
    config = Config(
        Split("demonstration-salt", 0.75, 0.125, 0.125), Generation("deterministic-teacher"), Quality(target_size=8, coverage_floors={"category": {c[0]: 1 for c in DEMO}}),
        Release("demo-corpus", "1.0.0", "CC-BY-4.0", ("supervised fine-tuning",), ("surveillance",), "test_fixture"), demo_mode=True,
    )
    taxonomy = {"categories": [c[0] for c in DEMO], "domains": ["general"], "tasks": ["answer"], "reasoning": ["direct"], "answer_forms": ["concise"]}
    benchmarks = [("bench-1", "Name the longest river of the southern continent.", None)]
    return workspace(spark, table(spark, seeds, doctor.SEEDS), config, [source("SRC-DEMO", "a" * 64)], taxonomy, benchmarks, **changes)


def calibration_workspace(spark: SparkSession, size: int = 1000) -> doctor.Workspace:
    """The calibration bank as a workspace: thresholds of 1, two bands, one anchor a family."""
    bank = calibration.bank(spark, size)
    ids = [a["anchor_id"] for a in behavior_anchors()]
    anchor = F.element_at(F.create_map(*[x for c, i in zip(calibration.CATEGORIES, ids) for x in (F.lit(c), F.lit(i))]), F.col("dimensions.category"))
    seeds = bank.withColumn("behavior_anchor_ids", F.array(anchor))
    config = Config(
        Split("calibration-salt"), Generation("deterministic-teacher"), Quality(target_size=size, near_duplicate_threshold=1.0, semantic_threshold=1.0, semantic_lsh_bands=2),
        Release("calibration-corpus", "1.0.0", "CC-BY-4.0", ("supervised fine-tuning",), ("surveillance",), "calibration"),
    )
    return workspace(spark, seeds, config, [source("SRC-PILOT-AUTHORED", "b" * 64)], {"categories": list(calibration.CATEGORIES)})


def production(spark: SparkSession) -> doctor.Workspace:
    """The frame of a production corpus: floors of the policy, one example seed, and a remote teacher
    whose authorization is open."""
    dims = {"answer_form": "concise", "category": "arithmetic", "difficulty": "introductory", "domain": "general", "evidence_mode": "deterministic", "reasoning": "direct", "risk": "ordinary", "task": "answer"}
    seed = {
        "seed_id": "seed-example", "lineage_id": "family-example", "question": "What is 12 multiplied by 12?", "reference_answer": "144", "dimensions": dims,
        "verifier": {"kind": "numeric", "expected": "144", "tolerance": 1e-6, "pattern": None, "required_citation_ids": []}, "source_ids": ["SRC-SEEDS"],
        "behavior_anchor_ids": [behavior_anchors()[0]["anchor_id"]], "generation_depth": 0,
    }
    config = Config(
        Split("replace-this-salt"), Generation("remote-teacher"), Quality(target_size=30_000), Release("new-corpus", "0.1.0", "CC-BY-4.0", ("supervised fine-tuning",), ("surveillance",), "production"),
    )
    taxonomy = {"categories": ["arithmetic"], "domains": ["general"], "tasks": ["answer"], "reasoning": ["direct"], "answer_forms": ["concise"]}
    open_ = teacher("remote-teacher", "remote", base_url="https://teacher.example/v1", api_key_env="TEACHER_API_KEY", authorization_status="unclear")
    return workspace(spark, table(spark, [seed], doctor.SEEDS), config, [source("SRC-SEEDS", "a" * 64)], taxonomy, teachers=[open_])
