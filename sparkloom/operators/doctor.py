"""Workspace checks: each is a small relational test over seeds and registries.

Registries (sources, teachers, reviewers, anchors) are small by nature and broadcast with a
checked count; seeds are scanned a fixed number of times, whatever their number.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.config import BEHAVIOR_DOMAINS, DIFFICULTIES, FLOORS, MIN_CATEGORIES, Config
from sparkloom.errors import ConfigurationError
from sparkloom.functions.canonical import canonical_python, sha256_text
from sparkloom.operators import referential as R

SEEDS = (
    "seed_id string, lineage_id string, question string, reference_answer string, dimensions struct<answer_form string, category string, difficulty string, "
    "domain string, evidence_mode string, reasoning string, risk string, task string>, verifier struct<kind string, expected string, tolerance double, "
    "pattern string, required_citation_ids array<string>>, source_ids array<string>, behavior_anchor_ids array<string>, generation_depth int"
)
SOURCES = (
    "source_id string, uri string, retrieved_at string, snapshot_sha256 string, authorization_status string, license_basis string, redistribution_allowed boolean, "
    "allowed_target_uses array<string>, compatible_release_licenses array<string>, attribution string, reviewer string"
)
TEACHERS = (
    "teacher_id string, provider string, model string, base_url string, api_key_env string, allow_private_endpoint boolean, authorization_status string, "
    "terms_snapshot_id string, authorization_basis string, allowed_target_uses array<string>, reviewed_at string, reviewer string"
)
REVIEWERS = "reviewer_id string, authorization_status string, allowed_categories array<string>, authorization_basis string, reviewed_at string, authorized_by string"
ANCHORS = (
    "anchor_id string, framework string, domain string, principle string, source_ref string, source_sha256 string, source_version string, source_ids array<string>, "
    "authorization_status string, latent_training boolean, reviewed_at string, reviewer string"
)
BENCHMARKS = "benchmark_id string, question string, answer string"
#: Rows of a registry that may be held by the driver and broadcast.
MOST_REGISTRY = 100_000
#: Offending keys named in a detail.
SHOWN = 20


@dataclass
class Workspace:
    config: Config
    seeds: DataFrame
    sources: DataFrame
    teachers: DataFrame
    reviewers: DataFrame
    anchors: DataFrame
    benchmarks: DataFrame
    taxonomy: dict[str, list[str]] = field(default_factory=dict)
    #: The code-owned profile that the anchor registry must equal, and its source's id.
    canonical_anchors: list[dict] | None = None
    anchor_source_id: str | None = None

    def rows(self, name: str) -> list[dict]:
        """A registry as plain rows, checked to be small."""
        got = getattr(self, name).limit(MOST_REGISTRY + 1).collect()
        if len(got) > MOST_REGISTRY:
            raise ConfigurationError(f"registry {name} is too large")
        return [r.asDict(recursive=True) for r in got]


def private_identifiers(anchors: list[dict]) -> dict[str, list[str]]:
    """By anchor: framework, id, domain, source reference and its parts, folded."""
    out = {}
    for a in anchors:
        names = {a.get("framework") or "", a["anchor_id"], a["domain"], a["source_ref"]}
        for ref in a["source_ref"].split(";"):
            names |= {ref, ref.partition(":")[2]}
        out[a["anchor_id"]] = sorted({n.casefold() for n in names if n})
    return out


def names(rows: DataFrame, column: str | Column) -> tuple[bool, str]:
    """Whether there is none, and the first few."""
    got = [r[0] for r in rows.select(column).distinct().orderBy(1).limit(SHOWN + 1).collect()]
    return not got, f"{got[:SHOWN]}" + (" and more" if len(got) > SHOWN else "")


def doctor(ws: Workspace, provider_id: str | None = None) -> list[dict]:
    """The checks in order: gate, status, detail."""
    out: list[dict] = []
    c, seeds = ws.config, ws.seeds
    current = c.schema_version == "1.1"

    def check(gate: str, passed: bool, detail: str) -> None:
        out.append({"gate": gate, "status": "pass" if passed else "fail", "detail": detail})

    def none(gate: str, what: str, rows: DataFrame, column: str) -> None:
        ok, found = names(rows, column)
        check(gate, ok, f"{what}: {found}")

    check("schema_current", current, "schema 1.1" if current else "schema 1.0 is readable for audit only and must be migrated before use")
    for gate, rows, key, what in (
        ("unique_sources", ws.sources, "source_id", "source"), ("unique_teachers", ws.teachers, "teacher_id", "teacher"),
        ("unique_reviewers", ws.reviewers, "reviewer_id", "reviewer"), ("unique_behavior_anchors", ws.anchors, "anchor_id", "behavior anchor"),
    ):
        check(gate, R.repeated(rows, key).isEmpty(), f"{what} IDs unique")
    spark = seeds.sparkSession
    categories = spark.createDataFrame([(x,) for x in ws.taxonomy.get("categories", [])], "category string")
    none("reviewer_category_coverage", "uncovered categories", R.uncovered(categories, "category", ws.reviewers), "category")
    check("unique_seeds", R.repeated(seeds, "seed_id").isEmpty(), "seed IDs unique")
    # references of seeds and anchors, exploded once
    seed_refs = seeds.select(F.explode("source_ids").alias("source_ref")).distinct().persist()
    anchor_refs = ws.anchors.select(F.explode("source_ids").alias("source_ref")).distinct()
    none("seed_sources_exist", "unknown sources", R.missing(seed_refs, "source_ref", ws.sources, "source_id"), "source_ref")
    none("behavior_anchor_sources_exist", "unknown sources", R.missing(anchor_refs, "source_ref", ws.sources, "source_id"), "source_ref")
    if current and ws.canonical_anchors is not None:
        loaded = canonical_python(ws.rows("anchors"))
        same = loaded == canonical_python(ws.canonical_anchors)
        check("behavior_anchor_canonical", same, f"registry matches code-owned anchor profile={same}")
        held = {r["source_id"]: r["snapshot_sha256"] for r in ws.rows("sources")}.get(ws.anchor_source_id)
        check("behavior_anchor_snapshot", held == sha256_text(loaded), f"source={ws.anchor_source_id}; registry digest matches={held == sha256_text(loaded)}")
    seed_anchors = seeds.select(F.explode("behavior_anchor_ids").alias("anchor_ref")).distinct().persist()
    none("seed_behavior_anchors_exist", "unknown anchors", R.missing(seed_anchors, "anchor_ref", ws.anchors, "anchor_id"), "anchor_ref")
    none("behavior_anchors_authorized", "unauthorized anchors", ws.anchors.where("authorization_status <> 'approved'"), "anchor_id")
    uses = F.array(*[F.lit(u) for u in c.release.intended_uses])
    rules = [
        ("behavior_anchor_sources_authorized", "seed_sources_authorized", "unauthorized sources", F.col("authorization_status") != "approved"),
        ("behavior_anchor_sources_redistributable", "seed_sources_redistributable", "non-redistributable sources", ~F.col("redistribution_allowed")),
        ("behavior_anchor_target_use_compatible", "source_target_use_compatible", "incompatible sources", ~R.subset(uses, F.col("allowed_target_uses"))),
        ("behavior_anchor_release_license_compatible", "source_release_license_compatible", "incompatible sources", ~F.array_contains("compatible_release_licenses", c.release.license)),
    ]
    for anchor_gate, seed_gate, what, bad in rules:
        for gate, refs in ((anchor_gate, anchor_refs), (seed_gate, seed_refs)):
            none(gate, what, R.referencing(ws.sources.where(bad), "source_id", refs, "source_ref"), "source_id")
    wanted = provider_id or c.generation.provider_id
    teachers = [t for t in ws.rows("teachers") if t["teacher_id"] == wanted]
    check("teacher_exists", len(teachers) == 1, f"teacher: {wanted}")
    check("teacher_authorized", bool(teachers) and teachers[0]["authorization_status"] == "approved", f"teacher: {wanted}")
    check("teacher_target_use_compatible", len(teachers) == 1 and set(c.release.intended_uses) <= set(teachers[0]["allowed_target_uses"]), f"teacher: {wanted}")
    fields = {"categories": "category", "domains": "domain", "tasks": "task", "reasoning": "reasoning", "answer_forms": "answer_form"}
    flat = seeds.select("seed_id", *[F.col(f"dimensions.{f}").alias(f) for f in fields.values()])
    outside = R.outside_taxonomy(flat, "seed_id", {f: ws.taxonomy.get(k, []) for k, f in fields.items()})
    outside = outside.select(F.concat("seed_id", F.lit(":"), "field", F.lit("="), "value").alias("bad")) if any(ws.taxonomy.get(k) for k in fields) else seeds.select(F.col("seed_id").alias("bad")).limit(0)
    none("taxonomy_membership", "invalid", outside, "bad")
    none("generation_depth", "depth blocked", seeds.where(F.col("generation_depth") + 1 > c.generation.max_generation_depth), "seed_id")
    # every scalar of the seeds in one pass
    facts = seeds.agg(
        F.count("*").alias("n"), F.count_distinct("dimensions.category").alias("categories"), F.collect_set("dimensions.difficulty").alias("difficulties"),
        F.count_if(F.size("behavior_anchor_ids") == 0).alias("bare"),
    ).first()
    check("seed_bank_nonempty", facts.n > 0, f"seed count: {facts.n}")
    if current and c.release.corpus_class == "production":
        check("production_seed_categories", facts.categories >= MIN_CATEGORIES, f"categories={facts.categories}; minimum={MIN_CATEGORIES}")
        lost = sorted(set(DIFFICULTIES) - set(facts.difficulties))
        check("production_seed_difficulties", not lost, f"missing={lost}")
        none("production_seed_behavior_anchors", "unanchored seeds", seeds.where(F.size("behavior_anchor_ids") == 0), "seed_id")
        domains = {r[0] for r in R.referencing(ws.anchors, "anchor_id", seed_anchors, "anchor_ref").select("domain").distinct().collect()}
        lost = sorted(set(BEHAVIOR_DOMAINS) - domains)
        check("production_behavior_domains", not lost, f"missing={lost}")
        capacity = {r.split: r.capacity for r in R.split_capacity(seeds, "lineage_id", c.split, 0).collect()}
        short = {s: n - capacity.get(s, 0) for s, n in FLOORS.items() if capacity.get(s, 0) < n}
        check("production_split_capacity", not short, f"capacity={capacity}; deficits={short}")
    seed_refs.unpersist()
    seed_anchors.unpersist()
    return out


def passed(checks: list[dict]) -> bool:
    return all(x["status"] == "pass" for x in checks)
