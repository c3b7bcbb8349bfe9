"""Review: packets for people, their decisions, and what binds the two."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.errors import AuthorizationError, GateError

DECISION = (
    "record_id string, candidate_sha256 string, decision string, reviewer string, rationale string, derivation_verified boolean, "
    "behavior_alignment_verified boolean, reviewed_at string"
)


def completeness(selected: DataFrame, decided: DataFrame, key: str) -> DataFrame:
    """Keys that spoil a full review: decided but unknown, decided twice, or missing."""
    counts = decided.groupBy(key).agg(F.count("*").alias("n")).withColumnRenamed(key, "__d")
    both = selected.select(F.col(key).alias("__s")).distinct().join(counts, F.col("__s") == F.col("__d"), "full_outer")
    problem = F.when(F.col("__s").isNull(), "unknown").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate")
    return both.select(F.coalesce("__s", "__d").alias(key), problem.alias("problem")).where("problem is not null")


def anchor_contexts(ids: Column, anchors: list[dict]) -> Column:
    """The anchors of a record in order; an unknown id raises.  The registry is a literal map."""
    fields = ("anchor_id", "domain", "principle", "source_ref", "source_sha256")
    kind = "array<struct<" + ",".join(f"{f}:string" for f in fields) + ">>"
    if not anchors:
        return F.when(F.size(ids) > 0, F.raise_error(F.lit("record has an unknown behavior anchor")).cast(kind)).otherwise(F.array().cast(kind))
    known = F.create_map(*[x for a in anchors for x in (F.lit(a["anchor_id"]), F.struct(*[F.lit(a[f]).alias(f) for f in fields]))])
    return F.transform(ids, lambda i: F.coalesce(F.try_element_at(known, i), F.raise_error(F.concat(F.lit("record has an unknown behavior anchor: "), i))))


def packets(selected: DataFrame, anchors: list[dict]) -> DataFrame:
    """What a reviewer sees, with an open decision bound to the content's digest."""
    no = F.lit(None).cast("string")
    return selected.select(
        "record_id", F.col("content_sha256").alias("candidate_sha256"), "question", "derivation", F.col("answer").alias("final_answer"), F.col("dimensions.category").alias("category"),
        anchor_contexts(F.col("behavior_anchor_ids"), anchors).alias("behavior_anchors"), F.lit("pending").alias("decision"), no.alias("reviewer"), no.alias("rationale"),
        F.lit(False).alias("derivation_verified"), F.lit(False).alias("behavior_alignment_verified"), no.alias("reviewed_at"),
    )


def may_review(category: Column, allowed: Column) -> Column:
    return F.array_contains(allowed, "*") | F.array_contains(allowed, category)


def problems(decided: DataFrame, selected: DataFrame, reviewers: DataFrame, anchors: list[dict], production: bool) -> DataFrame:
    """record_id and problem of every decision that cannot be taken in."""
    sealed = packets(selected, anchors)
    shown = ["candidate_sha256", "question", "derivation", "final_answer", "category", "behavior_anchors"]
    theirs = decided.select(F.col("record_id").alias("__id"), *[F.col(c).alias(f"__{c}") for c in [*shown, "decision", "reviewer", "rationale", "derivation_verified", "behavior_alignment_verified"]])
    rows = sealed.select("record_id", *shown).join(theirs, F.col("record_id") == F.col("__id"))
    known = reviewers.select(F.col("reviewer_id").alias("__r"), "authorization_status", "allowed_categories")
    rows = rows.join(F.broadcast(known), F.col("__reviewer") == F.col("__r"), "left")
    changed = F.lit(False)
    for c in shown[1:]:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"__{c}"))
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    attested = F.col("__derivation_verified") & F.col("__behavior_alignment_verified")
    found = [
        F.when(~F.col("candidate_sha256").eqNullSafe(F.col("__candidate_sha256")), "digest mismatch"),
        F.when(changed, "displayed content was changed"),
        F.when(~F.coalesce(F.col("__decision").isin("approved", "rejected"), F.lit(False)), "decision is pending"),
        F.when(blank("__reviewer") | blank("__rationale"), "reviewer and rationale are required"),
        F.when((F.col("__decision") == "approved") & ~F.coalesce(attested, F.lit(False)), "attestations are missing") if production else F.lit(None).cast("string"),
        F.when(~F.coalesce((F.col("authorization_status") == "approved") & may_review(F.col("category"), F.col("allowed_categories")), F.lit(False)), "reviewer is not authorized"),
    ]
    each = rows.select("record_id", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("problem"))
    return completeness(selected, decided, "record_id").unionByName(each)


def import_decisions(decided: DataFrame, selected: DataFrame, reviewers: DataFrame, anchors: list[dict], production: bool = False) -> DataFrame:
    """The selected records with ``review``; raises with the first problems found."""
    bad = problems(decided, selected, reviewers, anchors, production).limit(5).collect()
    if bad:
        kind = AuthorizationError if all(b.problem == "reviewer is not authorized" for b in bad) else GateError
        raise kind("review cannot be imported: " + "; ".join(f"{b.record_id}: {b.problem}" for b in bad))
    names = [f.split()[0] for f in DECISION.split(", ")]
    review = decided.select(F.col("record_id").alias("__id"), F.struct(*names).alias("review"))
    return selected.drop("review").join(review, F.col("record_id") == F.col("__id")).drop("__id")


def acknowledgements(corpus_class: str, manual: bool, derivations: bool, alignment: bool) -> None:
    """A bulk decision vouches for work that people have done: each kind is said for itself.  Fixtures
    need none, calibration the first, production all."""
    need = {"test_fixture": (), "calibration": ("manual review",), "production": ("manual review", "derivation verification", "behavior alignment")}[corpus_class]
    said = {"manual review": manual, "derivation verification": derivations, "behavior alignment": alignment}
    if lost := [x for x in need if not said[x]]:
        raise GateError(f"a bulk decision on a {corpus_class} corpus acknowledges {', '.join(lost)}")


def decide_all(selected: DataFrame, anchors: list[dict], reviewer: str, rationale: str, reviewed_at: str, derivations: bool, alignment: bool, decision: str = "approved") -> DataFrame:
    """Packets with one decision for all, attested as far as the caller has acknowledged."""
    out = packets(selected, anchors)
    values = {"decision": decision, "reviewer": reviewer, "rationale": rationale, "reviewed_at": reviewed_at, "derivation_verified": derivations, "behavior_alignment_verified": alignment}
    return out.select(*[F.lit(values[c]).alias(c) if c in values else F.col(c) for c in out.columns])


def counts(reviewed: DataFrame) -> dict:
    return reviewed.agg(F.count_if(F.col("review.decision") == "approved").alias("approved"), F.count_if(F.col("review.decision") == "rejected").alias("rejected")).first().asDict()
