"""Typed settings with their limits; plain dataclasses on the driver."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields, is_dataclass

from sparkloom.errors import ConfigurationError
from sparkloom.operators.splits import Split

DIMENSIONS = ("answer_form", "category", "difficulty", "domain", "evidence_mode", "reasoning", "risk", "task")
RISKS = ("ordinary", "sensitive", "dual_use", "high_stakes", "prohibited")
DIFFICULTIES = {"introductory": 0.25, "intermediate": 0.6, "advanced": 1.0}
EVIDENCE_MODES = ("deterministic", "source_grounded", "rubric")
AUTHORIZATION = ("approved", "blocked", "unclear", "expired")
SPLITS = ("train", "validation", "test")
CORPUS_CLASSES = ("production", "calibration", "test_fixture")
# The floors of a production corpus.
FLOORS = {"train": 20_000, "validation": 2_000, "test": 2_000}
MIN_CATEGORIES = 10
TRAINING_SEEDS = (17, 29, 47)
BEHAVIOR_DOMAINS = (
    "requirements-and-acceptance", "evidence-before-assertion", "provenance-and-traceability", "threat-modeling-and-least-authority",
    "independent-verification", "test-and-quality-gates", "change-impact-and-architecture", "operational-readiness-and-recovery",
    "context-boundaries-and-poisoning-resistance", "orchestration-and-accountable-integration",
)


def need(ok: bool, what: str) -> None:
    if not ok:
        raise ConfigurationError(what)


@dataclass(frozen=True)
class Generation:
    provider_id: str
    candidates_per_seed: int = 3
    max_generation_depth: int = 1
    temperature: float = 0.7
    max_tokens: int = 1024
    timeout_seconds: float = 60
    max_response_bytes: int = 1_000_000

    def __post_init__(self):
        need(3 <= self.candidates_per_seed <= 10, "candidates_per_seed is 3 to 10")
        need(0 <= self.max_generation_depth <= 8, "max_generation_depth is 0 to 8")
        need(0 <= self.temperature <= 2, "temperature is 0 to 2")
        need(32 <= self.max_tokens <= 32768, "max_tokens is 32 to 32768")
        need(0 < self.timeout_seconds <= 600, "timeout_seconds is over 0, at most 600")
        need(1024 <= self.max_response_bytes <= 10_000_000, "max_response_bytes is out of range")


@dataclass(frozen=True)
class Quality:
    target_size: int = 1000
    min_question_chars: int = 12
    min_answer_chars: int = 1
    min_derivation_chars: int = 24
    near_duplicate_threshold: float = 0.86
    semantic_threshold: float = 0.94
    semantic_dimensions: int = 384
    semantic_lsh_bands: int = 8
    max_per_lineage: int = 1
    coverage_floors: dict[str, dict[str, int]] = field(default_factory=dict)
    allowed_risks: tuple[str, ...] = ("ordinary", "sensitive")

    def __post_init__(self):
        need(self.target_size >= 1 and self.max_per_lineage >= 1, "sizes are positive")
        need(self.min_question_chars >= 1 and self.min_answer_chars >= 1, "lengths are positive")
        need(8 <= self.min_derivation_chars <= 4096, "min_derivation_chars is 8 to 4096")
        need(0 <= self.near_duplicate_threshold <= 1 and 0 <= self.semantic_threshold <= 1, "thresholds are 0 to 1")
        need(64 <= self.semantic_dimensions <= 4096, "semantic_dimensions is 64 to 4096")
        need(self.semantic_lsh_bands in (1, 2, 4, 8, 16), "semantic_lsh_bands is 1, 2, 4, 8 or 16")
        unknown = sorted(set(self.coverage_floors) - set(DIMENSIONS))
        need(not unknown, f"unknown coverage dimensions: {unknown}")
        low = [f"{d}.{v}" for d, values in self.coverage_floors.items() for v, n in values.items() if n < 1]
        need(not low, f"coverage floors must be positive: {low}")
        need(set(self.allowed_risks) <= set(RISKS), "unknown risk")

    def floors(self) -> list[tuple[str, str, int]]:
        return [(d, v, n) for d, values in sorted(self.coverage_floors.items()) for v, n in sorted(values.items())]


@dataclass(frozen=True)
class Review:
    required: bool = True

    def __post_init__(self):
        need(self.required is True, "review cannot be switched off")


@dataclass(frozen=True)
class Release:
    dataset_id: str
    version: str
    license: str
    intended_uses: tuple[str, ...]
    prohibited_uses: tuple[str, ...]
    corpus_class: str = "production"

    def __post_init__(self):
        need(bool(re.fullmatch(r"[a-z0-9][a-z0-9._-]+", self.dataset_id)), "dataset_id is malformed")
        need(bool(re.fullmatch(r"[0-9]+\.[0-9]+\.[0-9]+(?:[-+][A-Za-z0-9.-]+)?", self.version)), "version is malformed")
        need(bool(self.intended_uses) and bool(self.prohibited_uses), "uses must be named")
        need(self.corpus_class in CORPUS_CLASSES, "unknown corpus class")


@dataclass(frozen=True)
class Config:
    split: Split
    generation: Generation
    quality: Quality
    release: Release
    review: Review = Review()
    schema_version: str = "1.1"
    language_bcp47: str = "en"
    demo_mode: bool = False

    def __post_init__(self):
        need(self.schema_version in ("1.0", "1.1"), "unknown schema version")
        if self.schema_version == "1.0":
            return
        need(self.demo_mode == (self.release.corpus_class == "test_fixture"), f"corpus class {self.release.corpus_class} does not go with demo_mode = {self.demo_mode}: fixtures, and only they, are demos")
        if self.release.corpus_class == "production":
            need(self.quality.target_size >= sum(FLOORS.values()), f"production target_size must be at least {sum(FLOORS.values())}")


def build(kind: type, values: dict):
    """A dataclass from plain data; unknown keys are ignored, nested dataclasses are built too."""
    need(isinstance(values, dict), f"{kind.__name__} is not a mapping")
    nested = {"split": Split, "generation": Generation, "quality": Quality, "review": Review, "release": Release}
    args = {}
    for f in fields(kind):
        if f.name in values:
            v = values[f.name]
            if is_dataclass(kind) and kind is Config and f.name in nested:
                v = build(nested[f.name], v)
            elif isinstance(v, list):
                v = tuple(v)
            args[f.name] = v
    try:
        return kind(**args)
    except TypeError as e:
        raise ConfigurationError(f"{kind.__name__}: {e}") from e


def safe_identifier(value: str, label: str = "identifier") -> str:
    need(bool(re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]{0,127}", value)) and ".." not in value, f"invalid {label}: {value!r}")
    return value
