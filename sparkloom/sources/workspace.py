"""A workspace on disk: settings, registries, seeds and protected items, read as a ``Workspace`` and
written from one.

    config.yaml
    registry/{sources,teachers,reviewers,behavior-anchors,taxonomy}.yaml
    registry/protected-benchmarks.jsonl
    seeds/seeds.jsonl

Files are YAML where a YAML library is installed and JSON, which is YAML too, otherwise.
"""

from __future__ import annotations

import dataclasses
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.config import Config, build
from sparkloom.errors import AuthorizationError, ConfigurationError
from sparkloom.operators import doctor
from sparkloom.sources import fixtures
from sparkloom.sources.jsonl import file_length, read_config, read_jsonl, read_list
from sparkloom.sources.sinks import Files

#: Registry file, the key its list stands under, and its columns.
REGISTRIES = {
    "sources": ("sources", "sources", doctor.SOURCES), "teachers": ("teachers", "teachers", doctor.TEACHERS),
    "reviewers": ("reviewers", "reviewers", doctor.REVIEWERS), "anchors": ("behavior-anchors", "behavior_anchors", doctor.ANCHORS),
}


def to_yaml(value: object) -> str:
    try:
        import yaml
    except ImportError:
        return json.dumps(value, indent=2, ensure_ascii=False) + "\n"
    return yaml.safe_dump(value, sort_keys=False, allow_unicode=True)


def registry(spark: SparkSession, root: str, name: str) -> DataFrame:
    file, key, schema = REGISTRIES[name]
    path = f"{root}/registry/{file}.yaml"
    rows = read_list(spark, path, key, schema)
    first = rows.schema.fields[0].name
    if not rows.where(F.col(first).isNull()).isEmpty():
        raise ConfigurationError(f"{path}: an entry has no {first}")
    return rows


def config(spark: SparkSession, root: str) -> Config:
    return build(Config, read_config(spark, f"{root}/config.yaml"))


def taxonomy(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Dimension names with their values, as text."""
    value = read_config(spark, f"{root}/registry/taxonomy.yaml")
    if not all(isinstance(v, list) for v in value.values()):
        raise ConfigurationError("a taxonomy maps dimensions to lists of values")
    return {str(k): [str(x) for x in v] for k, v in value.items()}


def load(spark: SparkSession, root: str) -> doctor.Workspace:
    """All of a workspace; seeds and protected items stay distributed.

    Workspaces of schema 1.0 need no anchor registry; protected items may be missing anywhere.
    The anchor profile that the registry must equal is the engine's own, where the registry
    names its source."""
    settings = config(spark, root)
    tables = {}
    for name in REGISTRIES:
        lost = name == "anchors" and settings.schema_version == "1.0" and file_length(spark, f"{root}/registry/{REGISTRIES[name][0]}.yaml") is None
        tables[name] = spark.createDataFrame([], REGISTRIES[name][2]) if lost else registry(spark, root, name)
    benchmarks = f"{root}/registry/protected-benchmarks.jsonl"
    items = spark.createDataFrame([], doctor.BENCHMARKS) if file_length(spark, benchmarks) is None else read_jsonl(spark, benchmarks, doctor.BENCHMARKS)
    seeds = read_jsonl(spark, f"{root}/seeds/seeds.jsonl", doctor.SEEDS)
    anchors = fixtures.behavior_anchors()
    return doctor.Workspace(settings, seeds, **tables, benchmarks=items, taxonomy=taxonomy(spark, root), canonical_anchors=anchors, anchor_source_id=fixtures.ANCHOR_SOURCE)


def plain(value: object) -> object:
    """Dataclasses, tuples and rows as lists and mappings without nulls."""
    if dataclasses.is_dataclass(value):
        value = dataclasses.asdict(value)
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items() if v is not None}
    return [plain(v) for v in value] if isinstance(value, (list, tuple)) else value


def save(ws: doctor.Workspace, root: str) -> str:
    """Write a workspace to a folder that holds none yet."""
    spark = ws.seeds.sparkSession
    files = Files(spark, root)
    if files.exists("config.yaml"):
        raise ConfigurationError(f"there is a workspace already: {root}")
    for folder in ("registry", "seeds", "runs", "releases"):
        files.make(folder)
    files.write("config.yaml", to_yaml(plain(ws.config)))
    for name, (file, key, _) in REGISTRIES.items():
        files.write(f"registry/{file}.yaml", to_yaml({key: plain(ws.rows(name))}))
    files.write("registry/taxonomy.yaml", to_yaml(ws.taxonomy))
    for name, rows, key in (("seeds/seeds.jsonl", ws.seeds, "seed_id"), ("registry/protected-benchmarks.jsonl", ws.benchmarks, "benchmark_id")):
        files.write_lines(name, rows.select(key, F.to_json(F.struct(*rows.columns)).alias("line")), "line", key)
    return root


def scaffold(spark: SparkSession, root: str, demo: bool = False) -> str:
    """A new workspace: the demonstration's, or a production one whose teacher is not approved yet,
    so that nothing runs before a person has looked at the registries."""
    if demo:
        return save(fixtures.demo(spark), root)
    return save(fixtures.production(spark), root)


def teacher(ws: doctor.Workspace, id: str) -> dict:
    """The one approved teacher of this id."""
    found = [t for t in ws.rows("teachers") if t["teacher_id"] == id]
    if len(found) != 1:
        raise ConfigurationError(f"{len(found)} teachers are called {id}")
    if found[0]["authorization_status"] != "approved":
        raise AuthorizationError(f"teacher {id} is {found[0]['authorization_status']}")
    return found[0]


def reviewer(ws: doctor.Workspace, id: str, category: str) -> dict:
    """The one approved reviewer of this id, if it may judge the category."""
    found = [r for r in ws.rows("reviewers") if r["reviewer_id"] == id]
    if len(found) != 1:
        raise ConfigurationError(f"{len(found)} reviewers are called {id}")
    if found[0]["authorization_status"] != "approved" or not {"*", category} & set(found[0]["allowed_categories"]):
        raise AuthorizationError(f"reviewer {id} may not judge {category}")
    return found[0]

