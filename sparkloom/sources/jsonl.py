"""Strict JSON Lines and bounded reads."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.errors import ConfigurationError

# Limits of one input file.
MAX_JSONL_BYTES = 256 * 1024 * 1024
MAX_LINE_CHARS = 1024 * 1024
MAX_RECORDS = 1_000_000
MAX_CONFIG_BYTES = 10 * 1024 * 1024


def file_length(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file on any of Hadoop's file systems; None when there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(at).getLength() if fs.exists(at) else None


def read_text_bounded(spark: SparkSession, path: str, most: int = MAX_CONFIG_BYTES) -> str:
    size = file_length(spark, path)
    if size is None:
        raise ConfigurationError(f"there is no {path}")
    if size > most:
        raise ConfigurationError(f"{path} has {size} bytes; at most {most} are read")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_json_object(spark: SparkSession, path: str) -> dict:
    try:
        value = json.loads(read_text_bounded(spark, path))
    except ValueError as e:
        raise ConfigurationError(f"cannot read {path}: {e}") from e
    if not isinstance(value, dict):
        raise ConfigurationError(f"{path} holds a {type(value).__name__} where a mapping is needed")
    return value


def read_config(spark: SparkSession, path: str) -> dict:
    """A YAML object where a YAML reader is installed, else a JSON one (which is YAML too)."""
    text = read_text_bounded(spark, path)
    try:
        import yaml
    except ImportError:
        return read_json_object(spark, path)
    try:
        value = yaml.safe_load(text)
    except yaml.YAMLError as e:
        raise ConfigurationError(f"cannot read YAML {path}: {e}") from e
    if not isinstance(value, dict):
        raise ConfigurationError(f"{path} holds a {type(value).__name__} where a mapping is needed")
    return value


def read_list(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """A small registry: the list under ``key`` of a config file."""
    rows = read_config(spark, path).get(key)
    if not isinstance(rows, list):
        raise ConfigurationError(f"{path} has no list named {key}")
    kind = T._parse_datatype_string(schema)
    return spark.createDataFrame([tuple(r.get(f.name) for f in kind.fields) for r in rows], kind)


def problem_with(value: object, kind: T.DataType, at: str = "") -> str | None:
    """What is wrong with a parsed value; numbers are no strings and true is no number."""
    if value is None:
        return None
    checks = {T.StringType: str, T.BooleanType: bool, T.ArrayType: list, T.StructType: dict, T.MapType: dict}
    want = next((v for k, v in checks.items() if isinstance(kind, k)), None)
    if want is None:
        want = (int,) if isinstance(kind, T.IntegralType) else (int, float)
        if isinstance(value, bool) or not isinstance(value, want):
            return f"{at or 'value'} is not a {kind.simpleString()}"
        return None
    if not isinstance(value, want):
        return f"{at or 'value'} is not a {kind.simpleString()}"
    if isinstance(kind, T.ArrayType):
        return next((p for i, v in enumerate(value) if (p := problem_with(v, kind.elementType, f"{at}[{i}]"))), None)
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            if not f.nullable and value.get(f.name) is None:
                return f"{at}.{f.name} is missing"
            if p := problem_with(value.get(f.name), f.dataType, f"{at}.{f.name}"):
                return p
    return None


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """One record for each line that is not blank; any bad line fails the read.

    The limits on bytes are checked before, those on lines while reading.  ``strict`` checks
    types as they were written, which Spark's reader would coerce; unknown fields are ignored."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    size = file_length(spark, path)
    if size is None:
        raise ConfigurationError(f"there is no {path}")
    if size > MAX_JSONL_BYTES:
        raise ConfigurationError(f"{path} has {size} bytes; at most {MAX_JSONL_BYTES} are read")
    lines = spark.read.text(path, lineSep="\n")
    found = lines.agg(F.count("*").alias("n"), F.max(F.length("value")).alias("longest")).first()
    if found.n > MAX_RECORDS or (found.longest or 0) > MAX_LINE_CHARS:
        raise ConfigurationError(f"{path} has {found.n} lines, the longest of {found.longest} characters; at most {MAX_RECORDS} of {MAX_LINE_CHARS} are read")
    lines = lines.where(F.trim(F.translate("value", "\t\r", "  ")) != "")
    if strict:

        def check(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in source:
                for line in batch.column(0).to_pylist():
                    try:
                        value = json.loads(line)
                    except ValueError as e:
                        raise ValueError(f"not JSON: {line[:80]}") from e
                    if p := "line is not an object" if not isinstance(value, dict) else problem_with(value, kind):
                        raise ValueError(f"{p}: {line[:80]}")
                yield batch

        lines = lines.mapInArrow(check, "value string")
    return lines.select(F.from_json("value", kind, {"mode": "FAILFAST"}).alias("r")).select("r.*")
