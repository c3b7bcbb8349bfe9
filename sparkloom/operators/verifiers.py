"""Typed answer verifiers: one CASE over the kind, a Column builder for each."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from sparkloom.functions.text import casefold, strip
from sparkloom.operators.gates import listed

NUMBER = r"[-+]?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?"
REGEX_SECONDS = 0.05


def exact(answer: Column, expected: Column) -> Column:
    return casefold(strip(answer)) == casefold(strip(expected))


def first_number(text: Column) -> Column:
    """The first number anywhere in the text, commas left out, as text; null without one."""
    found = F.regexp_extract(F.replace(strip(text), F.lit(","), F.lit("")), f"(?U){NUMBER}", 0)
    return F.when(found != "", found)


def numeric(answer: Column, expected: Column, tolerance: Column) -> Column:
    """Within the tolerance, in decimals of 38 digits (18 after the point)."""
    as_decimal = lambda c: c.try_cast("decimal(38,18)")
    a, e = as_decimal(first_number(answer)), as_decimal(first_number(expected))
    return F.coalesce(F.abs(a - e) <= tolerance.cast("decimal(38,18)"), F.lit(False))


@F.pandas_udf(BooleanType())
def numeric_any(answer: pd.Series, expected: pd.Series, tolerance: pd.Series) -> pd.Series:
    """The same for numbers of any size; for rows whose numbers exceed 38 digits."""
    import re

    def one(a: str, e: str, t: float) -> bool:
        x, y = re.search(NUMBER, a.replace(",", "")), re.search(NUMBER, e.replace(",", ""))
        return bool(x and y) and abs(Decimal(x[0]) - Decimal(y[0])) <= Decimal(str(t))

    return pd.Series([one(a or "", e or "", t) for a, e, t in zip(answer, expected, tolerance)])


def regex_trusted(answer: Column, pattern: str) -> Column:
    """Full match of a pattern from a trusted registry, inside the JVM."""
    return strip(answer).rlike(rf"\A(?:{pattern})\z")


@F.pandas_udf(BooleanType())
def regex_untrusted(answer: pd.Series, pattern: pd.Series) -> pd.Series:
    """Full match with a time budget for each row; a bad pattern or a timeout is no match."""
    import regex

    def one(a: str | None, p: str | None) -> bool:
        if not p or a is None:
            return False
        try:
            return bool(regex.fullmatch(p, a.strip(), timeout=REGEX_SECONDS))
        except (TimeoutError, regex.error):
            return False

    return pd.Series([one(a, p) for a, p in zip(answer, pattern)])


def json_equal(answer: Column, expected: Column) -> Column:
    """Valid JSON and, unless nothing is expected, of the same structure: keys in any order, 1.0 as 1."""
    a = F.to_json(F.try_parse_json(answer))
    return a.isNotNull() & (expected.isNull() | F.coalesce(a == F.to_json(F.try_parse_json(expected)), F.lit(False)))


def citation(answer: Column, required: Column, cited: Column) -> Column:
    """All required ids are cited, and the marks [1] to [n] all occur in the answer."""
    marks = F.when(F.size(required) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.size(required)))
    return (F.size(F.array_except(required, cited)) == 0) & F.forall(marks, lambda i: F.contains(answer, F.concat(F.lit("["), i.cast("string"), F.lit("]"))))


def _regex(spec: Column, answer: Column, cited: Column) -> Column:
    return regex_untrusted(answer, spec["pattern"])


#: kind -> (verifier spec, answer, cited ids) -> passed.  ``expected`` of a spec is text: JSON for
#: the json kind, the plain value otherwise.  New kinds are added here.
KINDS: dict[str, Callable[[Column, Column, Column], Column]] = {
    "exact": lambda s, a, c: exact(a, s["expected"]),
    "numeric": lambda s, a, c: numeric(a, s["expected"], s["tolerance"]),
    "regex": _regex,
    "json": lambda s, a, c: json_equal(a, s["expected"]),
    "citation": lambda s, a, c: citation(a, s["required_citation_ids"], c),
}


def verify(candidates: DataFrame, regex: bool = True) -> DataFrame:
    """``candidates`` with ``verification``: kind, passed and detail; an unknown kind fails.

    Without ``regex`` the plan has no Python; regex rows then fail closed."""
    spec, answer, cited = F.col("verifier"), F.col("answer"), F.col("citation_ids")
    passed = F.lit(False)
    for kind, build in KINDS.items():
        if kind != "regex":
            passed = F.when(spec["kind"] == kind, build(spec, answer, cited)).otherwise(passed)
    if regex:
        # the pattern is null for other kinds, so the worker does nothing for them
        own = regex_untrusted(answer, F.when(spec["kind"] == "regex", spec["pattern"]))
        passed = F.when(spec["kind"] == "regex", own).otherwise(passed)
    required, given = F.array_sort(spec["required_citation_ids"]), F.array_sort(cited)
    a, e = first_number(answer), first_number(spec["expected"])
    # Details are part of the artifacts.
    detail = (
        F.when(spec["kind"] == "exact", "case-insensitive normalized exact comparison")
        .when((spec["kind"] == "numeric") & (a.isNull() | e.isNull()), "numeric value could not be parsed")
        .when(spec["kind"] == "numeric", F.concat(F.lit("actual="), a, F.lit("; expected="), e, F.lit("; tolerance="), spec["tolerance"].cast("string")))
        .when(spec["kind"] == "regex", F.concat(F.lit("bounded full-match pattern="), F.coalesce(spec["pattern"], F.lit("None"))))
        .when((spec["kind"] == "json") & F.try_parse_json(answer).isNull(), "answer is not valid JSON")
        .when((spec["kind"] == "json") & spec["expected"].isNull(), "valid JSON")
        .when(spec["kind"] == "json", "structural JSON equality")
        .when(spec["kind"] == "citation", F.concat(F.lit("required="), listed(required), F.lit("; cited="), listed(given)))
        .otherwise("")
    )
    return candidates.withColumn("verification", F.struct(spec["kind"].alias("kind"), F.coalesce(passed, F.lit(False)).alias("passed"), detail.alias("detail")))
