"""Canonical JSON, digests and the rendered training message."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.functions.text import strip

# Headings that trainers see.
DERIVATION = "Derivation:"
FINAL = "Final answer:"


def canonical_json(value: Column, keep_nulls: bool = False) -> Column:
    """Compact JSON of a struct whose fields are declared in alphabetical order.

    Spark writes control characters as \\u001F; lower-case hex is canonical.  The rewrite runs
    only on rows that have such an escape, and never touches an escaped backslash before it."""
    text = F.to_json(value, {"ignoreNullFields": "false"} if keep_nulls else {})
    lowered = text
    for code in (*range(0x0A, 0x10), 0x1A, 0x1B, 0x1C, 0x1D, 0x1E, 0x1F, 0x0B, 0x0E, 0x0F):
        name = f"{code:04X}"
        if name != name.lower():
            lowered = F.regexp_replace(lowered, rf"(?<!\\)((?:\\\\)*)\\u{name}", rf"$1\\u{name.lower()}")
    return F.when(text.rlike(r"\\u00[01][A-F]"), lowered).otherwise(text)


def canonical_python(value: object) -> str:
    """The same on the driver."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def sha256_text(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def render_assistant(derivation: Column, answer: Column) -> Column:
    """Numbered steps under one heading, the answer under another."""
    steps = F.array_join(F.transform(derivation, lambda s, i: F.concat((i + 1).cast("string"), F.lit(". "), strip(s))), "\n")
    return F.concat(F.lit(DERIVATION + "\n"), steps, F.lit(f"\n\n{FINAL}\n"), strip(answer))


def messages(question: Column, assistant: Column) -> Column:
    return F.array(
        F.struct(question.alias("content"), F.lit("user").alias("role")),
        F.struct(assistant.alias("content"), F.lit("assistant").alias("role")),
    )


def training_row(question: Column, derivation: Column, answer: Column) -> Column:
    """The one-line JSON that trainers read."""
    return canonical_json(F.struct(messages(question, render_assistant(derivation, answer)).alias("messages")))


def content_digest(question: Column, derivation: Column, answer: Column) -> Column:
    return digest(training_row(question, derivation, answer))


def legacy_digest(question: Column, answer: Column) -> Column:
    """Of the older schema, without a derivation."""
    return digest(canonical_json(F.struct(answer.alias("answer"), question.alias("question"))))


def record_id(content: Column, index: Column, run: Column, seed: Column) -> Column:
    key = canonical_json(F.struct(content.alias("content"), index.alias("index"), run.alias("run"), seed.alias("seed")))
    return F.concat(F.lit("qa_"), F.substring(digest(key), 1, 24))


def is_training_row(line: Column) -> Column:
    """Exactly one user and one assistant message, the assistant's in the rendered form."""
    parsed = F.try_parse_json(line)
    text = F.to_json(parsed)
    top = F.array_sort(F.json_object_keys(text))
    shape = F.from_json(line, "messages array<map<string,string>>").getField("messages")
    user, assistant = F.get(shape, 0), F.get(shape, 1)
    q, a = user["content"], assistant["content"]
    separator = f"\n\n{FINAL}\n"
    keys = lambda m: F.array_sort(F.map_keys(m)) == F.array(F.lit("content"), F.lit("role"))
    strings = lambda i: F.schema_of_variant(F.try_variant_get(parsed, f"$.messages[{i}].content", "variant")) == "STRING"
    ok = (
        (top == F.array(F.lit("messages"))) & (F.size(shape) == 2) & keys(user) & keys(assistant) & strings(0) & strings(1)
        & (user["role"] == "user") & (assistant["role"] == "assistant") & (strip(q) != "")
        & a.startswith(f"{DERIVATION}\n1. ") & (F.size(F.split(a, rf"\Q{separator}\E", -1)) == 2) & ~a.endswith(f"{FINAL}\n")
    )
    return F.coalesce(ok, F.lit(False))
