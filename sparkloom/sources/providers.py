"""Teachers: sources of generated outputs for seeds.

A provider turns seeds into (seed_id, outputs), outputs an array of (derivation, answer,
citation_ids).  Deterministic and collected teachers are plain projections and joins; a remote
one gets its client injected and runs in Arrow batches.
"""

from __future__ import annotations

import ipaddress
import json
import os
import socket
import urllib.request
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.errors import AuthorizationError, ConfigurationError, GateError

OUTPUTS = "array<struct<derivation:array<string>,answer:string,citation_ids:array<string>>>"
STEPS, STEP_CHARS, ANSWER_CHARS, CITATIONS = 16, 2048, 32768, 64
#: A fixed derivation for deterministic fixtures.
FIXTURE_STEPS = ("Read the task and identify the requested result and its constraints.", "Apply the constraints and confirm that the reference result satisfies them.")


def checked_count(count: int) -> int:
    if not 3 <= count <= 10:
        raise ConfigurationError("a provider gives 3 to 10 outputs")
    return count


def deterministic(seeds: DataFrame, count: int) -> DataFrame:
    """The reference answer under a fixed derivation, with all required citations."""
    checked_count(count)
    one = F.struct(F.array(*[F.lit(s) for s in FIXTURE_STEPS]).alias("derivation"), F.col("reference_answer").alias("answer"), F.col("verifier.required_citation_ids").alias("citation_ids"))
    return seeds.withColumn("outputs", F.transform(F.sequence(F.lit(1), F.lit(count)), lambda _: one))


def collected(seeds: DataFrame, responses: DataFrame, count: int) -> DataFrame:
    """Submitted responses (seed_id, candidate_index, derivation, answer); citations are dropped.
    Fails unless every seed has exactly the indexes 0 to count - 1."""
    checked_count(count)
    each = responses.groupBy("seed_id").agg(F.array_sort(F.collect_list(F.struct("candidate_index", "derivation", "answer"))).alias("r")).withColumnRenamed("seed_id", "__s")
    rows = seeds.join(each, F.col("seed_id") == F.col("__s"), "left").drop("__s")
    whole = F.transform("r", lambda x: x["candidate_index"].cast("int")) == F.sequence(F.lit(0), F.lit(count - 1))
    if not rows.where(~F.coalesce(whole, F.lit(False))).isEmpty():
        raise GateError("collected responses are incomplete")
    none = F.array().cast("array<string>")
    return rows.withColumn("outputs", F.transform("r", lambda x: F.struct(x["derivation"].alias("derivation"), x["answer"].alias("answer"), none.alias("citation_ids")))).drop("r")


def parse_outputs(text: str, count: int) -> list[dict]:
    """The strict reply of a remote teacher: {"candidates": [{"derivation": [...], "answer": ...}]}."""
    value = json.loads(text)
    rows = value["candidates"] if isinstance(value, dict) and set(value) == {"candidates"} else None
    if not isinstance(rows, list) or len(rows) != count:
        raise ValueError("a reply does not hold the asked number of candidates")
    out = []
    for r in rows:
        if not isinstance(r, dict) or not {"derivation", "answer"} <= set(r) <= {"derivation", "answer", "citation_ids"}:
            raise ValueError("a candidate has other fields")
        steps = [s.strip() for s in r["derivation"]]
        if not 1 <= len(steps) <= STEPS or not all(1 <= len(s) <= STEP_CHARS for s in steps) or not 1 <= len(r["answer"]) <= ANSWER_CHARS:
            raise ValueError("a candidate is out of bounds")
        out.append({"derivation": steps, "answer": r["answer"], "citation_ids": []})  # remote citations are never trusted
    return out


def remote(seeds: DataFrame, count: int, ask: Callable[[str, int], str], identifiers: tuple[str, ...] = (), most_bytes: int = 1_000_000) -> DataFrame:
    """A teacher behind ``ask(question, count) -> reply``, called once for each seed in the
    workers; questions that show a private identifier never leave."""
    checked_count(count)

    def run(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in source:
            replies = []
            for question in pdf.question:
                if any(i and i.casefold() in question.casefold() for i in identifiers):
                    raise ValueError("prompt contains a registered private identifier")
                text = ask(question, count)
                if len(text.encode()) > most_bytes:
                    raise ValueError("a reply exceeds the byte limit")
                replies.append(parse_outputs(text, count))
            yield pdf.assign(outputs=replies)[["seed_id", "outputs"]]

    got = seeds.select("seed_id", "question").mapInPandas(run, f"seed_id string, outputs {OUTPUTS}").withColumnRenamed("seed_id", "__s")
    return seeds.join(got, F.col("seed_id") == F.col("__s")).drop("__s")


def chat_request(model: str, question: str, count: int, temperature: float, max_tokens: int) -> dict:
    """The body of a chat-completion call."""
    rule = f'Return only JSON: {{"candidates": [{{"derivation": ["step"], "answer": "text"}}]}} with exactly {count} candidates.'
    return {
        "model": model, "temperature": temperature, "max_tokens": max_tokens, "response_format": {"type": "json_object"},
        "messages": [{"role": "system", "content": rule}, {"role": "user", "content": question}],
    }


def check_endpoint(url: str, allow_private: bool = False, with_key: bool = False, resolve: Callable = socket.getaddrinfo) -> None:
    """Refuse endpoints that could leak credentials or reach into a private network."""
    parts = urlsplit(url)
    if parts.username or parts.password or parts.fragment or not parts.hostname:
        raise ConfigurationError("an endpoint has no user info or fragment")
    if parts.scheme != "https" and not (allow_private and parts.scheme == "http"):
        raise ConfigurationError("an endpoint uses https")
    addresses = {ipaddress.ip_address(a[4][0]) for a in resolve(parts.hostname, parts.port or 443)}
    private = any(not a.is_global for a in addresses)
    if private and not allow_private:
        raise AuthorizationError("an endpoint resolves to a private address")
    if private and with_key:
        raise AuthorizationError("credentials are not sent to a private endpoint")


class NoRedirect(urllib.request.HTTPRedirectHandler):
    """A redirect could lead past the check of the endpoint."""

    def redirect_request(self, *_):
        return None


def chat_client(teacher: dict, generation, resolve: Callable = socket.getaddrinfo, send: Callable | None = None) -> Callable[[str, int], str]:
    """``ask`` for ``remote``: one chat-completion call a question, to a teacher of the registry.

    The endpoint is checked before every call, as names may resolve to something else by then.
    Replies are read up to the byte limit, without redirects and proxies; the key comes from the
    worker's environment.  ``send`` (url, headers, body, timeout, most bytes) stands in for the
    network in tests."""
    url, key_name = teacher["base_url"], teacher.get("api_key_env")
    private = bool(teacher.get("allow_private_endpoint"))
    model, limits = teacher["model"], (generation.temperature, generation.max_tokens)
    timeout, most = generation.timeout_seconds, generation.max_response_bytes
    if not url:
        raise ConfigurationError("a remote teacher has a base_url")

    def post(url: str, headers: dict[str, str], body: bytes, timeout: float, most: int) -> bytes:
        opener = urllib.request.build_opener(NoRedirect, urllib.request.ProxyHandler({}))
        with opener.open(urllib.request.Request(url, body, headers), timeout=timeout) as reply:
            return reply.read(most + 1)

    def ask(question: str, count: int) -> str:
        key = os.environ.get(key_name) if key_name else None
        if key_name and not key:
            raise ConfigurationError(f"{key_name} is not set")
        check_endpoint(url, private, key is not None, resolve)
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
        body = json.dumps(chat_request(model, question, count, *limits)).encode()
        got = (send or post)(url.rstrip("/") + "/chat/completions", headers, body, timeout, most)
        if len(got) > most:
            raise ValueError("a reply exceeds the byte limit")
        return json.loads(got)["choices"][0]["message"]["content"]

    return ask


PROVIDERS: dict[str, Callable[..., DataFrame]] = {"deterministic": deterministic, "collected": collected, "remote": remote}


def provider_for(kind: str) -> Callable[..., DataFrame]:
    if kind not in PROVIDERS:
        raise ConfigurationError(f"unknown provider: {kind}")
    return PROVIDERS[kind]
