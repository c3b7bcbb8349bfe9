"""Two HTTP planes over collections: workers lease and submit, and see questions alone; the control
plane creates, shows and finalizes.  Each has a bearer token and a port of its own.

Requests of a plane go one at a time to the collection, whose log is the only state, so a plane can
die and come back.  Standard library only; put a TLS proxy in front.
"""

from __future__ import annotations

import hmac
import json
import os
import re
import threading
from collections.abc import Callable
from dataclasses import dataclass
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sparkloom.errors import ConfigurationError, EngineError
from sparkloom.operators.broker import token_digest
from sparkloom.plans import collection
from sparkloom.sources import workspace
from sparkloom.sources.providers import ANSWER_CHARS, STEP_CHARS, STEPS

# Limits of a request and of a token, and words of tokens that nobody has set.
MOST_BODY, MOST_REQUESTS, LEAST_TOKEN, MOST_TOKEN = 65_536, 128, 32, 256
UNSET = ("change-me", "changeme", "example-token", "placeholder", "replace-with", "your-token")
AGENT_TOKEN, CONTROL_TOKEN = "SPARKLOOM_AGENT_TOKEN", "SPARKLOOM_CONTROL_TOKEN"
RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]{0,127}")


def checked_token(token: str) -> str:
    if token != token.strip() or len(token) < LEAST_TOKEN:
        raise ConfigurationError(f"a service token has {LEAST_TOKEN} characters or more, and no white space around")
    if any(word in token.casefold() for word in UNSET):
        raise ConfigurationError("a service token is a placeholder")
    return token


def token_of(name: str) -> str:
    if not os.environ.get(name):
        raise ConfigurationError(f"{name} is not set")
    return checked_token(os.environ[name])


@dataclass(frozen=True)
class Settings:
    root: str
    agent_token: str | None = None
    control_token: str | None = None
    lease_seconds: int = 900

    def __post_init__(self):
        tokens = [checked_token(t) for t in (self.agent_token, self.control_token) if t is not None]
        if not tokens:
            raise ConfigurationError("a plane needs its token")
        if len(tokens) == 2 and hmac.compare_digest(*map(token_digest, tokens)):
            raise ConfigurationError("the planes have different tokens")
        if not 30 <= self.lease_seconds <= 86_400:
            raise ConfigurationError("a lease lasts 30 to 86400 seconds")


class Reply(Exception):
    """An answer other than success."""

    def __init__(self, status: int, detail: str):
        super().__init__(detail)
        self.status, self.detail = status, detail


def submission(body: object) -> tuple[str, list[str], str]:
    """Token, derivation and answer of a request, within bounds; unknown fields are refused."""
    if not isinstance(body, dict) or set(body) != {"lease_token", "derivation", "answer"}:
        raise Reply(422, "a submission has lease_token, derivation and answer")
    token, steps, answer = body["lease_token"], body["derivation"], body["answer"]
    if not isinstance(token, str) or not LEAST_TOKEN <= len(token) <= MOST_TOKEN:
        raise Reply(422, "malformed lease_token")
    if not isinstance(steps, list) or not 1 <= len(steps) <= STEPS or not all(isinstance(s, str) and 1 <= len(s.strip()) <= STEP_CHARS for s in steps):
        raise Reply(422, "malformed derivation")
    if not isinstance(answer, str) or not 1 <= len(answer) <= ANSWER_CHARS:
        raise Reply(422, "malformed answer")
    return token, steps, answer


class Planes:
    """What the routes do; one lock, as a lease reads and appends."""

    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark, self.settings, self.lock = spark, settings, threading.Lock()

    def open_runs(self) -> list[str]:
        names = collection.names(self.spark, self.settings.root)
        return [n for n in names if collection.state_of(self.spark, self.settings.root, n)["state"] == "collecting"]

    def lease(self) -> dict | None:
        with self.lock:
            for run_id in self.open_runs():
                if got := collection.lease(self.spark, self.settings.root, run_id, 1, self.settings.lease_seconds):
                    x = got[0]
                    return {"task_id": x["task_id"], "lease_token": x["token"], "expires_at_unix": int(x["expires_at"]), "messages": [{"role": "user", "content": x["question"]}]}
        return None

    def submit(self, task_id: str, body: object) -> dict:
        token, steps, answer = submission(body)
        row = self.spark.createDataFrame([(task_id, token, steps, answer)], collection.SUBMISSIONS)
        with self.lock:
            for run_id in self.open_runs():
                known = self.has_task(run_id, task_id)
                if known and collection.submit(self.spark, self.settings.root, run_id, row, self.settings.lease_seconds)["accepted"]:
                    return {"status": "recorded"}
        raise Reply(404, "task unavailable")  # unknown, taken, too late or a wrong token: all the same

    def has_task(self, run_id: str, task_id: str) -> bool:
        rows = self.spark.read.parquet(f"{self.settings.root}/collections/{run_id}/tasks.parquet")
        return not rows.where(F.col("task_id") == F.lit(task_id)).isEmpty()

    def control(self, act: Callable[[], dict]) -> dict:
        with self.lock:
            try:
                return act()
            except EngineError as e:
                raise Reply(409, str(e)) from e

    def create(self, body: object) -> dict:
        if not isinstance(body, dict) or set(body) != {"run_id"} or not isinstance(body["run_id"], str) or not RUN_ID.fullmatch(body["run_id"]):
            raise Reply(422, "malformed run_id")
        return self.control(lambda: collection.create(workspace.load(self.spark, self.settings.root), self.settings.root, body["run_id"]))

    def status(self, run_id: str) -> dict:
        return self.control(lambda: collection.status(self.spark, self.settings.root, run_id))

    def finalize(self, run_id: str) -> dict:
        return self.control(lambda: collection.finalize(workspace.load(self.spark, self.settings.root), self.settings.root, run_id))


#: Method, path, name of the act, whether it has a body, and the status of success, by plane.
ROUTES = {
    "agent": [("POST", r"/v1/tasks/lease", "lease", False, 200), ("POST", r"/v1/tasks/([\w-]+)/responses", "submit", True, 202)],
    "control": [("POST", r"/v1/runs", "create", True, 201), ("GET", r"/v1/runs/([\w.-]+)", "status", False, 200), ("POST", r"/v1/runs/([\w.-]+)/finalize", "finalize", False, 200)],
}


def describe(plane: str) -> dict:
    """The routes of a plane, in the form of OpenAPI."""
    paths: dict[str, dict] = {}
    for method, path, name, body, status in ROUTES[plane]:
        shown = re.sub(r"\(.*?\)", "{id}", path)
        paths.setdefault(shown, {})[method.lower()] = {"operationId": name, "responses": {str(status): {"description": name}}} | ({"requestBody": {"required": True}} if body else {})
    return {"openapi": "3.1.0", "info": {"title": f"{plane} plane", "version": "1"}, "paths": paths}


def server(spark: SparkSession, plane: str, settings: Settings, host: str = "127.0.0.1", port: int = 0) -> ThreadingHTTPServer:
    """A plane, bound and not yet serving (``serve_forever``)."""
    token = settings.agent_token if plane == "agent" else settings.control_token
    if token is None:
        raise ConfigurationError(f"the {plane} plane has no token")
    acts, slots, expected = Planes(spark, settings), threading.BoundedSemaphore(MOST_REQUESTS), token_digest(token)
    if plane == "control":
        collection.recover(workspace.load(spark, settings.root), settings.root)

    class Handler(BaseHTTPRequestHandler):
        server_version, sys_version, timeout = "service", "", 30

        def log_message(self, *_):
            pass

        def answer(self, status: int, value: object = None) -> None:
            body = b"" if value is None else json.dumps(value, sort_keys=True, default=str).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(body)))
            self.send_header("Cache-Control", "no-store")
            if status == 401:
                self.send_header("WWW-Authenticate", "Bearer")
            self.end_headers()
            self.wfile.write(body)

        def body(self) -> object:
            """The request's body, never more than the limit of it; a length must be given."""
            length = self.headers.get("Content-Length", "0")
            if not length.isdigit() or self.headers.get("Transfer-Encoding"):
                raise Reply(400, "invalid content length")
            if int(length) > MOST_BODY:
                self.close_connection = True
                raise Reply(413, "request body too large")
            raw = self.rfile.read(int(length))
            try:
                return json.loads(raw) if raw else None
            except ValueError as e:
                raise Reply(422, "not JSON") from e

        def handle_one(self, method: str) -> None:
            if not slots.acquire(blocking=False):
                self.answer(503, {"detail": "too many requests"})
                return
            try:
                data = self.body()
                if method == "GET" and self.path == "/healthz":
                    self.answer(200, {"status": "ok"})
                    return
                kind, _, given = self.headers.get("Authorization", "").partition(" ")
                if kind.casefold() != "bearer" or not hmac.compare_digest(token_digest(given), expected):
                    raise Reply(401, "unauthorized")
                if plane == "control" and method == "GET" and self.path == "/openapi.json":
                    self.answer(200, describe(plane))
                    return
                for wanted, path, name, has_body, status in ROUTES[plane]:
                    m = re.fullmatch(path, self.path)
                    if m and wanted == method:
                        got = getattr(acts, name)(*m.groups(), *([data] if has_body else []))
                        self.answer(204 if got is None else status, got)
                        return
                raise Reply(404, "not found")
            except Reply as e:
                self.answer(e.status, {"detail": e.detail})
            except Exception:
                self.answer(500, {"detail": "internal error"})
            finally:
                slots.release()

        def do_GET(self):
            self.handle_one("GET")

        def do_POST(self):
            self.handle_one("POST")

    return ThreadingHTTPServer((host, port), Handler)
