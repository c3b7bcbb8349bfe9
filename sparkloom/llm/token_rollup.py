"""Token counts as delta-maintained rollups.

A batch holds signed changes: documents inserted, revised or deleted.  Its commit looks up what
the ledger holds of them, writes the difference (what goes with sign -1, what comes with +1) and
the additive change of the totals by source, language and tokenizer version.  Commits are
numbered.  A batch counts once the file of its number is there, made by a rename that fails if
the number is taken; a writer that loses a number works its difference out anew against the
commits before it.  So replays, attempts that died half-way and writers at the same time change
nothing twice.  A compaction is a commit too: it replaces the ledgers and totals so far by one.
"""

from __future__ import annotations

import base64
import json
import uuid

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.shared import batches, delete_path, text_key

VOCABULARIES = "/opt/tokenizers"
#: How the public byte-level vocabularies split a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ENCODERS: dict[str, object] = {}
LEDGER = "key string, source string, lang string, tokenizer string, tokens long, chars long, sign int"
TOTALS = "source string, lang string, tokenizer string, documents long, tokens long, chars long"


def encoder(name: str, data: bytes, pattern: str):
    if name not in ENCODERS:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        ENCODERS[name] = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return ENCODERS[name]


def key_of() -> Column:
    """The doc_id as text; where it is null, a name of the text."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), text_key(F.col("text"))))


def count_tokens(docs: DataFrame, tokenizer: str, folder: str = VOCABULARIES, pattern: str = PATTERN) -> DataFrame:
    """key, source, lang, tokenizer, tokens and chars of every row.

    ``key`` is the doc_id as text, or names the text where the id is null; a null text has no
    tokens.  The vocabulary, a file of under 2 MB, is read here and sent to the workers."""
    with open(f"{folder}/{tokenizer}.tiktoken", "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        code = encoder(tokenizer, vocabulary.value, pattern)
        n = [len(code.encode_ordinary(t)) if t else 0 for t in batch.column(3).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([tokenizer] * len(n)), pa.array(n, pa.int64()), batch.column(4)], names=["key", "source", "lang", "tokenizer", "tokens", "chars"])

    rows = docs.select(key_of().alias("key"), "source", "lang", "text", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"))
    return batches(rows, work, "key string, source string, lang string, tokenizer string, tokens long, chars long")


class TokenRollup:
    """A store of committed batches in a folder that all executors share.

    The folder's file system must rename without overwriting in one step, as HDFS and local disks
    do; object stores do so only where they have conditional writes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.path}/commits"))

    def log(self) -> list[dict]:
        """The commits in order: number, batch, attempt and whether all before it are replaced."""
        out = []
        for status in self._fs.listStatus(self._path(f"{self.path}/commits")):
            if status.getPath().getName().endswith(".json"):
                stream = self._fs.open(status.getPath())
                try:
                    out.append(json.loads(bytes(stream.readAllBytes()).decode()))
                finally:
                    stream.close()
        return sorted(out, key=lambda e: e["number"])

    def committed(self) -> dict[str, str]:
        """Batch ids and the folders of the attempts that won."""
        return {e["batch"]: e["attempt"] for e in self.log()}

    def _read(self, part: str, schema: str, log: list[dict]) -> DataFrame:
        since = max([i for i, e in enumerate(log) if e["replaces"]], default=0)
        folders = [f"{self.path}/{part}/{e['attempt']}" for e in log[since:]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def ledger(self, log: list[dict] | None = None) -> DataFrame:
        """What holds now: one row for each document."""
        rows = self._read("ledger", LEDGER, self.log() if log is None else log)
        rows = rows.groupBy("key", "source", "lang", "tokenizer", "tokens", "chars").agg(F.sum("sign").alias("n"))
        return rows.where("n > 0").drop("n")

    def totals(self) -> DataFrame:
        """documents, tokens and chars by source, lang and tokenizer; groups that came to nothing are left out."""
        rows = self._read("totals", TOTALS, self.log()).groupBy("source", "lang", "tokenizer")
        return rows.agg(*[F.sum(c).alias(c) for c in ("documents", "tokens", "chars")]).where("documents <> 0")

    def commit(self, batch: str, upserts: DataFrame | None = None, deletes: DataFrame | None = None) -> bool:
        """Insert or revise ``upserts`` (columns as ``count_tokens`` gives) and take out the keys of
        ``deletes``; False, and no change, if the batch was committed before.

        Of a key that occurs more than once in a batch the row with most tokens holds (then the
        last by its other columns); a key both upserted and deleted is deleted.  Null sources and
        languages are groups of their own.  Empty batches are committed too."""
        log = self.log()
        if batch in {e["batch"] for e in log}:
            return False
        columns = ["key", "source", "lang", "tokenizer", "tokens", "chars"]
        fresh = self.spark.createDataFrame([], LEDGER).drop("sign") if upserts is None else upserts.select(*columns)
        fresh = fresh.groupBy("key").agg(F.max(F.struct("tokens", "chars", "source", "lang", "tokenizer")).alias("r")).select("key", *[F.col(f"r.{c}").alias(c) for c in columns[1:]])
        gone = None if deletes is None else deletes.select(F.col("key").cast("string").alias("key")).distinct()
        if gone is not None:
            fresh = fresh.join(gone, "key", "left_anti")
        # the new rows are counted once: both the lookup and the write read them from here
        new_path = f"{self.path}/new/{uuid.uuid4().hex}"
        fresh.withColumn("sign", F.lit(1)).select(*columns, "sign").write.option("compression", "zstd").parquet(new_path)
        fresh = self.spark.read.schema(LEDGER).parquet(new_path)
        try:
            while True:
                signed = fresh
                if log:
                    changed = fresh.select("key") if gone is None else fresh.select("key").union(gone)
                    old = self.ledger(log).join(changed, "key", "left_semi").withColumn("sign", F.lit(-1))
                    signed = fresh.unionByName(old.select(*columns, "sign"))
                if self._write(batch, signed, log):
                    return True
                log = self.log()
                if batch in {e["batch"] for e in log}:
                    return False
        finally:
            delete_path(self.spark, new_path)

    def compact(self) -> bool:
        """Replace all commits so far by one ledger of what holds; False if another writer came in
        between.  Batch ids stay known; folders that no commit needs any more are left to
        ``vacuum``, as readers may still be at them."""
        log = self.log()
        return self._write(f"compaction {uuid.uuid4().hex}", self.ledger(log).withColumn("sign", F.lit(1)), log, True)

    def vacuum(self) -> None:
        """Delete what a compaction has replaced, and what dead attempts have left."""
        log = self.log()
        since = max([i for i, e in enumerate(log) if e["replaces"]], default=0)
        needed = {e["attempt"] for e in log[since:]}
        for part in ("ledger", "totals", "new"):
            folder = self._path(f"{self.path}/{part}")
            for status in self._fs.listStatus(folder) if self._fs.exists(folder) else ():
                if status.getPath().getName() not in needed:
                    self._fs.delete(status.getPath(), True)

    def _write(self, batch: str, signed: DataFrame, log: list[dict], replaces: bool = False) -> bool:
        """Write ledger and totals of an attempt, and take the next number for it."""
        attempt = uuid.uuid4().hex
        signed.write.option("compression", "zstd").parquet(f"{self.path}/ledger/{attempt}")
        delta = self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger/{attempt}").groupBy("source", "lang", "tokenizer")
        delta = delta.agg(F.sum("sign").cast("long").alias("documents"), *[F.sum(F.col(c) * F.col("sign")).alias(c) for c in ("tokens", "chars")])
        delta.coalesce(1).write.parquet(f"{self.path}/totals/{attempt}")
        number = log[-1]["number"] + 1 if log else 0
        if self._mark({"number": number, "batch": batch, "attempt": attempt, "replaces": replaces}):
            return True
        for part in ("ledger", "totals"):
            delete_path(self.spark, f"{self.path}/{part}/{attempt}")
        return False

    def _mark(self, entry: dict) -> bool:
        jvm = self.spark.sparkContext._jvm
        temporary, final = (self._path(f"{self.path}/commits/{name}") for name in (f".{entry['attempt']}", f"{entry['number']:012d}.json"))
        stream = self._fs.create(temporary, False)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        try:
            if self._fs.getUri().getScheme() == "file":  # there a rename overwrites, but a second link fails
                local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (final, temporary)]
                jvm.java.nio.file.Files.createLink(*local)
                return True
            if self._fs.exists(final):
                return False
            return self._fs.rename(temporary, final)
        except Py4JJavaError as e:
            if self._fs.exists(final):
                return False
            raise e
        finally:
            self._fs.delete(temporary, False)
