"""Sinks: ordered JSON Lines, small files written once, checksums."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.errors import ImmutableArtifactError


class Files:
    """A folder on any of Hadoop's file systems, for driver-side files of bounded size."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str = ""):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self.path(name))

    def make(self, name: str = "", fresh: bool = False) -> None:
        if fresh and self.exists(name):
            raise ImmutableArtifactError(f"exists already: {self.root}/{name}")
        self.fs.mkdirs(self.path(name))

    def names(self, name: str = "") -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(name)))

    def read(self, name: str) -> bytes:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """To a temporary name, then renamed: a reader sees the whole file or none."""
        temporary = f".{name.rsplit('/', 1)[-1]}.{uuid.uuid4().hex}"
        folder, _, _ = name.rpartition("/")
        temporary = f"{folder}/{temporary}" if folder else temporary
        stream = self.fs.create(self.path(temporary), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.fs.delete(self.path(name), False)
        if not self.fs.rename(self.path(temporary), self.path(name)):
            raise OSError(f"cannot write {name}")

    def copy(self, name: str, to: str, tail: str = "") -> None:
        """The bytes of a file and then ``tail``, piece by piece and not through Python, under a temporary name that is then
        renamed; ``to`` may be the file itself."""
        folder, _, last = to.rpartition("/")
        temporary = f"{folder}/.{last}.{uuid.uuid4().hex}".lstrip("/")
        out = self.fs.create(self.path(temporary), False)
        try:
            source = self.fs.open(self.path(name))
            try:
                self.spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            finally:
                source.close()
            if tail:
                out.write(bytearray(tail.encode()))
        finally:
            out.close()
        self.fs.delete(self.path(to), False)
        if not self.fs.rename(self.path(temporary), self.path(to)):
            raise OSError(f"cannot write {to}")

    def write_json(self, name: str, value: object) -> None:
        self.write(name, json.dumps(value, indent=2, sort_keys=True) + "\n")

    def read_json(self, name: str) -> dict:
        return json.loads(self.read(name))

    def sha256(self, name: str) -> str:
        """Streamed in pieces of 1 MiB."""
        stream, digest = self.fs.open(self.path(name)), hashlib.sha256()
        try:
            while piece := bytes(stream.readNBytes(1 << 20)):
                digest.update(piece)
        finally:
            stream.close()
        return digest.hexdigest()

    def rename(self, old: str, new: str) -> None:
        if self.exists(new) or not self.fs.rename(self.path(old), self.path(new)):
            raise ImmutableArtifactError(f"cannot promote to {new}")

    def delete(self, name: str = "") -> None:
        self.fs.delete(self.path(name), True)

    def write_lines(self, name: str, rows: DataFrame, line: str, order: str) -> None:
        """One file of lines in order; an empty input still makes a file.

        Many tasks sort and write their ranges; the files are then joined end to end, as people's
        tools read and hash these artifacts whole.  Nothing passes through Python."""
        if self.exists(name):
            raise ImmutableArtifactError(f"exists already: {name}")
        head, _, tail = name.rpartition("/")
        folder = f"{head}/.{tail}.{uuid.uuid4().hex}".lstrip("/")
        self.write_sorted_parts(folder, rows, line, order)
        whole = f"{folder}/.whole"
        out = self.fs.create(self.path(whole), False)
        try:
            for part in self.names(folder):
                if part.startswith("part-"):
                    source = self.fs.open(self.path(f"{folder}/{part}"))
                    try:
                        self.spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
                    finally:
                        source.close()
        finally:
            out.close()
        try:
            self.rename(whole, name)
        finally:
            self.delete(folder)

    def write_sorted_parts(self, name: str, rows: DataFrame, line: str, order: str) -> None:
        """Lines over many part files, range-partitioned, in order of their names."""
        rows.orderBy(order).select(F.col(line).alias("value")).write.mode("errorifexists").text(f"{self.root}/{name}", lineSep="\n")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their number from 0, for pairing two files by position.

    Line numbers come from one pass that counts lines by partition; only the counts meet on the
    driver."""
    lines = spark.read.text(path, lineSep="\n").withColumn("pid", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    counts = {r.pid: r.n for r in lines.groupBy("pid").agg(F.count("*").alias("n")).collect()}
    start, total = {}, 0
    for pid in sorted(counts):
        start[pid] = total
        total += counts[pid]
    if not counts:
        return lines.select(F.col("at").alias("line"), "value")
    offsets = F.create_map(*[x for k, v in start.items() for x in (F.lit(k), F.lit(v).cast("long"))])
    within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return lines.select((F.try_element_at(offsets, F.col("pid")) + within).alias("line"), "value")
