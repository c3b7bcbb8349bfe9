"""Sharded JSON Lines: several lines of each record in files of their own, paired by position, and a digest tree.

All lines of a record go to the shard of the same number and stand at the same place in it.  A shard is
one part file, or a range of part numbers when it is large, so that no task writes or digests more than about
``SHARD_BYTES``.  The executors write the shards and digest them; each shard's digest is a leaf, and the parents, up to the one root,
are digests of their children's.  The root is the anchor: whoever holds it can tell whether any part of any size of corpus has changed,
and the listed parts say which.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.errors import ImmutableArtifactError
from sparkloom.sources.sinks import Files
from sparkloom.storage import dispose, stored

#: Bytes of lines in a part file, about, and children of a node of the digest tree.
SHARD_BYTES, FANOUT = 32 << 20, 64
#: A file of so many times the lines that SHARD_BYTES hold is rolled: many rows of one key make such files.
ROLL = 8
PARTS = "kind string, shard int, bytes long, sha256 string"


def write(files: Files, name: str, rows: DataFrame, key: str, kinds: list[str], shards: int | None = None) -> dict:
    """Write each of the columns ``kinds`` of ``rows`` as lines, in order of ``key``, to ``name``/<kind>/, with the list of parts
    and the tree's root beside them; nothing has the name until all of it is there.

    A key's rows stand in one shard, in order of their lines.  Of a given number of ``shards`` each has as many part
    numbers as its bytes need.  Null lines are empty ones, an empty table has one empty shard."""
    if files.exists(name):
        raise ImmutableArtifactError(f"exists already: {name}")
    spark, hidden = rows.sparkSession, f".{name}.building"
    files.delete(hidden)
    rows = rows.select(F.col(key).alias("key"), *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in kinds])
    n, *sizes = rows.agg(F.count("*"), *[F.sum(F.octet_length(k).cast("long") + 1) for k in kinds]).first()
    size = max(x or 0 for x in sizes)
    pieces = 1 if shards is None else max(1, math.ceil(size / shards / SHARD_BYTES))
    count = max(1, math.ceil(size / SHARD_BYTES)) if shards is None else shards * pieces
    # the ranges are drawn once: each kind is dealt by the numbers written here
    placed = stored(rows.repartitionByRange(count, "key").withColumn("part", F.spark_partition_id()), "shards")
    for kind in kinds:
        lines = placed.repartitionById(count, F.col("part")).sortWithinPartitions("key", *kinds).select(F.col(kind).alias("value"))
        lines.write.option("maxRecordsPerFile", max(1, ROLL * SHARD_BYTES * n // max(1, size))).text(f"{files.root}/{hidden}/{kind}", lineSep="\n")
    dispose(placed)
    found = parts(spark, f"{files.root}/{hidden}", kinds, pieces)
    found.write.json(f"{files.root}/{hidden}/parts")
    listed = spark.read.schema(PARTS).json(f"{files.root}/{hidden}/parts")
    summary = {"kinds": kinds, "root": root(listed), "parts": listed.count(), "pieces": pieces}
    files.write_json(f"{hidden}/tree.json", summary)
    files.rename(hidden, name)
    return summary


def place(path: Column) -> Column:
    """The numbers in a part file's name: that of the part, and that of the file it was rolled to."""
    rolled = F.regexp_extract(path, r"-c(\d+)\.[^/]*$", 1).try_cast("int")
    return F.struct(F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1).cast("int").alias("part"), F.coalesce(rolled, F.lit(0)).alias("rolled"))


def shard_of(place: Column, pieces: int) -> Column:
    return F.floor(place["part"] / pieces).cast("int")


def in_order(names: list[str]) -> list[str]:
    """The part files among ``names``, as ``place`` orders them."""
    number = lambda pattern, x: int((re.search(pattern, x) or (0, 0))[1])
    return sorted((x for x in names if x.startswith("part-")), key=lambda x: (number(r"^part-(\d+)", x), number(r"-c(\d+)\.[^/]*$", x), x))


def parts(spark: SparkSession, path: str, kinds: list[str], pieces: int = 1) -> DataFrame:
    """kind, shard, bytes and sha256 of the files that are there, digested by the executors.  The digest of a shard
    of several files is that of their sizes and digests in order."""
    found = None
    for kind in kinds:
        content = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/{kind}")
        one = content.select(F.lit(kind).alias("kind"), place(F.col("path")).alias("place"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
        found = one if found is None else found.unionByName(one)
    files = found.groupBy("kind", shard_of(F.col("place"), pieces).alias("shard")).agg(F.sum("bytes").alias("bytes"), F.array_sort(F.collect_list(F.struct("place", "bytes", "sha256"))).alias("files"))
    several = F.sha2(F.array_join(F.transform("files", lambda x: F.concat_ws("|", x["bytes"].cast("string"), x["sha256"])), "\n"), 256)
    return files.select("kind", "shard", "bytes", F.when(F.size("files") == 1, F.col("files")[0]["sha256"]).otherwise(several).alias("sha256"))


def root(listed: DataFrame) -> str:
    """The digest of the parts in order of kind and shard: of FANOUT children at a time, up to one."""
    leaf = F.sha2(F.concat_ws("|", "kind", F.col("shard").cast("string"), F.col("bytes").cast("string"), "sha256"), 256)
    # parts of a kind are numbered, so the number of a leaf needs the sizes of the kinds before it alone
    order = Window.partitionBy("kind").orderBy("shard")
    nodes = listed.select("kind", (F.row_number().over(order) - 1).alias("at"), leaf.alias("digest"))
    sizes = {r.kind: r.n for r in nodes.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    tops = []
    for kind in sorted(sizes):
        level, n = nodes.where(F.col("kind") == kind).select("at", "digest"), sizes[kind]
        while n > 1:
            children = F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda x: x["digest"])
            level = level.groupBy(F.floor(F.col("at") / FANOUT).alias("up")).agg(F.sha2(F.array_join(children, ""), 256).alias("digest")).select(F.col("up").alias("at"), "digest")
            n = math.ceil(n / FANOUT)
        tops.append(f"{kind}:{level.first().digest}")
    return level.sparkSession.range(1).select(F.sha2(F.lit("\n".join(tops)), 256)).first()[0] if tops else ""


def check(files: Files, name: str, anchor: str) -> DataFrame:
    """What differs between the parts that are listed and those that are there: code, kind and shard.

    Codes: ``missing``, ``unlisted``, ``changed`` (bytes or digest), and ``root`` when the list is not the one of the
    ``anchor``."""
    spark = files.spark
    path = f"{files.root}/{name}"
    tree = files.read_json(f"{name}/tree.json")
    listed = spark.read.schema(PARTS).json(f"{path}/parts")
    there = parts(spark, path, tree["kinds"], tree.get("pieces", 1))
    a, b = listed.select("kind", "shard", F.struct("bytes", "sha256").alias("listed")), there.select("kind", "shard", F.struct("bytes", "sha256").alias("there"))
    both = a.join(b, ["kind", "shard"], "full")
    code = F.when(F.col("there").isNull(), "missing").when(F.col("listed").isNull(), "unlisted").when(F.col("listed") != F.col("there"), "changed")
    found = both.select(code.alias("code"), "kind", "shard").where("code is not null")
    if root(listed) != anchor:
        found = found.unionByName(spark.createDataFrame([("root", None, None)], "code string, kind string, shard int"))
    return found


def numbered_lines(lines: DataFrame, pieces: int = 1) -> DataFrame:
    """``value`` of a text read, with its shard and its line number there, from 0.

    A file is read in blocks by several tasks: lines are counted by block, blocks' counts are summed up in
    order, and each line adds its place in the block.  Blocks are a small table, joined and never literal."""
    rows = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"))
    blocks = rows.groupBy("file", "start").agg(F.count("*").alias("n"), F.min("id").alias("least")).withColumn("place", place(F.col("file")))
    blocks = blocks.withColumn("shard", shard_of(F.col("place"), pieces))
    before = Window.partitionBy("shard").orderBy("place", "start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("file").alias("f"), F.col("start").alias("s"), "shard", "least", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rows = rows.join(blocks, (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")))
    return rows.select("shard", (F.col("offset") + F.col("id") - F.col("least")).alias("line"), "value")


def read(files: Files, name: str, kinds: list[str] | None = None) -> DataFrame:
    """shard, line and a column for each kind: lines of the same shard and number are a record's.  A line that
    has no partner leaves a null."""
    spark, out, tree = files.spark, None, files.read_json(f"{name}/tree.json")
    for kind in kinds or tree["kinds"]:
        lines = numbered_lines(spark.read.option("pathGlobFilter", "part-*").text(f"{files.root}/{name}/{kind}", lineSep="\n"), tree.get("pieces", 1))
        rows = lines.select("shard", "line", F.col("value").alias(kind))
        out = rows if out is None else out.join(rows, ["shard", "line"], "full")
    return out


def export(files: Files, name: str, kind: str, to: str) -> str:
    """One file of all lines of a kind, in order, for tools that want one; its SHA-256.  The bytes pass through the driver."""
    names = in_order(files.names(f"{name}/{kind}"))
    out = files.fs.create(files.path(f".{to}"), False)
    try:
        for part in names:
            source = files.fs.open(files.path(f"{name}/{kind}/{part}"))
            try:
                files.spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            finally:
                source.close()
    finally:
        out.close()
    files.rename(f".{to}", to)
    return files.sha256(to)
