"""Sharded lines: pairing by position, the digest tree, and export to one file."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sparkloom.errors import ImmutableArtifactError
from sparkloom.sources import shards
from sparkloom.sources.sinks import Files


@pytest.fixture
def files(spark, tmp_path):
    return Files(spark, str(tmp_path))


def records(spark, n):
    r = random.Random(n)
    rows = [(f"{i:05d}", "x" * r.randrange(200) + f" é {i}", f"side {i}" if i % 9 else None) for i in range(n)]
    r.shuffle(rows)
    return rows, spark.createDataFrame(rows, "id string, data string, side string").repartition(5)


@pytest.mark.parametrize("n, count", [(1000, 7), (1000, None), (3, 8), (0, 2)])
def test_pairs_over_shards(spark, files, monkeypatch, n, count):
    monkeypatch.setattr(shards, "SHARD_BYTES", 10_000)
    monkeypatch.setattr(shards, "FANOUT", 3)
    rows, df = records(spark, n)
    tree = shards.write(files, "corpus", df, "id", ["data", "side"], count)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")  # a shard is read in several blocks
    try:
        got = [(x.shard, x.line, x.data, x.side) for x in shards.read(files, "corpus").orderBy("shard", "line").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [x[2:] for x in got] == [(d, s or "") for _, d, s in sorted(rows)]
    assert count is not None or len({x[0] for x in got}) >= 4
    assert shards.check(files, "corpus", tree["root"]).collect() == []
    whole = "".join(d + "\n" for _, d, _ in sorted(rows)).encode()
    assert shards.export(files, "corpus", "data", "corpus.jsonl") == hashlib.sha256(whole).hexdigest() and files.read("corpus.jsonl") == whole
    with pytest.raises(ImmutableArtifactError):
        shards.write(files, "corpus", df, "id", ["data", "side"], count)


def test_the_root_is_that_of_a_plain_tree(spark, monkeypatch):
    monkeypatch.setattr(shards, "FANOUT", 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for sizes in ({"a": 1}, {"a": 3, "b": 2}, {"a": 10, "b": 28}):
        rows = [(k, i, 7 * i, sha(f"{k}{i}")) for k, n in sizes.items() for i in range(n)]
        tops = []
        for k in sorted(sizes):
            level = [sha(f"{k}|{i}|{b}|{d}") for x, i, b, d in rows if x == k]
            while len(level) > 1:
                level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
            tops.append(f"{k}:{level[0]}")
        df = spark.createDataFrame(rows, shards.PARTS).repartition(3)
        assert shards.root(df) == sha("\n".join(tops))
        changed = df.withColumn("sha256", F.when((F.col("kind") == "a") & (F.col("shard") == 0), "0").otherwise(F.col("sha256")))
        assert shards.root(changed) != shards.root(df)


def test_every_change_of_a_part_is_found(spark, files):
    _, df = records(spark, 300)
    tree = shards.write(files, "corpus", df, "id", ["data", "side"], 4)
    names = {k: files.names(f"corpus/{k}") for k in ("data", "side")}
    part = lambda k, n: f"corpus/{k}/" + next(x for x in names[k] if x.startswith(f"part-{n:05d}"))
    text = files.read(part("data", 2)).decode()
    files.write(part("data", 2), text.replace("é", "e", 1))
    files.delete(part("side", 3))
    files.write("corpus/side/part-00017.txt", "more\n")
    got = {tuple(x) for x in shards.check(files, "corpus", tree["root"]).collect()}
    assert got == {("changed", "data", 2), ("missing", "side", 3), ("unlisted", "side", 17)}
    # whoever changes the list too is found by the anchor
    listed = spark.read.schema(shards.PARTS).json(f"{files.root}/corpus/parts").where("shard <> 3 or kind <> 'side'").collect()
    files.delete("corpus/parts")
    spark.createDataFrame(listed, shards.PARTS).write.json(f"{files.root}/corpus/parts")
    assert ("root", None, None) in {tuple(x) for x in shards.check(files, "corpus", tree["root"]).collect()}


def test_no_file_grows_with_its_shard(spark, files, monkeypatch):
    """A fixed number of shards keeps its numbers, and its files their size; a change in any file is its shard's."""
    monkeypatch.setattr(shards, "SHARD_BYTES", 2_000)
    rows, df = records(spark, 600)
    df = df.unionAll(spark.createDataFrame([("00300", f"{i:05d} of one key", "") for i in range(3000)], df.schema))
    tree = shards.write(files, "corpus", df, "id", ["data", "side"], 3)
    names = shards.in_order(files.names("corpus/data"))
    assert tree["parts"] == 6 and tree["pieces"] > 5
    assert max(len(files.read(f"corpus/data/{x}")) for x in names) < 20 * shards.SHARD_BYTES
    got = shards.read(files, "corpus").orderBy("shard", "line").collect()
    wanted = sorted([(a, b, c or "") for a, b, c in rows] + [("00300", f"{i:05d} of one key", "") for i in range(3000)])
    assert [(x.data, x.side) for x in got] == [x[1:] for x in wanted] and {x.shard for x in got} == {0, 1, 2}
    assert shards.check(files, "corpus", tree["root"]).collect() == []
    part = names[-1]
    files.write(f"corpus/data/{part}", files.read(f"corpus/data/{part}").decode() + "more\n")
    files.delete(f"corpus/side/{next(x for x in files.names('corpus/side') if x.startswith('part-00001-'))}")
    files.write(f"corpus/data/part-{17 * tree['pieces']:05d}.txt", "more\n")
    assert {tuple(x) for x in shards.check(files, "corpus", tree["root"]).collect()} == {("changed", "data", 2), ("changed", "side", 0), ("unlisted", "data", 17)}


def test_copy_in_pieces(spark, tmp_path, monkeypatch):
    """A file is copied, onto itself too, without its bytes in Python."""
    files = Files(spark, str(tmp_path))
    files.write("a.txt", "é\n" * 700_000)
    monkeypatch.setattr(Files, "read", None)
    files.copy("a.txt", "b.txt")
    files.copy("a.txt", "a.txt", "{}\n")
    assert (tmp_path / "b.txt").read_text() == "é\n" * 700_000 and (tmp_path / "a.txt").read_text() == "é\n" * 700_000 + "{}\n"
    assert files.names() == [x for x in files.names() if x.endswith("a.txt") or x.endswith("b.txt")]


def test_tampering_reads_no_part_on_the_driver(spark, tmp_path, monkeypatch):
    from sparkloom.plans import checks

    spark.range(60).selectExpr("id doc_id", "repeat('w ', 100) text").write.parquet(str(tmp_path / "documents.parquet"))
    read = Files.read
    monkeypatch.setattr(Files, "read", lambda self, name: read(self, name) if name.endswith(".json") else 1 / 0)
    got = sorted((x.run, x.code, x.kind, x.shard, x.n) for x in checks.shard_tampering(spark, str(tmp_path)).collect())
    assert got == [("clean", "none", "", -1, 60), ("hurt", "changed", "data", 1, 60), ("hurt", "missing", "side", 0, 60), ("hurt", "unlisted", "data", 99, 60), ("other anchor", "root", "", -1, 60)]
