"""The pipeline, stage by stage, against plain versions of its stages."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkloom.llm import mixing, shared
from tests.llm.test_llm import prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(21)
    path = str(tmp_path_factory.mktemp("tables"))
    items = [(i, prose(r, 4)) for i in range(3)]
    rows = []
    for i in range(240):
        text = prose(r, r.randint(3, 9))
        if i % 5 == 1:
            text += " blorgast vexinoid krumpfel blorgast."
        if i % 8 == 2:
            text += " " + items[i % 3][1]
        if i % 9 == 3:
            text += f" Write to user{i}@corp.example.com now."
        if i % 11 == 4 and rows:
            text = rows[-3][1]
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int("blorgast" in t)) for i, t, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, items


def test_stages(spark, folder):
    path, rows, items = folder
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path).persist()
        seen[name] = docs
        if name != "mixing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = [x for x in rows if "blorgast" not in x[1]]
    assert {x.doc_id for x in seen["toxicity"].collect()} >= {x[0] for x in clean} - set() and sum("blorgast" in x.text for x in seen["toxicity"].collect()) <= 2
    first = {}
    for i, t, *_ in rows:
        if i in {x.doc_id for x in seen["toxicity"].collect()}:
            first.setdefault(t, i)
    assert {x.doc_id for x in seen["near_duplicates"].collect()} == set(first.values())
    leaked = lambda t: any(item in t for _, item in items)
    assert {x.doc_id for x in seen["decontamination"].collect()} == {i for t, i in first.items() if not leaked(t)}
    before, after = {x.doc_id: x for x in seen["decontamination"].collect()}, {x.doc_id: x for x in seen["pii"].collect()}
    assert before.keys() == after.keys() and all((after[i].text == x.text) == ("@" not in x.text) and after[i].n_chars == len(after[i].text) for i, x in before.items())
    taken = {x.doc_id: x.taken for x in mixing.taken_by_document(seen["pii"]).collect()}
    words = {}
    for x in seen["mixing"].collect():
        words[x.doc_id] = words.get(x.doc_id, 0) + x.mix_words
    assert words == {i: n for i, n in taken.items() if n}


def test_run(spark, folder):
    path, *_ = folder
    out = corpus_pipeline.run(spark, path)
    again = corpus_pipeline.run(spark, path)
    pick = lambda df: sorted(tuple(r) for r in df.select("doc_id", "mix_pass", "mix_words", F.md5("text")).collect())
    assert pick(out) == pick(again) and pick(out)


def test_odd_rows_through_every_stage(spark, tmp_path):
    """Nulls in every column, empty and long texts, ties, repeated rows, further columns, empty tables."""
    from tests.llm.test_llm import DOC, odd_rows

    path = str(tmp_path)
    names = ("node", "size", "n", "key", "tie", "score", "row", "d", "t", "root", "hits", "item_id", "pass", "again", "bundle", "doc")
    docs = spark.createDataFrame(odd_rows() + [(20, "Write to a.b@corp.example.com, Mr. John Smith", "en", None, 1), (21, "Write to a.b@corp.example.com, Mr. John Smith.", None, "a", None)], DOC)
    docs = docs.withColumns({c: F.lit("mine") for c in names})
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "same text again"), (None, None), (2, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(3, 1, 0), (7, 0, 1), (None, None, None), (4, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    for table in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{path}/{table}.parquet").limit(0).write.parquet(f"{path}/none/{table}.parquet")
    counts = []
    now = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, path)
        assert now.columns[: len(docs.columns)] == docs.columns
        if name != "mixing":
            assert now.columns == docs.columns
        now = now.persist()
        counts.append(now.count())
    assert counts[0] >= counts[1] >= counts[2] == counts[3] and counts[1] < counts[0] and counts[4] >= 1
    assert not now.where("text like '%John Smith%' or text like '%a.b@%' or text like '%same text again%'").count()
    assert corpus_pipeline.run(spark, f"{path}/none").count() == 0
    empty = spark.read.parquet(f"{path}/none/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, path).count() == 0, name


def test_driver_gives_back(spark):
    """What a step has freed leaves the driver's heap before the next."""
    runtime = spark._jvm.Runtime.getRuntime()
    used = lambda: runtime.totalMemory() - runtime.freeMemory()
    held = [spark.sparkContext._gateway.new_array(spark._jvm.long, 2_000_000) for _ in range(40)]
    before = used()
    del held
    shared.give_back(spark)
    assert before - used() > 300e6


def test_each_stage_gives_back(spark, folder, monkeypatch):
    path, *_ = folder
    docs, calls = spark.read.parquet(f"{path}/documents.parquet"), []
    monkeypatch.setattr(shared, "give_back", lambda s: calls.append(s))
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:4:2] + corpus_pipeline.STAGES[3:4]):
        stage(spark, docs, path)
        assert len(calls) == number + 1
