"""Relational checks: references, keys, sets, coverage and similarity of small parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.operators.splits import Split, assign_split


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def missing(rows: DataFrame, key: str, registry: DataFrame, registry_key: str) -> DataFrame:
    """Rows whose reference is not in the registry (a null reference is missing)."""
    known = registry.select(F.col(registry_key).alias("__k"))
    return rows.join(known, F.col(key) == F.col("__k"), "left_anti")


def missing_count(rule: str, rows: DataFrame, key: str, registry: DataFrame, registry_key: str) -> DataFrame:
    return missing(rows.select(F.col(key).alias("__r")), "__r", registry, registry_key).agg(F.lit(rule).alias("rule"), F.count("*").alias("bad"))


def referencing(rows: DataFrame, key: str, registry: DataFrame, registry_key: str) -> DataFrame:
    """Rows whose reference is in the registry, each once."""
    return rows.join(registry.select(F.col(registry_key).alias("__k")), F.col(key) == F.col("__k"), "left_semi")


def repeated(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def extra_rows(name: str, rows: DataFrame, key: str) -> DataFrame:
    """How many rows repeat a key that stood before; grouped first, so no wide distinct."""
    return rows.groupBy(key).count().agg(F.lit(name).alias("name"), F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("extra"))


def crossing_lineages(rows: DataFrame, lineage: str = "lineage", split: str = "split") -> DataFrame:
    pairs = rows.select(F.col(lineage).alias("lineage"), F.col(split).alias("split")).distinct()
    return pairs.groupBy("lineage").agg(F.count("*").alias("splits")).where("splits > 1")


def split_capacity(rows: DataFrame, lineage: str, split: Split, floor: int) -> DataFrame:
    each = rows.select(lineage).distinct().groupBy(assign_split(F.col(lineage), split).alias("split")).agg(F.count("*").alias("capacity"))
    return each.withColumn("deficit", F.greatest(F.lit(floor) - F.col("capacity"), F.lit(0)).cast("long"))


def uncovered(categories: DataFrame, column: str, reviewers: DataFrame) -> DataFrame:
    """Categories that no approved reviewer may judge; ``*`` stands for all.  The allowed values
    are exploded, so that the anti-join is an equality and not a nested loop."""
    allowed = reviewers.where("authorization_status = 'approved'").select(F.explode("allowed_categories").alias("__c")).distinct()
    free = allowed.where("__c = '*'").agg(F.count("*").alias("__stars"))
    left = categories.join(allowed, F.col(column) == F.col("__c"), "left_anti")
    return left.join(F.broadcast(free.where("__stars = 0")), F.lit(True)).drop("__stars")


def outside_taxonomy(rows: DataFrame, id: str, taxonomy: dict[str, list[str]]) -> DataFrame:
    """id, field and value of every value that its dimension does not list; one scan."""
    checks = [F.when(~F.coalesce(F.col(f).isin(*values), F.lit(False)), F.struct(F.lit(f).alias("field"), F.col(f).alias("value"))) for f, values in taxonomy.items() if values]
    return rows.select(id, F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("bad")).select(id, "bad.field", "bad.value")


def set_report(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Sizes of both differences, the intersection and the union of two id sets."""
    both = left.select(F.col(key).alias("k"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(right.select(F.col(key).alias("k"), F.lit(0).alias("a"), F.lit(1).alias("b")))
    each = both.groupBy("k").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return each.agg(F.count_if(F.expr("a = 1 and b = 0")).alias("only_selected"), F.count_if(F.expr("a = 0 and b = 1")).alias("only_reviewed"), F.count_if(F.expr("a = 1 and b = 1")).alias("both_sides"), F.count("*").alias("all_ids"))


def subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0


def containment(docs: DataFrame, items: DataFrame, threshold: float, most_broadcast: int = 200_000) -> DataFrame:
    """Documents that hold a share of an item's distinct word trigrams: doc_id, item_id, shared,
    item_shingles, containment.

    Trigrams are 64-bit hashes from the first step on.  The items' are broadcast only when a
    count shows them to be few; the documents' side is then never shuffled before it is reduced
    to hits.  Beyond, the documents' trigrams are shuffled once."""
    sets = T.with_shingles(items, F.col("text"), ["item_id"])
    flat = sets.select("item_id", F.size("s").cast("long").alias("item_shingles"), F.explode("s").alias("x"))
    if flat.count() <= most_broadcast:
        flat = F.broadcast(flat)
    # (for an inner explode the optimizer adds a filter on the array, and writes the whole chain of
    # expressions out again in it; the join drops the nulls of an outer one)
    hits = T.with_shingles(docs, F.col("text"), ["doc_id"]).select("doc_id", F.explode_outer("s").alias("x")).join(flat, "x")
    rows = hits.groupBy("doc_id", "item_id", "item_shingles").agg(F.count("*").alias("shared"))
    rows = rows.withColumn("containment", F.col("shared") / F.col("item_shingles"))
    return rows.where(F.col("containment") >= threshold).select("doc_id", "item_id", "shared", "item_shingles", "containment")


def query_pairs(rows: DataFrame, id: str, vector: str, queries: Column, threshold: float, block: int = 500) -> DataFrame:
    """A stated set of queries against all vectors, in blocks: both sides are gathered into bounded
    matrices, each cell of vectors is multiplied with each block of queries, and only pairs at
    the threshold leave a task.  Gives a, b, cosine."""
    import numpy as np
    import pyarrow as pa

    wanted = rows.where(queries).select(F.col(id).alias("q"), F.col(vector).alias("v"))
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(max(1, -(-wanted.count() // block)))))
    blocks = wanted.groupBy("block").agg(F.collect_list(F.struct("q", "v")).alias("m"))
    other = rows.select(F.col(id).alias("b"), F.col(vector).alias("w"))
    cells = max(1, -(-rows.count() // (4 * block)))
    other = other.withColumn("cell", F.pmod(F.xxhash64("b"), F.lit(cells))).groupBy("cell").agg(F.collect_list(F.struct("b", "w")).alias("o"))
    # cells by blocks, each pair of them a bounded matrix product
    both = other.crossJoin(blocks)

    def work(source):
        for batch in source:
            for o, m in zip(batch.column("o").to_pylist(), batch.column("m").to_pylist()):
                left, right = np.array([x["v"] for x in m], np.float64), np.array([x["w"] for x in o], np.float64)
                dots = np.clip(left @ right.T, 0, 1)
                i, j = np.nonzero(dots >= threshold)
                a, b = np.array([x["q"] for x in m])[i], np.array([x["b"] for x in o])[j]
                keep = a != b
                yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep]), pa.array(dots[i, j][keep])], names=["a", "b", "cosine"])

    return both.select("o", "m").mapInArrow(work, "a long, b long, cosine double")
