"""Document fingerprints: SimHash over weighted terms, and a radius search over permuted blocks.

A term is a pair of neighbouring words (of a one-word text, the word).  Its 128-bit hash votes
on every bit with weight 1 + floor(log2(occurrences)); a bit is set when its votes are positive.
A text without words, empty or null, has no votes and the fingerprint 0.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import MASK, Words, batches, even_ranges, in_ranges, mix64, spans, stored

BITS = 128
LANES = np.array([sum(((v >> (3 - b)) & 1) << (16 * b) for b in range(4)) for v in range(16)], np.uint64)
#: So many terms at most go into one run of 16-bit counters: weights are at most 40.
RUN = 1600


def fingerprints(texts: pa.Array) -> np.ndarray:
    """An array of (texts, BITS / 8) bytes."""
    words = Words(texts)
    term, owner = spans(words, 2)
    out = np.zeros((words.n, BITS // 8), np.uint8)
    if not len(term):
        return out
    order = np.lexsort((term, owner))
    term, owner = term[order], owner[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    weight = (1 + np.floor(np.log2(np.diff(np.append(at, len(term)))))).astype(np.uint64)
    term, owner = term[at], owner[at]
    begin = np.flatnonzero(np.diff(owner, prepend=-1))
    size = np.diff(np.append(begin, len(owner)))
    runs = np.concatenate([np.arange(b, b + s, RUN) for b, s in zip(begin, size)])
    run_doc = owner[runs]
    first_run = np.flatnonzero(np.diff(run_doc, prepend=-1))
    half = np.add.reduceat(np.add.reduceat(weight, runs), first_run).astype(np.int64)
    votes = np.zeros((len(first_run), BITS), np.int64)
    for word in range(BITS // 64):
        h = mix64(term + np.uint64((0x9E3779B97F4A7C15 * (word + 1)) & MASK))
        for nibble in range(16):
            lanes = LANES[((h >> np.uint64(60 - 4 * nibble)) & np.uint64(15)).astype(np.intp)] * weight
            sums = np.add.reduceat(lanes, runs)
            for b in range(4):
                part = ((sums >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
                votes[:, word * 64 + nibble * 4 + b] = np.add.reduceat(part, first_run)
    out[run_doc[first_run]] = np.packbits(2 * votes > half[:, None], axis=1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits, 0 to 1."""
    return 1 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def hexes(prints: np.ndarray) -> list[str]:
    return [x.tobytes().hex() for x in prints]


def fingerprint(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``id`` and ``fingerprint`` (hex) of every row; null and empty texts have fingerprint 0."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(hexes(fingerprints(batch.column(1))))], names=["id", "fingerprint"])

    kind = docs.schema[id].dataType.simpleString()
    return batches(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), work, f"id {kind}, fingerprint string").withColumnRenamed("id", id)


def with_successor(docs: DataFrame, rows_each: int = 4000, most_ranges: int = 10_000) -> DataFrame:
    """Fingerprint each document, its edited text and the next document, descending by doc_id.

    Null ids come last and ties go by the text's hash.  Rows are dealt into ranges of doc_id of
    about ``rows_each`` rows (rows of one id stay together), and more where there would be over
    ``most_ranges`` ranges; the first row of a range is also sent to the range before it, so
    that every range is worked through as one sorted stream.  What is broadcast is the key of
    each range's first row.  An empty table gives no rows; a single row is followed by itself."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows_each = max(rows_each, rows.count() // most_ranges)
    ranges = even_ranges(rows, F.col("doc_id"), F.lit(1), rows_each, descending=True)
    keyed = rows.select(ranges.column.alias("part"), "doc_id", "text", F.xxhash64("text").alias("tie"))
    order = F.struct(F.col("doc_id").isNull().alias("a"), (-F.col("doc_id")).alias("b"), F.col("tie").alias("c"))
    heads = {r.part: r.head for r in rows.select(ranges.column.alias("part"), "doc_id", F.xxhash64("text").alias("tie")).groupBy("part").agg(F.min(order).alias("head")).collect()}
    found = sorted(heads)
    before = {p: found[i - 1] for i, p in enumerate(found)}  # the first range's head follows the last row of all
    spark = docs.sparkSession
    marks = spark.createDataFrame(
        [(p, None if heads[p].b is None else -heads[p].b, heads[p].c, before[p]) for p in found], "part int, doc_id long, tie long, to int"
    )
    # one row stands for the range's head, however many repeat it
    heads_df = keyed.join(F.broadcast(marks), (keyed.part == marks.part) & keyed.doc_id.eqNullSafe(marks.doc_id) & (keyed.tie == marks.tie), "inner").select(marks["to"].alias("part"), keyed.doc_id, "text", keyed.tie)
    heads_df = heads_df.dropDuplicates(["part"])
    both = keyed.withColumn("tail", F.lit(False)).unionByName(heads_df.withColumn("tail", F.lit(True)))
    dealt = in_ranges(both, "part", ranges).sortWithinPartitions("part", "tail", F.col("doc_id").desc_nulls_last(), "tie")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in source:
            part = batch.column("part").to_pylist()
            ids, texts, tail = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("tail").to_pylist()
            out = []
            for row in zip(part, ids, texts, tail):
                if held is not None:
                    if held[0] != row[0]:
                        raise RuntimeError("a range has no row after it")
                    out.append((held[1], held[2], row[2]))
                held = None if row[3] else row
            yield from finish(out)
        if held is not None:
            raise RuntimeError("a range has no row after it")

    def finish(out: list[tuple]) -> Iterator[pa.RecordBatch]:
        lo, size = 0, 0
        for i, row in enumerate(out):
            size += len(row[1]) + len(row[2])
            if size > 8_000_000 or i + 1 == len(out):
                yield table(out[lo : i + 1])
                lo, size = i + 1, 0

    def table(out: list[tuple]) -> pa.RecordBatch:
        texts = [x[1] for x in out]
        edited = [t[: len(t) - len(t) // 3] + nxt[: len(t) // 3] for _, t, nxt in out]
        own = fingerprints(pa.array(texts + [out[-1][2]], pa.large_string()))
        new = fingerprints(pa.array(edited, pa.large_string()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in out], pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
                pa.array(hexes(own[:-1])),
                pa.array(hexes(new)),
                pa.array(likeness(own[:-1], new)),
                pa.array(likeness(own[:-1], own[1:])),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def block_masks(blocks: int) -> list[tuple[int, int]]:
    """Bit ranges of nearly equal blocks."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    return list(zip(edges, edges[1:]))


def within_radius(prints: DataFrame, radius: int = 6, blocks: int = 8, cell: int = 2048) -> DataFrame:
    """``fingerprint`` and ``n_links``: how many other distinct fingerprints are at most ``radius`` bits away.

    Two such fingerprints agree on at least ``blocks - radius`` blocks whole, so there is a table
    for each choice of so many blocks, keyed by their bits.  A pair counts in the first table
    that holds it.  A bucket over ``cell`` rows is compared in pairs of cells, and tasks emit a
    count for each fingerprint, never the pairs.  The empty fingerprint of texts without words
    has no links.  An empty input gives an empty result."""
    keep = blocks - radius
    assert 0 < keep <= blocks
    edges = block_masks(blocks)
    masks = []
    for chosen in itertools.combinations(range(blocks), keep):
        bits = np.zeros(BITS, np.uint8)
        for b in chosen:
            bits[edges[b][0] : edges[b][1]] = 1
        masks.append(np.packbits(bits).view(">u8").astype(np.uint64))
    masks = np.array(masks)

    def expand(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = np.frombuffer(bytes.fromhex("".join(batch.column(0).to_pylist())), ">u8").astype(np.uint64).reshape(-1, 2)
        a, b = raw[:, 0], raw[:, 1]
        keys = [mix64(mix64(a & m[0]) + (b & m[1]) + np.uint64(i)).view(np.int64) for i, m in enumerate(masks)]
        which = np.repeat(np.arange(len(masks), dtype=np.int32), len(raw))
        columns = [which, np.concatenate(keys), np.tile(a.view(np.int64), len(masks)), np.tile(b.view(np.int64), len(masks))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["which", "key", "a", "b"])

    distinct = prints.where(F.col("fingerprint") != "0" * (BITS // 4)).select("fingerprint").distinct()
    rows = stored(batches(distinct, expand, "which int, key long, a long, b long"), "blocks")
    many = rows.groupBy("which", "key").count().where("count > 1")
    dealt = rows.join(many, ["which", "key"]).withColumn("cells", F.ceil(F.col("count") / cell).cast("int"))
    own = F.pmod(F.xxhash64("a", "b"), F.col("cells")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("cells") - 1), lambda i: F.struct(F.least(i, own).alias("lo"), F.greatest(i, own).alias("hi")))
    dealt = dealt.select("which", "key", "a", "b", own.alias("own"), F.explode(pairs).alias("at")).select("which", "key", "a", "b", "own", "at.lo", "at.hi")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        raw = pdf[["a", "b"]].to_numpy(np.int64).view(np.uint64)
        which, lo, hi, side = int(pdf.which.iloc[0]), int(pdf.lo.iloc[0]), int(pdf.hi.iloc[0]), pdf.own.to_numpy()
        left, right = np.flatnonzero(side == lo), np.flatnonzero(side == hi)
        counts = np.zeros(len(pdf), np.int64)
        for i in left:
            diff = raw[right] ^ raw[i]
            at = np.flatnonzero((np.bitwise_count(diff).sum(axis=1) <= radius) & diff.any(axis=1))
            if len(at):
                at = at[((diff[at] & masks[which]) == 0).all(axis=1)]
                for m in masks[:which]:
                    at = at[((diff[at] & m) != 0).any(axis=1)]
                counts[i] += len(at)
                if lo != hi:
                    counts[right[at]] += 1
        return pdf[["a", "b"]].assign(n=counts)[counts > 0]

    found = dealt.groupBy("which", "key", "lo", "hi").applyInPandas(compare, "a long, b long, n long")
    hexed = F.lower(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("a", "b")]))
    return found.groupBy("a", "b").agg(F.sum("n").alias("n_links")).select(hexed.alias("fingerprint"), "n_links")


def document_fingerprints(docs: DataFrame, radius: int = 6, blocks: int = 8) -> DataFrame:
    """``with_successor`` and, for each row, ``n_links``: other fingerprints within ``radius``.

    Null texts are empty ones and link to nothing; repeated rows each follow the one before, in the
    order of a hash of the text, and have equal fingerprints and links; null ids come last."""
    rows = stored(with_successor(docs), "prints")
    links = within_radius(rows, radius, blocks).withColumnRenamed("fingerprint", "f")
    return rows.join(links, F.col("fingerprint") == F.col("f"), "left").drop("f").withColumn("n_links", F.coalesce("n_links", F.lit(0)))
