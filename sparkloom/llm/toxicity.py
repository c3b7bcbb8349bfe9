"""Toxicity: a bag of subword embeddings, averaged, into a linear softmax, trained jointly in numpy.

Words are split into byte n-grams (3 to 6, with word borders) of the lower-cased text, hashed to
buckets with an embedding each, so an unseen misspelling shares most vectors with the word it
comes from.  Insults are a few words in a long text, so the average is taken over windows of
``WINDOW`` words, and the window likeliest to be toxic decides, in training as in scoring.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import BYTE_CODE, Words, batches, give_back, mix64, pieces

GRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 18
DIM = 8
WINDOW = 4
#: Passes over the texts to learn from, however many these are.  Stopping by the loss of a fifth that is not learnt
#: from was tried and was worse at every size.
EPOCHS = 12
RATE = 0.35
POWER = 0.8  # 1 would give both classes the same weight
#: The classifier is fitted on at most so many labelled rows of each class, those first by a
#: hash of their id; every text is scored.
TRAIN_ROWS_PER_CLASS = 3000
TRAIN_BYTES = 24_000_000
SLICE = 20_000  # words whose grams are at hand together
PIECE = 2_000_000  # bytes of text that a worker takes at a time


class Model:
    """Embeddings, softmax weights and bias; ``table`` is each bucket's share of the log-odds."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.vectors, self.weights, self.bias = vectors, weights, bias
        self.table = (vectors @ (weights[:, 1] - weights[:, 0])).astype(np.float32)
        self.offset = float(bias[1] - bias[0])


def each_gram(words: Words):
    """For each gram length, buckets and word index of the n-grams: of the word with a border
    sign on each side, from the first byte of a character."""
    size = words.end - words.start
    padded = int(size.sum() + 2 * len(size))
    at = np.cumsum(size + 2) - (size + 2)
    text = np.full(padded, ord("#"), np.uint8)
    whose = np.repeat(np.arange(len(size), dtype=np.int32), size + 2)
    inside = np.ones(padded, bool)
    inside[at] = inside[at + size + 1] = False
    text[inside] = words.data[np.arange(int(size.sum())) + np.repeat(words.start - (np.cumsum(size) - size), size)]
    left = (np.repeat(at + size + 2, size + 2) - np.arange(padded)).astype(np.int32)
    # a UTF-8 continuation byte begins no gram
    left[(text & 0xC0) == 0x80] = 0
    code = BYTE_CODE[text]
    rolled = np.zeros(padded, np.uint64)
    for n in range(1, min(max(GRAMS), padded) + 1):
        rolled[: padded - n + 1] *= np.uint64(0x100000001B3)
        rolled[: padded - n + 1] += code[n - 1 :]
        if n in GRAMS:
            keep = np.flatnonzero(left >= n)
            yield (mix64(rolled[keep] + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int32), whose[keep]


def gram_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and word index of every gram, words in order; a word's own hash is one of them."""
    parts = [((words.hash % np.uint64(BUCKETS)).astype(np.int32), np.arange(len(words.hash), dtype=np.int32)), *each_gram(words)]
    bag, owner = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(owner, kind="stable")
    return bag[order], owner[order]


def windows(words: Words, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last word (exclusive) and text of each window: half-overlapping, whole texts."""
    count = np.diff(words.bounds)
    step = width // 2
    each = np.where(count == 0, 0, np.maximum(1, -(-(count - step) // step)))
    doc = np.repeat(np.arange(words.n), each)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
    first = words.bounds[doc] + nth * step
    return first, np.minimum(first + width, words.bounds[doc + 1]), doc


def word_odds(words: Words, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the sum of its grams' log-odds and their number, without a list of the grams."""
    n = len(words.hash)
    total = table[(words.hash % np.uint64(BUCKETS)).astype(np.intp)].astype(np.float64)
    count = np.ones(n)
    for lo in range(0, n, SLICE):
        part = slice(lo, min(n, lo + SLICE))
        some = SimpleNamespace(hash=words.hash[part], start=words.start[part], end=words.end[part], data=words.data)
        size = len(some.hash)
        for bucket, owner in each_gram(some):
            total[part] += np.bincount(owner, table[bucket], size)
            count[part] += np.bincount(owner, minlength=size)
    return total, count


def odds(texts: pa.Array, model: Model) -> np.ndarray:
    """Log-odds of each text: its highest window; a text without words gets the lone bias."""
    words = Words(texts)
    out = np.full(words.n, model.offset)
    if len(words.hash):
        total, count = (np.concatenate(([0.0], np.cumsum(v))) for v in word_odds(words, model.table))
        first, last, doc = windows(words)
        score = model.offset + (total[last] - total[first]) / (count[last] - count[first])
        at = np.flatnonzero(np.diff(doc, prepend=-1))
        out[doc[at]] = np.maximum.reduceat(score, at)
    return out


def train(texts: list[str], labels: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Model:
    """Fit embeddings and softmax together by AdaGrad on each text's deciding window.

    Without texts of both classes the model answers with the bias alone: their only class, or
    not toxic."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    weights = rng.normal(0, 0.3, (DIM, 2)).astype(np.float32)
    bias = np.array([1.0, -1.0], np.float32)
    labels = np.asarray(labels, np.int64)
    if len(set(labels.tolist())) < 2:
        sign = 1.0 if len(labels) and labels[0] else -1.0
        return Model(np.zeros((BUCKETS, DIM), np.float32), weights, np.array([-sign, sign], np.float32))
    seen_v, seen_w, seen_b = np.full(BUCKETS, 1e-4, np.float32), np.full((DIM, 2), 1e-2, np.float32), np.full(2, 1e-2, np.float32)
    rate = labels.mean()
    share = np.where(labels == 1, (0.5 / rate) ** POWER, (0.5 / (1 - rate)) ** POWER).astype(np.float32)
    groups = [np.arange(i, min(i + 400, len(texts))) for i in range(0, len(texts), 400)]
    for epoch in range(epochs):
        for g in rng.permutation(len(groups)):
            rows = groups[g]
            words = Words(pa.array([texts[i] for i in rows], pa.large_string()))
            if not len(words.hash):
                continue
            model = Model(vectors, weights, bias)
            total, count = (np.concatenate(([0.0], np.cumsum(v))) for v in word_odds(words, model.table))
            first, last, doc = windows(words)
            score = model.offset + (total[last] - total[first]) / (count[last] - count[first])
            # the deciding window of each text; and of a clean text a random one too
            jitter = score + rng.gumbel(0, 0.3 / (1 + epoch), len(score))
            best = np.flatnonzero(np.diff(doc, prepend=-1))
            stops = np.append(best[1:], len(doc))
            chosen = [b + int(np.argmax(jitter[b:e])) for b, e in zip(best, stops)]
            extra = [int(rng.integers(b, e)) for b, e in zip(best, stops) if labels[rows[doc[b]]] == 0]
            pick = rng.permutation(np.array(chosen + extra))
            # grams of the words in these windows only
            size = last[pick] - first[pick]
            at = np.repeat(first[pick] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            bag, owner = gram_keys(SimpleNamespace(hash=words.hash[at], start=words.start[at], end=words.end[at], data=words.data))
            edge = np.searchsorted(owner, np.append(np.cumsum(size) - size, size.sum()))
            lo, hi = edge[:-1], edge[1:]
            for part in np.array_split(np.arange(len(pick)), max(1, len(pick) // 64)):
                y, c = labels[rows[doc[pick[part]]]], share[rows[doc[pick[part]]]]
                spread = np.concatenate([np.arange(lo[i], hi[i]) for i in part])
                which = np.repeat(np.arange(len(part)), hi[part] - lo[part])
                size = np.maximum(1, hi[part] - lo[part])[:, None]
                b = bag[spread]
                begin = np.cumsum(hi[part] - lo[part]) - (hi[part] - lo[part])
                mean = np.add.reduceat(vectors[b], begin, axis=0) / size
                z = mean @ weights + bias
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(y)), y] -= 1
                grad = p * c[:, None] / len(part)
                gw, gb, gm = mean.T @ grad, grad.sum(axis=0), (grad @ weights.T) / size
                seen_w += gw**2
                seen_b += gb**2
                weights -= RATE * gw / np.sqrt(seen_w)
                bias -= RATE * gb / np.sqrt(seen_b)
                ids, back = np.unique(b, return_inverse=True)
                gv = np.zeros((len(ids), DIM), np.float32)
                np.add.at(gv, back, gm[which].astype(np.float32))
                seen_v[ids] += (gv**2).mean(axis=1)
                vectors[ids] -= RATE * gv / np.sqrt(seen_v[ids])[:, None]
    return Model(vectors, weights, bias)


def held_out(id):
    """Ids whose crc32, as text, leaves 0 when divided by 5 are never learnt from.  A null id is not one
    of them; it has no label to learn from either."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_ROWS_PER_CLASS, most_bytes: int = TRAIN_BYTES) -> Model:
    """Train on labelled, not held-out rows: at most ``per_class`` ids of each class, those
    first by a hash, and of them texts of ``most_bytes`` in all: an id whose text would overrun
    them is passed over.  Raises when that leaves a class without a text.  Null labels and ids
    don't count; of an id with several labels the larger one holds."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id")
    picked = [known.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(per_class) for y in (0, 1)]
    picked = picked[0].union(picked[1]).withColumnRenamed("doc_id", "d")
    # at most 2 * per_class rows are broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id").cast("long") == F.col("d"))
    rows = rows.select("d", "toxic", F.coalesce("text", F.lit("")).alias("text")).withColumn("bytes", F.octet_length("text"))
    sizes = rows.groupBy("d").agg(F.max("toxic").alias("toxic"), F.sum("bytes").alias("bytes")).select(F.xxhash64("d").alias("h"), "d", "toxic", "bytes")
    sizes = sorted((r.h, r.d, r.toxic, r.bytes) for r in sizes.collect())
    total, over, left = 0, [], set()
    for _, d, y, b in sizes:
        if total + b > most_bytes:
            over.append(d)
        else:
            total += b
            left.add(y)
    if lost := {y for _, _, y, _ in sizes} - left:
        raise ValueError(f"no text of toxic = {sorted(lost)} fits into the {most_bytes} bytes to learn from")
    if over:
        rows = rows.where(~F.col("d").isin(over))
    got = sorted((r.d, r.text, r.toxic) for r in rows.select("d", "text", "toxic").collect())
    mixed = np.random.default_rng(11).permutation(len(got))
    model = train([got[i][1] for i in mixed], np.array([got[i][2] for i in mixed], np.int64))
    del got, sizes
    give_back(docs.sparkSession)
    return model


def score(docs: DataFrame, model: Model, extra: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``extra`` of every row, ``score`` and ``predicted``.  Null texts are scored as empty."""
    # about 1 MB whatever the input: the bucket's share of the log-odds is all that scoring needs
    shared = docs.sparkSession.sparkContext.broadcast((model.table, model.offset))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        light = Model.__new__(Model)
        light.table, light.offset = shared.value
        z = odds(batch.column(len(extra)), light)
        p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(extra))), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[*extra, "score", "predicted"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in extra)
    return batches(docs.select(*[F.col(f"`{c}`") for c in extra], F.col("text").alias("__text")), work, schema + ", score double, predicted int", PIECE)


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Null ids are not held out, null texts are scored as empty, texts of any length are read whole;
    repeated rows come out as often as they are there, and equal texts with equal scores.  A
    score of exactly 0.5 is predicted 1.  Labels that repeat, are null or belong to no document:
    see ``fit``.  An empty table gives no rows."""
    model = fit(docs, labels, **options)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns.  A null or empty text has the odds of a text
    without words, equal texts share their fate, null ids don't matter, and an empty table stays empty."""
    if not docs.columns:
        return docs
    model = fit(docs, labels, **options)
    shared = docs.sparkSession.sparkContext.broadcast((model.table, model.offset))
    text = docs.columns.index("text")

    def keep(source):
        light = Model.__new__(Model)
        light.table, light.offset = shared.value
        for batch in source:
            for piece in pieces(batch, PIECE):
                yield piece.filter(pa.array(odds(piece.column(text), light) < 0))

    return docs.mapInArrow(keep, docs.schema)
