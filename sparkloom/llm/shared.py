"""What several operators share: stored tables, word hashing, deterministic range layout."""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.storage import FOLDERS, clean, delete_path, dispose, give_back, new_folder, path_of, shared_dir, stored

__all__ = ["FOLDERS", "clean", "delete_path", "dispose", "give_back", "new_folder", "path_of", "shared_dir", "stored"]
MASK = (1 << 64) - 1


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


# ---------------------------------------------------------------- hashing


def mix64(x: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64, over an array of uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0x9DDFEA08EB382D69
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True
CHUNK = 1 << 20
POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, kept between calls."""
    if len(POWERS.get("up", ())) < n:
        size = max(n, CHUNK + 1)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            POWERS[name] = np.cumprod(run)
    return POWERS["up"], POWERS["down"]


class Words:
    """The words of a batch of texts: hash, text index, byte start and end of each, in order.

    A word is a maximal run of ASCII letters, digits, underscores and non-ASCII characters
    of the lower-cased text.  ``data`` and ``offsets`` hold the lower-cased UTF-8 bytes."""

    def __init__(self, texts: pa.Array, lower: bool = True):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if lower:
            texts = pc.utf8_lower(texts)
        n = len(texts)
        self.n = n
        self.offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = texts.buffers()[2] if n else None
        self.data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        hashes, docs, starts, ends = [], [], [], []
        for lo, hi, a, b in self._pieces():
            part = self.data[a:b]
            if not len(part):
                continue
            word = WORD_BYTE[part]
            first = np.zeros(b - a + 1, bool)
            edges = self.offsets[lo : hi + 1] - a
            first[edges[(edges >= 0) & (edges <= b - a)]] = True
            start = word.copy()
            start[1:] &= ~word[:-1] | first[1 : b - a]
            end = word.copy()
            end[:-1] &= ~word[1:] | first[1 : b - a]
            s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
            up, down = powers(len(part) + 1)
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(BYTE_CODE[part] * up[: len(part)], out=total[1:])
            h = (total[e] - total[s]) * down[s]
            hashes.append(mix64(h + (e - s).astype(np.uint64)))
            docs.append(np.searchsorted(self.offsets[lo + 1 : hi + 1], s + a, side="right") + lo)
            starts.append(s + a)
            ends.append(e + a)
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        self.hash = cat(hashes, np.uint64)
        self.doc = cat(docs, np.int64)
        self.start = cat(starts, np.int64)
        self.end = cat(ends, np.int64)
        #: words of text i are bounds[i] to bounds[i + 1]
        self.bounds = np.searchsorted(self.doc, np.arange(n + 1))

    def _pieces(self) -> Iterator[tuple[int, int, int, int]]:
        """Texts and bytes to look at together: about CHUNK bytes, cut between words only."""
        lo, off = 0, self.offsets
        while lo < self.n:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + CHUNK, side="right")) - 1)
            hi = min(hi, self.n)
            a, b = int(off[lo]), int(off[hi])
            while b - a > CHUNK:
                cut = a + CHUNK
                gaps = np.flatnonzero(~WORD_BYTE[self.data[a + 1 : cut]])
                if len(gaps):
                    cut = a + 1 + int(gaps[-1])
                else:
                    gaps = np.flatnonzero(~WORD_BYTE[self.data[cut:b]])
                    cut = cut + int(gaps[0]) if len(gaps) else b
                yield lo, hi, a, cut
                a = cut
            yield lo, hi, a, b
            lo = hi


def spans(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of every run of ``width`` words; a text with fewer, but some,
    gives one run of all its words."""
    h, doc, n = words.hash, words.doc, len(words.hash)
    count = np.diff(words.bounds)
    short = np.flatnonzero((count > 0) & (count < width))
    out, owner = [], []
    if n >= width:
        keep = np.flatnonzero(doc[: n - width + 1] == doc[width - 1 :])
        mixed = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            mixed = mixed * np.uint64(BASE) + h[k : n - width + 1 + k]
        out.append(mix64(mixed[keep]))
        owner.append(doc[keep])
    if len(short):
        x = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = count[short] > k
            x[has] = x[has] * np.uint64(BASE) + h[words.bounds[short[has]] + k]
        out.append(mix64(x))
        owner.append(short)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out, owner = np.concatenate(out), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return out[order], owner[order]


def text_key(text: Column) -> Column:
    """A 128-bit name of a text; a null text is an empty one."""
    return F.md5(F.coalesce(text, F.lit("")))


PIECE = 6_000_000


def pieces(batch: pa.RecordBatch, most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` bytes, so that a worker's memory stays bounded; a row
    larger than that comes alone."""
    n = batch.num_rows
    if not n:
        return
    each = np.zeros(n, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            each += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    lo, total = 0, np.cumsum(each)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + most, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def small_batches(spark: SparkSession, most: int = 16 << 20) -> None:
    """Keep Arrow batches to ``most`` bytes in this session: texts can be long, and a batch is held
    several times over on its way."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()) > most:
        spark.conf.set(name, str(most))


def batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, most: int = PIECE) -> DataFrame:
    small_batches(df.sparkSession)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for piece in pieces(batch, most):
                yield work(piece)

    return df.mapInArrow(run, schema)


# ---------------------------------------------------------------- range layout


class Ranges:
    """Ranges of a numeric key that hold about ``target`` weight each, the same on every run.

    ``column`` gives a row's range number in key order, null keys last (``count - 1``);
    ``totals`` are the weights."""

    def __init__(self, column: Column, count: int, totals: list[float]):
        self.column, self.count, self.totals = column, count, totals


MOST_SLOTS = 1 << 21


def even_ranges(df: DataFrame, key: Column, weight: Column, target: float, fine: int = 1024, depth: int = 8, descending: bool = False, most_slots: int = MOST_SLOTS) -> Ranges:
    """Cut the key's span into equal bins, sum the weight of each, split the bins that are too
    heavy again, and join neighbours up to ``target``.

    There are at least four bins for each range (``fine`` at least, 65,536 at most), so what the
    driver gets follows total / target and not the rows.  Bins are split as long as their rows
    differ, to ``depth`` levels; should the tables take over ``most_slots`` numbers, the bins left
    whole are named in a warning.  Rows of one key stay together."""
    rows = df.select(key.cast("double").alias("k"), weight.cast("double").alias("w"))
    lo, hi, nulls, total = rows.agg(F.min("k"), F.max("k"), F.sum(F.when(F.col("k").isNull(), F.col("w"))), F.sum("w")).first()
    last_weight = float(nulls or 0)
    if lo is None:
        return Ranges(F.lit(0), 1, [last_weight])
    while fine < 65536 and fine * target < 4 * total:
        fine *= 2
    starts, widths, child = [lo], [(hi - lo) / fine], {}
    leaves: list[tuple[float, float, int]] = []

    def table(values: list, kind: str) -> Column:
        return F.from_json(F.lit("[" + ",".join(map(repr, values)) + "]"), f"array<{kind}>")

    def slot(x: Column, levels: int) -> Column:
        """Number of the bin that x falls in, by the tables as they are now."""
        low, wide = table(starts, "double"), table(widths, "double")
        below = table([child.get(i, -1) for i in range(len(starts) * fine)] if child else [], "int")

        def step(at: Column, _) -> Column:
            node = at["node"]
            spot = F.when(F.get(wide, node) > 0, F.floor((x - F.get(low, node)) / F.get(wide, node))).otherwise(0)
            spot = node * fine + F.greatest(F.lit(0), F.least(F.lit(fine - 1), spot)).cast("int")
            return F.when(node < 0, at).otherwise(F.struct(spot.alias("slot"), F.lit(-2).alias("node")))

        def down(at: Column, _) -> Column:
            return F.when(at["node"] == -2, F.struct(at["slot"].alias("slot"), F.coalesce(F.get(below, at["slot"]), F.lit(-1)).alias("node"))).otherwise(at)

        first = F.struct(F.lit(-1).alias("slot"), F.lit(0).alias("node"))
        # steps in turn: find the bin in the node, then the node that the bin was split into
        both = lambda at, i: F.when(i % 2 == 0, step(at, i)).otherwise(down(at, i))
        return F.aggregate(F.sequence(F.lit(0), F.lit(2 * levels - 2)), first, both, lambda at: at["slot"])

    level_start = 0
    for d in range(depth):
        level_end = len(starts)
        sums = rows.where("k is not null").select(slot(F.col("k"), d + 1).alias("slot"), "w", "k").where(F.col("slot") >= level_start * fine)
        sums = sums.groupBy("slot").agg(F.sum("w").alias("w"), F.min("k").alias("a"), F.max("k").alias("b")).collect()
        left = 0.0
        for r in sorted(sums, key=lambda r: -(r.w or 0)):
            if r.w and r.w > target and r.b > r.a and d + 1 < depth and (len(starts) + 1) * fine <= most_slots:
                child[r.slot] = len(starts)
                starts.append(r.a)
                widths.append((r.b - r.a) / fine)
            else:
                leaves.append((r.a, r.w or 0.0, r.slot))
                left = max(left, (r.w or 0) * (r.b > r.a))
        if left > 2 * target:
            warnings.warn(f"a range keeps a weight of {left:.4g} for {target:.4g}: raise the target or most_slots", stacklevel=2)
        level_start = level_end
        if len(starts) == level_end:
            break
    levels = d + 1
    leaves.sort(reverse=descending)
    number, totals = {}, []
    for _, w, at in leaves:
        if not totals or totals[-1] + w > target:
            totals.append(0.0)
        totals[-1] += w
        number[at] = len(totals) - 1
    last = len(totals)
    ranks = table([number.get(i, -1) for i in range(len(starts) * fine)], "int")
    column = F.when(key.isNull(), F.lit(last)).otherwise(F.get(ranks, slot(key.cast("double"), levels)))
    return Ranges(column, last + 1, [*totals, last_weight])


def in_ranges(df: DataFrame, name: str, ranges: Ranges) -> DataFrame:
    """Deal rows out by their range number: neighbours together, partitions of about equal weight."""
    n = max(1, min(ranges.count, max(parts(df.sparkSession), math.ceil(ranges.count / 4))))
    share, before, own = (sum(ranges.totals) or 1) / n, 0.0, []
    for w in ranges.totals:
        own.append(min(n - 1, int((before + w / 2) / share)))
        before += w
    return df.repartitionById(n, F.get(F.from_json(F.lit(str(own)), "array<int>"), F.col(name)))


# ---------------------------------------------------------------- connected components


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node``, ``root`` (its component's smallest node) for undirected edges ``a``, ``b``.

    Large-star and small-star steps in turn, each a combined minimum by node and a join that
    adaptive execution may split; every step is stored, so lineage stays short.  Nodes are
    strings.  Raises if ``rounds`` is not enough, which takes over 2**rounds nodes in a chain."""
    spark = edges.sparkSession
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(rounds):
        both = now.union(now.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        # large-star: neighbours above a node join its least neighbour
        large = now.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least.withColumnRenamed("a", "u"), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small-star: a node and its smaller neighbours join the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        after = stored(small.where("a <> b").distinct(), "edges")
        dispose(now)
        now = after
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    roots = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
