"""Centroid clustering of integer vectors with Hamerly's bounds.

With each vector go its centroid, an upper bound of the distance to it and a lower bound of the
distance to any other.  When centroids move, the upper bound grows by what the own one moved
and the lower bound falls by the most that another moved.  A vector whose upper bound stays
under its lower bound, or under half the way from its centroid to the nearest other, keeps its
centroid unseen; the others are measured to all centroids, in whole numbers.  Bounds
are rounded outwards, so all assignments are those of exact arithmetic.

A round reads the vectors with their bounds and writes them anew; centroids are updated by the
sums of the vectors that changed sides, and the driver holds nothing but centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import batches, dispose, stored

SIZE, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, "3"
#: Components from here on are refused: squared distances would not fit in 64 bits.
MOST = 1 << 27
#: A lower bound where there is no other centroid.
FAR = 1e300
#: Bounds are widened by this share, far over the rounding of a square root and a sum.
SLACK = 1e-12


def kept(embeddings: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the vector as integers floor(scale * x), of the vectors with ``size`` components, none
    null, not finite, or from MOST on."""
    x = F.col("embedding")
    v = F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("int"))
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) * scale < F.lit(float(MOST))))
    return embeddings.select("vec_id", F.when(x.isNotNull() & (F.size(x) == size) & fine, v).alias("v")).where("v is not null")


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: str = SEED) -> np.ndarray:
    """The vectors whose ids come first by SHA-256; a null id is an empty one, equal ids go by their vectors."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(order.alias("o"), "v").orderBy("o", "v").limit(clusters).collect()
    return np.array([r.v for r in rows], np.int64)


def squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all vectors to all centroids."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def reach(square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers just over and just under the roots of whole numbers."""
    root = np.sqrt(square.astype(np.float64))
    return root * (1 + SLACK), root * (1 - SLACK)


class Drift:
    """What a move of centroids means for bounds."""

    def __init__(self, old: np.ndarray, new: np.ndarray):
        self.moved = reach(((new - old) ** 2).sum(axis=1))[0]
        k = len(new)
        # the most that any centroid but this one moved
        self.others = np.array([max((self.moved[j] for j in range(k) if j != i), default=0.0) for i in range(k)])
        apart = squares(new, new)
        np.fill_diagonal(apart, np.iinfo(np.int64).max)
        #: a vector nearer to its centroid than this has no other as near
        self.safe = reach(apart.min(axis=1))[1] / 2 if k > 1 else np.full(k, FAR)


STATE = "v array<int>, cluster int, before int, upper double, lower double"


def scanned(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid of each vector (the first of equals), its square, and both bounds."""
    square = squares(x, centroids)
    best = square.argmin(axis=1)
    rows = np.arange(len(x))
    nearest = square[rows, best]
    square[rows, best] = np.iinfo(np.int64).max
    second = square.min(axis=1) if len(centroids) > 1 else nearest
    return best.astype(np.int32), nearest, reach(nearest)[0], reach(second)[1] if len(centroids) > 1 else np.full(len(x), FAR)


def matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def assigned(rows: DataFrame, centroids: np.ndarray, old: np.ndarray | None = None) -> DataFrame:
    """The vectors with the state they have among ``centroids``.  Without ``old``, the centroids that
    the state of ``rows`` goes back to, all are measured."""
    drift = None if old is None else Drift(old, centroids)
    arrays = None if drift is None else (drift.moved, drift.others, drift.safe)
    kind = rows.schema["vec_id"].dataType.simpleString()
    names = ["vec_id", *(c.split()[0] for c in STATE.split(", "))]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = matrix(batch.column(1))
        n = len(x)
        if arrays is None:
            before = np.full(n, -1, np.int32)
            cluster, _, upper, lower = scanned(x, centroids) if n else (before, None, np.zeros(0), np.zeros(0))
        else:
            moved, others, safe = arrays
            before, upper, lower = (batch.column(i).to_numpy(zero_copy_only=False).copy() for i in (2, 4, 5))
            cluster = before.copy()
            upper, lower = (upper + moved[cluster]) * (1 + SLACK), lower - others[cluster]
            lower -= np.abs(lower) * SLACK
            unsure = np.flatnonzero(upper >= np.maximum(lower, safe[cluster]))
            if len(unsure):
                cluster[unsure], _, upper[unsure], lower[unsure] = scanned(x[unsure], centroids)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cluster), pa.array(before), pa.array(upper), pa.array(lower)], names=names)

    return batches(rows.select(*(names if arrays is not None else names[:2])), work, f"vec_id {kind}, {STATE}")


def moved_sums(state: DataFrame, clusters: int) -> tuple[np.ndarray, np.ndarray]:
    """By cluster, how many vectors more it has than before, and the sum of their components more."""

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in source:
            x = matrix(batch.column(0))
            if len(x):
                x = np.column_stack([np.ones(len(x), np.int64), x])
                total = np.zeros((clusters, x.shape[1]), np.int64) if total is None else total
                for sign, column in ((1, 1), (-1, 2)):
                    at = batch.column(column).to_numpy()
                    for k in range(clusters):
                        total[k] += sign * x[at == k].sum(axis=0)
        if total is not None:
            k, d = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(k.ravel().astype(np.int32)), pa.array(d.ravel().astype(np.int32)), pa.array(total.ravel())], names=["k", "d", "s"])

    rows = state.where("cluster <> before").select("v", "cluster", "before").mapInArrow(count, "k int, d int, s long")
    # as many rows as centroids have components, whatever the input
    found = rows.groupBy("k", "d").agg(F.sum("s").alias("s")).collect()
    size = max((r.d for r in found), default=0)
    out = np.zeros((clusters, size + 1), np.int64)
    for k, d, s in found:
        out[k, d] = s
    return out[:, 0], out[:, 1:]


def cluster(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector of ``embeddings`` (vec_id,
    embedding).

    Not kept are vectors of another size, with a null or a component that is not finite or whose integer is 2**27
    or more, as squares of it would not fit in 64 bits.  Equal vectors and repeated rows count each;
    null ids are kept and stay null; of equally near centroids the smaller number wins.  With fewer vectors
    than ``clusters`` there are as many centroids as vectors; without any there are no rows.  An inertia that
    does not fit in 64 bits is null.  Other columns are left out."""
    vectors = stored(kept(embeddings, size, scale), "vectors")
    centroids = first_centroids(vectors, clusters, seed)
    k = len(centroids)
    if not k:
        kind = embeddings.schema["vec_id"].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    counts, sums, old, state = np.zeros(k, np.int64), np.zeros((k, size), np.int64), None, vectors
    for _ in range(rounds):
        now = stored(assigned(state, centroids, old), "bounds")
        dispose(state)
        more, summed = moved_sums(now, k)
        counts += more
        if summed.size:
            sums += summed
        some = counts > 0
        old, state = centroids, now
        centroids = np.where(some[:, None], sums // np.maximum(counts, 1)[:, None], old)
    state = stored(measured(assigned(state, centroids, old), centroids), "distances")
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    totals = {r.cluster: int(r.w) for r in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("w")).collect()}
    long = lambda w: w if w < 1 << 63 else None
    each, inertia = [long(totals.get(i, 0)) for i in range(k)], long(sum(totals.values()))
    at = lambda values, kind: F.get(F.array(*[F.lit(x).cast(kind) for x in values]), F.col("cluster"))
    return state.select("vec_id", "cluster", "distance", at(each, "long").alias("cluster_inertia"), F.lit(inertia).cast("long").alias("inertia"), at(digest, "string").alias("centroid_sha256"))


def measured(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and the exact squared distance to it."""
    kind = state.schema["vec_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, at = matrix(batch.column(1)), batch.column(2).to_numpy()
        square = ((x - centroids[at]) ** 2).sum(axis=1) if len(x) else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(square)], names=["vec_id", "cluster", "distance"])

    return batches(state.select("vec_id", "v", "cluster"), work, f"vec_id {kind}, cluster int, distance long")


def sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED, size: int = SIZE, scale: int = SCALE) -> str:
    """The rows of ``cluster`` in DuckDB: plain rounds, every vector measured to every centroid."""
    square = "list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
    steps = []
    for n in range(rounds + 1):
        steps.append(f"a{n} as materialized (select i, arg_min(c.k, (d, c.k)) k, min(d) d from (select x.i, c.k, {square} d from x, c{n} c) c group by i)")
        if n < rounds:
            floor = "(s - ((s % n) + n) % n) // n"
            steps.append(f"s{n} as (select k, p, sum(x.v[p])::bigint s, count(*)::bigint n from a{n} join x using (i), range(1, {size + 1}) r(p) group by k, p)")
            steps.append(f"m{n} as (select k, list(({floor})::bigint order by p) v from s{n} group by k)")
            steps.append(f"c{n + 1} as materialized (select c.k, coalesce(m.v, c.v) v from c{n} c left join m{n} m using (k))")
    last = rounds
    return f"""
with x as materialized (
  select row_number() over () i, vec_id, list_transform(embedding, lambda e: floor({scale} * e::double)::bigint) v from embeddings
  where len(embedding) = {size} and len(list_filter(embedding, lambda e: e is not null and isfinite(e) and abs(e::double) * {scale} < {MOST})) = {size}),
c0 as (select (row_number() over (order by sha256('{seed}:' || coalesce(vec_id::varchar, '')), v))::int - 1 k, v from x
       qualify k < {clusters}),
{", ".join(steps)},
t as (select k, sum(d)::bigint w from a{last} group by k)
select vec_id, a.k::int as cluster, d::bigint distance, t.w cluster_inertia, (select sum(w) from t)::bigint inertia, sha256(array_to_string(c.v, ',')) centroid_sha256
from a{last} a join x using (i) join t using (k) join c{last} c using (k)"""
