"""Centroid clustering against plain rounds in Python's whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from sparkloom.llm import centroids

SCHEMA = "vec_id long, embedding array<double>"
OUT = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def brute(rows, clusters=8, rounds=10, size=64):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) and abs(1024 * x) < 2**27 for x in v)]
    order = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    means = [v for _, v in order[:clusters]]

    def assign():
        found = []
        for _, v in kept:
            found.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(means)))
        return found

    for _ in range(rounds):
        at = [k for _, k in assign()]
        for k in range(len(means)):
            own = [v for (_, v), a in zip(kept, at) if a == k]
            if own:
                means[k] = [sum(c) // len(own) for c in zip(*own)]
    last = assign()
    total = [sum(d for d, a in last if a == k) for k in range(len(means))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in means]
    long = lambda x: x if x < 2**63 else None
    return sorted(((i, k, d, long(total[k]), long(sum(total)), names[k]) for (i, _), (d, k) in zip(kept, last)), key=str)


def rows_of(df):
    return sorted((tuple(x) for x in df.select(*OUT).collect()), key=str)


def vectors(r, n, size=64, step=0.25):
    middles = [[r.uniform(-2, 2) for _ in range(size)] for _ in range(11)]
    return [(i, [round((m + r.gauss(0, 0.6)) / step) * step for m in r.choice(middles)]) for i in range(n)]


def test_clusters_equal_brute_force(spark):
    """Coarse steps give equal distances; odd vectors are left out, repeated ones and a third of equal ones count each."""
    r = random.Random(5)
    rows = vectors(r, 240)
    rows += [(1000 + i, rows[0][1]) for i in range(100)] + rows[:4] + [(None, rows[9][1]), (None, rows[9][1])]
    odd = [(1, None), (2, []), (3, [0.5] * 63), (4, [0.5] * 65), (5, [0.5] * 63 + [None]), (6, [float("nan")] * 64), (7, [0.1] * 63 + [float("-inf")]), (8, [1e300] * 64)]
    df = spark.createDataFrame(rows + odd, SCHEMA).repartition(6).selectExpr("*", "'mine' as cluster", "1 as v", "2 as upper", "0 as before")
    assert rows_of(centroids.cluster(df)) == brute(rows + odd)


def test_small_integers_make_ties(spark):
    r = random.Random(6)
    rows = [(i, [r.choice((-1, 0, 1)) / 1024 for _ in range(3)]) for i in range(150)]
    got = rows_of(centroids.cluster(spark.createDataFrame(rows, SCHEMA), size=3))
    assert got == brute(rows, size=3)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_centroids(spark, n):
    rows = vectors(random.Random(n), n)
    assert rows_of(centroids.cluster(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_large_components(spark):
    r = random.Random(7)
    rows = [(i, [r.choice((-1, 1)) * 131071.5 for _ in range(64)]) for i in range(30)]
    got = rows_of(centroids.cluster(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows) and got[0][4] is None


def test_bounds_hold_and_spare_scans(spark):
    """In every round bounds enclose the exact distances, and late rounds measure few vectors."""
    r = random.Random(9)
    x = np.array([[math.floor(1024 * e) for e in v] for _, v in vectors(r, 3000, step=0.001)])
    means, seen = x[:8].copy(), []
    at, _, upper, lower = centroids.scanned(x, means)
    for _ in range(12):
        new = np.array([x[at == k].sum(axis=0) // max(1, (at == k).sum()) for k in range(8)])
        drift = centroids.Drift(means, new)
        upper, lower, means = upper + drift.moved[at], lower - drift.others[at], new
        square = centroids.squares(x, means)
        rest = square.copy()
        rest[np.arange(len(x)), at] = np.iinfo(np.int64).max
        assert (upper >= np.sqrt(square[np.arange(len(x)), at]) * (1 - 1e-15)).all() and (lower <= np.sqrt(rest.min(axis=1))).all()
        unsure = upper >= np.maximum(lower, drift.safe[at])
        assert (square.argmin(axis=1) == at)[~unsure].all()
        at[unsure], _, upper[unsure], lower[unsure] = centroids.scanned(x[unsure], means)
        seen.append(unsure.mean())
    assert seen[-1] < 0.2
