"""Clustering with bounds against a plain one that measures everything."""

import hashlib
import math
import random

import numpy as np
import pytest

from sijill.llm import centroids

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=8, rounds=10, size=64):
    points = []
    for id, v in rows:
        if v is None or len(v) != size or any(x is None or not math.isfinite(x) for x in v):
            continue
        points.append((id, [math.floor(1024 * float(np.float32(x))) for x in v]))
    by_hash = sorted(points, key=lambda p: (hashlib.sha256(f"3:{'' if p[0] is None else p[0]}".encode()).hexdigest(), p[0] is not None, p[0] or 0, p[1]))
    cents = [p[1] for p in by_hash[:k]]

    def assign():
        out = []
        for _, p in points:
            d = [sum((a - b) ** 2 for a, b in zip(p, c, strict=True)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(cents)):
            if mine := [p for (_, p), (o, _) in zip(points, own, strict=True) if o == c]:
                cents[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    own = assign()
    inertia = [sum(d for o, d in own if o == c) for c in range(len(cents))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(repr((id, o, d, inertia[o], sum(inertia), digest[o])) for (id, _), (o, d) in zip(points, own, strict=True))


def found(spark, rows, seen=None, schema=SCHEMA):
    df = centroids.cluster(spark.createDataFrame(rows, schema), k=8, rounds=10, salt="3:", seen=seen)
    return sorted(repr((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)) for r in df.collect())


@pytest.mark.parametrize("kind", ["groups", "noise", "ties"])
def test_against_full_scans(spark, kind):
    rng = random.Random(kind)
    middle = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(6)]
    if kind == "groups":
        rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(middle)]) for i in range(700)]
    elif kind == "noise":
        rows = [(i, [rng.gauss(0, 1) for _ in range(64)]) for i in range(500)]
    else:  # many equal vectors, and many that are as near to one centroid as to another
        rows = [(i // 2, [rng.choice([-1.0, 0.0, 1.0]) if j < 2 else 0.0 for j in range(64)]) for i in range(400)]
    seen = []
    assert found(spark, rows, seen) == brute(rows)
    assert len(seen) == 11
    if kind == "groups":  # bounds spare most distances after the first rounds, and fewer of them are kept
        full = 8 * len(rows)
        assert seen[0][0] == full and sum(s[0] for s in seen[3:]) < full and seen[-1][1] < seen[0][1]


def test_odd_rows(spark):
    one = [0.5] * 64
    rows = [(1, one), (1, one), (None, one), (2, None), (3, one[:63]), (4, [*one[:63], None]), (5, [*one[:63], float("nan")]), (6, [*one[:63], float("-inf")]), (7, [-0.0001] * 64), (8, [])]
    assert found(spark, rows) == brute(rows) and len(found(spark, rows)) == 4
    assert found(spark, []) == [] and found(spark, [(2, None)]) == []
    assert found(spark, [(9, one)]) == brute([(9, one)])
    extra = spark.createDataFrame([(1, one, "a", 2, 3)], SCHEMA + ", own string, cluster long, point int")
    assert centroids.cluster(extra, 8, 10, "3:").first().cluster == 0
    far = centroids.cluster(spark.createDataFrame([(1, [3e38] * 64), (2, [-3e38] * 64)], SCHEMA), 8, 2, "3:")
    assert {r.distance for r in far.collect()} == {0}


def test_few_centroids(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(64)]) for i in range(60)]
    for k in (1, 2, 3):
        got = centroids.cluster(spark.createDataFrame(rows, SCHEMA), k, 4, "3:")
        assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows, k, 4)
