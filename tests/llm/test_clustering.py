import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barworks.llm.clustering import LARGEST, VantageTree, centroid_clusters, centroid_digest, moved, whole_vectors


def brute(rows, k, rounds, scale=1024, seed=3):
    """(id, cluster, distance) by every vector against every centroid, and the centroids."""
    rows = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    order = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    where = [v for _, v in order[:k]]
    for step in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(where)) for _, v in rows]
        if step == rounds:
            return [(i, n, d) for (i, _), (d, n) in zip(rows, near)], where
        for n in range(len(where)):
            mine = [v for (_, v), (_, m) in zip(rows, near) if m == n]
            if mine:
                where[n] = [sum(column) // len(mine) for column in zip(*mine)]


@pytest.mark.parametrize("centroids", [1, 2, 3, 8, 61])
@pytest.mark.parametrize("spread", [2, 3000])
def test_tree_finds_the_nearest_and_the_smaller_of_equals(centroids, spread):
    """Small spreads give ties and equal centroids by the dozen."""
    source = np.random.default_rng(centroids)
    where = source.integers(-spread, spread, (centroids, 4))
    where[-1] = where[0]
    vectors = np.concatenate([source.integers(-2 * spread, 2 * spread, (500, 4)), where])
    found, squared = VantageTree(where).nearest(vectors)
    every = ((vectors[:, None] - where) ** 2).sum(axis=2)
    assert (squared == every.min(axis=1)).all() and (found == every.argmin(axis=1)).all()


def test_tree_at_the_largest_components():
    source = np.random.default_rng(1)
    where = source.integers(-LARGEST + 1, LARGEST, (20, 64))
    vectors = np.concatenate([where, where + source.integers(-1, 2, where.shape)]).clip(-LARGEST + 1, LARGEST - 1)
    found, squared = VantageTree(where).nearest(vectors)
    exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in where] for v in vectors]
    assert [min(e) for e in exact] == squared.tolist() and [e.index(min(e)) for e in exact] == found.tolist()


def test_tree_leaves_branches_out(monkeypatch):
    """Far groups of centroids: most vectors never meet most centroids."""
    source = np.random.default_rng(2)
    where = np.repeat(source.integers(-10_000, 10_000, (16, 8)), 4, axis=0) + source.integers(-3, 3, (64, 8))
    tree, visits = VantageTree(where), []
    visit = tree._visit
    monkeypatch.setattr(tree, "_visit", lambda at, rows, *rest: (visits.append(len(rows)), visit(at, rows, *rest)))
    found, squared = tree.nearest(where)
    assert (squared == 0).all() and (where[found] == where).all()
    assert sum(visits) < 0.5 * len(where) * len(tree.nodes)


def test_rounds_against_brute_force(spark):
    source = random.Random(3)
    rows = [(k, [source.gauss(k % 5, 0.3) for _ in range(6)]) for k in range(200)]
    rows += [(300 + k, rows[7][1]) for k in range(90)] + [(7, rows[7][1]), (7, [0.0] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    out = centroid_clusters(df, dimensions=6, centroids=8, rounds=10).collect()
    want, where = brute(rows, 8, 10)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in out), key=str) == sorted(want, key=str)
    for r in out:
        assert r.centroid == where[r.cluster]
        assert r.cluster_inertia == sum(d for _, n, d in want if n == r.cluster) and r.inertia == sum(d for _, _, d in want)


def test_what_is_kept(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, None), (6, []), (7, [1.0]), (8, [1.0, 2.0, 3.0]),
            (9, [-0.0001, 0.0001]), (None, [1.0, 1.0]), (1, [0.5, -0.5])]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id bigint, embedding array<float>, cluster string, id int")
    kept = sorted((tuple(r) for r in whole_vectors(df, dimensions=2).collect()), key=str)
    assert kept == sorted([(1, [512, -512]), (1, [512, -512]), (9, [-1, 0]), (None, [1024, 1024])], key=str)
    out = centroid_clusters(df, dimensions=2, centroids=8, rounds=3)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert [r.distance for r in out.collect()] == [0] * 4
    assert centroid_clusters(df.limit(0), dimensions=2).count() == 0
    with pytest.raises(Exception, match="after scaling"):
        centroid_clusters(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id bigint, embedding array<double>"), dimensions=2).collect()


def test_centroids_move_by_exact_floors(spark):
    class Sum:
        def __init__(self, cluster, place, total):
            self.cluster, self.place, self.total = cluster, place, total

    sums = [Sum(0, -1, 3), Sum(0, 0, -1), Sum(0, 1, 10 ** 25 + 2)]
    assert moved([[5, 5], [6, 6]], sums) == [[-1, (10 ** 25 + 2) // 3], [6, 6]]
    row = spark.range(1).select(centroid_digest(F.array(F.lit(-1), F.lit(20)).cast("array<bigint>")).alias("d")).first()
    assert row.d == hashlib.sha256(b"-1,20").hexdigest()
