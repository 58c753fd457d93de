"""Centroid clustering in whole numbers, each vector finding its centroid in a vantage-point tree.

Vectors become integers once and are written. A round builds a tree over the
centroids in the driver, broadcasts it, and maps over the vectors: each goes
through the tree best branch first, until the nearest branch left is further than the
centroid it has. The vectors of a slice take their steps side by side in arrays, every
vector with its own queue. A task returns one line of sums a centroid and component,
so a round shuffles tasks x centroids x components numbers, whatever the vectors' spread.

Distances are sums of squares of integers, exact; only the bounds of branches are
real numbers, widened by more than their rounding, so no branch is cut wrongly.
A branch at exactly the radius is visited too: it may hold an equally near centroid of
smaller number.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from barworks.session import scratch_path, write_and_reread

DIMENSIONS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Integer components stay below this, so that squared distances of 64 of them fit a long.
LARGEST = 1 << 27
#: Centroids in a leaf.
LEAF = 2
#: Cells (vectors x tree nodes) of the queues of a slice.
SLICE_CELLS = 1 << 20
#: Relative widening of a branch's bound, above the rounding of roots and differences.
SLACK = 1e-9


class VantageTree:
    """Nodes in arrays: a vantage centroid, its two children with their distance ranges, or a leaf's centroids."""

    def __init__(self, centroids):
        self.centroids = np.asarray(centroids, np.int64)
        self.nodes = []
        if len(self.centroids):
            self._build(np.arange(len(self.centroids)))

    def _build(self, members):
        at = len(self.nodes)
        self.nodes.append(None)
        if len(members) <= LEAF:
            self.nodes[at] = (members, None, ())
            return at
        vantage, rest = members[0], members[1:]
        far = np.sqrt(((self.centroids[rest] - self.centroids[vantage]) ** 2).sum(axis=1).astype(np.float64))
        order = np.argsort(far, kind="stable")
        half = (len(rest) + 1) // 2
        children = [(self._build(rest[part]), far[part].min(), far[part].max()) for part in (order[:half], order[half:]) if len(part)]
        self.nodes[at] = (None, vantage, tuple(children))
        return at

    def nearest(self, vectors):
        """(centroid, squared distance) of each integer vector: the nearest, of equals the smaller number."""
        found, best = np.empty(len(vectors), np.int64), np.empty(len(vectors), np.int64)
        step = max(1, SLICE_CELLS // len(self.nodes))
        for low in range(0, len(vectors), step):
            found[low:low + step], best[low:low + step] = self._search(vectors[low:low + step])
        return found, best

    def _search(self, vectors):
        n = len(vectors)
        queue = np.full((n, len(self.nodes)), np.inf)
        queue[:, 0] = 0
        found = np.full(n, len(self.centroids), np.int64)
        best = np.full(n, np.iinfo(np.int64).max, np.int64)
        rows = np.arange(n)
        while len(rows):
            node = queue[rows].argmin(axis=1)
            bound = queue[rows, node]
            # Inclusive: a branch as near as the best so far is still visited.
            open_ = np.isfinite(bound) & (bound <= np.sqrt(best[rows].astype(np.float64)))
            rows, node, bound = rows[open_], node[open_], bound[open_]
            queue[rows, node] = np.inf
            for at in np.unique(node):
                here = node == at
                self._visit(at, rows[here], bound[here], vectors, queue, found, best)
        return found, best

    def _visit(self, at, rows, bound, vectors, queue, found, best):
        leaf, vantage, children = self.nodes[at]
        for number in leaf if vantage is None else (vantage,):
            squared = ((vectors[rows] - self.centroids[number]) ** 2).sum(axis=1)
            nearer = (squared < best[rows]) | ((squared == best[rows]) & (number < found[rows]))
            found[rows[nearer]], best[rows[nearer]] = number, squared[nearer]
        if vantage is not None:
            away = np.sqrt(squared.astype(np.float64))
            for child, low, high in children:
                gap = np.maximum(away - high, low - away) - SLACK * (away + high)
                queue[rows, child] = np.maximum(bound, gap)


def whole_vectors(vectors, id_col="vec_id", vector_col="embedding", dimensions=DIMENSIONS, scale=SCALE):
    """(id, v): floor(scale * x) of each component, of the vectors that have ``dimensions`` finite ones.

    Vectors of another length, null ones, and those with a null, NaN or infinite component
    are left out. A component whose integer reaches ``LARGEST`` fails the job: its
    distances would not fit a long.
    """
    x = F.col("x")
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    small = F.forall(x, lambda c: F.abs(c.cast("double")) * scale < LARGEST)
    value = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("int"))
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("x")).filter((F.size(x) == dimensions) & F.coalesce(finite, F.lit(False)))
    return kept.select("id", F.when(small, value).otherwise(
        F.raise_error(F.lit(f"a component of {LARGEST} or more after scaling")).cast("array<int>")).alias("v"))


def _matrix(column):
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(column), -1)


def _sums(whole, shared):
    """(cluster, place, total): component sums of each centroid's vectors; their number is at place -1."""
    def compute(batches):
        tree = shared.value
        totals = np.zeros((len(tree.centroids), tree.centroids.shape[1] + 1), object)
        for batch in batches:
            if batch.num_rows:
                matrix = _matrix(batch.column(0))
                near, _ = tree.nearest(matrix)
                for number in np.unique(near):
                    mine = near == number
                    totals[number, 1:] += matrix[mine].sum(axis=0)
                    totals[number, 0] += int(mine.sum())
        cluster, place = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(place - 1, pa.int32()),
                                          pa.array([str(t) for t in totals[cluster, place]], pa.string())], names=["cluster", "place", "total"])

    parts = whole.select("v").mapInArrow(compute, "cluster int, place int, total string")
    return parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def _assigned(whole, shared):
    """(id, cluster, distance) of every vector."""
    def compute(batches):
        tree = shared.value
        for batch in batches:
            near, squared = tree.nearest(_matrix(batch.column(1))) if batch.num_rows else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(near.astype(np.int32)), pa.array(squared)], names=["id", "cluster", "distance"])

    return whole.mapInArrow(compute, f"id {whole.schema['id'].dataType.simpleString()}, cluster int, distance bigint")


def first_centroids(whole, centroids=CENTROIDS, seed=SEED):
    """The vectors whose ids have the smallest SHA-256 of ``seed:id``, in that order.

    Rows of one id follow the order of their components; a null id comes last.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    return [r.v for r in whole.orderBy(digest.asc_nulls_last(), F.col("v")).limit(centroids).select("v").collect()]


def moved(centroids, sums):
    """The centroids after a round: exact floors of the means; one without vectors stays."""
    totals = {(r.cluster, r.place): int(r.total) for r in sums}
    out = []
    for number, old in enumerate(centroids):
        count = totals.get((number, -1), 0)
        out.append([totals.get((number, place), 0) // count for place in range(len(old))] if count else old)
    return out


def centroid_clusters(vectors, id_col="vec_id", vector_col="embedding", dimensions=DIMENSIONS, centroids=CENTROIDS,
                      rounds=ROUNDS, scale=SCALE, seed=SEED):
    """(id_col, cluster, distance, cluster_inertia, inertia, centroid): one row a kept vector.

    Centroids start as ``first_centroids``; each round assigns every vector to the
    nearest one (ties: smaller number) and moves the centroids to the floored means.
    ``distance`` is squared, ``cluster_inertia`` and ``inertia`` are its sums over the cluster
    and over all, ``centroid`` the components of the final centroid. What is kept
    is said in ``whole_vectors``; repeated rows each count and give a row; with fewer vectors
    than centroids there are as many centroids as vectors; without any, no
    rows. Other input columns are not returned, whatever their names.

    The driver holds the centroids and their sums: ``centroids * (dimensions + 1)``
    numbers. The tree that is broadcast has the same size.
    """
    spark = vectors.sparkSession
    whole = write_and_reread(whole_vectors(vectors, id_col, vector_col, dimensions, scale), scratch_path(spark, "whole-vectors"))
    where = first_centroids(whole, centroids, seed)
    for _ in range(rounds if where else 0):
        shared = spark.sparkContext.broadcast(VantageTree(where))
        where = moved(where, _sums(whole, shared).collect())
        shared.unpersist()
    shared = spark.sparkContext.broadcast(VantageTree(where))
    placed = write_and_reread(_assigned(whole, shared), scratch_path(spark, "clusters"))
    inertia = {r.cluster: int(r.total) for r in
               placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    final = spark.createDataFrame(
        [(k, inertia[k], sum(inertia.values()), where[k]) for k in inertia],
        "number int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    # One row a centroid.
    return placed.join(F.broadcast(final), F.col("cluster") == F.col("number")).select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def centroid_digest(components):
    """Lower-case hex SHA-256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.transform(components, lambda c: c.cast("string")), ","), 256)

