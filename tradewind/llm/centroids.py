"""Centroid clustering of whole-number vectors with a vantage-point tree over the centroids.

Vectors of `dimensions` components, none null or non-finite, become whole numbers, floor(scale * x). The first centroids
are the vectors of the least hashes of their ids. Each round builds a vantage-point tree over the centroids on the
driver and broadcasts it (as many vectors as there are centroids). A task finds the nearest centroid of each vector by
best-first branch and bound: of the subtrees open to a vector, that of the least lower bound is entered next, until that
bound lies beyond the best distance. The radius is inclusive, so that a centroid at the same distance with a smaller
number is found too, and allows for the rounding of square roots; distances themselves are exact whole numbers. The
vectors of a block take these steps together, each with its own open subtrees. Tasks add up the vectors of each
cluster, so a round shuffles one row for each task and cluster, and the driver gets one for each cluster.

Defined cases: vectors of another length, with a null, NaN or infinite component, or that are null, are left out; one
with a component of 2^21 or more over scale / 64 in size is refused with an error, as distances must fit a long; equal
distances go to the centroid of the smaller number; equal hashes to the smaller vector; rows of a null id are clustered
but start no centroid; repeated rows count each; with fewer vectors than centroids there are as many centroids as
vectors; a centroid without vectors stays as it is; an empty table gives no rows; other columns, whatever their names,
play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.shared import release_memory, ship_package, written

CENTROIDS = 16
ROUNDS = 3
DIMENSIONS = 64
SCALE = 64
SEED = 1
#: Size of a component from which squared distances of whole vectors might not fit a long.
MOST = 1 << 27
LEAF = 2
#: Open subtrees of the vectors of a block, at most.
_OPEN = 1 << 19
_CLOSED = np.inf


@dataclass(frozen=True)
class Node:
    """A subtree: a vantage centroid with two subtrees and the range of their distances from it, or a leaf."""

    centroids: tuple[int, ...]
    children: tuple[tuple[int, float, float], ...] = ()


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two whole-number arrays of the same shape, or of rows to one vector."""
    apart = x - y
    return np.einsum("ij,ij->i", apart, apart)


class VantagePointTree:
    """Nearest of `points` (rows of whole numbers), numbered from 0."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points.astype(np.int64)
        self.nodes: list[Node] = []
        self._build(np.arange(len(points)))

    def _build(self, members: np.ndarray) -> int:
        """The number of the node over the members. The vantage centroid is the farthest from their first."""
        number = len(self.nodes)
        if len(members) <= LEAF:
            self.nodes.append(Node(tuple(members.tolist())))
            return number
        vantage = members[np.argmax(squared(self.points[members], self.points[members[0]]))]
        others = members[members != vantage]
        far = squared(self.points[others], self.points[vantage])
        order = np.argsort(far, kind="stable")
        others, far = others[order], np.sqrt(far[order].astype(np.float64))
        self.nodes.append(Node(()))
        half, children = len(others) // 2, []
        for part in (slice(0, half), slice(half, None)):
            if len(others[part]):
                children.append((self._build(others[part]), float(far[part][0]), float(far[part][-1])))
        self.nodes[number] = Node((int(vantage),), tuple(children))
        return number

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and exact squared distance of each vector's nearest point; of equal ones the smallest number."""
        rows = max(1, _OPEN // len(self.nodes))
        found = [self._block(vectors[i : i + rows]) for i in range(0, len(vectors), rows)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([n for n, _ in found]), np.concatenate([d for _, d in found])

    def _block(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best = np.full(len(vectors), np.iinfo(np.int64).max)
        number = np.full(len(vectors), len(self.points))
        bounds = np.full((len(vectors), len(self.nodes)), _CLOSED)
        bounds[:, 0] = 0.0
        active = np.arange(len(vectors))
        while len(active):
            entered = np.argmin(bounds[active], axis=1)
            bound = bounds[active, entered]
            radius = np.sqrt(best[active].astype(np.float64))
            go = (bound < _CLOSED) & (bound <= radius + 1e-9 * (1.0 + radius))
            active, entered, bound = active[go], entered[go], bound[go]
            bounds[active, entered] = _CLOSED
            order = np.argsort(entered, kind="stable")
            edges = np.flatnonzero(np.diff(entered[order], prepend=-1, append=-1))
            for i, j in zip(edges, edges[1:]):
                rows, at = active[order[i:j]], order[i:j]
                node, ours = self.nodes[entered[order[i]]], vectors[active[order[i:j]]]
                for c in node.centroids:
                    distance = squared(ours, self.points[c])
                    better = (distance < best[rows]) | (distance == best[rows]) & (c < number[rows])
                    best[rows[better]], number[rows[better]] = distance[better], c
                if node.children:
                    away = np.sqrt(distance.astype(np.float64))
                    for child, low, high in node.children:
                        bounds[rows, child] = np.maximum(bound[at], np.maximum(away - high, low - away))
        return number, best


@dataclass(frozen=True)
class Clustering:
    """assignments: vec_id, cluster, distance (squared) of every vector kept; centroids: the rows by number."""

    assignments: DataFrame
    centroids: list[list[int]]


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, components (whole numbers) of the vectors kept."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    kept = kept.where((F.size("embedding") == dimensions) & finite)
    small = F.forall("embedding", lambda x: F.abs(x * scale) < MOST)
    whole = F.transform("embedding", lambda x: F.floor(x * scale).cast("int"))
    refused = F.raise_error(F.lit(f"a component is beyond {MOST} / {scale}"))
    return kept.select("vec_id", F.when(small, whole).otherwise(refused).alias("components"))


def first_centroids(vectors: DataFrame, centroids: int, seed: int) -> np.ndarray:
    """The vectors of the least hashes, in their order; `centroids` rows come to the driver."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.where("vec_id is not null").orderBy(drawn, "components").limit(centroids).select("components").collect()
    return np.array([r["components"] for r in rows], dtype=np.int64)


def _rows(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions).astype(np.int64)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the floor of the mean of the vectors nearest to it, if there are any."""
    tree = vectors.sparkSession.sparkContext.broadcast(VantagePointTree(centroids))
    count, dimensions = centroids.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, sums = np.zeros(count, np.int64), np.zeros((count, dimensions), np.int64)
        for batch in batches:
            ours = _rows(batch, dimensions)
            cluster, _ = tree.value.nearest(ours)
            for c in np.unique(cluster):
                mine = ours[cluster == c]
                members[c] += len(mine)
                sums[c] += mine.sum(axis=0)
        some = np.flatnonzero(members)
        columns = [pa.array(some.astype(np.int32)), pa.array(members[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))]
        yield pa.record_batch(columns, ["cluster", "members", "sums"])
        release_memory()

    parts = vectors.select("vec_id", "components").mapInArrow(add_up, "cluster int, members long, sums array<long>")
    total = parts.groupBy("cluster").agg(F.sum("members").alias("members"), *[F.sum(F.col("sums")[i]).alias(f"_{i}") for i in range(dimensions)])
    moved = centroids.copy()
    for row in total.collect():
        moved[row["cluster"]] = [row[f"_{i}"] // row["members"] for i in range(dimensions)]
    tree.destroy()
    return moved


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance of every vector; written, so that the broadcast tree is needed no longer."""
    tree = vectors.sparkSession.sparkContext.broadcast(VantagePointTree(centroids))
    dimensions = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = tree.value.nearest(_rows(batch, dimensions))
            yield pa.record_batch([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])
        release_memory()

    found = written(vectors.select("vec_id", "components").mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    tree.destroy()
    return found


def clustered(
    vectors: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
) -> Clustering:
    """Clusters of vec_id, embedding after `rounds` rounds."""
    spark = vectors.sparkSession
    ship_package(spark)
    whole = written(whole_vectors(vectors, dimensions, scale), "vectors")
    found = first_centroids(whole, centroids, seed)
    if not len(found):
        return Clustering(spark.createDataFrame([], "vec_id long, cluster int, distance long"), [])
    for _ in range(rounds):
        found = moved(whole, found)
    return Clustering(assigned(whole, found), found.tolist())


def inertia(clustering: Clustering) -> DataFrame:
    """cluster, cluster_inertia: distances summed over each cluster that has vectors."""
    return clustering.assignments.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
