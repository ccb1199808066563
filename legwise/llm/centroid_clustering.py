"""Centroid clustering in whole numbers, with an n-simplex projection in front of the distances.

Components become integers, ``floor(scale * x)``, so sums, means and distances are exact and
do not depend on the order of rows.  The distances of every vector to a few pivots are
computed once and written.  Seen from the pivots, a vector is the apex of a simplex on
them; its coordinates follow from those distances.  The last coordinate is its height over
the pivots' space, whose direction is unknown, so the distance of two apexes is a lower
bound of the true distance, and with one height turned over it is an upper bound.  A centroid
whose lower bound is above the least upper bound cannot be the nearest; only the others'
exact distances are computed.

What passes the driver is the centroids: ``centroids`` x ``dimensions`` numbers a round,
whatever the number of rows.  Vectors are not shuffled; each task adds up its own rows.

Defined results: vectors that are null, of another length, or with a component that is null, NaN
or infinite are left out; with fewer vectors than centroids each one is a centroid, without any the result is empty; equal
ids are ordered by their components; repeated rows count as often as they occur; a null id is
hashed as an empty one; other columns are ignored.  Integers beyond ``LARGEST`` are an error,
since their squared distance would not fit in a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from legwise.staging import stage

CENTROIDS, DIMENSIONS, ROUNDS, SCALE = 40, 64, 5, 256
PIVOTS = 12
#: 64 squared differences of twice this fit in a long.
LARGEST = 1 << 27
#: Part of the squared scale by which bounds may err; rounding is far below it.
SLACK = 1e-5
CHUNK = 2048


class Pivots(NamedTuple):
    """Pivots and the simplex on them: row i - 1 of ``base`` is pivot i, pivot 0 the origin."""

    points: np.ndarray
    base: np.ndarray


def squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to a few others."""
    return np.stack([np.einsum("ij,ij->i", points - o, points - o) for o in others], axis=1) if len(others) else np.zeros((len(points), 0), np.int64)


def choose_pivots(points: np.ndarray, count: int = PIVOTS) -> Pivots:
    """Up to ``count`` of the points, each the one highest over the simplex of those before it."""
    chosen = [0]
    base = np.zeros((0, 0))
    while len(chosen) < min(count, len(points)):
        apexes = project(squared(points, points[chosen]), base)
        heights = apexes[:, -1]
        best = int(np.argmax(heights))
        if heights[best] <= 0.05 * max(1.0, np.abs(base).max(initial=0)):
            break
        base = np.hstack([base, np.zeros((len(base), 1))])
        base = np.vstack([base, apexes[best]])
        chosen.append(best)
    return Pivots(points[chosen], base)


def project(distances: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Apex coordinates from squared distances to the pivots; the last one is the height."""
    away = distances.astype(float)
    apexes = np.zeros(away.shape)
    for i, pivot in enumerate(base):
        known = apexes[:, :i] @ pivot[:i]
        apexes[:, i] = ((away[:, 0] + pivot @ pivot - away[:, i + 1]) / 2 - known) / pivot[i]
    rest = away[:, 0] - np.einsum("ij,ij->i", apexes, apexes)
    apexes[:, -1] = np.sqrt(np.maximum(rest, 0))
    return apexes


def bounds(apexes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances of all apexes to the others."""
    lower = np.einsum("ij,ij->i", apexes, apexes)[:, None] + np.einsum("ij,ij->i", others, others) - 2 * apexes @ others.T
    return lower, lower + 4 * apexes[:, -1:] * others[:, -1]


def nearest(points: np.ndarray, distances: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each point's nearest centroid (ties: the smaller number), and how many were measured."""
    theirs = project(squared(centroids, pivots.points), pivots.base)
    cluster, distance, measured = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64), 0
    for first in range(0, len(points), CHUNK):
        part = slice(first, first + CHUNK)
        mine = project(distances[part], pivots.base)
        lower, upper = bounds(mine, theirs)
        slack = SLACK * (1 + (mine**2).sum(axis=1).max() + (theirs**2).sum(axis=1).max())
        rows, columns = np.nonzero(lower <= upper.min(axis=1, keepdims=True) + slack)
        apart = points[part][rows] - centroids[columns]
        exact = np.full(lower.shape, np.iinfo(np.int64).max)
        exact[rows, columns] = np.einsum("ij,ij->i", apart, apart)
        cluster[part] = exact.argmin(axis=1)
        distance[part] = exact[np.arange(len(exact)), cluster[part]]
        measured += len(rows)
    return cluster, distance, measured


def _matrix(column: pa.Array, kind: type = np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _lists(matrix: np.ndarray) -> pa.Array:
    width = matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * width), pa.array(matrix.ravel()))


def _distances(batches, pivots: Pivots) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            points = _matrix(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(points), _lists(squared(points, pivots.points))], ["key", "point", "away"])


def _sums(batches, centroids: np.ndarray, pivots: Pivots) -> Iterator[pa.RecordBatch]:
    sums, members = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
    for batch in batches:
        if batch.num_rows:
            points = _matrix(batch.column(1))
            cluster, _, _ = nearest(points, _matrix(batch.column(2)), centroids, pivots)
            np.add.at(sums, cluster, points)
            members += np.bincount(cluster, minlength=len(members))
    some = np.flatnonzero(members)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(members[some]), _lists(sums[some])], ["cluster", "members", "sums"])


def _assigned(batches, centroids: np.ndarray, pivots: Pivots) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            cluster, distance, _ = nearest(_matrix(batch.column(1)), _matrix(batch.column(2)), centroids, pivots)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["key", "cluster", "distance"])


def whole(vectors: DataFrame, vector: str, key: str, dimensions: int, scale: int) -> DataFrame:
    """``key`` and ``point``, the integer components of the vectors that have ``dimensions`` finite ones."""
    given = F.col("vector")
    finite = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce((F.size(given) == dimensions) & finite, F.lit(False))

    def integer(x: Column) -> Column:
        scaled = F.floor(x * scale)
        large = F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}")).cast("int")
        return F.when(F.abs(x * scale) < LARGEST, scaled.cast("int")).otherwise(large)

    rows = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    return rows.where(usable).select("key", F.transform(given, integer).alias("point"))


def first_centroids(points: DataFrame, count: int, salt: str) -> np.ndarray:
    """The points with the smallest hashes of their ids, in order of the hashes; ``count`` rows."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = points.orderBy(digest, "point").limit(count).select("point").collect()
    return np.array([r.point for r in rows], np.int64)


def _moved(points: DataFrame, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    sums = points.mapInArrow(lambda b: _sums(b, centroids, pivots), "cluster int, members bigint, sums array<bigint>")
    totals = (
        sums.select("cluster", "members", F.posexplode("sums").alias("place", "part"))
        .groupBy("cluster", "place")
        .agg(F.sum("members").alias("members"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    )
    moved = centroids.copy()
    for row in totals.collect():
        moved[row.cluster, row.place] = int(row.total) // row.members
    return moved


def cluster(
    vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", centroids: int = CENTROIDS, dimensions: int = DIMENSIONS,
    rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS, salt: str = "2:",
) -> DataFrame:
    """``key``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of every usable vector."""
    if dimensions > 64:
        raise ValueError("squared distances of more than 64 components may not fit in a long")
    spark = vectors.sparkSession
    points = whole(vectors, vector, key, dimensions, scale)
    kind = points.schema["key"].dataType
    current = first_centroids(points, centroids, salt)
    if not len(current):
        schema = StructType([StructField(key, kind), *StructType.fromDDL(
            "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string").fields])
        return spark.createDataFrame([], schema)
    fixed = choose_pivots(current, pivots)
    cached = StructType([StructField("key", kind), *StructType.fromDDL("point array<bigint>, away array<bigint>").fields])
    measured = stage(points.mapInArrow(lambda b: _distances(b, fixed), cached), "pivot_distances")
    for _ in range(rounds):
        current = _moved(measured, current, fixed)
    last = current
    shape = StructType([StructField("key", kind), *StructType.fromDDL("cluster int, distance bigint").fields])
    assigned = stage(measured.mapInArrow(lambda b: _assigned(b, last, fixed), shape), "assigned")
    inertia = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("cluster_inertia")).collect()
    total = sum(int(r.cluster_inertia) for r in inertia)
    facts = spark.createDataFrame(
        [(r.cluster, int(r.cluster_inertia), total, hashlib.sha256(",".join(map(str, last[r.cluster].tolist())).encode()).hexdigest()) for r in inertia],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
