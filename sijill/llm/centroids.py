"""Centroid clustering of integer vectors with adaptive bounds, after Drake.

A vector's row carries an upper bound of the distance to its centroid, lower bounds of the
distances to its next few centroids, in order, and one bound for all the rest. When
centroids move, bounds give way by as much. Where the upper bound stays below the first
lower bound, the vector's centroid is certain and nothing is measured; else those centroids
are measured whose bounds don't clear the upper one, and all of them where even the bound
of the rest doesn't. Only strict order counts as certain, with room for rounding, and what
is measured is measured in integers: equal distances always are, and go to the smaller
number. So every assignment is that of a full scan. How many centroids have bounds of their
own adapts to the ranks that the last round came to.

A round is one pass: a task writes its vectors' new rows and, for each batch, a row a
centroid with its vectors' sum and count, into one table in the shared folder. Sums are
added up by centroid and component, so the driver gets as many numbers as the centroids
have. Rows never travel between tasks, whatever their values, and a round that is lost with
its executor is made again from the table before.

Defined cases: a vector of another length, null, or with a null, NaN or infinite component
is left out, and all others are kept, each row for itself, also with a null id or one that
others have; a component's integer is floor(scale * x), at most 2^27 either way, beyond
which distances would not fit a long; with fewer vectors than centroids, each starts one;
an empty table gives an empty table; other columns are ignored. Of equal hashes the smaller
id, then the smaller vector starts the centroid of smaller number; a null id is hashed as
the empty string and comes first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, kept

#: Largest integer of a component either way.
LARGEST = 2**27
#: Room for rounding in a bound, as a share.
ROOM = 1e-12

STATE = "id long, point array<int>, own int, upper double, near array<int>, lower array<double>, rest double, sums array<long>, n long, rank int, measured long"
NAMES = [f.split(" ")[0] for f in STATE.split(", ")]


def integers(df: DataFrame, id: str, vector: str, size: int, scale: int) -> DataFrame:
    """id, point of the rows that are kept."""
    v = F.col(vector)
    fits = (F.size(v) == size) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int")
    return df.where(fits).select(F.col(id).cast("long").alias("id"), F.transform(v, whole).alias("point"))


def seeds(points: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k points whose salted ids hash least."""
    hashed = points.withColumn("hash", F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256))
    return [list(r.point) for r in hashed.orderBy("hash", F.col("id").asc_nulls_first(), "point").limit(k).collect()]


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of each point to each of its own row of centroids, or to all."""
    gap = points[:, None, :] - centroids
    return np.einsum("ijk,ijk->ij", gap, gap)


def moved(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How far each centroid went, at least."""
    gap = (new - old).astype(np.float64)
    return np.sqrt((gap * gap).sum(axis=1)) * (1 + 4 * ROOM)


class Bounds:
    """The bounds of a batch of points, as arrays of a row each."""

    def __init__(self, own: np.ndarray, upper: np.ndarray, near: np.ndarray, lower: np.ndarray, rest: np.ndarray):
        self.own, self.upper, self.near, self.lower, self.rest = own, upper, near, lower, rest

    @classmethod
    def unknown(cls, n: int, few: int) -> Bounds:
        """Nothing is certain yet."""
        return cls(np.zeros(n, np.int32), np.full(n, np.inf), np.zeros((n, few), np.int32), np.zeros((n, few)), np.zeros(n))

    def give_way(self, drift: np.ndarray) -> None:
        self.upper = (self.upper + drift[self.own]) * (1 + ROOM)
        self.lower = np.maximum(self.lower - drift[self.near], 0) * (1 - ROOM)
        self.rest = np.maximum(self.rest - drift.max(initial=0), 0) * (1 - ROOM)
        # A bound holds for all centroids from its rank on, so that one comparison clears them.
        for i in range(self.lower.shape[1] - 1, -1, -1):
            self.lower[:, i] = np.minimum(self.lower[:, i], self.lower[:, i + 1] if i + 1 < self.lower.shape[1] else self.rest)

    def narrow(self, few: int) -> None:
        """Keeps ``few`` bounds, the others join the rest."""
        if few < self.lower.shape[1]:
            self.rest = np.minimum(self.rest, self.lower[:, few:].min(axis=1))
            self.near, self.lower = self.near[:, :few], self.lower[:, :few]

    def settle(self, points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, int]:
        """Makes every assignment certain. Returns the rank that each point came to (0: nothing measured; few + 1: all) and how many distances were measured."""
        few = self.lower.shape[1]
        rank = (self.upper[:, None] >= self.lower).sum(axis=1)
        rank = np.where(self.upper >= self.rest, few + 1, rank)
        measured = 0
        for r in np.unique(rank[rank > 0]):
            at = np.flatnonzero(rank == r)
            if r <= few:
                some = np.concatenate([self.own[at, None], self.near[at, :r]], axis=1)
                found = _distances(points[at], centroids[some])
            else:
                some = np.broadcast_to(np.arange(len(centroids), dtype=np.int32), (len(at), len(centroids)))
                found = _distances(points[at], centroids[None])
            measured += found.size
            order = np.lexsort((some, found), axis=1)
            some, found = np.take_along_axis(some, order, 1), np.sqrt(np.take_along_axis(found, order, 1).astype(np.float64))
            self.own[at], self.upper[at] = some[:, 0], found[:, 0] * (1 + ROOM)
            if r <= few:
                self.near[at, :r], self.lower[at, :r] = some[:, 1:], found[:, 1:] * (1 - ROOM)
            else:
                wide = min(few, len(centroids) - 1)
                self.near[at, :wide], self.lower[at, :wide] = some[:, 1 : wide + 1], found[:, 1 : wide + 1] * (1 - ROOM)
                self.rest[at] = found[:, wide + 1] * (1 - ROOM) if wide + 1 < len(centroids) else np.inf
        return rank, measured


def _matrix(column: pa.ListArray, rows: int, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(dtype)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    places = np.arange(0, values.size + 1, values.shape[1] if values.shape[1] else 1, dtype=np.int32) if values.shape[1] else np.zeros(len(values) + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(values.reshape(-1), kind))


def _round(state: DataFrame, centroids: np.ndarray, drift: np.ndarray | None, few: int) -> DataFrame:
    """``state`` after an assignment, with the batches' sums. drift: None in the first round, where state has id and point alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            points = _matrix(b.column(1), n, np.int64)
            if drift is None:
                bounds = Bounds.unknown(n, few)
            else:
                bounds = Bounds(b.column(2).to_numpy().copy(), b.column(3).to_numpy().copy(), _matrix(b.column(4), n, np.int32), _matrix(b.column(5), n, np.float64), b.column(6).to_numpy().copy())
                bounds.narrow(few)
                bounds.give_way(drift)
            rank, measured = bounds.settle(points, centroids)
            none = lambda kind, rows=n: pa.nulls(rows, kind)
            ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
            rows = [b.column(0), b.column(1), pa.array(bounds.own, pa.int32()), pa.array(bounds.upper), _lists(bounds.near, pa.int32()), _lists(bounds.lower, pa.float64()), pa.array(bounds.rest), none(longs), none(pa.int64()), none(pa.int32()), none(pa.int64())]
            yield pa.RecordBatch.from_arrays([x.cast(ints) if str(x.type).startswith("list<") and i == 1 else x for i, x in enumerate(rows)], names=NAMES)
            there = np.unique(bounds.own)
            sums = np.stack([points[bounds.own == c].sum(axis=0) for c in there])
            m = len(there)
            counts = np.array([(bounds.own == c).sum() for c in there], np.int64)
            highest, of_batch = np.full(m, rank.max(), np.int32), np.array([measured, *[0] * (m - 1)], np.int64)
            yield pa.RecordBatch.from_arrays([none(pa.int64(), m), none(ints, m), pa.array(there, pa.int32()), none(pa.float64(), m), none(ints, m), none(pa.list_(pa.float64()), m), none(pa.float64(), m), _lists(sums, pa.int64()), pa.array(counts), pa.array(highest), pa.array(of_batch)], names=NAMES)

    return state.mapInArrow(run, STATE)


def _mean(total: int, n: int) -> int:
    return total // n


def cluster(df: DataFrame, k: int, rounds: int, salt: str, id: str = "vec_id", vector: str = "embedding", size: int = 64, scale: int = 1024, seen: list | None = None) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector.

    seen: gets (distances measured, bounds kept, highest rank) of every assignment.
    """
    spark = df.sparkSession
    state = kept(integers(df, id, vector, size, scale), "centroids-points")
    first = seeds(state, k, salt)
    if not first:
        return spark.createDataFrame([], RESULT.replace("vec_id", id))
    centroids, drift = np.array(first, np.int64), None
    most, least = max(1, min(len(first) - 1, max(2, len(first) // 2))), max(1, len(first) // 8)
    few = most if len(first) > 1 else 0
    for turn in range(rounds + 1):
        made = kept(_round(state, centroids, drift, few), "centroids-state")
        discard(state)
        sums = made.where("sums is not null")
        told = sums.agg(F.max("rank").alias("rank"), F.sum("measured").alias("measured")).first()
        if seen is not None:
            seen.append((told.measured, few, told.rank))
        state = made.where("sums is null").select(NAMES[:7])
        state.kept_path = made.kept_path
        if turn == rounds:
            break
        new = centroids.copy()
        # As many rows as the centroids have components.
        for r in sums.select("own", "n", F.posexplode("sums")).groupBy("own", "pos").agg(F.sum("col").alias("total"), F.sum("n").alias("n")).collect():
            new[r.own, r.pos] = _mean(r.total, r.n)
        drift, centroids = moved(centroids, new), new
        if turn:  # the first round measures all of them
            few = max(least, min(few, told.rank)) if few else 0
    measured = kept(_measured(state, centroids, id), "centroids-measured")
    discard(state)
    inertia = measured.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # a row a centroid
    whole = sum(r.cluster_inertia for r in inertia)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    named = spark.createDataFrame([(r.cluster, r.cluster_inertia, whole, digests[r.cluster]) for r in inertia], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return measured.join(F.broadcast(named), "cluster").select(id, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def _measured(state: DataFrame, centroids: np.ndarray, id: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            gap = _matrix(b.column(1), b.num_rows, np.int64) - centroids[b.column(2).to_numpy()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(np.einsum("ij,ij->i", gap, gap))], names=[id, "cluster", "distance"])

    return state.select("id", "point", "own").mapInArrow(run, f"`{id}` long, cluster int, distance long")
