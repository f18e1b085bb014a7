"""Exact integer centroid clustering with a progressive search on Walsh-Hadamard coefficients.

Vectors and centroids are transformed once by the integer Walsh-Hadamard matrix, whose
rows are put in order of their sign changes, coarse to fine. The matrix keeps
squared distances up to the factor ``DIMS``, so sums of squared coefficient differences
are lower bounds at every stage and the exact distance at the last one. The
centroid nearest on the coarsest coefficient is finished first; every other one
is dropped as soon as its sum is strictly greater, and what is left is finished.

A round sends one row of sums per task and cluster; the driver holds the centroids only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recensio.session import materialize

DIMS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
#: Ends of the stages: so many coefficients are summed when centroids are dropped.
STAGES = (1, 2, 4, 8, 16, 32, DIMS)
#: Largest size of an integer component that leaves exact sums of squares in 64 bits.
LARGEST = 1 << 24
#: Vectors that are compared at once.
TOGETHER = 8192


def _sequency(dims: int) -> np.ndarray:
    """Rows of the natural Hadamard matrix by their number of sign changes."""
    places = np.arange(dims)
    signs = np.bitwise_count(places[:, None] & places[None, :]) & 1
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


ORDER = _sequency(DIMS)


def transform(vectors: np.ndarray) -> np.ndarray:
    """Coefficients of integer rows, coarse to fine."""
    rows, dims = vectors.shape
    out, half = vectors.astype(np.int64), 1
    while half < dims:
        pairs = out.reshape(rows, dims // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, dims)
        half *= 2
    return out[:, ORDER]


def restore(coefficients: list[int]) -> list[int]:
    """The integer vector (or sum of vectors) of coefficients; exact at any size."""
    natural = np.zeros(DIMS, object)
    natural[ORDER] = coefficients
    half = 1
    while half < DIMS:
        pairs = natural.reshape(DIMS // (2 * half), 2, half)
        natural = np.stack([pairs[:, 0] + pairs[:, 1], pairs[:, 0] - pairs[:, 1]], axis=1).reshape(DIMS)
        half *= 2
    return [int(x) // DIMS for x in natural]


def nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the exact squared distance.

    ``rows`` and ``centres`` are coefficients.
    """
    n = np.arange(len(rows))
    sums = np.square(rows[:, :1] - centres[:, 0][None, :])
    guess = sums.argmin(axis=1)
    bound = np.square(rows - centres[guess]).sum(axis=1)
    alive = sums <= bound[:, None]
    alive[n, guess] = False
    for begin, end in zip(STAGES, STAGES[1:], strict=False):
        row, centre = np.nonzero(alive)
        if not len(row):
            break
        sums[row, centre] += np.square(rows[row, begin:end] - centres[centre, begin:end]).sum(axis=1)
        alive[row, centre] = sums[row, centre] <= bound[row]
    sums[n, guess] = bound
    alive[n, guess] = True
    sums[~alive] = np.iinfo(np.int64).max
    best = sums.argmin(axis=1)
    return best, sums[n, best] // DIMS


def _stored(rows: np.ndarray) -> pa.Array:
    """Coefficients as one binary value a row; they fit 32 bits while components stay within LARGEST."""
    data = np.ascontiguousarray(rows, np.int32)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * (4 * DIMS)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _loaded(column: pa.Array) -> Iterator[np.ndarray]:
    for start in range(0, len(column), TOGETHER):
        part = column.slice(start, TOGETHER)
        yield np.frombuffer(b"".join(part.to_pylist()), np.int32).reshape(len(part), DIMS).astype(np.int64)


def _transformed(scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMS)
            whole = np.floor(values * scale)
            if np.abs(whole).max(initial=0) > LARGEST:
                raise ValueError(f"components over {LARGEST / scale:g} leave no exact distances in 64 bits")
            yield pa.record_batch([batch.column("id"), _stored(transform(whole))], names=["id", "coefficients"])

    return run


def _summed(centres: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = np.zeros(centres.shape, np.int64), np.zeros(len(centres), np.int64)
        for batch in batches:
            for rows in _loaded(batch.column("coefficients")):
                cluster, _ = nearest(rows, centres)
                count += np.bincount(cluster, minlength=len(centres))
                for c in np.unique(cluster):
                    sums[c] += rows[cluster == c].sum(axis=0)
        held = np.flatnonzero(count)
        totals = pa.array(list(sums[held]), pa.list_(pa.int64()))
        yield pa.record_batch([pa.array(held, pa.int32()), pa.array(count[held]), totals], names=["cluster", "n", "sums"])

    return run


def _assigned(centres: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest(rows, centres) for rows in _loaded(batch.column("coefficients"))]
            cluster, distance = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0), np.zeros(0))
            yield pa.record_batch([batch.column("id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    return run


def _usable(vector: Column) -> Column:
    """Exactly DIMS components, none null or non-finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (F.size(vector) == DIMS) & ~bad


def cluster_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: str = "3",
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid)`` of every usable vector.

    Usable vectors have exactly ``DIMS`` components, none null or non-finite; each
    becomes floor(scale * x). Centroids start as the vectors whose ids, as
    ``seed:id``, have the smallest sha256 (equal hashes: by coefficients); a round assigns every
    vector to the nearest centroid (ties: the smaller number) and replaces each
    centroid that has vectors by their floored mean. A round that changes nothing ends the
    rounds, as later ones would be the same.

    Ids may be of any type. Repeated rows each count. Rows without id are
    clustered and start a centroid only where ids run out. Fewer vectors than ``clusters`` give that many
    centroids, no vector no rows. Components over ``LARGEST / scale`` in size are refused. Other columns are ignored.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.select(F.col(vec_id).alias("id")).dtypes)["id"]
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(_usable(F.col("v")))
    kept = materialize(rows.mapInArrow(_transformed(scale), f"id {kind}, coefficients binary"))
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(code.asc_nulls_last(), "coefficients").select("coefficients").limit(clusters).collect()
    centres = np.array([np.frombuffer(r[0], np.int32) for r in first], np.int64).reshape(-1, DIMS)
    centroids = [restore(c.tolist()) for c in centres]
    for _ in range(rounds if len(centres) else 0):
        sums = kept.select("coefficients").mapInArrow(_summed(centres), "cluster int, n long, sums array<long>")
        parts = sums.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
        gathered = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
        held: dict[int, list[int]] = {}
        counts = {}
        for row in gathered.collect():  # DIMS rows a cluster
            held.setdefault(row["cluster"], [0] * DIMS)[row["place"]] = int(row["total"])
            counts[row["cluster"]] = row["n"]
        before = centroids
        centroids = [[x // counts[c] for x in restore(held[c])] if c in held else old for c, old in enumerate(before)]
        centres = transform(np.array(centroids, np.int64))
        if centroids == before:
            break
    if not len(centres):
        return spark.createDataFrame([], f"`{vec_id}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    placed = materialize(kept.mapInArrow(_assigned(centres), f"id {kind}, cluster int, distance long"))
    spread = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    known = [(c, s, sum(spread.values()), centroids[c]) for c, s in spread.items()]
    table = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return placed.join(F.broadcast(table), "cluster").select(
        F.col("id").alias(vec_id), "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
