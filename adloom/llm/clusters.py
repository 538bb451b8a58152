"""Lloyd's centroid clustering over exact integers, with bounds loosened by geometry.

Every vector keeps an upper bound of the distance to its own centroid and a lower bound
of the distance to all others. When centroids move, the upper bound grows by the own
centroid's drift. The lower bound shrinks by less than the others' drift: vectors of a
cluster lie in a sphere, and a centroid that moves from ``a`` to ``b`` comes nearer to a
vector by at most ``|ab| * cos(t)``, ``t`` being the vector's angle to the move as seen
from the middle of ``a`` and ``b``. In the plane of the move and the sphere's centre the
sphere spans the angles ``t0 - arcsin(r / D)`` to ``t0 + arcsin(r / D)``, so the cosine of
the smaller one bounds them all. Vectors whose bounds don't part are measured against
their own centroid, and if that doesn't settle it against all, in exact integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.vectors import Relay, floor_means, integer_vectors, unpacked

#: Widens every bound by more than the rounding errors it may hold.
SLACK = 1e-12
#: The same for angles, whose functions lose half of the digits where they are steep.
ANGLE_SLACK = 1e-7

_STATE = "vec_id bigint, x binary, cluster int, before int, upper double, lower double"
_FINAL = "vec_id bigint, cluster int, distance bigint"


@dataclass(frozen=True)
class Move:
    """What a round needs to know of the step from the old to the present centroids."""

    drift: np.ndarray  # of each centroid
    loosen: np.ndarray  # of the lower bounds of each cluster
    half: np.ndarray  # half the distance to the nearest other centroid


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Exact squared distance of every row to every centre."""
    most = max(np.abs(x).max(initial=0), np.abs(centers).max(initial=0))
    if 4 * x.shape[1] * int(most) ** 2 < 2**53:  # whole numbers a double holds
        a, b = x.astype(float), centers.astype(float)
        found = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
        return found.astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centers], axis=1)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Per cluster, by how much a moved centroid of another one may have come nearer to a vector in its sphere."""
    step = (new - old).astype(float)
    drift = np.sqrt((step**2).sum(1))
    away = old[:, None, :] - (old + new)[None, :, :] / 2.0  # cluster, moved centroid
    far = np.sqrt((away**2).sum(2))
    with np.errstate(divide="ignore", invalid="ignore"):
        angle = np.arccos(np.clip((away * step[None]).sum(2) / (far * drift[None]), -1, 1))
        width = np.arcsin(np.clip(radius[:, None] / far, 0, 1))
        nearer = drift[None] * np.clip(np.cos(np.maximum(angle - width, 0)) + ANGLE_SLACK, 0, 1)
    nearer = np.where(far > radius[:, None], nearer, drift[None])
    nearer = np.where(drift[None] > 0, nearer, 0.0)
    np.fill_diagonal(nearer, 0.0)
    return nearer.max(axis=1, initial=0.0)


def _move(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> Move:
    gaps = np.sqrt(squared_distances(new, new).astype(float))
    np.fill_diagonal(gaps, np.inf)
    drift = np.sqrt(((new - old).astype(float) ** 2).sum(1))
    return Move(drift, loosening(old, new, radius), gaps.min(axis=1) / 2 * (1 - SLACK))


def _scan(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centre, the smaller number if tied, with the bounds it gives."""
    found = squared_distances(x, centers)
    best = found.argmin(axis=1)
    every = np.arange(len(x))
    upper = np.sqrt(found[every, best].astype(float)) * (1 + SLACK)
    rest = found.astype(float)
    rest[every, best] = np.inf
    return best, upper, np.sqrt(rest.min(axis=1)) * (1 - SLACK)


def reassign(
    x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centers: np.ndarray, move: Move
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Cluster and bounds after a move, and how many vectors had to be measured against all centres."""
    upper = (upper + move.drift[cluster]) * (1 + SLACK)
    shrunk = move.loosen[cluster]
    lower = lower - shrunk - SLACK * (np.where(np.isinf(lower), 0, np.abs(lower)) + shrunk)
    apart = np.maximum(lower, move.half[cluster])
    unsure = np.flatnonzero(upper >= apart)
    exact = ((x[unsure] - centers[cluster[unsure]]) ** 2).sum(1)
    upper[unsure] = np.sqrt(exact.astype(float)) * (1 + SLACK)
    unsure = unsure[upper[unsure] >= apart[unsure]]
    cluster = cluster.copy()
    if len(unsure):
        cluster[unsure], upper[unsure], lower[unsure] = _scan(x[unsure], centers)
    return cluster, upper, lower, len(unsure)


def _assign(centers: np.ndarray, move: Move | None, last: bool):
    """One pass over the state: every vector to its nearest centroid."""
    dims = centers.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column("x"), dims)
            if move is None:
                before = np.full(len(x), -1)
                cluster, upper, lower = _scan(x, centers) if len(x) else (before, np.zeros(0), np.zeros(0))
            else:
                before = batch.column("cluster").to_numpy().astype(np.int64)
                bounds = [batch.column(c).to_numpy().copy() for c in ("upper", "lower")]
                cluster, upper, lower, _ = reassign(x, before, *bounds, centers, move)
            if last:
                exact = ((x - centers[cluster]) ** 2).sum(1)
                columns = {"vec_id": batch.column("vec_id"), "cluster": pa.array(cluster, pa.int32()), "distance": exact}
            else:
                columns = {
                    "vec_id": batch.column("vec_id"),
                    "x": batch.column("x"),
                    "cluster": pa.array(cluster, pa.int32()),
                    "before": pa.array(before, pa.int32()),
                    "upper": upper,
                    "lower": lower,
                }
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _tally(k: int, dims: int):
    """Per task, what each cluster gained less what it lost, and the radius of its sphere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, radius = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), np.zeros(k)
        for batch in batches:
            now, before = (batch.column(c).to_numpy() for c in ("cluster", "before"))
            np.maximum.at(radius, now, batch.column("upper").to_numpy())
            changed = now != before
            x = unpacked(batch.column("x").filter(pa.array(changed)), dims)
            for cluster, sign in ((now[changed], 1), (before[changed], -1)):
                held = cluster >= 0
                np.add.at(n, cluster[held], sign)
                np.add.at(sums, cluster[held], sign * x[held])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k), pa.int32()), pa.array(n), pa.array(list(sums), pa.list_(pa.int64())), pa.array(radius)],
            ["cluster", "n", "sums", "radius"],
        )

    return run


def _tallied(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Changes of counts and sums, and radii: ``k`` rows whatever the data."""
    parts = state.select("x", "cluster", "before", "upper").mapInArrow(
        _tally(k, dims), "cluster int, n bigint, sums array<bigint>, radius double"
    )
    sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims)]
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), *sums).collect()
    n, total, radius = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), np.zeros(k)
    for r in rows:
        n[r["cluster"]], radius[r["cluster"]] = r["n"], r["radius"]
        total[r["cluster"]] = [r[f"s{i}"] for i in range(dims)]
    return n, total, radius


def first_centroids(vectors: DataFrame, k: int, seed: str) -> list[bytes]:
    """Vectors of the ``k`` smallest SHA-256 of ``seed`` and id; ids that are null come last, ties by stored bytes."""
    ranked = vectors.select(F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256).alias("h"), "x")
    return [bytes(r["x"]) for r in ranked.orderBy(F.asc_nulls_last("h"), "x").limit(k).collect()]


def cluster_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    seed: str = "2:",
) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` per vector kept.

    Components become ``floor(scale * x)``; distances are squared, ties go to the smaller
    number, and each of ``rounds`` rounds replaces a centroid that has vectors by the
    floor of their mean. Kept are rows of :func:`integer_vectors`: no null vector, no
    null or non-finite component, exactly ``dims`` of them. Rows that repeat an id count
    each; with fewer than ``k`` vectors there are as many centroids; without any, or in an
    empty table, no rows. A null id is kept as null. Other columns are ignored. Sums
    beyond 64 bits are null.
    """
    spark = df.sparkSession
    relay = Relay(spark, "cluster-state")
    state = relay.next(integer_vectors(df, vec_col, scale, dims, vec_id=id_col).withColumn("vec_id", F.col("vec_id").cast("long")))
    start = first_centroids(state, k, seed)
    if not start:
        schema = f"{_FINAL}, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return spark.createDataFrame([], schema)
    k = len(start)
    centers = np.frombuffer(b"".join(start), "<i4").astype(np.int64).reshape(k, dims)
    counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
    move = None
    for _ in range(rounds):
        state = relay.next(state.mapInArrow(_assign(centers, move, False), _STATE))
        gained, shift, radius = _tallied(state, k, dims)
        counts, sums = counts + gained, sums + shift
        moved = floor_means(sums, counts, centers)
        move, centers = _move(centers, moved, radius), moved
    placed = relay.next(state.mapInArrow(_assign(centers, move, True), _FINAL))

    inertia = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.try_sum("distance").alias("s")).collect()}
    parts = list(inertia.values())
    whole = sum(parts) if None not in parts and sum(parts) < 2**63 else None
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers.tolist()]
    rows = [(c, s, whole, digests[c]) for c, s in inertia.items()]
    clusters = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(clusters), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )  # k rows
