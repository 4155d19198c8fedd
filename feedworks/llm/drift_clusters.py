"""Centroid clustering with bounds that loosen by less than the centroids' drift.

Every vector keeps an upper bound of the distance to its own centroid and a lower bound of the
distance to all others. While the first is smaller, the vector stays where it is unseen;
otherwise its exact whole-number distances are worked out. When centroid c moves to c', a lower
bound for c need not fall by the whole drift: all vectors of a cluster lie in a sphere around
their own centroid, and by symmetry the worst of them lies in the plane of the sphere's
centre, c and c'. There the fall is largest at the least angle with the drift that the sphere
reaches (seen from the midpoint of c and c'), and at its farthest point if that angle is acute,
its nearest one if it is not. It is never more than the drift, and negative for spheres that
c moves away from: their bounds get tighter.

Vectors are kept in blocks, in buckets; a round joins them with the bounds of the round before
(17 bytes a vector), so that neither side is shuffled. Sums change only by vectors that
change their cluster. The driver holds the centroids and one sum per component.

* Vectors that are null, of another width, or hold null or non-finite components take no part.
* Vectors with a null id take part (hashed as ``null``); rows that repeat an id are vectors of their own.
* Equal distances go to the smaller cluster; equal hashes of ids start with the smaller vector.
* Fewer vectors than ``k`` make fewer clusters; no vectors, an empty result.
* A component of 2**27 or more in size, as a whole number, raises an error: its distances would
  not fit into a long.
* The result has its own columns only, so none of the input's can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedworks.llm.buckets import bucketed
from feedworks.llm.common import written

#: Vectors of a block.
BLOCK = 4096
LIMIT = 1 << 27


def whole_vectors(df: DataFrame, vec_id: str, vector: str, width: int, scale: int) -> DataFrame:
    """Rows (vec_id, v) of the vectors that take part, each component floor(scale * x)."""
    x = F.col(vector).cast("array<double>")
    usable = F.size(x) == width
    usable &= F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    in_range = F.forall(x, lambda c: F.abs(F.floor(c.cast("double") * scale).cast("double")) < LIMIT)
    # A product beyond a long's range saturates in floor, so the limit sees it.
    floors = F.transform(x, lambda c: F.floor(c * scale).cast("int"))
    return df.where(F.col(vector).isNotNull() & usable).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.when(in_range, floors).otherwise(F.raise_error(F.lit("a component of a vector is too large"))).alias("v"),
    )


def exact_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of whole-number vectors and centroids, exact."""
    largest = max(int(abs(x).max(initial=0)), int(abs(c).max(initial=0)))
    if 4 * x.shape[1] * largest * largest < 1 << 53:
        x, c = x.astype(float), c.astype(float)  # every sum is a whole number that a double holds
        out = (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * (x @ c.T)
        return out.astype(np.int64)
    x = x.astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c.astype(np.int64)], axis=1)


def sphere_loss(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """The most that the distance to ``old``, moved to ``new``, falls for any point of a sphere."""
    move = new - old
    drift = float(np.linalg.norm(move))
    if drift == 0.0:
        return 0.0
    from_middle = centre - (old + new) / 2
    away = float(np.linalg.norm(from_middle))
    if away <= radius * (1 + 1e-9) + 1e-9:
        return drift  # the sphere reaches the midpoint, and with it every angle
    cos_centre = float(np.clip(from_middle @ move / (away * drift), -1, 1))
    sin_centre = np.sqrt(1 - cos_centre**2) + 1e-7  # rounding may only loosen
    sin_sphere = min(1.0, radius / away * (1 + 1e-9))
    cos_sphere = np.sqrt(1 - sin_sphere**2)
    if cos_centre >= cos_sphere:
        cos_least = 1.0
    else:
        cos_least = min(1.0, cos_centre * cos_sphere + sin_centre * sin_sphere + 1e-7)
    # The fall grows with the distance from the midpoint if it is one, and shrinks if it is a rise.
    s = away + radius if cos_least > 0 else away - radius
    to_old = np.sqrt(max(0.0, s * s + drift * drift / 4 + s * drift * cos_least))
    to_new = np.sqrt(max(0.0, s * s + drift * drift / 4 - s * drift * cos_least))
    return float(min(drift, 2 * s * drift * cos_least / (to_old + to_new)))


def losses(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each cluster the drift of its centroid, and the most that its vectors' lower bounds fall."""
    k = len(old)
    drift = np.linalg.norm(new - old, axis=1)
    loss = np.zeros(k)
    for a in range(k):
        others = [sphere_loss(old[a], radius[a], old[j], new[j]) for j in range(k) if j != a]
        loss[a] = max(others, default=0.0)
    return drift, loss


def assign(x, c, cluster, upper, lower) -> np.ndarray:
    """Scan the vectors whose bounds do not settle their cluster, in place; returns which were scanned."""

    def open_rows(rows):
        # Squares of whole numbers are exact, so a relative margin covers what roots and sums lose.
        margin = 1e-9 * (1 + upper[rows] + abs(np.where(np.isinf(lower[rows]), 0, lower[rows])))
        return rows[~(upper[rows] + margin < lower[rows])]

    rows = open_rows(np.arange(len(x)))
    if len(rows):
        for j in np.unique(cluster[rows]):
            mine = rows[cluster[rows] == j]
            upper[mine] = np.sqrt(exact_distances(x[mine], c[j : j + 1])[:, 0].astype(float))
        rows = open_rows(rows)
    if len(rows):
        far = exact_distances(x[rows], c)
        nearest = far.argmin(axis=1)
        at = np.arange(len(rows))
        cluster[rows], upper[rows] = nearest, np.sqrt(far[at, nearest].astype(float))
        far = far.astype(float)
        far[at, nearest] = np.inf
        lower[rows] = np.sqrt(far.min(axis=1))
    return rows


def cluster_vectors(
    df: DataFrame, k: int, rounds: int, vec_id: str = "vec_id", vector: str = "embedding", width: int = 64, scale: int = 1024
) -> DataFrame:
    """Each vector's cluster after ``rounds`` rounds, from the ``k`` vectors with the smallest id hashes.

    Returns (vec_id, cluster, distance, cluster_inertia, inertia, centroid): the squared distance, its
    sums over the cluster and over all, and the centroid's whole-number components. Rounds
    after one that moves no centroid would change nothing and are not run.
    """
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    spark = df.sparkSession
    vectors = whole_vectors(df, vec_id, vector, width, scale)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                ids = part.column("vec_id")
                x = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                columns = [pa.array([number]), pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())]
                yield pa.record_batch(columns, ["block", "ids", "data"])
                number += 1

    blocks = bucketed(vectors.mapInArrow(pack, "block long, ids array<long>, data binary"), "cluster-vectors", "block")
    hashed = F.sha2(F.concat(F.lit("3:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = vectors.orderBy(hashed, "v").limit(k).select("v").collect()
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([r["v"] for r in first], np.int64)
    k = len(centroids)

    def step(c: np.ndarray, drift: np.ndarray | None, loss: np.ndarray | None):
        """Assignment by centroids ``c``, from the bounds before they moved."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    x = np.frombuffer(row["data"], np.int32).reshape(-1, width)
                    if drift is None:
                        before = None
                        cluster = np.zeros(len(x), np.int32)
                        upper, lower = np.full(len(x), np.inf), np.zeros(len(x))
                    else:
                        before = np.frombuffer(row["cluster"], np.int32)
                        cluster = before.copy()
                        upper = np.frombuffer(row["upper"]) + drift[before]
                        lower = np.frombuffer(row["lower"]) - loss[before]
                    scanned = assign(x, c, cluster, upper, lower)
                    gained = np.zeros((k, width + 1), np.int64)
                    moved = np.arange(len(x)) if before is None else np.flatnonzero(cluster != before)
                    one = np.concatenate((x[moved].astype(np.int64), np.ones((len(moved), 1), np.int64)), axis=1)
                    np.add.at(gained, cluster[moved], one)
                    if before is not None:
                        np.subtract.at(gained, before[moved], one)
                    radius = np.zeros(k)
                    np.maximum.at(radius, cluster, upper)
                    yield pa.record_batch(
                        [
                            pa.array([row["block"]]),
                            *(pa.array([a.tobytes()], pa.binary()) for a in (cluster, upper, lower)),
                            pa.array([gained.ravel().tolist()], pa.list_(pa.int64())),
                            pa.array([radius.tolist()], pa.list_(pa.float64())),
                            pa.array([len(scanned)]),
                        ],
                        ["block", "cluster", "upper", "lower", "gained", "radius", "scanned"],
                    )

        return run

    state_schema = (
        "block long, cluster binary, upper binary, lower binary, gained array<long>, radius array<double>, scanned long"
    )
    sums = [[0] * (width + 1) for _ in range(k)]
    state, drift, loss = None, None, None
    for done in range(rounds + 1):
        known = blocks if state is None else blocks.join(state.select("block", "cluster", "upper", "lower"), "block")
        run = step(centroids, drift, loss)
        state = bucketed(known.drop("ids").mapInArrow(run, state_schema), "cluster-bounds", "block")
        if done == rounds:
            break
        # A row for each component of each centroid, however many vectors there are.
        for r in state.select(F.posexplode("gained")).groupBy("pos").agg(F.sum("col").alias("gained")).collect():
            sums[r["pos"] // (width + 1)][r["pos"] % (width + 1)] += r["gained"]
        radius = state.agg(*(F.max(F.get("radius", F.lit(j))).alias(f"r{j}") for j in range(k))).first()
        moved = np.array(
            [[s // row[-1] for s in row[:-1]] if row[-1] else old for row, old in zip(sums, centroids.tolist())], np.int64
        )
        if (moved == centroids).all():
            break
        drift, loss = losses(centroids.astype(float), moved.astype(float), np.array(radius, float))
        centroids = moved

    final = centroids

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["data"], np.int32).reshape(-1, width)
                cluster = np.frombuffer(row["cluster"], np.int32)
                distance = np.zeros(len(x), np.int64)
                for j in np.unique(cluster):
                    mine = cluster == j
                    distance[mine] = exact_distances(x[mine], final[j : j + 1])[:, 0]
                ids = pa.array(row["ids"], pa.int64())
                yield pa.record_batch([ids, pa.array(cluster), pa.array(distance)], ["vec_id", "cluster", "distance"])

    assigned = written(
        blocks.join(state.select("block", "cluster"), "block").mapInArrow(tell, "vec_id long, cluster int, distance long"),
        "cluster-members",
    )
    of_cluster = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    rows = [(j, of_cluster[j], sum(of_cluster.values()), final[j].tolist()) for j in of_cluster]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    # One row per cluster.
    return assigned.join(F.broadcast(about), "cluster").select(*(part.split()[0] for part in schema.split(", ")))


def digest(centroid: list[int]) -> str:
    """What ``centroid_sha256`` of the registered query holds, in plain code."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
