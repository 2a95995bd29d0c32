"""Centroid clustering of integer vectors, filtered in PCA-rotated coordinates.

One pass gathers the second moments of all vectors; their eigenvectors give a
rotation. The next pass stores each vector as integers beside its leading rotated
coordinates and the norm of the rest. The projected distance to a centroid plus the
squared difference of the two rest norms can never be above the true squared
distance, so most centroids drop out on a few floats. What survives is settled in
integers, so the rotation and its rounding decide the work and never the result.

Rounds read the stored table. Only sums per cluster leave a task, and only the
centroids, a number that does not grow with the data, pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import new_path
from .rows import column_of, saved

#: Leading rotated coordinates that are stored.
LEADING = 16
#: Integers beyond this have squared distances that may not fit 64 bits.
LARGEST = 1 << 27
#: Part of the norms by which float32 storage and rotation may move a bound; twenty times what they can.
SLACK = 1e-6

_ASSIGNED = "vec_id long, cluster int, distance long"
RESULT = f"{_ASSIGNED}, cluster_inertia long, inertia long, centroid_sha256 string"


@dataclass(frozen=True)
class Rotation:
    """``(x - mean) @ axes``: axes in falling order of variance, the first ``leading`` are kept apart."""

    mean: np.ndarray
    axes: np.ndarray
    leading: int

    def split(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and the norm of the others."""
        turned = (points - self.mean) @ self.axes
        return turned[:, : self.leading], np.linalg.norm(turned[:, self.leading :], axis=1)


@dataclass(frozen=True)
class Centroids:
    """Integer centroids with their rotated form."""

    values: np.ndarray
    lead: np.ndarray
    rest: np.ndarray

    @staticmethod
    def of(values: np.ndarray, rotation: Rotation) -> Centroids:
        return Centroids(values, *rotation.split(values.astype(np.float64)))

    def nearest(self, points: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid of each integer point (ties: smaller number), its exact squared distance, distances taken."""
        n, k = len(points), len(self.values)
        lead, rest = lead.astype(np.float64), rest.astype(np.float64)
        low = ((lead[:, None, :] - self.lead) ** 2).sum(2) + (rest[:, None] - self.rest) ** 2
        guess = low.argmin(1)
        exact = np.full((n, k), np.iinfo(np.int64).max)
        rows = np.arange(n)
        exact[rows, guess] = best = ((points - self.values[guess]) ** 2).sum(1)
        norms = np.sqrt((lead**2).sum(1) + rest**2)[:, None] + np.sqrt((self.lead**2).sum(1) + self.rest**2)
        alive = low <= (np.sqrt(best.astype(np.float64))[:, None] + SLACK * (norms + 1)) ** 2
        alive[rows, guess] = False
        at, other = np.nonzero(alive)
        exact[at, other] = ((points[at] - self.values[other]) ** 2).sum(1)
        cluster = exact.argmin(1)
        return cluster, exact[rows, cluster], n + len(at)


def _whole(vectors: DataFrame, components: int) -> DataFrame:
    """Vectors of the right length, as doubles."""
    kept = vectors.filter(F.size("embedding") == components)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))


def _integers(batch: pa.RecordBatch, components: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have finite components only, and those rows' ``floor(scale * x)`` as doubles."""
    values = column_of(batch, "v").flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
    kept = np.isfinite(values).all(1)
    return kept, np.floor(scale * values[kept])


def rotation_of(vectors: DataFrame, components: int, scale: int, leading: int) -> tuple[Rotation, int]:
    """The principal axes of all usable vectors and the number of these.

    ValueError where a component is beyond ``LARGEST`` once scaled. A task adds up
    its moments and gives them as rows, so the driver gets one number per moment.
    """
    upper = np.triu_indices(components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, largest = 0, 0.0
        sums, squares = np.zeros(components), np.zeros((components, components))
        for batch in batches:
            _, points = _integers(batch, components, scale)
            if len(points):
                rows, largest = rows + len(points), max(largest, float(np.abs(points).max()))
                sums += points.sum(0)
                squares += points.T @ points
        values = np.concatenate([[rows, largest], sums, squares[upper]])
        yield pa.RecordBatch.from_pydict({"pos": pa.array(np.arange(len(values), dtype=np.int32)), "value": pa.array(values)})

    found = _whole(vectors, components).select("v").mapInArrow(run, "pos int, value double")
    moments = {r.pos: r for r in found.groupBy("pos").agg(F.sum("value").alias("sum"), F.max("value").alias("max")).collect()}
    rows = int(moments[0]["sum"]) if moments else 0
    if not rows:
        return Rotation(np.zeros(components), np.eye(components), leading), 0
    if moments[1]["max"] > LARGEST:
        raise ValueError(f"a component is {moments[1]['max']:.3g} once scaled; exact distances need at most {LARGEST}")
    sums = np.array([moments[2 + i]["sum"] for i in range(components)])
    squares = np.zeros((components, components))
    squares[upper] = [moments[2 + components + i]["sum"] for i in range(len(upper[0]))]
    mean = sums / rows
    spread = np.triu(squares) + np.triu(squares, 1).T - rows * np.outer(mean, mean)
    return Rotation(mean, np.linalg.eigh(spread)[1][:, ::-1], leading), rows


def rotated_points(vectors: DataFrame, rotation: Rotation, components: int, scale: int) -> DataFrame:
    """``vec_id, point, lead, rest`` of every usable vector, saved in the shared folder.

    ``point`` holds 4-byte integers in a form whose bytes sort as they do (``_ordered``),
    ``lead`` 4-byte floats.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, points = _integers(batch, components, scale)
            lead, rest = rotation.split(points)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": column_of(batch, "vec_id").filter(pa.array(kept)),
                    "point": _packed(_ordered(points)),
                    "lead": _packed(lead.astype("<f4")),
                    "rest": pa.array(rest.astype(np.float32)),
                }
            )

    schema = "vec_id long, point binary, lead binary, rest float"
    path = new_path(vectors.sparkSession, "rotated")
    _whole(vectors, components).mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return vectors.sparkSession.read.schema(schema).parquet(path)


def _packed(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * (rows.itemsize * rows.shape[1])
    data = np.ascontiguousarray(rows)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _ordered(points: np.ndarray) -> np.ndarray:
    """Integers as big-endian offsets from the least one."""
    return (points.astype(np.int64) + (1 << 31)).astype(">u4")


def _integers_of(column: pa.Array, components: int) -> np.ndarray:
    return _unpacked(column, ">u4", components).astype(np.int64) - (1 << 31)


def _unpacked(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _assigned(batch: pa.RecordBatch, centroids: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    points = _integers_of(column_of(batch, "point"), centroids.values.shape[1])
    lead = _unpacked(column_of(batch, "lead"), "<f4", centroids.lead.shape[1])
    cluster, distance, _ = centroids.nearest(points, lead, column_of(batch, "rest").to_numpy())
    return points, cluster, distance


def moved(points: DataFrame, centroids: Centroids) -> np.ndarray:
    """The centroids after one round: exact floors of the means of their vectors; empty ones stay.

    A task gives one row per cluster and component, with the cluster's count as one more.
    """
    k, components = centroids.values.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, components + 1), np.int64)
        for batch in batches:
            rows, cluster, _ = _assigned(batch, centroids)
            sums[:, -1] += np.bincount(cluster, minlength=k)
            for c in range(k):
                sums[c, :-1] += rows[cluster == c].sum(0)
        used, pos = np.nonzero(np.broadcast_to(sums[:, -1:] > 0, sums.shape))
        yield pa.RecordBatch.from_pydict(
            {"cluster": pa.array(used, pa.int32()), "pos": pa.array(pos, pa.int32()), "value": pa.array(sums[used, pos])}
        )

    sums = points.drop("vec_id").mapInArrow(run, "cluster int, pos int, value long")
    total = F.sum(F.col("value").cast("decimal(38,0)")).alias("total")
    found = {(r.cluster, r.pos): int(r.total) for r in sums.groupBy("cluster", "pos").agg(total).collect()}
    values = centroids.values.copy()
    for c in {c for c, _ in found}:
        values[c] = [found[c, i] // found[c, components] for i in range(components)]
    return values


def _seed_hash(seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)


def cluster(
    vectors: DataFrame,
    clusters: int = 16,
    rounds: int = 3,
    components: int = 64,
    scale: int = 64,
    seed: int = 1,
    leading: int = LEADING,
) -> DataFrame:
    """Clusters the vectors of ``vec_id, embedding``; one row per usable vector.

    ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``: cluster
    from 0, squared distance to its centroid, that distance summed over the cluster
    and over all (null beyond 64 bits), digest of the final centroid.

    A vector takes part with exactly ``components`` components, none null or not
    finite, as integers ``floor(scale * x)``; ValueError where one is beyond
    ``LARGEST``. Centroids start as the vectors of the smallest hashes of
    ``seed:vec_id``, of equal hashes the smaller integers; vectors without an id take
    part but start only where too few have one. With fewer vectors than clusters there
    are as many clusters as vectors, so equal vectors may be two equal centroids, of
    which the smaller number gets all. Repeated rows count as often; no usable vector
    gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    rotation, rows = rotation_of(vectors, components, scale, min(leading, components))
    if not rows:
        return spark.createDataFrame([], RESULT)
    points = rotated_points(vectors, rotation, components, scale)
    first = points.orderBy(_seed_hash(seed).asc_nulls_last(), "point").select("point").limit(clusters).collect()
    values = _integers_of(pa.array([r.point for r in first], pa.binary()), components)
    for _ in range(rounds):
        values = moved(points, Centroids.of(values, rotation))
    final = Centroids.of(values, rotation)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, cluster, distance = _assigned(batch, final)
            columns = {"vec_id": column_of(batch, "vec_id"), "cluster": pa.array(cluster, pa.int32())}
            yield pa.RecordBatch.from_pydict(columns | {"distance": pa.array(distance)})

    assigned = saved(points.mapInArrow(run, _ASSIGNED), "assigned")
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    inertia = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(total).collect()}

    def fitting(value: int) -> int | None:
        return value if value < 1 << 63 else None

    per_cluster = [
        (c, fitting(inertia[c]), fitting(sum(inertia.values())), hashlib.sha256(",".join(map(str, values[c])).encode()).hexdigest())
        for c in sorted(inertia)
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # One row per cluster: small whatever the number of vectors.
    return assigned.join(F.broadcast(spark.createDataFrame(per_cluster, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
