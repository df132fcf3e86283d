"""Exact k-means over integer vectors by sort-means.

Every round sorts, for each centroid, the others by their distance from it (k * k numbers, in the driver). A vector
starts at the centroid it had and looks at the others in that order, until one is strictly further from its centroid
than twice its own distance: by the triangle inequality neither that one nor any later one can be nearer or as near.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_folder

#: Components stay within this, so that squared distances fit in 64 bits at up to 64 components.
LIMIT = 1 << 27


def integer_vectors(vectors: DataFrame, dims: int = 64, scale: int = 1024, column: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors of exactly `dims` components, none null or not finite, each component x as
    floor(scale * x) with x as a double. Others are left out. A component beyond LIMIT is an error: distances would no
    longer be exact."""
    x = F.col(f"`{column}`").cast("array<double>")
    whole = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x")).filter(F.size("x") == dims)
    whole = whole.filter(~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    far = F.raise_error(F.lit(f"a component beyond {LIMIT} / {scale}: squared distances would not fit in a long")).cast("bigint")
    return whole.select("vec_id", F.transform("x", lambda c: F.when(F.abs(c * scale) > LIMIT, far).otherwise(F.floor(c * scale))).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of `seed:vec_id`; of equal ids the smaller vector first. A null vec_id
    counts as an empty text. k rows come to the driver."""
    sha = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r[0] for r in vectors.select("v", sha.alias("h")).orderBy("h", "v").limit(k).select("v").collect()], np.int64)


def nearest(v: np.ndarray, before: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Each vector's nearest centroid (of equally near ones the smallest number), its squared distance, and how many
    distances that took; `before` is where the scan of each vector starts."""
    apart = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    found, best, tried = before.copy(), np.zeros(len(v), np.int64), 0
    for c in np.unique(before).tolist():
        rows = np.flatnonzero(before == c)
        own = ((v[rows] - centroids[c]) ** 2).sum(axis=1)
        near, at = own.copy(), np.full(len(rows), c)
        left = np.arange(len(rows))
        tried += len(rows)
        for j in np.argsort(apart[c], kind="stable").tolist():
            if j == c:
                continue
            left = left[apart[c, j] <= 4 * own[left]]
            if not len(left):
                break
            d = ((v[rows[left]] - centroids[j]) ** 2).sum(axis=1)
            tried += len(left)
            better = (d < near[left]) | ((d == near[left]) & (j < at[left]))
            near[left[better]], at[left[better]] = d[better], j
        found[rows], best[rows] = at, near
    return found, best, tried


class Rounds:
    """Tables of the rounds, in the shared folder: each is written from the one before, which goes when it is done."""

    def __init__(self, like: DataFrame) -> None:
        self.spark, self.top, self.path = like.sparkSession, f"{shared_folder(like.sparkSession)}/rounds-{uuid.uuid4().hex}", None

    def hold(self, df: DataFrame, name: object) -> DataFrame:
        old, self.path = self.path, f"{self.top}/{name}"
        df.write.parquet(self.path)
        if old:
            jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(old)
            jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
        return self.spark.read.schema(df.schema).parquet(self.path)


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """rows (vec_id, v, cluster, distance) with cluster and distance anew; cluster says where each scan starts."""
    flat = centroids.copy()  # k * dims numbers go along with the task

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                v = part["v"].flatten().to_numpy(zero_copy_only=False).reshape(len(part), flat.shape[1])
                found, best, _ = nearest(v.astype(np.int64), part["cluster"].to_numpy(zero_copy_only=False).astype(np.int64), flat)
                yield pa.RecordBatch.from_arrays([part["vec_id"], part["v"], pa.array(found.astype(np.int32)), pa.array(best)], names=["vec_id", "v", "cluster", "distance"])

    return rows.mapInArrow(batches, "vec_id bigint, v array<bigint>, cluster int, distance bigint")


def sort_means(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, v, cluster, distance) of each of integer_vectors()'s rows, and the centroids they were assigned to.

    Each of `rounds` rounds assigns every vector, then moves a centroid to its vectors' componentwise floor(sum /
    count); one without vectors stays. Vectors are assigned once more at the end. A round is one pass without a
    shuffle and one aggregate of k rows, summed where the vectors are read before anything is shuffled, so a cluster
    with most of the rows costs nothing extra. Sums that leave 64 bits are an error. Only centroids reach the driver.

    With fewer than k vectors each is a centroid. Equal vectors that both start as centroids leave the higher number
    empty. Repeated rows count as often as they occur; an empty table gives an empty result."""
    held = Rounds(vectors)
    start = vectors.select("vec_id", "v", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
    rows = held.hold(start, "start")
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows, centroids
    dims = centroids.shape[1]
    for r in range(rounds):
        rows = held.hold(assigned(rows, centroids), r)
        sums = rows.groupBy("cluster").agg(F.count("*").alias("n"), *(F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims))).collect()
        moved = centroids.copy()
        for cluster, n, *total in sums:
            moved[cluster] = [t // n for t in total]
        centroids = moved
    return held.hold(assigned(rows, centroids), "end"), centroids


def centroid_clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dims: int = 64, scale: int = 1024) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia and inertia (distances summed over
    its cluster and over all), centroid_sha256 (of its centroid's components as decimal integers joined by `,`).
    Vectors of another length, or with a null or not finite component, have no row; a null vec_id stays; columns but
    vec_id and embedding are not read."""
    rows, centroids = sort_means(integer_vectors(vectors, dims, scale), k, rounds, seed)
    sums = {r[0]: r[1] for r in rows.groupBy("cluster").agg(F.sum("distance")).collect()}
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    small = [(c, total, shas[c]) for c, total in sorted(sums.items())]  # at most k rows
    named = rows.sparkSession.createDataFrame(small, "cluster int, cluster_inertia bigint, centroid_sha256 string")
    found = rows.join(F.broadcast(named), "cluster")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(sums.values())).cast("bigint").alias("inertia"), "centroid_sha256")
