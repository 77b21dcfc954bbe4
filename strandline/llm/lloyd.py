"""Centroid clustering by plain Lloyd rounds over integer vectors.

A vector is kept when it has exactly `size` components, none null, NaN or infinite; each component x becomes the
integer floor(scale * x).  Integers beyond 2^27 in magnitude are held at that bound, so that a squared distance
always fits 64 bits.  The k kept vectors with the smallest sha256 of `<seed>:<vec_id>` are the first centroids.  A
round broadcasts the centroids (k * size integers), assigns every vector to the nearest one (ties: the smaller number) and
adds the vectors of each centroid within a task; these sums, k rows a task at most, merge through a
groupBy.  A centroid becomes the exact floor of its mean, an empty one stays.  The driver holds k centroids, never a vector more.

Repeated rows all count.  Of rows that repeat a vec_id the least vector comes first among the first centroids, each row
being one; rows with a null vec_id are clustered but never start a centroid.  With fewer than k vectors that have an
id there are as many centroids.  An empty table, or one that keeps no vector, gives an empty result; so
does a table in which no kept vector has an id.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Workspace, stored

#: Components are held within this magnitude: 64 squared differences of it fit a signed 64-bit integer.
BOUND = 1 << 27
#: Vectors whose differences are taken at once.
ROWS = 4096


def integer_vectors(vectors: DataFrame, id_column: str, column: str, size: int, scale: int) -> DataFrame:
    """(vec_id, v array<int>) of the kept vectors."""
    x = F.col(column)
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    whole = lambda c: F.floor(F.least(F.greatest(c.cast("double") * scale, F.lit(-float(BOUND))), F.lit(float(BOUND)))).cast("int")
    return vectors.where((F.size(x) == size) & finite).select(F.col(id_column).alias("vec_id"), F.transform(x, whole).alias("v"))


def nearest(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest centroid of each row, the smaller one on ties, and its squared distance."""
    out = np.empty((len(centroids), len(v)), np.int64)
    for lo in range(0, len(v), ROWS):
        part = v[lo : lo + ROWS]
        for c, centroid in enumerate(centroids):
            d = part - centroid
            out[c, lo : lo + ROWS] = np.einsum("ij,ij->i", d, d)
    best = out.argmin(0)
    return best, out[best, np.arange(len(v))]


def matrix(column: pd.Series, size: int) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *column.to_numpy()]).astype(np.int64, copy=False).reshape(-1, size)


@dataclass
class Clusters:
    """centroids: one row each; assigned: stored (vec_id, cluster, distance)."""

    centroids: np.ndarray
    assigned: DataFrame


def assign(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of kept vectors (vec_id, v).  Ids travel as text, since pandas would turn integers beside a null into floats."""
    sent = kept.sparkSession.sparkContext.broadcast(centroids)
    kind = kept.schema["vec_id"].dataType

    def run(frames: Iterator[pd.DataFrame]):
        for frame in frames:
            cluster, distance = nearest(matrix(frame["v"], sent.value.shape[1]), sent.value)
            yield pd.DataFrame({"vec_id": frame["vec_id"], "cluster": cluster.astype(np.int32), "distance": distance})

    named = kept.select(F.col("vec_id").cast("string").alias("vec_id"), "v")
    return named.mapInPandas(run, "vec_id string, cluster int, distance bigint").withColumn("vec_id", F.col("vec_id").cast(kind))


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round over kept vectors (vec_id, v)."""
    sent = kept.sparkSession.sparkContext.broadcast(centroids)
    k, size = centroids.shape
    names = [f"s{j}" for j in range(size)]

    def run(frames: Iterator[pd.DataFrame]):
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for frame in frames:
            v = matrix(frame["v"], size)
            cluster = nearest(v, sent.value)[0]
            order = np.argsort(cluster, kind="stable")
            own, first = np.unique(cluster[order], return_index=True)
            if len(own):
                sums[own] += np.add.reduceat(v[order], first, axis=0)
            counts += np.bincount(cluster, minlength=k)
        own = np.flatnonzero(counts)
        yield pd.DataFrame({"cluster": own.astype(np.int32), "n": counts[own]} | dict(zip(names, sums[own].T)))

    part = kept.select("v").mapInPandas(run, "cluster int, n bigint, " + ", ".join(f"{s} bigint" for s in names))
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).cast("bigint").alias(c)
    rows = part.groupBy("cluster").agg(wide("n"), *map(wide, names)).collect()  # k rows at most
    sent.unpersist()
    out = centroids.copy()
    for row in rows:
        out[row["cluster"]] = [row[s] // row["n"] for s in names]  # Python's // is the floor
    return out


def lloyd(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, size: int = 64, scale: int = 256, id_column: str = "vec_id", column: str = "embedding") -> Clusters | None:
    """Cluster the vectors; None if no kept vector has an id."""
    with Workspace(vectors.sparkSession) as ws:
        kept = ws.stored(integer_vectors(vectors, id_column, column, size, scale), "integer-vectors")
        named = kept.where("vec_id is not null").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
        first = named.orderBy("h", "v").limit(k).collect()
        if not first:
            return None
        centroids = np.array([row["v"] for row in first], np.int64)
        for _ in range(rounds):
            centroids = moved(kept, centroids)
        return Clusters(centroids, stored(assign(kept, centroids), "clusters"))


def cluster_report(vectors: DataFrame, **how) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of its final centroid."""
    spark = vectors.sparkSession
    found = lloyd(vectors, **how)
    if found is None:
        kind = vectors.schema[how.get("id_column", "vec_id")].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    own = {r["cluster"]: int(r["d"]) for r in found.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]
    table = spark.createDataFrame([(c, own.get(c, 0), sum(own.values()), s) for c, s in enumerate(sha)], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.assigned.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows are broadcast
