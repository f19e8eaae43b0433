"""Centroid clustering over distinct quantised vectors.

Vectors become whole numbers, ``floor(scale * x)`` of each component. Equal ones are grouped to one with its multiplicity, and Lloyd's rounds
run over these: each task sums its vectors, weighted by their multiplicities, for each centroid, and only ``k * (dimensions + 2)`` numbers of
a task leave it. All sums are whole numbers, so a centroid is the exact ``floor(sum / count)`` whatever the order of rows. At the end the
assignment of each distinct vector is joined back to the rows. Vectors that at least one row in ``1 / hot`` has (no more than ``hot`` of
them) are joined by a broadcast, so a frequent vector fills no task; the others are shuffled.

The first centroids are the ``k`` rows with the smallest ``sha256("<seed>:<vec_id>")``, equal ones by their vectors, null ids last; fewer rows
give fewer centroids. An empty centroid stays where it is. Ties of distance go to the smaller number.

Rows: a vector that is null, of another length than ``dimensions``, or that holds null or non-finite components takes no part. Rows with a
null id or with an id that others have are rows of their own. Components beyond 64 bits are set to the nearest 64-bit number, distances and
their sums likewise; up to there all is exact. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

MOST = 2**63 - 1
Centroids = list[list[int]]


def quantised(df: DataFrame, scale: int, dimensions: int, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and v of the rows that take part."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where((F.size("x") == dimensions) & finite).select("vec_id", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))


def nearest(vectors: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and squared distance, exact: in float64 where all sums stay below 2**53, else in whole Python numbers."""
    reach = float(np.abs(vectors.astype(np.float64)).max(initial=0)) + max(abs(float(x)) for c in centroids for x in c)
    if 4 * vectors.shape[1] * reach * reach < 2**53:
        a, c = vectors.astype(np.float64), np.array(centroids, np.float64)
        squares = (a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)
        own = squares.argmin(1)
        return own, squares[np.arange(len(a)), own].astype(np.int64)
    own, least = [], []
    for v in vectors.tolist():
        squares = [sum((x - y) ** 2 for x, y in zip(v, c, strict=True)) for c in centroids]
        own.append(min(range(len(squares)), key=squares.__getitem__))
        least.append(min(squares[own[-1]], MOST))
    return np.array(own, np.int64), np.array(least, np.int64)


def _weighted(values: np.ndarray, weights: np.ndarray) -> list[int]:
    """Sums of the rows times their weights."""
    if float(np.abs(values.astype(np.float64)).max(initial=0)) * float(weights.sum()) < 2**62:
        return (weights @ values).tolist()
    return [sum(w * x for w, x in zip(weights.tolist(), column, strict=True)) for column in values.T.tolist()]


def _vectors(batch: pa.RecordBatch, at: int, dimensions: int) -> np.ndarray:
    return batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def totals(distinct: DataFrame, centroids: Centroids) -> dict[int, dict[int, int]]:
    """For each centroid with vectors the sum of each component, under -1 how many vectors there are and under -2 the sum of their distances."""
    dimensions = len(centroids[0])
    shared = distinct.sparkSession.sparkContext.broadcast(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[int]] = {}
        for batch in batches:
            v, n = _vectors(batch, 0, dimensions), batch.column(1).to_numpy()
            own, far = nearest(v, shared.value)
            for c in np.unique(own).tolist():
                at = own == c
                part = [*_weighted(v[at], n[at]), int(n[at].sum()), *_weighted(far[at, None], n[at])]
                sums[c] = [x + y for x, y in zip(sums[c], part, strict=True)] if c in sums else part
        if sums:
            names = [*range(dimensions), -1, -2]
            columns = [[c for c in sums for _ in names], names * len(sums), [str(x) for part in sums.values() for x in part]]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2])], ["c", "part", "x"])

    rows = distinct.select("v", "n").mapInArrow(add, "c int, part int, x string").groupBy("c", "part").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    out: dict[int, dict[int, int]] = {}
    for row in rows.collect():  # k * (dimensions + 2) at most
        out.setdefault(row["c"], {})[row["part"]] = int(row["x"])
    shared.destroy()
    return out


def assigned(distinct: DataFrame, centroids: Centroids) -> DataFrame:
    """v, cluster and distance of each distinct vector."""
    dimensions = len(centroids[0])
    shared = distinct.sparkSession.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, far = nearest(_vectors(batch, 0, dimensions), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.astype(np.int32)), pa.array(far)], ["v", "cluster", "distance"])

    return distinct.select("v").mapInArrow(assign, "v array<bigint>, cluster int, distance bigint")


def cluster_vectors(df: DataFrame, *, k: int = 16, rounds: int = 3, scale: int = 64, dimensions: int = 64, seed: int = 1, vec_id: str = "vec_id", embedding: str = "embedding", hot: int = 1024) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid (its components) of each row that takes part."""
    spark = df.sparkSession
    rows = quantised(df, scale, dimensions, vec_id, embedding)
    distinct = stored(rows.groupBy("v").agg(F.count("*").alias("n")))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    centroids = [list(r["v"]) for r in rows.orderBy(name.asc_nulls_last(), "v").limit(k).select("v").collect()]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    if not centroids:
        return rows.select("vec_id").join(F.broadcast(spark.createDataFrame([], schema + ", distance bigint"))).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid").limit(0)
    for _ in range(rounds):
        for c, sums in totals(distinct, centroids).items():
            centroids[c] = [sums[i] // sums[-1] for i in range(dimensions)]
    last = totals(distinct, centroids)
    whole = min(sum(s[-2] for s in last.values()), MOST)
    facts = spark.createDataFrame([(c, min(s[-2], MOST), whole, centroids[c]) for c, s in last.items()], schema)
    least = max(2, -(-sum(s[-1] for s in last.values()) // hot))
    frequent = F.broadcast(assigned(distinct.where(F.col("n") >= least), centroids))  # hot rows at most, as each stands for one row in hot
    others = rows.join(F.broadcast(distinct.where(F.col("n") >= least).select("v")), "v", "left_anti").join(assigned(distinct.where(F.col("n") < least), centroids), "v")
    placed = rows.join(frequent, "v").select("vec_id", "cluster", "distance").unionByName(others.select("vec_id", "cluster", "distance"))
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")  # k rows


def digest(numbers: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()
