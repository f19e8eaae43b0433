"""An inverted file over vectors: cells around learned centres, vectors written by cell, and searches that read only the cells they need.

Centres are learned by spherical k-means from at most ``sample`` vectors, chosen by a hash of their ids; every vector is indexed. Each cell
keeps the widest angle between its centre and one of its vectors. The table of cells is small (``cells`` rows) and is all that a search needs
to know which folders to read.

``probe`` looks into the cells nearest to each query. How many of them give which recall is measured when the index is built: ``tuned`` vectors
are searched exactly, and the curve says in how many cells, counted from the nearest to the query, their true neighbours lie. Vectors in groups
need a few cells, vectors without any structure need most. ``nearest`` is exact: no vector of a cell can be
nearer to a query than the angle to the centre less the cell's width, so it reads the cells nearest to each query first, then those that can
hold something as good as the n-th best so far.

Vectors without a direction (null, zero, or with components that are no numbers) and those of another length than the index has take no part,
neither do queries of that kind.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.session import stored
from corpusmill.sources.commits import Versions

SLACK = 1e-6  # in angles and scores: rounding must not hide a cell


def with_direction(vectors: DataFrame, dimensions: int, key: str, embedding: str) -> DataFrame:
    """id and v (doubles) of the vectors that take part."""
    rows = vectors.select(F.col(key).alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x))
    return rows.where((F.size("v") == dimensions) & whole & F.col("id").isNotNull()).where((square > 0) & (square < float("inf")))


def best_of(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the n best scores, ties by id."""
    if len(scores) > 4 * n:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        near = np.flatnonzero(scores >= least)
        return near[np.lexsort((ids[near], -scores[near]))[:n]]
    return np.lexsort((ids, -scores))[:n]


class VectorIndex:
    """Opened where it lies. ``build`` writes one; a search reads the last that was written to its end."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.versions = spark, Versions(spark, path)
        found = self.versions.numbers()
        if not found:
            raise ValueError(f"no index in {path}")
        self.path = self.versions.folder(found[-1])
        cells = sorted(self.spark.read.parquet(f"{self.path}/cells").collect(), key=lambda r: r["cell"])  # a row for each cell
        self.cells = np.array([r["cell"] for r in cells], np.int64)
        self.centres = np.array([r["centre"] for r in cells], np.float64).reshape(len(cells), len(cells[0]["centre"]) if cells else 0)
        self.widths = np.array([r["width"] for r in cells], np.float64)
        self.dimensions = self.centres.shape[1]
        curve = self.spark.read.parquet(f"{self.path}/curve").collect() if "curve" in self.versions.inside(found[-1]) else []  # a row for each cell at most
        self.curve = {r["probes"]: r["recall"] for r in curve}

    @classmethod
    def build(cls, vectors: DataFrame, path: str, *, dimensions: int, cells: int | None = None, sample: int = 1 << 16, rounds: int = 10, rows_per_file: int = 1_000_000, tuned: int = 128, neighbours: int = 10, key: str = "vec_id", embedding: str = "embedding", seed: int = 1) -> "VectorIndex":
        """``cells``: by default the root of the number of vectors, 4,096 at most."""
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        spark, versions = vectors.sparkSession, Versions(vectors.sparkSession, path)
        rows = with_direction(vectors, dimensions, key, embedding)
        n = rows.count()
        wanted = cells or max(1, min(4096, math.isqrt(n)))
        drawn = rows.where(F.pmod(F.xxhash64("id"), F.lit(-(-n // sample) or 1)) == 0).withColumn("features", array_to_vector("v"))
        out = versions.aside()
        if n and wanted > 1:
            model = KMeans(k=wanted, distanceMeasure="cosine", maxIter=rounds, seed=seed, predictionCol="cell").fit(drawn)
            centres = [np.asarray(c, np.float64) / np.linalg.norm(c) for c in model.clusterCenters()]
        else:
            centres = [np.eye(1, dimensions)[0]] if n else []
        shared = spark.sparkContext.broadcast(np.array(centres).reshape(-1, dimensions))
        kind = rows.schema["id"].dataType.simpleString()

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                values = np.array(batch["v"].tolist(), np.float64).reshape(-1, dimensions)
                cosines = (values / np.linalg.norm(values, axis=1)[:, None]) @ shared.value.T
                own = cosines.argmax(1)
                yield batch.assign(cell=own.astype(np.int32), angle=np.arccos(np.clip(cosines[np.arange(len(own)), own], -1, 1)))

        placed = stored(rows.mapInPandas(place, f"id {kind}, v array<double>, cell int, angle double"))
        sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("width")).collect()  # a row for each cell
        table = [(r["cell"], [float(x) for x in centres[r["cell"]]], r["width"] + SLACK, r["n"]) for r in sizes]
        spark.createDataFrame(table, "cell int, centre array<double>, width double, n bigint").coalesce(1).write.parquet(f"{out}/cells")
        files = spark.createDataFrame([(r["cell"], -(-r["n"] // rows_per_file)) for r in sizes], "cell int, files int")
        dealt = placed.join(F.broadcast(files), "cell").withColumn("file", F.pmod(F.xxhash64("id"), "files"))  # a large cell is written by several tasks
        dealt.select("id", "v", "cell", "file").repartition("cell", "file").drop("file").write.partitionBy("cell").parquet(f"{out}/vectors")
        number = versions.append(out)
        if n:
            index = cls(spark, path)
            index._measure(tuned, neighbours, versions.folder(number))
        return cls(spark, path)

    def _measure(self, tuned: int, n: int, folder: str) -> None:
        """Writes which share of true neighbours the nearest 1, 2, ... cells of a query hold."""
        rows = self.spark.read.parquet(f"{folder}/vectors")
        drawn = rows.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(tuned).select(F.col("id").alias("query_id"), F.col("v").alias("embedding"))
        asked = {r["query_id"]: r["embedding"] for r in drawn.collect()}  # `tuned` rows
        found = self.nearest(drawn, n + 1, key="id").where("query_id <> id")
        cell = {int(c): i for i, c in enumerate(self.cells)}
        order = {q: np.argsort(np.argsort(self._angles(np.array([v]) / np.linalg.norm(v))[0], kind="stable")) for q, v in asked.items()}
        near = found.select("query_id", "id")
        places = [int(order[r["query_id"]][cell[r["cell"]]]) for r in rows.join(F.broadcast(near), "id").select("query_id", "cell").collect()]  # `tuned` times n rows
        curve = np.cumsum(np.bincount(places, minlength=len(self.cells))) / max(1, len(places))
        self.spark.createDataFrame([(i + 1, float(x)) for i, x in enumerate(curve)], "probes int, recall double").coalesce(1).write.parquet(f"{folder}/curve")

    def probes_for(self, recall: float) -> int:
        """The least number of cells that gave this recall when the index was built; all of them where nothing was measured."""
        return min((p for p, r in self.curve.items() if r >= recall), default=max(1, len(self.cells)))

    def vectors(self, cells: list[int]) -> DataFrame:
        """Rows of these cells; folders of others aren't read."""
        return self.spark.read.parquet(f"{self.path}/vectors").where(F.col("cell").isin(cells))

    def _angles(self, matrix: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(matrix @ self.centres.T, -1, 1))

    def probe(self, queries: DataFrame, n: int = 10, *, probes: int | None = None, recall: float = 0.97, query: str = "query_id", key: str = "vec_id", embedding: str = "embedding", most_queries: int = 4096) -> DataFrame:
        """query, rank, key and score of the n most similar vectors in the ``probes`` cells nearest to each query, by default as
        many as gave that recall when the index was built."""
        return self._search(queries, n, probes or self.probes_for(recall), False, query, key, embedding, most_queries)

    def nearest(self, queries: DataFrame, n: int = 10, *, first: int = 4, query: str = "query_id", key: str = "vec_id", embedding: str = "embedding", most_queries: int = 4096) -> DataFrame:
        """query, rank, key and score of the n most similar vectors of all; ``first`` cells are read before the others are judged."""
        return self._search(queries, n, first, True, query, key, embedding, most_queries)

    def _search(self, queries: DataFrame, n: int, first: int, exact: bool, query: str, key: str, embedding: str, most_queries: int) -> DataFrame:
        asked = with_direction(queries, self.dimensions, query, embedding)
        kinds = asked.schema["id"].dataType.simpleString(), self.spark.read.parquet(f"{self.path}/vectors").schema["id"].dataType.simpleString() if len(self.cells) else "bigint"
        parts, block = [], []
        for row in asked.toLocalIterator():  # a block of queries at a time; each is searched and written before the next
            block.append((row["id"], row["v"]))
            if len(block) == most_queries:
                parts.append(stored(self._block(block, n, first, exact, *kinds)))
                block = []
        if block or not parts:
            parts.append(self._block(block, n, first, exact, *kinds))
        found = reduce(DataFrame.unionByName, parts)
        return found.select(F.col("q").alias(query), "rank", F.col("id").alias(key), "score")

    def _block(self, block: list[tuple[Any, list[float]]], n: int, first: int, exact: bool, query_kind: str, kind: str) -> DataFrame:
        schema = f"q {query_kind}, id {kind}, score double"
        if not block or not len(self.cells):
            return self.spark.createDataFrame([], f"{schema}, rank int")
        names = [q for q, _ in block]
        matrix = np.array([v for _, v in block], np.float64)
        matrix /= np.linalg.norm(matrix, axis=1)[:, None]
        angles = self._angles(matrix)
        near = np.zeros(angles.shape, bool)
        np.put_along_axis(near, np.argsort(angles, axis=1, kind="stable")[:, :first], True, axis=1)
        found = self._scan(names, matrix, near, n, schema)
        if exact and not near.all():
            found = stored(found)
            rank = Window.partitionBy("q").orderBy(F.desc("score"), "id")
            worst = found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") == n).select("q", "score")
            bound = {r["q"]: r["score"] for r in worst.collect()}  # a number for each query of the block
            reachable = np.cos(np.clip(angles - self.widths, 0, np.pi))  # no vector of the cell is more similar
            least = np.array([bound.get(q, -np.inf) for q in names])
            more = ~near & (reachable >= least[:, None] - SLACK)
            if more.any():
                found = found.unionByName(self._scan(names, matrix, more, n, schema))
        rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= n)

    def _scan(self, names: list, matrix: np.ndarray, wanted: np.ndarray, n: int, schema: str) -> DataFrame:
        """The n best of each query among the vectors of its wanted cells, for each task."""
        chosen = np.flatnonzero(wanted.any(0))
        by_cell = {int(self.cells[c]): np.flatnonzero(wanted[:, c]) for c in chosen}
        shared = self.spark.sparkContext.broadcast((names, matrix, by_cell))

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names, matrix, by_cell = shared.value
            best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for batch in batches:
                for cell, own in batch.groupby("cell", sort=False):
                    values = np.array(own["v"].tolist(), np.float64)
                    ids, at = own["id"].to_numpy(), by_cell[int(cell)]
                    scores = (values / np.linalg.norm(values, axis=1)[:, None]) @ matrix[at].T
                    for k, q in enumerate(at.tolist()):
                        both = best.get(q)
                        all_ids, all_scores = (ids, scores[:, k]) if both is None else (np.concatenate([both[0], ids]), np.concatenate([both[1], scores[:, k]]))
                        top = best_of(all_ids, all_scores, n)
                        best[q] = all_ids[top], all_scores[top]
            for q, (ids, scores) in best.items():
                yield pd.DataFrame({"q": [names[q]] * len(ids), "id": ids, "score": scores})

        return self.vectors([int(self.cells[c]) for c in chosen]).select("id", "v", "cell").mapInPandas(search, schema)

    def files_read(self, queries: DataFrame, probes: int, query: str = "query_id", embedding: str = "embedding") -> int:
        """How many of the index's files a probe of these queries reads; for reports over few queries, which are collected."""
        matrix = np.array([r["v"] for r in with_direction(queries, self.dimensions, query, embedding).collect()], np.float64).reshape(-1, self.dimensions)
        near = np.argsort(self._angles(matrix / np.linalg.norm(matrix, axis=1)[:, None]), axis=1, kind="stable")[:, :probes]
        return self.vectors([int(self.cells[c]) for c in np.unique(near)]).agg(F.countDistinct("_metadata.file_path")).first()[0]


def recall(found: DataFrame, exact: DataFrame, query: str = "query_id", key: str = "vec_id") -> float:
    """The share of the exact answers that were found."""
    both = exact.select(query, key).join(found.select(query, key).withColumn("found", F.lit(1)), [query, key], "left")
    row = both.agg(F.count("found").alias("found"), F.count("*").alias("n")).first()
    return row["found"] / row["n"] if row["n"] else 1.0
