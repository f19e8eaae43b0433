"""Exact top-k inner products by block-at-a-time pruning.

Candidates lie in blocks of consecutive rows, each with its forward index (its vectors, component by component) and, for every
component, the largest and the smallest value. Summed over a query's components, the larger of weight times either is a bound that no
score of the block exceeds. Each query takes the blocks in falling order of their bounds and stops at the first bound below its
k-th score; blocks on a bound equal to it are scored, as a tie may go to a smaller id.

Scores are integers. Components are ``floor(scale * x)``; sums below 2**53 are made in float64, where they are exact, others in whole
Python numbers (a score outside of 64 bits is set to the nearest 64-bit number). Queries go in runs of at most ``most_queries`` rows,
collected, broadcast, searched and written one at a time, so no more than one run is held anywhere; every candidate row is read for each.

Rows: vectors that are null, empty or hold null or non-finite components, and rows with a null id, take no part. A row isn't a candidate
for a query of the same id. Rows that repeat an id are candidates of their own; a repeated query id counts once, by its largest vector.
Vectors of another length than the query's are no candidates for it. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, stored

RESULT = "query_id bigint, vec_id bigint, score bigint"
LONG = 2**63


def _exact(a: np.ndarray, b: np.ndarray) -> bool:
    return a.size == 0 or b.size == 0 or float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53


def _whole(a: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in a], dtype=object).reshape(a.shape)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact scores of the rows of a against the rows of b."""
    if _exact(a, b):
        return (a @ b.T).astype(np.int64)
    whole = _whole(a).dot(_whole(b).T)
    return np.clip(whole, -LONG, LONG - 1).astype(np.int64)


class Best:
    """The k best candidates of a query so far: highest score, then smallest id."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def kth(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.k else -np.inf

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(self.scores) == self.k:
            near = scores >= self.scores[-1]
            ids, scores = ids[near], scores[near]
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, ~scores))[: self.k]
        self.ids, self.scores = ids[order], scores[order]


def search_blocks(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, best: list[Best], rows: int) -> int:
    """Add these candidates to the best of each query; how many blocks were scored."""
    starts = range(0, len(ids), rows)
    top = np.array([vectors[s : s + rows].max(0) for s in starts])
    low = np.array([vectors[s : s + rows].min(0) for s in starts])
    bounds = np.maximum(queries, 0) @ top.T + np.minimum(queries, 0) @ low.T
    if not _exact(queries, vectors):
        bounds = bounds * (1 + 1e-9 * np.sign(bounds)) + 1  # rounded sums must not fall below the true ones
    scored = 0
    order = np.argsort(-bounds, axis=1, kind="stable")
    for q, found in enumerate(best):
        for b in order[q]:
            if bounds[q, b] < found.kth:
                break
            at = slice(b * rows, (b + 1) * rows)
            scores = _products(queries[q : q + 1], vectors[at])[0]
            other = ids[at] != query_ids[q]
            found.add(ids[at][other], scores[other])
            scored += 1
    return scored


def top_k(df: DataFrame, is_query: Column, *, k: int = 10, scale: int = 1024, vec_id: str = "vec_id", embedding: str = "embedding", block_rows: int = 64, most_queries: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best rows."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall("v", finite))
    asked = rows.where("q").groupBy("vec_id").agg(F.max("v").alias("v"))
    session = df.sparkSession
    n = asked.count()
    if n > most_queries:  # runs of queries by rank in the order of ids, without a window over all of them
        asked = checkpointed(asked)
        cuts = asked.approxQuantile("vec_id", [i / -(-n // most_queries * 2) for i in range(1, -(-n // most_queries * 2))], 0.01 / -(-n // most_queries))
        edges = [None, *sorted({int(c) for c in cuts}), None]
        runs = [asked.where((F.lit(True) if a is None else F.col("vec_id") > a) & (F.lit(True) if b is None else F.col("vec_id") <= b)) for a, b in zip(edges, edges[1:], strict=False)]
    else:
        runs = [asked]
    parts = []
    for run in runs:
        part, queries = _searched(rows, run.collect(), k, scale, block_rows, session)
        if len(runs) > 1:  # each run is searched and written before the next is collected
            part = stored(part)
            queries.destroy()
        parts.append(part)
    found = session.read.schema(RESULT).parquet(*[f for p in parts for f in p.inputFiles()]) if len(runs) > 1 and any(p.inputFiles() for p in parts) else parts[0]
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def gathered(batches: Iterator[pa.RecordBatch], most_bytes: int = 64_000_000) -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold ``most_bytes``, so that blocks are ordered among as many as fit; best scores stay from one to the next."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most_bytes:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _searched(rows: DataFrame, asked: list, k: int, scale: int, block_rows: int, session) -> tuple[DataFrame, Broadcast]:
    by_size: dict[int, list] = {}
    for r in asked:
        by_size.setdefault(len(r["v"]), []).append(r)
    queries = session.sparkContext.broadcast({d: (np.array([r["vec_id"] for r in rs], np.int64), np.floor(np.array([r["v"] for r in rs], np.float64) * scale)) for d, rs in by_size.items()})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {d: [Best(k) for _ in query_ids] for d, (query_ids, _) in queries.value.items()}
        for batch in gathered(batches):
            ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            sizes = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
            for d, (query_ids, matrix) in queries.value.items():
                at = np.flatnonzero(sizes == d)
                if not len(at):
                    continue
                flat = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                search_blocks(ids[at], np.floor(flat * scale), query_ids, matrix, kept[d], block_rows)
        for d, bests in kept.items():
            for query_id, best in zip(queries.value[d][0], bests, strict=True):
                if len(best.ids):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best.ids), query_id)), pa.array(best.ids), pa.array(best.scores)], ["query_id", "vec_id", "score"])

    return rows.select("vec_id", "v").mapInArrow(search, RESULT), queries
