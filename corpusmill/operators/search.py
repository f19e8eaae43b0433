"""Lookup by vectors and by words."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from corpusmill.functions.text import content_terms, content_terms_of
from corpusmill.operators.ann import best_of
from corpusmill.operators.salience import project
from corpusmill.session import stored

DIMENSIONS = 256


@F.pandas_udf(ArrayType(FloatType()))
def text_embedding(texts: pd.Series) -> pd.Series:
    """Vectors of unit length (zero for texts without content terms) that need no model: every term adds to a component of its hash, up or
    down by one of its bits, by one plus the logarithm of its count."""
    out = []
    for text in texts:
        terms, counts = np.unique(content_terms_of(text or "") or [""], return_counts=True)
        vector = np.zeros(DIMENSIONS)
        hashes = np.array([zlib.crc32(t.encode()) for t in terms], np.int64)
        np.add.at(vector, hashes % DIMENSIONS, np.where(hashes >> 31 & 1, 1.0, -1.0) * (1 + np.log(counts)) * (terms != ""))
        length = np.sqrt((vector * vector).sum())
        out.append((vector / length if length else vector).astype(np.float32))
    return pd.Series(out)


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def vector_top_k(vectors: DataFrame, query: list[float], n: int = 5, *, key: str = "vec_id", embedding: str = "embedding", where: Column | None = None) -> DataFrame:
    """key and score of the n most similar rows that ``where`` lets through, ties by key."""
    rows = vectors if where is None else vectors.where(where)
    given = F.array(*[F.lit(float(x)) for x in query])
    return rows.select(key, cosine(F.col(embedding), given).alias("score")).where("score IS NOT NULL AND NOT isnan(score)").orderBy(F.desc("score"), key).limit(n)


def vectors_top_k(vectors: DataFrame, queries: DataFrame, n: int = 5, *, key: str = "vec_id", query: str = "query_id", embedding: str = "embedding", most_queries: int = 1024) -> DataFrame:
    """query, rank (from 1), key and score of the n most similar rows for each of a stated set of queries, ties by key.

    Queries go in blocks of at most ``most_queries``, each sent to every task as one matrix; a task keeps the n best of its rows for each
    query, and only these are shuffled. Vectors without a direction (null, empty, zero, or with components that are no numbers) take no part,
    nor do those of another length than the query's."""
    asked = queries.select(F.col(query).alias("q"), F.col(embedding).cast("array<double>").alias("v")).where("q IS NOT NULL AND size(v) > 0")
    kind = asked.schema["q"].dataType.simpleString()
    id_ = vectors.schema[key].dataType.simpleString()
    rows = vectors.select(F.col(key).alias("id"), F.col(embedding).cast("array<double>").alias("v")).where("size(v) > 0")
    parts, block = [], []
    for row in asked.toLocalIterator():
        block.append((row["q"], row["v"]))
        if len(block) == most_queries:  # searched and written before the next block is collected
            parts.append(stored(_nearest(rows, block, n, f"q {kind}, id {id_}, score double")))
            block = []
    if block or not parts:
        parts.append(_nearest(rows, block, n, f"q {kind}, id {id_}, score double"))
    found = reduce(DataFrame.unionByName, parts)
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= n).select(F.col("q").alias(query), "rank", F.col("id").alias(key), "score")


def _nearest(rows: DataFrame, block: list[tuple[Any, list[float]]], n: int, schema: str) -> DataFrame:
    by_size: dict[int, list[tuple[Any, np.ndarray]]] = {}
    for q, v in block:
        unit = np.array(v, np.float64)
        length = np.sqrt((unit * unit).sum())
        if length > 0 and np.isfinite(length):
            by_size.setdefault(len(v), []).append((q, unit / length))
    shared = rows.sparkSession.sparkContext.broadcast({d: ([q for q, _ in qs], np.array([u for _, u in qs])) for d, qs in by_size.items()})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            sizes = batch["v"].map(len)
            for d, (ids, matrix) in shared.value.items():
                own = batch[sizes == d]
                if not len(own):
                    continue
                values = np.array(own["v"].tolist(), np.float64)
                lengths = np.sqrt((values * values).sum(1))
                usable = np.isfinite(lengths) & (lengths > 0)
                names, scores = own["id"].to_numpy()[usable], (values[usable] / lengths[usable, None]) @ matrix.T
                for k in range(len(ids)):
                    held = best.get((d, k))
                    all_names, all_scores = (names, scores[:, k]) if held is None else (np.concatenate([held[0], names]), np.concatenate([held[1], scores[:, k]]))
                    top = best_of(all_names, all_scores, n)
                    best[d, k] = all_names[top], all_scores[top]
        for (d, k), (names, scores) in best.items():
            yield pd.DataFrame({"q": [shared.value[d][0][k]] * len(names), "id": names, "score": scores})

    return rows.mapInPandas(search, schema)


def lexical_top_k(weights: DataFrame, idf: DataFrame, text: str, n: int = 5, *, key: str = "chunk_id") -> DataFrame:
    """key and score of the n chunks whose TF-IDF vectors are nearest to the text's, ties by key."""
    spark = weights.sparkSession
    asked = spark.createDataFrame([(text,)], "text string").select(F.lit(0).alias("query_id"), F.explode(content_terms(F.col("text"))).alias("term"))
    vector = project(asked, idf).select("term", F.col("w").alias("q"))
    scored = weights.join(F.broadcast(vector), "term")  # no more rows than the text has words
    return scored.groupBy(key).agg(F.sum(F.col("w") * F.col("q")).alias("score")).orderBy(F.desc(F.bround("score", 9)), key).limit(n)
