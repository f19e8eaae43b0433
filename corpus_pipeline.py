"""Corpus pipeline: quality classifier, line dedup, near-dedup, benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on every row that the stage before it kept. All but the last return the columns of
``docs``; a stage that changes texts sets ``n_chars`` anew. Rows without a doc_id pass all stages: no row with an id can stand for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bpe, decontaminate, line_dedup, near, quality
from corpusmill.llm.common import stored, table
from corpusmill.llm.queries import vocabulary

#: Documents less likely than this to be of quality 1 go.
LEAST_QUALITY = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules find more likely bad than good go."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs.select(F.struct(*docs.columns).alias("row"), "text"), model, keep=("row",))
    return scored.where(F.col("score") >= LEAST_QUALITY).select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 20 characters in at least 3 documents stay in one of them. All columns but text travel as one, so they may have any names."""
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), "doc_id", "text")
    out = line_dedup.dedup_lines(rows, keep=("row",), least_chars=20, least_documents=3)
    columns = [F.length("text").cast("long").alias(c) if c == "n_chars" else F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return out.select(*columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by similarities of at least 0.8 over five-word shingles, the document with the least id stays. Links are
    found by operator 7's ball hashing of fingerprints and, where these lie too far apart, by the keys of ``near``; all are verified exactly.

    A document is an id with its words: where an id repeats with other words, each is judged for itself. Rows equal in both are one, the
    least of them by text and then the other columns."""
    whole = docs.where("doc_id IS NOT NULL").select("doc_id", near.node(F.col("text")).alias("__node"), F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")]).alias("__row"))
    found = near.near_classes(docs.where("doc_id IS NOT NULL"), width=5, similarity=0.8).withColumnRenamed("node", "__node")
    ids = whole.groupBy("__node").agg(F.min("doc_id").alias("doc_id"))
    rooted = ids.join(found, "__node", "left").select(F.coalesce("root", "__node").alias("root"), "doc_id", "__node")
    first = rooted.groupBy("root").agg(F.min(F.struct("doc_id", "__node")).alias("first")).select("first.*")
    kept = whole.join(first, ["doc_id", "__node"], "left_semi").groupBy("doc_id", "__node").agg(F.min("__row").alias("__row"))
    return kept.select("doc_id", "__row.*").select(docs.columns).unionByName(docs.where("doc_id IS NULL"))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    judged = decontaminate.find_leaks(rows, table(spark, sf_dir, "benchmark"), keep=("row",), shingle=5, similarity=0.8)
    return judged.where(F.size("leaks") == 0).select("row.*")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source with the ids (little-endian unsigned 32-bit numbers), their number, and digests of the ids and of the decoded text."""
    out = bpe.encode(docs, vocabulary(), keep=("doc_id", "lang", "source"))
    return out.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level BPE", token_stage),
]

#: No SQL: fitting rules and replaying merges have none; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
