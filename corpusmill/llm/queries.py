"""The thin queries over the operators, with their production parameters, each over its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, chat, clusters, decontaminate, fingerprints, license_scan, line_dedup, quality, simhash, substring_dedup, topk, url_filter
from .common import table

BLOCK, ALLOW = ("net/", "example.com/de/"), ("example.net/en/", "org/fr/")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), ALLOW, BLOCK, keep=("page_id",))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each line that a licence family is found and confirmed in."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), least_chars=20, least_documents=3)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def vocabulary() -> bpe.Vocabulary:
    import public_tokenizers

    return bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(table(spark, sf_dir, "documents"), vocabulary(), keep=("doc_id",))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and each benchmark item that it leaks."""
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shingle=5, similarity=0.8)
    return found.select("doc_id", F.inline("leaks")).withColumnRenamed("start", "first_word")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"), width=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


CONFLICTING = "</s>[INST] ok [/INST]"


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", CONFLICTING), (-7, 1, "assistant", CONFLICTING)], rows.schema)
    formatted = chat.format_conversations(rows.unionByName(added))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Read each conversation back from its formatted text and loss mask."""
        last, out, turns, loss, counts, reader = None, [], None, None, None, None

        def take(read: Iterator[tuple[str, str]]) -> None:
            for role, text in read:
                turns.update(f"{role}\n{text}\n".encode())
                counts[0] += 1

        def close() -> None:
            if counts is not None:
                take(reader.close())
                out.append((last, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))

        for batch in batches:
            for conv, position, said, begins, a, b in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5, 6)), strict=True):
                if position == 0:
                    close()
                    last, turns, loss, counts, reader = conv, hashlib.sha256(), hashlib.sha256(), [0, 0, 0], chat.Reader()
                take(reader.feed(said))
                if a is not None:
                    masked = chat.unescape(said[a - begins : b - begins])
                    loss.update(masked.encode())
                    counts[1] += len(masked)
                counts[2] += len(said)
        close()
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInArrow(digest, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clusters.cluster_vectors(table(spark, sf_dir, "embeddings"), k=16, rounds=3, scale=64, dimensions=64, seed=1)
    text = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(text, 256).alias("centroid_sha256"))


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"), keep=("doc_id",))


def tokenizers() -> alignment.Tokenizers:
    import public_tokenizers as files

    return alignment.Tokenizers(files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN, files.path("piece_bpe_32k.model"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizers(), keep=("doc_id",))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_license_scan,
        op3_quality_classifier,
        op4_line_dedup,
        op5_byte_bpe,
        op6_benchmark_decontamination,
        op7_simhash_near_dedup,
        op8_substring_dedup,
        op9_chat_formatting,
        op10_exact_top_k,
        op11_centroid_clustering,
        op12_document_fingerprints,
        op13_tokenizer_alignment,
    )
}
