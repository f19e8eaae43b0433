"""The compilation of a corpus: documents to chunks, records, index and pack."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.config import Config
from corpusmill.operators import annotate, index, salience, segment
from corpusmill.session import stored


def now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def first_chunks(chunks: DataFrame, limit: int | None) -> DataFrame:
    """The first chunks of the corpus, by the folders and names of their paths (by source file where there are no paths) and place; all of
    them for none or 0. Links are those of the whole corpus."""
    first = F.split("path", "/") if "path" in chunks.columns else F.col("source_file")
    return chunks.orderBy(first, "document_slug", "idx").limit(limit) if limit else chunks


def compile_corpus(documents: DataFrame, cfg: Config = Config(), *, created_at: str | None = None, answers: DataFrame | None = None, limit: int | None = None, chunks: DataFrame | None = None) -> DataFrame:
    """A row for each chunk with ``fm``, its record, and body. ``answers`` (chunk_id, answer) are a model's; without them all
    classification is by fallback. No corpus statistics: salience is 0 and nothing is related."""
    chunks = first_chunks(segment.chunk_documents(documents, cfg.chunking), limit) if chunks is None else chunks
    return _records(_classified(chunks, answers, cfg), cfg, created_at or now())


def _classified(chunks: DataFrame, answers: DataFrame | None, cfg: Config) -> DataFrame:
    if answers is None:
        return annotate.classify_fallback(chunks, cfg)
    return annotate.classify_answers(chunks.join(answers.select("chunk_id", "answer"), "chunk_id", "left"), "answer", cfg).drop("answer")


def _records(classified: DataFrame, cfg: Config, created_at: str) -> DataFrame:
    plain = {
        "related_chunks": F.array().cast("array<string>"),
        "index_ref": F.lit(None).cast("struct<entry:string,line:int>"),
        "lexical_distinctiveness": F.lit(0.0),
        "information_density": F.lit(0.0),
    }
    rows = classified.withColumns({k: v for k, v in plain.items() if k not in classified.columns})
    return rows.select(annotate.frontmatter(cfg, created_at).alias("fm"), "body", "heading")


@dataclass(frozen=True)
class Compiled:
    """What a full compilation gives."""

    records: DataFrame
    entries: DataFrame
    corpus: salience.Corpus
    cfg: Config

    @property
    def siblings(self) -> DataFrame:
        """Worked out only where they are asked for, as no record holds them."""
        return index.entry_siblings(index.slug_vectors(self.corpus.slug_weights, self.entries), self.cfg.index.sibling_threshold)

    @property
    def weights(self) -> DataFrame:
        return self.corpus.weights

    @property
    def idf(self) -> DataFrame:
        return self.corpus.idf


def full_corpus(documents: DataFrame, cfg: Config = Config(), *, created_at: str | None = None, answers: DataFrame | None = None, limit: int | None = None, chunks: DataFrame | None = None) -> Compiled:
    """As compile_corpus, with corpus statistics, related chunks and the index. Chunks are read several times, so they are written;
    ``chunks`` are those of the documents where that has been done before."""
    chunks = stored(first_chunks(segment.chunk_documents(documents, cfg.chunking), limit)) if chunks is None else chunks
    corpus = salience.Corpus(chunks)
    distinct = corpus.distinctiveness()
    dense = salience.information_density(chunks)
    classified = stored(_classified(chunks, answers, cfg))
    related = index.related_chunks(classified, cfg.salience)
    related = related.groupBy("chunk_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "related_id"))), lambda r: r["related_id"]).alias("related_chunks"))
    entries = stored(index.index_entries(index.document_roots(corpus.slug_counts, corpus.idf, cfg.index), chunks, cfg.index))
    refs = index.index_refs(chunks, index.index_lines(entries))
    rows = classified
    for part in (distinct, dense, refs):
        rows = rows.join(part, "chunk_id", "left")
    rows = rows.join(related, "chunk_id", "left").withColumn("related_chunks", F.coalesce("related_chunks", F.array().cast("array<string>")))
    return Compiled(_records(rows, cfg, created_at or now()), entries, corpus, cfg)


def corpus_stats(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.countDistinct("document_slug").alias("total_documents"), F.count("*").alias("total_chunks"))


def classify_report(answered: DataFrame) -> DataFrame:
    """How many chunks a model classified, and how many fell back."""
    return answered.agg(F.count_if(~F.col("fallback")).alias("ok"), F.count_if("fallback").alias("fallback"))
