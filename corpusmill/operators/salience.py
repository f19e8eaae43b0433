"""Corpus statistics over chunks as sparse long tables: term counts, document frequency, TF-IDF weights, distinctiveness and density."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import content_terms
from corpusmill.operators import terms
from corpusmill.session import stored


def term_counts(chunks: DataFrame, key: str = "chunk_id", body: str = "body") -> DataFrame:
    """key, term, n. Counted within each task before the shuffle, so a term goes there once for each key of the task."""
    terms = chunks.select(key, F.explode_outer(content_terms(F.col(body))).alias("term")).where("term IS NOT NULL")
    return terms.groupBy(key, "term").agg(F.count("*").alias("n"))


def document_frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def inverse_frequency(counts: DataFrame, chunks: DataFrame) -> DataFrame:
    """term, df, idf over all chunks, those without terms included."""
    size = chunks.agg(F.greatest(F.count("*"), F.lit(1)).alias("size"))
    idf = F.log((1 + F.col("size")) / (1 + F.col("df"))) + 1
    return document_frequency(counts).join(F.broadcast(size)).select("term", "df", idf.alias("idf"))  # size is one row


def tfidf(counts: DataFrame, idf: DataFrame, key: str = "chunk_id") -> DataFrame:
    """key, term, w: weights of unit length for each key."""
    raw = counts.join(idf.select("term", "idf"), "term").select(key, "term", (F.col("n") * F.col("idf")).alias("raw"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("raw") / length).alias("w"))


def centroid(weights: DataFrame, chunks: DataFrame) -> DataFrame:
    """term, c: mean weight over all chunks, those without terms included, scaled to unit length."""
    size = chunks.agg(F.greatest(F.count("*"), F.lit(1)).alias("size"))
    mean = weights.groupBy("term").agg(F.sum("w").alias("s")).join(F.broadcast(size)).select("term", (F.col("s") / F.col("size")).alias("m"))
    length = mean.agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("length"))
    return mean.join(F.broadcast(length)).select("term", F.when(F.col("length") > 0, F.col("m") / F.col("length")).otherwise(0.0).alias("c"))


def lexical_distinctiveness(chunks: DataFrame, weights: DataFrame, middle: DataFrame, key: str = "chunk_id") -> DataFrame:
    """key and lexical_distinctiveness: cosine distance from the centroid, from 0 for the least to 1 for the most distant chunk."""
    near = weights.join(middle, "term").groupBy(key).agg(F.sum(F.col("w") * F.col("c")).alias("cosine"))
    far = chunks.select(key).join(near, key, "left").select(key, (1 - F.coalesce("cosine", F.lit(0.0))).alias("distance"))
    return _shares(far, key)


def _shares(far: DataFrame, key: str) -> DataFrame:
    span = far.agg(F.min("distance").alias("low"), F.max("distance").alias("high"))
    spread = F.col("high") - F.col("low")
    share = F.when(spread > 1e-9, F.bround((F.col("distance") - F.col("low")) / spread, 3)).otherwise(0.0)
    return far.join(F.broadcast(span)).select(key, share.alias("lexical_distinctiveness"))


def information_density(chunks: DataFrame, key: str = "chunk_id", body: str = "body", tokens: str = "tokens") -> DataFrame:
    """key and information_density: distinct content terms for each estimated token, 1 at most."""
    distinct = F.size(F.array_distinct(content_terms(F.col(body))))
    share = F.when(F.col(tokens) > 0, F.bround(F.least(F.lit(1.0), distinct / F.col(tokens)), 3)).otherwise(0.0)
    return chunks.select(key, share.alias("information_density"))


def project(terms: DataFrame, idf: DataFrame, key: str = "query_id") -> DataFrame:
    """key, term, w for any terms (key, term): those of the vocabulary, weighted and scaled to unit length."""
    return tfidf(terms.groupBy(key, "term").agg(F.count("*").alias("n")), idf, key)


class Corpus:
    """The same statistics over lists of terms, for whole corpora: the texts are read once, and terms of a chunk stay in its row.

    ``chunks``: chunk_id, body and the columns to keep. Tables that several steps read are written when they are first asked for."""

    def __init__(self, chunks: DataFrame, most: int = terms.MOST, keep: tuple[str, ...] = ("document_slug",)):
        self.most, self.lists = most, terms.listed(chunks, keep=keep)

    @cached_property
    def size(self) -> int:
        return self.lists.count()

    @cached_property
    def counted(self) -> DataFrame:
        return stored(terms.frequency(self.lists))

    @property
    def idf(self) -> DataFrame:
        return terms.inverse(self.counted, self.size)

    @cached_property
    def _known(self) -> DataFrame:
        return terms.with_frequency(self.lists, self.counted, self.most)

    def kept(self) -> Corpus:
        """Writes the lists with the chunks of each term, for weights that are read more than once."""
        self._known = stored(self._known)
        return self

    @property
    def weighed(self) -> DataFrame:
        return terms.weighed(self._known, self.size)

    @property
    def weights(self) -> DataFrame:
        return terms.weights(self.weighed)

    def weights_of(self, which: str) -> DataFrame:
        """The weights of the chunks for which ``which`` holds, in columns that are kept; no other chunk's terms are looked up."""
        return terms.weights_of(self.lists.where(which), self.counted, self.size, self.most)

    @property
    def factors(self) -> DataFrame:
        """chunk_id, terms, xs, factors and length: the weights by what they are made of, a row for each chunk."""
        return terms.factors(self.lists, self.counted, self.size, self.most)

    @property
    def slug_counts(self) -> DataFrame:
        """document_slug, term and n, a row for each chunk and term."""
        return terms.rows_of(self.lists, ["document_slug"], "ns", "n")

    @property
    def slug_weights(self) -> DataFrame:
        """document_slug, term and w, a row for each chunk and term."""
        return terms.rows_of(self.weighed, ["document_slug"], "ws", "w")

    def centroid(self) -> DataFrame:
        """term, df and c, as ``centroid`` has it."""
        mean = stored(self.weights.groupBy("term").agg((F.sum("w") / max(self.size, 1)).alias("m"), F.count("*").alias("df")))
        length = mean.agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("length"))
        return mean.join(F.broadcast(length)).select("term", "df", F.when(F.col("length") > 0, F.col("m") / F.col("length")).otherwise(0.0).alias("c"))

    def distinctiveness(self) -> DataFrame:
        """chunk_id and lexical_distinctiveness, as ``lexical_distinctiveness`` has it."""
        self.kept()
        middle = stored(self.centroid().select("term", "df", F.col("c").alias("x")))
        near = terms.cosines(self.weighed, middle, self.most)
        once = self.lists.where("first").count() == self.size
        far = near if once else self.lists.select("chunk_id").join(near, "chunk_id", "left")
        far = stored(far.select("chunk_id", (1 - F.coalesce("cosine", F.lit(0.0))).alias("distance")))
        return _shares(far, "chunk_id")
