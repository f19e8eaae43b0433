"""One query for each operator, over the whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.config import Config
from corpusmill.functions import text as T
from corpusmill.operators import annotate, html, index, pack, salience, search, segment
from corpusmill.operators.ann import VectorIndex
from corpusmill.operators.fanout import fan_out
from corpusmill.operators.postings import Postings
from corpusmill.plans import compile as plan
from corpusmill.session import scratch
from corpusmill.sources.collection import Collection

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CFG = Config()
AT = "2026-01-01T00:00:00Z"
LONG = "bigint"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table with fewer splits than there are cores dealt out evenly, as small files have one row group and would keep one core
    busy; larger tables are left as they lie, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: rows of a task where each row costs much more than its bytes
TASK_ROWS = 50_000


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly to tasks of about TASK_ROWS, however few row groups a file has: a row group is read by one task whole."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS)))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as documents: slug, source_file, title and text."""
    rows = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select(F.concat(F.lit("doc-"), "doc_id").alias("slug"), "text")
    return segment.with_title(rows.withColumn("source_file", F.concat("slug", F.lit(".md")))).select("slug", "source_file", "title", "text")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation as a document: a heading, and a section for each turn with its lines as paragraphs."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.format_string("## %s %d\n\n%s", "role", "turn", F.replace("text", F.lit("\n"), F.lit("\n\n"))).alias("part"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "part"))).alias("parts"))
    slug = F.concat(F.lit("conversation-"), "conv_id")
    text = F.concat(F.format_string("# Conversation %d\n\n", "conv_id"), F.array_join(F.col("parts.part"), "\n\n"))
    return segment.with_title(whole.select(slug.alias("slug"), F.concat(slug, F.lit(".md")).alias("source_file"), text.alias("text"))).select("slug", "source_file", "title", "text")


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks of their source."""
    rows = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return rows.select(F.concat(F.lit("doc-"), "doc_id").alias("chunk_id"), F.col("source").alias("document_slug"), F.col("doc_id").alias("idx"), F.col("text").alias("body"), F.lit("").alias("heading"), F.concat(F.lit("Document "), "doc_id").alias("document_title")).withColumn("tokens", T.estimate_tokens(F.col("body")))


# --- text -----------------------------------------------------------------------------------------------------------------------------------


@query
def tokenize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = T.tokenize(F.col("text"))
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.size(words).cast(LONG).alias("n_words"), F.size(F.array_distinct(words)).cast(LONG).alias("n_distinct"))


@query
def content_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = T.content_terms(F.col("text"))
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.size(terms).cast(LONG).alias("n_terms"), F.array_join(F.slice(terms, 1, 5), " ").alias("first_terms"))


@query
def estimate_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", T.estimate_tokens(F.col("text")).cast(LONG).alias("tokens"))


@query
def slugify_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs of what stands before the first full stop, whole."""
    first = F.split_part("text", F.lit("."), F.lit(1))
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", T.slugify(first).alias("slug"))


@query
def title_case_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.concat_ws(" ", "source", "lang").alias("name")).distinct()
    return rows.select("name", T.title_case(F.col("name")).alias("title"))


@query
def first_sentence_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", annotate.fallback_summary(F.col("text"), F.lit(""), F.lit("untitled")).alias("summary"))


@query
def whitespace_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.whitespace_words(F.col("text")).cast(LONG).alias("n_words"))


# --- segmentation ---------------------------------------------------------------------------------------------------------------------------


@query
def extract_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(spark, sf_dir).select("slug", "title").unionByName(documents(spark, sf_dir).select("slug", "title"))


@query
def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = segment.with_sections(conversations(spark, sf_dir))
    return rows.select("slug", F.posexplode_outer("sections").alias("section", "s")).where("section IS NOT NULL").select("slug", F.col("section").cast(LONG).alias("section"), "s.heading", "s.body")


@query
def paragraph_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = segment.with_sections(conversations(spark, sf_dir)).select("slug", F.posexplode_outer("sections").alias("section", "s")).where("section IS NOT NULL")
    rows = rows.select("slug", "section", F.posexplode_outer(segment.paragraphs(F.col("s.body"))).alias("paragraph", "text")).where("paragraph IS NOT NULL")
    return rows.select("slug", F.col("section").cast(LONG).alias("section"), F.col("paragraph").cast(LONG).alias("paragraph"), "text")


@query
def sentence_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.size(F.split(T.strip(F.col("text")), T.SENTENCE_END)).cast(LONG).alias("n_sentences"))


@query
def oversized_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.posexplode_outer(segment.split_oversized(T.strip(F.col("text")), CFG.chunking.max_tokens)).alias("piece", "text")).where("piece IS NOT NULL")
    return rows.select("doc_id", F.col("piece").cast(LONG).alias("piece"), T.estimate_tokens(F.col("text")).cast(LONG).alias("tokens"), F.md5("text").alias("text_md5"))


@query
def greedy_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = segment.with_packed(conversations(spark, sf_dir)).select("slug", F.posexplode_outer("packed").alias("chunk", "c")).where("chunk IS NOT NULL")
    return rows.select("slug", F.col("chunk").cast(LONG).alias("chunk"), "c.heading", "c.body")


def _chunk_rows(rows: DataFrame) -> DataFrame:
    return rows.select("chunk_id", "document_slug", F.col("idx").cast(LONG).alias("idx"), F.col("total").cast(LONG).alias("total"), "heading", F.md5("body").alias("body_md5"), F.col("tokens").cast(LONG).alias("tokens"), "next_id", "previous_id")


@query
def conversation_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunk_rows(segment.chunk_documents(conversations(spark, sf_dir)))


@query
def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunk_rows(segment.chunk_documents(documents(spark, sf_dir)))


@query
def limit_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plan.first_chunks(segment.chunk_documents(conversations(spark, sf_dir)), 100)
    return rows.select("chunk_id", "next_id")


# --- corpus statistics ----------------------------------------------------------------------------------------------------------------------


@query
def information_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return salience.information_density(units(spark, sf_dir))


@query
def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return salience.term_counts(units(spark, sf_dir))


@query
def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return salience.document_frequency(salience.term_counts(units(spark, sf_dir)))


@query
def inverse_document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return salience.Corpus(units(spark, sf_dir)).idf.select("term", "df", F.bround("idf", 6).alias("idf"))


@query
def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return salience.Corpus(units(spark, sf_dir)).weights.select("chunk_id", "term", F.bround("w", 6).alias("w"))


@query
def centroid_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return salience.Corpus(units(spark, sf_dir)).centroid().select("term", F.bround("c", 6).alias("c"))


@query
def lexical_distinctiveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return salience.Corpus(units(spark, sf_dir)).distinctiveness()


@query
def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.corpus_stats(units(spark, sf_dir))


# --- index ----------------------------------------------------------------------------------------------------------------------------------


def _roots(corpus: salience.Corpus) -> DataFrame:
    return index.document_roots(corpus.slug_counts, corpus.idf, CFG.index)


@query
def document_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roots(salience.Corpus(units(spark, sf_dir))).select("document_slug", F.col("rank").cast(LONG).alias("rank"), "term", F.bround("score", 6).alias("score"))


@query
def index_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = units(spark, sf_dir)
    entries = index.index_entries(_roots(salience.Corpus(rows)), rows, CFG.index)
    return entries.select("document_slug", F.array_join("root_terms", " ").alias("root_terms"), F.size("children").cast(LONG).alias("n_children"), F.md5(F.array_join("children", " ")).alias("children_md5"))


@query
def entry_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = salience.Corpus(units(spark, sf_dir))
    entries = index.entry_slugs(_roots(corpus), CFG.index)
    return index.entry_siblings(index.slug_vectors(corpus.slug_weights, entries), CFG.index.sibling_threshold)


@query
def index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.index_lines(units(spark, sf_dir).select("document_slug")).select("document_slug", F.col("line").cast(LONG).alias("line"))


@query
def index_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = units(spark, sf_dir)
    lines = index.index_lines(index.entry_slugs(_roots(salience.Corpus(rows)), CFG.index))
    return index.index_refs(rows, lines).select("chunk_id", F.col("index_ref.entry").alias("entry"), F.col("index_ref.line").cast(LONG).alias("line"))


# --- annotation -----------------------------------------------------------------------------------------------------------------------------


@query
def fallback_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotate.fallback_topics(units(spark, sf_dir)).select("chunk_id", F.posexplode_outer("topics").alias("place", "t")).where("place IS NOT NULL")
    return rows.select("chunk_id", F.col("place").cast(LONG).alias("place"), F.col("t.topic").alias("topic"), F.col("t.depth").cast(LONG).alias("depth"))


@query
def topic_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotate.fallback_topics(units(spark, sf_dir))
    return rows.select("chunk_id", annotate.topic_path(F.col("topics")).alias("topic_path"), annotate.specificity(F.col("topics")).alias("specificity"))


@query
def related_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = index.related_chunks(annotate.fallback_topics(units(spark, sf_dir)), CFG.salience)
    return found.select("chunk_id", F.col("rank").cast(LONG).alias("rank"), "related_id", F.bround("overlap", 6).alias("overlap"))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as a model might give them, made from events: in a fence, in prose, or broken."""
    rows = dealt(table(spark, sf_dir, "events").select("event_id", "event_type", "user_id"))
    e = F.col("event_id")
    depth = F.when(e % 3 == 0, F.concat(F.lit('"'), e % 9, F.lit('"'))).otherwise((e % 9).cast("string"))
    body = F.concat(
        F.lit('{"chunk_type": "'), F.when(e % 2 == 0, " FACT ").otherwise("claim"), F.lit('", "confidence": '), F.when(e % 5 == 0, '"0.25"').otherwise(F.format_string("%.2f", (e % 150) / 100)),
        F.lit(', "standalone": '), F.when(e % 7 == 0, "false").otherwise('"yes"'), F.lit(', "utility": "Contextual", "authority": 3, "summary": "  Event '), "event_type",
        F.lit('.  ", "topics": [{"topic": "'), "event_type", F.lit('", "depth": '), depth, F.lit('}, 4, {"topic": "User '), "user_id", F.lit('"}, {"topic": "'), "event_type", F.lit('"}], "aliases": {"Kind": " '), "event_type",
        F.lit(' ", "x": 1}, "goal_affinity": [{"domain": "Shop Floor", "weight": '), F.format_string("%.2f", (e % 40) / 20), F.lit("}]}"),
    )
    said = F.when(e % 11 == 0, F.concat(F.lit("no object here "), "event_type")).when(e % 2 == 0, F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n```\n"))).otherwise(F.concat(F.lit("I think "), body, F.lit(" fits.")))
    return rows.select(F.concat(F.lit("e-"), e).alias("chunk_id"), F.lit("events").alias("document_slug"), F.lit("").alias("heading"), F.lit("Events").alias("document_title"), F.concat_ws(" ", F.lit("Seen."), "event_type").alias("body"), said.alias("answer"))


@query
def extract_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = annotate.extract_json(F.col("answer"))
    return answers(spark, sf_dir).select("chunk_id", found.isNotNull().alias("is_object"), F.try_variant_get(found, "$.utility", "string").alias("utility"))


@query
def coerce_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotate.classify_answers(answers(spark, sf_dir))
    pairs = F.transform("topics", lambda t: F.concat_ws(":", t["topic"], t["depth"].cast("string")))
    return rows.select(
        "chunk_id", "chunk_type", "summary", F.array_join(pairs, " ").alias("topics"), F.array_join(F.transform("aliases", lambda a: F.concat_ws("=", a["key"], a["value"])), " ").alias("aliases"),
        F.array_join(F.transform("goal_affinity", lambda g: g["domain"]), " ").alias("goals"), F.element_at("goal_affinity", 1)["weight"].alias("weight"), "utility", "authority", "confidence", "standalone", "fallback",
    )


@query
def classify_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.classify_report(annotate.classify_answers(answers(spark, sf_dir)))


# --- records and packs ----------------------------------------------------------------------------------------------------------------------


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.compile_corpus(conversations(spark, sf_dir), CFG, created_at=AT)


def altered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of documents, some made invalid by their labels and sources."""
    rows = units(spark, sf_dir).join(table(spark, sf_dir, "labels").select(F.concat(F.lit("doc-"), "doc_id").alias("chunk_id"), "quality", "toxic"), "chunk_id", "left")
    rows = annotate.classify_fallback(rows.withColumns({"source_file": F.concat("chunk_id", F.lit(".md")), "total": F.lit(1), "next_id": F.lit(None).cast("string"), "previous_id": F.lit(None).cast("string"), "related_chunks": F.array().cast("array<string>"), "index_ref": F.lit(None).cast("struct<entry:string,line:int>"), "lexical_distinctiveness": F.lit(0.0), "information_density": F.lit(0.0), "idx": F.col("idx").cast("int")}), CFG)
    rows = rows.withColumn("chunk_type", F.when(F.col("quality") == 0, "rubbish").otherwise(F.col("chunk_type")))
    rows = rows.withColumn("confidence", F.when(F.col("toxic") == 1, 1.5).otherwise(F.col("confidence")))
    rows = rows.withColumn("aliases", F.when(F.col("quality") == 1, F.array(F.struct(F.col("document_slug").alias("key"), F.lit(" origin ").alias("value")))).otherwise(F.col("aliases")))
    rows = rows.select(annotate.frontmatter(CFG, AT).alias("fm"), "body", "quality")
    return rows.withColumn("fm", F.col("fm").withField("status", F.when(F.col("quality") == 0, "draft").otherwise("active")))


@query
def compile_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(spark, sf_dir)
    return rows.select("fm.chunk_id", "fm.document_title", "fm.summary", "fm.topic_path", F.col("fm.salience.specificity").alias("specificity"), F.col("fm.navigation.current").cast(LONG).alias("current"), F.col("fm.navigation.next").alias("next"), "fm.status", F.col("fm.temporal.created_at").alias("created_at"), F.col("fm.tokens").cast(LONG).alias("tokens"))


@query
def frontmatter_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.validate_frontmatter(altered(spark, sf_dir))


@query
def pack_chunks_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pack.pack_chunks(altered(spark, sf_dir))
    return rows.select("id", "title", F.md5("text").alias("text_md5"), "summary", F.array_join("topics", " ").alias("topics"), F.array_join("aliases", "|").alias("aliases"), F.col("source.doc").alias("doc"), F.col("source.position").cast(LONG).alias("position"), F.col("tokens").cast(LONG).alias("tokens"))


@query
def pack_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc-"), F.col("doc_id") - F.col("doc_id") % 7 % 2).alias("id"), F.when(F.col("doc_id") % 50 == 0, "").otherwise(F.col("source")).alias("title"), "text")
    return pack.chunk_problems(rows)


@query
def alias_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.array(F.struct(F.col("source").alias("key"), F.concat(F.lit(" "), "lang").alias("value")), F.struct(F.lit("  ").alias("key"), F.lit("x").alias("value")))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(pack.flatten_aliases(pairs), "|").alias("aliases"))


@query
def embedding_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = altered(spark, sf_dir)
    made = [F.md5(pack.embedding_text(F.col("body"), F.col("fm.aliases"), s)).alias(s) for s in ("append", "prepend", "none")]
    return rows.select("fm.chunk_id", *made)


@query
def flatten_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pack.flat_metadata(altered(spark, sf_dir))
    return rows.select("chunk_id", "document_slug", "chunk_type", "topic_path", "topics", "aliases", "goal_affinity", F.col("nav_current").cast(LONG).alias("nav_current"), "nav_next", "specificity", "standalone", "authority", "confidence", "status", "decay_class", "created_at", F.col("tokens").cast(LONG).alias("tokens"))


@query
def upsert_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc-"), "doc_id").alias("chunk_id"), "source", F.col("doc_id").alias("version"))
    pages_ = table(spark, sf_dir, "pages").select(F.concat(F.lit("doc-"), F.col("page_id") * 2).alias("chunk_id"), F.lit("page").alias("source"), F.col("page_id").alias("version"))
    return pack.upsert(rows, pages_)


@query
def upsert_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of upsert_chunks, through a collection that keeps the second table as a delta."""
    held = Collection(spark, scratch(spark))
    held.upsert(table(spark, sf_dir, "documents").select(F.concat(F.lit("doc-"), "doc_id").alias("chunk_id"), "source", F.col("doc_id").alias("version")))
    held.upsert(table(spark, sf_dir, "pages").select(F.concat(F.lit("doc-"), F.col("page_id") * 2).alias("chunk_id"), F.lit("page").alias("source"), F.col("page_id").alias("version")))
    return held.rows().select("chunk_id", "source", "version")


# --- pages and search -----------------------------------------------------------------------------------------------------------------------


@query
def html_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.convert_pages(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "title", "body", "error")


@query
def import_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select(F.format_string("/export/%06d.html", "page_id").alias("path"), "html")
    return html.import_pages(rows).select("path", "status", "slug", "title")


@query
def page_paths_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("/x/"), F.when(F.col("page_id") % 5 == 0, "images/").otherwise("pages/"), "page_id", F.lit(".html")).alias("path"))
    return rows.where(html.page_path_kept(F.col("path")))


@query
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100, itself included."""
    rows = table(spark, sf_dir, "embeddings")
    found = search.vectors_top_k(rows, rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), 10)
    return found.select("query_id", F.col("rank").cast(LONG).alias("rank"), "vec_id", F.bround("score", 6).alias("score"))


@query
def lexical_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = salience.Corpus(units(spark, sf_dir))
    return search.lexical_top_k(corpus.weights, corpus.idf, "worthless erhe tion auxtion keit", 10).select("chunk_id", F.bround("score", 6).alias("score"))


def _vector_index(spark: SparkSession, sf_dir: str) -> tuple[VectorIndex, DataFrame]:
    """An index of all vectors, and those whose id is divisible by 100 as queries."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return VectorIndex.build(rows, scratch(spark), dimensions=64), rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query
def vector_index_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of vector_topk, from an index that tells which cells can hold them."""
    held, asked = _vector_index(spark, sf_dir)
    return held.nearest(asked, 10).select("query_id", F.col("rank").cast(LONG).alias("rank"), "vec_id", F.bround("score", 6).alias("score"))


@query
def vector_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly the rows of vector_topk, from the cells nearest to each query."""
    held, asked = _vector_index(spark, sf_dir)
    return held.probe(asked, 10).select("query_id", F.col("rank").cast(LONG).alias("rank"), "vec_id", F.bround("score", 6).alias("score"))


@query
def postings_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten chunks nearest to the eight heaviest terms of every document whose id is divisible by 100."""
    corpus = salience.Corpus(units(spark, sf_dir), keep=("idx",))
    heaviest = Window.partitionBy("chunk_id").orderBy(F.desc(F.bround("w", 9)), "term")
    asked = corpus.weights_of("idx % 100 = 0").withColumn("place", F.row_number().over(heaviest)).where("place <= 8").select(F.col("chunk_id").alias("query_id"), "term", F.col("w").alias("q"))
    found = Postings.of_lists(corpus.factors, scratch(spark)).search(asked, 10)
    return found.select("query_id", F.col("rank").cast(LONG).alias("rank"), "chunk_id", F.bround("score", 6).alias("score"))


@query
def fan_out_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What 3,000 tokens hold around every document whose id is divisible by 100."""
    rows = units(spark, sf_dir)
    hits = rows.where("idx % 100 = 0").select(F.col("chunk_id").alias("query_id"), "chunk_id")
    found = fan_out(hits, rows, entry_siblings(spark, sf_dir), budget=3000)
    return found.select("query_id", F.col("place").cast(LONG).alias("place"), "chunk_id", F.col("hop").cast(LONG).alias("hop"), "total")


@query
def full_compile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of a full compilation over the conversations: records with salience, related chunks and index references."""
    rows = plan.full_corpus(conversations(spark, sf_dir), CFG, created_at=AT).records
    return rows.select("fm.chunk_id", F.col("fm.salience.lexical_distinctiveness").alias("lexical_distinctiveness"), F.col("fm.salience.information_density").alias("information_density"), F.array_join("fm.related_chunks", " ").alias("related"), F.col("fm.index_ref.line").cast(LONG).alias("line"))


def flagship(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """Documents compiled into chunk rows."""
    return _chunk_rows(segment.chunk_documents(documents(spark, sf_dir)))
