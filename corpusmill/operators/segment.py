"""Documents into sections, paragraphs, pieces and chunks, by array expressions: no shuffle, no Python.

Arrays are exploded by the outer form and rows without an element left out afterwards: for the plain form the optimizer puts a filter on
the array's size below the projections that make the array, which works it out again for each place where it is used.

Every document is a row and stays one until its chunks are exploded, so documents of any number spread over any number of tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.config import Chunking
from corpusmill.functions.text import HEADING, SENTENCE_END, SPACE, count_words, estimate_tokens, lines, strip, title_case, tokens_of


def with_title(documents: DataFrame, text: str = "text", stem: str = "slug") -> DataFrame:
    """Adds ``title``: the first heading, else the stem in title case."""
    heads = F.filter(lines(F.col(text)), lambda line: line.rlike(HEADING))
    titled = documents.withColumn("__heads", heads)
    named = strip(F.regexp_extract(F.col("__heads")[0], HEADING, 2))
    plain = title_case(strip(F.regexp_replace(F.col(stem), "[-_]+", " ")))
    return titled.withColumn("title", F.when(F.size("__heads") > 0, named).otherwise(plain)).drop("__heads")


def with_sections(documents: DataFrame, text: str = "text", respect_headings: bool = True) -> DataFrame:
    """Adds ``sections``, an array of heading and body. A heading line opens a section and isn't in its body; sections without text vanish;
    a document without sections is one section."""
    whole = F.array(F.struct(F.lit("").alias("heading"), strip(F.col(text)).alias("body")))
    if not respect_headings:
        return documents.withColumn("sections", whole)
    cut = documents.withColumn("__lines", lines(F.col(text)))
    heads = F.filter(
        F.transform("__lines", lambda line, i: F.struct(i.alias("at"), F.when(line.rlike(HEADING), strip(F.regexp_extract(line, HEADING, 2))).alias("heading"))),
        lambda h: h["heading"].isNotNull(),
    )
    cut = cut.withColumn("__heads", F.concat(F.array(F.struct(F.lit(-1).alias("at"), F.lit("").alias("heading"))), heads))
    until = lambda i: F.coalesce(F.try_element_at("__heads", i + 2)["at"], F.size("__lines"))
    body = lambda h, i: strip(F.array_join(F.slice("__lines", h["at"] + 2, until(i) - h["at"] - 1), "\n"))
    sections = F.transform("__heads", lambda h, i: F.struct(h["heading"].alias("heading"), body(h, i).alias("body")))
    cut = cut.withColumn("sections", F.filter(sections, lambda s: s["body"] != ""))
    return cut.withColumn("sections", F.when(F.size("sections") == 0, whole).otherwise(F.col("sections"))).drop("__lines", "__heads")


def paragraphs(body: Column) -> Column:
    """Stretches between blank lines, stripped, without empty ones."""
    return F.filter(F.transform(F.split(body, rf"\n{SPACE}*\n"), strip), lambda p: p != "")


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it occurs there."""
    return F.transform(F.array(value), use)[0]


def _ranges(cuts: Column, n: Column) -> Column:
    """Begin and size of the stretches of n things that begin at 0 and at each cut."""
    return _with(
        F.concat(F.array(F.lit(0)), cuts, F.array(n)),
        lambda at: F.transform(F.slice(at, 1, F.size(at) - 1), lambda begin, i: F.struct(begin.alias("begin"), (F.element_at(at, i + 2) - begin).alias("n"))),
    )


def _stretches(items: Column, cuts: Column, make: Callable[[Column], Column]) -> Column:
    """What ``make`` makes of the items from each cut to the next; nothing of no items."""
    return F.transform(F.filter(_ranges(cuts, F.size(items)), lambda r: r["n"] > 0), lambda r: make(F.slice(items, r["begin"] + 1, r["n"])))


def _cuts(items: Column, state: dict[str, Column], cut: Callable[[Column, Column], Column], step: Callable[[Column, Column, Column], dict[str, Column]]) -> Column:
    """The places of the items before which ``cut`` finds that a new stretch begins, given the state that ``step`` carries along. Only places
    are gathered, so the texts of long documents are never copied from step to step."""
    start = F.struct(F.array().cast("array<int>").alias("cuts"), F.lit(0).alias("place"), *[v.alias(k) for k, v in state.items()])

    def add(acc: Column, x: Column) -> Column:
        def next_(fresh: Column) -> Column:
            cuts = F.when(fresh & (acc["place"] > 0), F.concat(acc["cuts"], F.array(acc["place"]))).otherwise(acc["cuts"])
            return F.struct(cuts.alias("cuts"), (acc["place"] + 1).alias("place"), *[v.alias(k) for k, v in step(acc, x, fresh).items()])

        return _with((acc["place"] == 0) | cut(acc, x), next_)

    return F.aggregate(items, start, add, lambda acc: acc["cuts"])


def _filled(acc: Column, x: Column, fresh: Column) -> Column:
    return F.when(fresh, 0).otherwise(acc["tokens"]) + x["tokens"]


def split_oversized(paragraph: Column, max_tokens: int) -> Column:
    """Sentences packed in order while their tokens add up to at most ``max_tokens``; a longer sentence stays whole."""
    sentences = F.transform(F.split(paragraph, SENTENCE_END), lambda s: F.struct(s.alias("text"), estimate_tokens(s).alias("tokens")))

    def packed(sized: Column) -> Column:
        cuts = _cuts(sized, {"tokens": F.lit(0)}, lambda acc, x: acc["tokens"] + x["tokens"] > max_tokens, lambda acc, x, fresh: {"tokens": _filled(acc, x, fresh)})
        return _with(cuts, lambda at: _stretches(sized, at, lambda part: F.array_join(part["text"], " ")))

    return _with(sentences, packed)


def _items(sections: str, max_tokens: int) -> Column:
    """What is packed: paragraphs, and the pieces of oversized ones, which stand alone."""

    def of(s: Column, k: Column) -> Column:
        item = lambda text, tokens, atomic: F.struct(k.alias("section"), s["heading"].alias("heading"), text.alias("text"), tokens.alias("tokens"), F.lit(atomic).alias("atomic"))
        sized = F.transform(paragraphs(s["body"]), lambda p: F.struct(p.alias("text"), estimate_tokens(p).alias("tokens")))
        pieces = lambda p: F.transform(split_oversized(p["text"], max_tokens), lambda piece: item(piece, estimate_tokens(piece), True))
        return F.flatten(F.transform(sized, lambda p: F.when(p["tokens"] > max_tokens, pieces(p)).otherwise(F.array(item(p["text"], p["tokens"], False)))))

    return F.flatten(F.transform(sections, of))


def _packed(items: str, target: int) -> Column:
    """Paragraphs of a section joined while they reach at most ``target`` tokens."""
    before = {"tokens": F.lit(0), "section": F.lit(-1), "alone": F.lit(False)}
    cuts = _cuts(
        F.col(items), before,
        lambda acc, x: x["atomic"] | acc["alone"] | (x["section"] != acc["section"]) | (acc["tokens"] + x["tokens"] > target),
        lambda acc, x, fresh: {"tokens": _filled(acc, x, fresh), "section": x["section"], "alone": x["atomic"]},
    )
    chunk = lambda part: F.struct(part[0]["heading"].alias("heading"), F.array_join(part["text"], "\n\n").alias("body"))
    return _with(cuts, lambda at: _stretches(F.col(items), at, chunk))


def _merged(chunks: str, minimum: int, maximum: int) -> Column:
    """Chunks under the minimum joined to the one before, whatever its section, where both stay within the maximum."""
    weighed = F.transform(chunks, lambda c: F.struct(c["heading"].alias("heading"), c["body"].alias("body"), F.length(c["body"]).alias("chars"), count_words(c["body"]).alias("words")))
    weighed = F.transform(weighed, lambda c: c.withField("tokens", tokens_of(c["chars"], c["words"])))

    def merged(whole: Column) -> Column:
        cuts = _cuts(
            whole, {"chars": F.lit(0), "words": F.lit(0)},
            lambda acc, c: (c["tokens"] >= minimum) | (tokens_of(acc["chars"], acc["words"]) + c["tokens"] > maximum),
            lambda acc, c, fresh: {"chars": F.when(fresh, 0).otherwise(acc["chars"] + 2) + c["chars"], "words": F.when(fresh, 0).otherwise(acc["words"]) + c["words"]},
        )
        total = lambda part, name: F.aggregate(part[name], F.lit(0), lambda a, x: a + x)
        chunk = lambda part: F.struct(
            part[0]["heading"].alias("heading"), F.array_join(part["body"], "\n\n").alias("body"), tokens_of(total(part, "chars") + 2 * (F.size(part) - 1), total(part, "words")).alias("tokens")
        )
        return _with(cuts, lambda at: _stretches(whole, at, chunk))

    return _with(weighed, merged)


def with_packed(documents: DataFrame, text: str = "text", cfg: Chunking = Chunking()) -> DataFrame:
    """Adds ``packed``, the chunks before small ones are merged."""
    cut = with_sections(documents, text, cfg.respect_headings)
    return cut.withColumn("__items", _items("sections", cfg.max_tokens)).withColumn("packed", _packed("__items", cfg.target_tokens)).drop("__items", "sections")


def with_chunks(documents: DataFrame, text: str = "text", cfg: Chunking = Chunking()) -> DataFrame:
    """Adds ``chunks``, an array of heading, body and tokens."""
    return with_packed(documents, text, cfg).withColumn("chunks", _merged("packed", cfg.min_tokens, cfg.max_tokens)).drop("packed")


def chunk_documents(documents: DataFrame, cfg: Chunking = Chunking()) -> DataFrame:
    """A row for each chunk of documents with slug, source_file, title and text (and path, which stays); documents without text give none."""
    path = ["path"] if "path" in documents.columns else []
    cut = with_chunks(documents.select("slug", "source_file", "title", "text", *path), "text", cfg)
    rows = cut.select("slug", "source_file", "title", *path, F.size("chunks").alias("total"), F.posexplode_outer("chunks").alias("idx", "c")).where("idx IS NOT NULL")
    name = lambda i: F.format_string("%s_%03d", "slug", i)
    at = F.col("idx")
    return rows.select(
        name(at).alias("chunk_id"),
        F.col("slug").alias("document_slug"),
        "source_file",
        F.col("title").alias("document_title"),
        "idx",
        "total",
        F.col("c.heading").alias("heading"),
        F.col("c.body").alias("body"),
        F.col("c.tokens").alias("tokens"),
        F.when(at < F.col("total") - 1, name(at + 1)).alias("next_id"),
        F.when(at > 0, name(at - 1)).alias("previous_id"),
        *path,
    )
