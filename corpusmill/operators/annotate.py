"""Classification without a model, coercion of a model's answers, the nested chunk record and its validation."""

from __future__ import annotations

import json
import math
from collections import Counter
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from corpusmill.config import Config
from corpusmill.functions.text import content_terms_of, first_sentence, slug_of, slugify, slugify_ascii, strip

# --- fixed values: what the fields of a record may hold -----------------------------------------------------------------------------------
CHUNK_TYPES = ("section", "definition", "procedure", "fact", "idiom", "narrative", "reference")
UTILITIES = ("procedural", "declarative", "contextual", "orienting")
AUTHORITIES = ("canonical", "derived", "informal", "speculative")
DECAY_CLASSES = ("evergreen", "slow-decay", "fast-decay", "ephemeral")
SOURCE_TYPES = ("human-authored", "model-generated", "system-event", "conversation")
STATUSES = ("active", "draft", "superseded", "archived")
MOST_TOPICS, MOST_ALIASES, MOST_GOALS, FALLBACK_TOPICS, COMMON_TERMS, DEEPEST = 6, 4, 4, 3, 8, 4
# ------------------------------------------------------------------------------------------------------------------------------------------

TOPICS = "array<struct<topic:string,depth:int>>"
ALIASES = "array<struct<key:string,value:string>>"
GOALS = "array<struct<domain:string,weight:double>>"


def topic(name: Column, depth: Column) -> Column:
    return F.struct(name.alias("topic"), depth.cast("int").alias("depth"))


@F.pandas_udf(ArrayType(StringType()))
def _common_terms(texts: pd.Series) -> pd.Series:
    return pd.Series([[] if t is None else [term for term, _ in Counter(content_terms_of(t)).most_common(COMMON_TERMS)] for t in texts])


def common_terms(text: Column) -> Column:
    """The most frequent content terms of a text, ties by first place. Counting stays within the row: by aggregation every term of the
    corpus would be shuffled, and the texts for the join behind it."""
    return _common_terms(text)


def fallback_topics(chunks: DataFrame, body: str = "body", heading: str = "heading", slug: str = "document_slug") -> DataFrame:
    """Adds ``topics``: the heading's slug and the commonest terms' slugs, three together; the first is the most specific."""
    rows = chunks.withColumns({"__head": slugify(F.col(heading)), "__doc": slugify(F.col(slug)), "__common": common_terms(F.col(body))})
    heads = F.filter(F.array("__head"), lambda h: h.isNotNull() & (h != ""))
    terms = F.filter(F.transform("__common", slugify_ascii), lambda t: t != "")
    # a heading always stays; terms are taken until three topics are there, one at least being looked at
    rows = rows.withColumn("__names", F.slice(F.array_distinct(F.concat(heads, terms)), 1, FALLBACK_TOPICS))
    names = F.when(F.size("__names") > 0, F.col("__names")).otherwise(F.array(F.coalesce(F.nullif(F.col("__doc"), F.lit("")), F.lit("unclassified"))))
    rows = rows.withColumn("topics", F.transform(names, lambda n, i: topic(n, F.when(i == 0, 0).otherwise(1))))
    return rows.drop("__head", "__doc", "__common", "__names")


def topic_path(topics: Column) -> Column:
    """Names from the most specific on, ties in their order, joined by dots."""
    by_depth = F.array_sort(F.transform(topics, lambda t, i: F.struct(t["depth"].alias("d"), i.alias("i"), t["topic"].alias("t"))))
    return F.array_join(F.transform(by_depth, lambda x: x["t"]), ".")


def specificity(topics: Column) -> Column:
    """Share of topics of depth 0, to three places."""
    n = F.size(topics)
    return F.when(n > 0, F.bround(F.size(F.filter(topics, lambda t: t["depth"] == 0)) / n, 3)).otherwise(0.0)


def fallback_summary(body: Column, heading: Column, title: Column) -> Column:
    first = first_sentence(body)
    return F.when(first != "", first).when(F.coalesce(heading, F.lit("")) != "", heading).otherwise(title)


def classify_fallback(chunks: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Adds the classification that needs no model."""
    rows = fallback_topics(chunks)
    return rows.withColumns(
        {
            "chunk_type": F.lit("section"),
            "summary": fallback_summary(F.col("body"), F.col("heading"), F.col("document_title")),
            "aliases": F.array().cast(ALIASES),
            "goal_affinity": default_goals(),
            "utility": F.lit("declarative"),
            "authority": F.lit(cfg.provenance.default_authority),
            "confidence": F.bround(F.lit(float(cfg.provenance.default_confidence)), 3),
            "standalone": F.lit(True),
        }
    )


def default_goals() -> Column:
    return F.array(F.struct(F.lit("general").alias("domain"), F.lit(0.5).alias("weight")))


# --- a model's answer ---------------------------------------------------------------------------------------------------------------------


def _plain(value: Any) -> Any:
    """Numbers that JSON has no name for as texts."""
    if isinstance(value, float) and not math.isfinite(value):
        return str(value)
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def _named(value: Any, key: str) -> Any:
    """An object of a list with the text at ``key`` as a slug; as it is, stripped, where it makes none."""
    if isinstance(value, dict) and isinstance(value.get(key), str):
        return value | {key: slug_of(value[key]) or value[key].strip()}
    return value


def read_object(text: str | None) -> str | None:
    """A JSON object as plain JSON in which the order of aliases cannot be lost, null for anything else. Of a repeated key the last value
    counts, NaN and infinite numbers become texts, names become slugs (accents go, other characters beyond ASCII vanish), and aliases a
    list of pairs in the order of the object."""
    try:
        found = json.loads(text or "")
    except (ValueError, RecursionError):
        return None
    if not isinstance(found, dict):
        return None
    if isinstance(topics := found.get("topics"), list):
        found["topics"] = [x | {"topic": slug_of(str(x.get("topic", "")))} if isinstance(x, dict) else x for x in topics]
    if isinstance(goals := found.get("goal_affinity"), list):
        found["goal_affinity"] = [_named(x, "domain") for x in goals]
    pairs = found.get("aliases") if isinstance(found.get("aliases"), dict) else {}
    found["aliases"] = [[slug_of(k) or k.strip(), v.strip()] for k, v in pairs.items() if isinstance(v, str) and k.strip() and v.strip()]
    return json.dumps(_plain(found))


@F.pandas_udf(StringType())
def _read_objects(texts: pd.Series) -> pd.Series:
    return texts.map(read_object)


def extract_json(answer: Column) -> Column:
    """The first fenced object, else what stands from the first to the last brace, read by ``read_object``, as VARIANT; null unless it is
    an object. A model's answer is slow to come by, so reading it in Python costs little, and VARIANT sorts keys and refuses repeated ones."""
    fenced = F.nullif(F.regexp_extract(answer, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1), F.lit(""))
    braced = F.nullif(F.regexp_extract(answer, r"(?s)(\{.*\})", 1), F.lit(""))
    return F.try_parse_json(_read_objects(F.coalesce(fenced, braced)))


def _get(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


def _kind(value: Column, path: str) -> Column:
    """The type at a path, as schema_of_variant names it; null where there is nothing."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def _is_text(value: Column, path: str) -> Column:
    return F.coalesce(_kind(value, path) == "STRING", F.lit(False))


def as_enum(value: Column, path: str, allowed: tuple[str, ...], default: str) -> Column:
    name = F.lower(strip(_get(value, path)))
    return F.when(_is_text(value, path) & name.isin(*allowed), name).otherwise(default)


def as_share(value: Column, path: str, default: float) -> Column:
    """A number, a text of one or a boolean, within 0 and 1, to three places; what is no number counts as 0."""
    kind = _kind(value, path)
    number = F.when(kind == "BOOLEAN", F.when(_get(value, path, "boolean"), 1.0).otherwise(0.0)).when(kind == "STRING", F.expr("NULL").cast("double")).otherwise(_get(value, path, "double"))
    number = F.coalesce(number, F.when(kind == "STRING", strip(_get(value, path)).try_cast("double")))
    return F.when(number.isNull(), F.lit(round(float(default), 3))).otherwise(F.bround(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.nanvl(number, F.lit(0.0)))), 3))


def as_bool(value: Column, path: str, default: bool) -> Column:
    kind = _kind(value, path)
    return F.when(kind == "BOOLEAN", _get(value, path, "boolean")).when(kind == "STRING", F.lower(strip(_get(value, path))).isin("true", "yes", "1")).otherwise(default)


def _elements(value: Column, path: str) -> Column:
    """The objects in a list; none if it isn't one."""
    listed = F.coalesce(_kind(value, path).startswith("ARRAY"), F.lit(False))
    return F.filter(F.coalesce(F.when(listed, _get(value, path, "array<variant>")), F.array().cast("array<variant>")), lambda x: F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False)))


def given_topics(value: Column) -> Column:
    """Names, no name twice, six at most; depths whole and from 0 to 4."""
    kind = lambda x: _kind(x, "$.depth")
    whole = lambda x: F.when(kind(x) == "BOOLEAN", F.when(_get(x, "$.depth", "boolean"), 1).otherwise(0)).when(kind(x) == "STRING", strip(_get(x, "$.depth")).try_cast("int")).otherwise(_get(x, "$.depth", "double").try_cast("int"))
    named = F.transform(
        _elements(value, "$.topics"),
        lambda x: topic(F.coalesce(_get(x, "$.topic"), F.lit("")), F.least(F.lit(DEEPEST), F.greatest(F.lit(0), F.coalesce(whole(x), F.lit(0))))),
    )
    return F.slice(_first_of(F.filter(named, lambda t: t["topic"] != ""), "topic", TOPICS), 1, MOST_TOPICS)


def _first_of(items: Column, key: str, kind: str) -> Column:
    """Only the first item of each key."""
    start = F.array().cast(kind)
    return F.aggregate(items, start, lambda acc, x: F.when(F.exists(acc, lambda y: y[key] == x[key]), acc).otherwise(F.concat(acc, F.array(x))))


def given_aliases(value: Column) -> Column:
    """Pairs of texts that aren't blank, in the order of the answer, until four are there; a later pair takes the place of an earlier one
    of its key."""
    listed = F.coalesce(_get(value, "$.aliases", "array<array<string>>"), F.array().cast("array<array<string>>"))
    start = F.array().cast(ALIASES)

    def put(acc: Column, pair: Column) -> Column:
        x = F.struct(pair[0].alias("key"), pair[1].alias("value"))
        known = F.exists(acc, lambda y: y["key"] == x["key"])
        with_ = F.when(known, F.transform(acc, lambda y: F.when(y["key"] == x["key"], x).otherwise(y))).otherwise(F.concat(acc, F.array(x)))
        return F.when(F.size(acc) < MOST_ALIASES, with_).otherwise(acc)

    return F.aggregate(listed, start, put)


def given_goals(value: Column) -> Column:
    """Domains that are texts, with weights in 0 to 1; four at most, ``general`` if there are none."""
    named = F.filter(_elements(value, "$.goal_affinity"), lambda x: _is_text(x, "$.domain") & (F.coalesce(strip(_get(x, "$.domain")), F.lit("")) != ""))
    goals = F.slice(F.transform(named, lambda x: F.struct(_get(x, "$.domain").alias("domain"), as_share(x, "$.weight", 0.5).alias("weight"))), 1, MOST_GOALS)
    return F.when(F.size(goals) > 0, goals).otherwise(default_goals())


def classify_answers(chunks: DataFrame, answer: str = "answer", cfg: Config = Config()) -> DataFrame:
    """Adds the classification that a model's answer gives, each field coerced or replaced by its fallback. Without an object in the answer
    all are fallbacks, confidence is 0.3 at most and ``fallback`` is true."""
    rows = fallback_topics(chunks.withColumn("__raw", extract_json(F.col(answer))))
    raw = F.coalesce(F.col("__raw"), F.parse_json(F.lit("{}")))
    rows = rows.withColumns({"__v": raw, "fallback": F.col("__raw").isNull(), "__own": F.col("topics")})
    v, p = F.col("__v"), cfg.provenance
    said = strip(_get(v, "$.summary"))
    share = as_share(v, "$.confidence", p.default_confidence)
    given = given_topics(v)
    rows = rows.withColumns(
        {
            "chunk_type": as_enum(v, "$.chunk_type", CHUNK_TYPES, "section"),
            "summary": F.when(_is_text(v, "$.summary") & (said != ""), said).otherwise(fallback_summary(F.col("body"), F.col("heading"), F.col("document_title"))),
            "topics": F.when(F.size(given) > 0, given).otherwise(F.col("__own")),
            "aliases": given_aliases(v),
            "goal_affinity": given_goals(v),
            "utility": as_enum(v, "$.utility", UTILITIES, "declarative"),
            "authority": as_enum(v, "$.authority", AUTHORITIES, p.default_authority),
            "confidence": F.when(F.col("fallback"), F.least(share, F.lit(0.3))).otherwise(share),
            "standalone": as_bool(v, "$.standalone", True),
        }
    )
    return rows.drop("__raw", "__v", "__own")


# --- the record ---------------------------------------------------------------------------------------------------------------------------


def _blank_null(text: str) -> Column:
    return F.lit(text or None).cast("string")


def frontmatter(cfg: Config, created_at: str) -> Column:
    """The nested record of a chunk, its fields in their order. Needs the chunk's own columns and its classification; columns for salience,
    related chunks and index reference may be constants."""
    p = cfg.provenance
    c = F.col
    return F.struct(
        c("chunk_id"), c("document_slug"), c("source_file"), c("chunk_type"), c("document_title"), c("summary"), c("topics"), topic_path(c("topics")).alias("topic_path"), c("aliases"),
        F.struct(c("idx").alias("current"), c("total"), c("next_id").alias("next"), c("previous_id").alias("previous")).alias("navigation"),
        F.lit(None).cast("string").alias("series"), c("related_chunks"), c("index_ref"),
        F.struct(c("lexical_distinctiveness"), c("information_density"), specificity(c("topics")).alias("specificity"), c("standalone")).alias("salience"),
        c("goal_affinity"), c("utility"),
        F.struct(F.lit(p.source_type).alias("source_type"), c("authority"), c("confidence"), _blank_null(p.author).alias("author"), _blank_null(p.original_source).alias("original_source")).alias("provenance"),
        F.lit("active").alias("status"),
        F.struct(F.lit(created_at).alias("created_at"), F.lit(None).cast("string").alias("effective_date"), F.lit(None).cast("string").alias("stale_after"), F.lit(cfg.temporal.decay_class).alias("decay_class"), F.lit(None).cast("string").alias("last_accessed"), F.lit(0).alias("access_count")).alias("temporal"),
        c("tokens"),
    )


def frontmatter_problems(fm: str = "fm") -> Column:
    """Messages of the rules that a record breaks, in the order of its fields; empty if none."""
    f = lambda path: F.col(f"{fm}.{path}")
    filled = lambda x: F.coalesce(x, F.lit("")) != ""
    cid = F.concat(F.coalesce(f("chunk_id"), F.lit("?")), F.lit(": "))
    said = lambda *text: F.concat(cid, *text)
    shown = lambda x: F.coalesce(F.concat(F.lit("'"), x, F.lit("'")), F.lit("None"))
    within = lambda x: F.coalesce((x >= 0.0) & (x <= 1.0) & ~F.isnan(x), F.lit(False))
    one_of = lambda x, allowed: F.coalesce(x.isin(*allowed), F.lit(False))
    rules = [
        (filled(f("chunk_id")), F.lit("missing chunk_id")),
        (filled(f("document_slug")), said(F.lit("missing document_slug"))),
        (one_of(f("chunk_type"), CHUNK_TYPES), said(F.lit("bad chunk_type "), shown(f("chunk_type")))),
        (one_of(f("utility"), UTILITIES), said(F.lit("bad utility "), shown(f("utility")))),
        (filled(f("summary")), said(F.lit("empty summary"))),
        (F.coalesce(F.size(f("topics")), F.lit(0)) > 0, said(F.lit("no topics"))),
        (filled(f("topic_path")), said(F.lit("empty topic_path"))),
        (one_of(f("provenance.source_type"), SOURCE_TYPES), said(F.lit("bad source_type"))),
        (one_of(f("provenance.authority"), AUTHORITIES), said(F.lit("bad authority"))),
        (within(f("provenance.confidence")), said(F.lit("confidence out of range"))),
        *[(within(f(f"salience.{k}")), said(F.lit(f"salience.{k} out of range ("), F.coalesce(f(f"salience.{k}").cast("string"), F.lit("-1")), F.lit(")"))) for k in ("lexical_distinctiveness", "information_density", "specificity")],
        (f("salience.standalone").isNotNull(), said(F.lit("standalone not bool"))),
        (one_of(f("temporal.decay_class"), DECAY_CLASSES), said(F.lit("bad decay_class"))),
        (one_of(f("status"), STATUSES), said(F.lit("bad status"))),
        (F.coalesce(f("tokens") >= 0, F.lit(False)), said(F.lit("bad tokens"))),
    ]
    return F.filter(F.array(*[F.when(~ok, message) for ok, message in rules]), lambda m: m.isNotNull())


def validate_frontmatter(records: DataFrame, fm: str = "fm") -> DataFrame:
    """A row for each problem: chunk_id and problem."""
    return records.select(F.col(f"{fm}.chunk_id").alias("chunk_id"), F.explode(frontmatter_problems(fm)).alias("problem"))
