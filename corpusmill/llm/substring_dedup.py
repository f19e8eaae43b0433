"""Substring deduplication with suffix automata of reference shards.

A word goes if a window of ``width`` consecutive words covers it that also starts in a document with a smaller id.

The reference here is the corpus itself, so its automata cannot all be broadcast, and not every document can stream through every one.
A window's anchor decides which shard it belongs to: the least hash of its word n-grams, the same wherever the window stands. Neighbouring
windows with one anchor are a run. Runs with an anchor that only one document has are done. Of the rest, equal runs are one, with the least
id; what stands alone under its anchor has no other text to be compared with. The texts of the others are sent to the shards of their
anchors. A shard builds the automaton of its texts, some thousand words at a time, streams the same texts through it for their
matching statistics, and so finds for each window the least document that has it. Anchors with more than ``most_runs`` different
texts go by single windows instead, whose least document is an aggregate, so no group of texts is unbounded. Spans are then cut from
the documents.

Rows: null texts have no words. A document without an id is no reference and keeps all words. Rows that repeat an id don't count as
smaller than each other. Texts go in whole, an empty table gives an empty result, and only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import SuffixAutomaton
from .common import check_names, map_slices, raw, stored
from .words import Words, mix, sliding_min

RUNS = "anchor bigint, run bigint, __id bigint, __row bigint, start int, windows int"
PIECES = "anchor bigint, run bigint, pieces array<struct<at:int,n:int,first:bigint>>"


def runs_of(texts: list[bytes], width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor, hash, text number, first word and number of windows of each run."""
    words = Words(texts)
    n = len(words) - width + 1
    if n < 1:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    anchors = sliding_min(words.grams(gram), width - gram + 1)
    inside = words.doc[:n] == words.doc[width - 1 :]
    begins = inside.copy()
    begins[1:] &= (anchors[1:] != anchors[:-1]) | ~inside[:-1] | (words.doc[1:n] != words.doc[: n - 1])
    starts = np.flatnonzero(begins)
    stops = np.append(np.flatnonzero(begins | ~inside), n)
    ends = stops[np.searchsorted(stops, starts, side="right")]
    hashes = mix(words.stretch(starts, ends + width - 1) + np.uint64(1))
    doc = words.doc[starts]
    return anchors[starts], hashes, doc, starts - words.first[doc], ends - starts


def pieces_of(firsts: list[int]) -> list[dict]:
    """Runs of equal numbers: where, how many, which."""
    out, at = [], 0
    for first, same in groupby(firsts):
        n = len(list(same))
        out.append({"at": at, "n": n, "first": first})
        at += n
    return out


def shard_results(rows: Iterator[tuple[int, int, int, bytes]], width: int, most_words: int) -> Iterator[tuple[int, int, list[dict]]]:
    """Anchor, run and pieces for rows of anchor, run, least id and text, an anchor's rows together."""

    def solve(shard: list[tuple[int, int, int, list[bytes]]]) -> Iterator[tuple[int, int, list[dict]]]:
        automaton = SuffixAutomaton()
        for _, _, label, words in shard:
            automaton.add(words, label)
        for anchor, run, _, words in shard:
            yield anchor, run, pieces_of(list(automaton.windows(words, width)))

    shard, held, last = [], 0, None
    for anchor, run, label, text in rows:
        if anchor != last and held >= most_words:
            yield from solve(shard)
            shard, held = [], 0
        words = text.split()
        shard.append((anchor, run, label, words))
        held, last = held + len(words), anchor
    if shard:
        yield from solve(shard)


def dedup_substrings(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), width: int = 50, gram: int = 16, most_runs: int = 256, most_words: int = 20_000) -> DataFrame:
    """``keep`` columns, ``text`` (the words that stay, with single spaces), n_words and n_removed. None of those kept
    may have the name of one of the others."""
    check_names(keep, ("text", "n_words", "n_removed"))
    gram = min(gram, width)
    column = F.coalesce(F.col(text).cast("string"), F.lit(""))
    docs = df.select(F.col(doc_id).cast("long").alias("__id"), F.xxhash64(column).alias("__row"), column.alias("__text"))

    def find(part: pa.RecordBatch) -> pa.RecordBatch:
        anchors, hashes, doc, starts, counts = runs_of(raw(part.column(2)), width, gram)
        at = pa.array(doc)
        return pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64)), pa.array(hashes.view(np.int64)), part.column(0).take(at), part.column(1).take(at), pa.array(starts, pa.int32()), pa.array(counts, pa.int32())], ["anchor", "run", "__id", "__row", "start", "windows"])

    runs = stored(map_slices(docs.where("__id IS NOT NULL"), find, RUNS, 2))
    distinct = runs.groupBy("anchor", "run").agg(F.min(F.struct("__id", "__row", "start", "windows")).alias("first"), F.max("__id").alias("last"))
    anchors = distinct.groupBy("anchor").agg(F.min("first.__id").alias("low"), F.max("last").alias("high"), F.count("*").alias("n")).where("low < high")
    suspects = stored(distinct.join(anchors.select("anchor", "n"), "anchor").select("anchor", "run", "n", "first.*"))

    alone = suspects.where("n = 1").select("anchor", "run", F.array(F.struct(F.lit(0).alias("at"), F.col("windows").alias("n"), F.col("__id").alias("first"))).alias("pieces"))
    found = alone.unionByName(_by_automata(_texts(docs, suspects.where((F.col("n") > 1) & (F.col("n") <= most_runs)), width), width, most_words))
    if not suspects.where(F.col("n") > most_runs).isEmpty():
        found = found.unionByName(_by_windows(_texts(docs, suspects.where(F.col("n") > most_runs), width), width))

    covered = F.filter("pieces", lambda p: p["first"] < F.col("__id"))
    spans = F.transform(covered, lambda p: F.struct((F.col("start") + p["at"]).alias("a"), (F.col("start") + p["at"] + p["n"] + F.lit(width - 1)).alias("b")))
    cuts = runs.join(found, ["anchor", "run"]).select("__id", "__row", spans.alias("spans")).where(F.size("spans") > 0)
    cuts = cuts.groupBy("__id", "__row").agg(F.flatten(F.collect_list("spans")).alias("__spans"))

    rows = df.select(*[F.col(k).alias(f"__keep{i}") for i, k in enumerate(keep)], F.col(doc_id).cast("long").alias("__id"), F.xxhash64(column).alias("__row"), column.alias("__text"))
    joined = rows.join(cuts, ["__id", "__row"], "left").select(*[f"__keep{i}" for i in range(len(keep))], F.col("__spans.a").alias("__a"), F.col("__spans.b").alias("__b"), "__text")
    kinds = "".join(f"`__keep{i}` {joined.schema[i].dataType.simpleString()}, " for i in range(len(keep)))

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        texts, counts, removed = [], [], []
        k = len(keep)
        for a, b, t in zip(part.column(k).to_pylist(), part.column(k + 1).to_pylist(), raw(part.column(k + 2)), strict=True):
            words = t.split()
            counts.append(len(words))
            if a:
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, a, 1)
                np.add.at(depth, b, -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
            removed.append(counts[-1] - len(words))
            texts.append(b" ".join(words))
        made = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
        return pa.RecordBatch.from_arrays([*part.columns[:k], *made], [*part.schema.names[:k], "text", "n_words", "n_removed"])

    return map_slices(joined, cut, f"{kinds}text string, n_words bigint, n_removed bigint", len(keep) + 2).toDF(*keep, "text", "n_words", "n_removed")


def _texts(docs: DataFrame, suspects: DataFrame, width: int) -> DataFrame:
    """anchor, run, ``first`` (least id) and the words of each run, from the document that has it first."""
    wanted = suspects.groupBy("__id", "__row").agg(F.collect_list(F.struct("anchor", "run", "start", "windows")).alias("wanted"))
    rows = docs.join(wanted, ["__id", "__row"]).select("__id", F.col("wanted.anchor"), F.col("wanted.run"), F.col("wanted.start"), F.col("wanted.windows"), "__text")

    def take(part: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        lists = [part.column(k).to_pylist() for k in range(5)]
        for i, anchor, run, start, windows, t in zip(*lists, raw(part.column(5)), strict=True):
            words = t.split()
            out += [(a, r, i, b" ".join(words[s : s + n + width - 1])) for a, r, s, n in zip(anchor, run, start, windows, strict=True)]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["anchor", "run", "first", "words"])

    return map_slices(rows, take, "anchor bigint, run bigint, first bigint, words binary", 5)


def _by_automata(texts: DataFrame, width: int, most_words: int) -> DataFrame:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("first", pa.int64())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for row in shard_results(rows, width, most_words):
            out.append(row)
            if len(out) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["anchor", "run", "pieces"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["anchor", "run", "pieces"])

    return texts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, PIECES)


def _by_windows(texts: DataFrame, width: int) -> DataFrame:
    """The same for anchors with many texts: each window for itself."""

    def split(part: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for anchor, run, first, t in zip(*(c.to_pylist() for c in part.columns), strict=True):
            words = t.split()
            out += [(xxhash.xxh3_128_digest(b" ".join(words[j : j + width])), anchor, run, j, first) for j in range(len(words) - width + 1)]
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["window", "anchor", "run", "at", "first"])

    windows = stored(map_slices(texts, split, "window binary, anchor bigint, run bigint, at int, first bigint", 3))
    least = windows.groupBy("window").agg(F.min("first").alias("least"))
    rows = windows.join(least, "window").select("anchor", "run", F.struct("at", F.lit(1).alias("n"), F.col("least").alias("first")).alias("piece"))
    return rows.groupBy("anchor", "run").agg(F.collect_list("piece").alias("pieces"))
