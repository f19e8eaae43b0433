"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle similarity.

A document leaks an item if some window of as many words as the item, or the whole of a document with fewer words, is at least
``similarity`` alike: over shingles of ``shingle`` words
(the whole sequence where there are fewer), weighted by how often they occur, the sum of the smaller weights over the sum of the larger.

The sum of the smaller weights can't be that large unless that share of the item's shingles stands in the window, so windows
with fewer hits among the items' shingles are passed over first; that loses none. Each window left gets a 64-bit SimHash of its
shingles. Fingerprints are cut into 8 blocks: of two within ``radius`` bits, some block differs in at most radius // 8, so a table by
block and value that lists the items within those bits finds every item within the radius. Candidates are then compared exactly.

At similarity 0.8 and equal sizes fingerprints differ in about 10 bits with a deviation of 3; the radius of 24 leaves five deviations.

The items are collected in runs of at most ``most_words`` words (an index takes about 600 bytes for each). One run is broadcast at a time and
given back when its leaks are written, so a larger benchmark reads the documents again for each run and neither the driver nor a task holds
more than one run.

Rows: null and empty texts and items have no words; they leak nothing and are leaked by nothing. Repeated documents and items are judged
each for itself; null ids are kept. An item's best window counts, the first among equals. Texts go in whole, empty tables give no leaks,
and only the named columns are read. A kept column named leaks is an error that names it.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import check_names, map_slices, raw, stored
from .words import Words

BLOCKS = 8
LEAKS = "array<struct<item_id:bigint,similarity:double,start:int,n_words:int>>"
_ONES = np.array([bin(i).count("1") for i in range(256)])


def simhash(hashes: np.ndarray) -> np.ndarray:
    """The 8 blocks of the fingerprint of weighted shingles: each occurrence adds its weight of one."""
    bits = np.unpackbits(np.ascontiguousarray(hashes).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(2 * bits.sum(0, dtype=np.int64) > len(hashes))


def alike(a: Counter, b: Counter) -> float:
    """Sum of smaller weights over sum of larger weights."""
    low = (a & b).total()
    return low / (a.total() + b.total() - low) if a or b else 0.0


def shingles(words: list[bytes], width: int) -> Counter:
    width = min(width, len(words))
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if width else Counter()


@dataclass
class Items:
    """Items with the same number of words."""

    n_words: int
    width: int
    least_hits: int
    ids: list[int | None] = field(default_factory=list)
    weights: list[Counter] = field(default_factory=list)
    prints: list[np.ndarray] = field(default_factory=list)
    hashes: set[int] = field(default_factory=set)
    tables: np.ndarray | None = None

    def close(self, radius: int) -> None:
        """tables[block, value, item]: whether the item's block is within the block's share of the radius."""
        prints = np.array(self.prints)
        near = _ONES[np.arange(256)[:, None, None] ^ prints[None]] <= radius // BLOCKS  # value, item, block
        self.tables = np.ascontiguousarray(near.transpose(2, 0, 1))
        self.known = np.array(sorted(self.hashes), np.uint64)

    def candidates(self, print_: np.ndarray, radius: int) -> list[int]:
        found = np.flatnonzero(self.tables[np.arange(BLOCKS), print_].any(0))
        return [i for i in found if _ONES[self.prints[i] ^ print_].sum() <= radius]


class Index:
    def __init__(self, items: list[tuple[int | None, bytes]], shingle: int, similarity: float, radius: int):
        self.similarity, self.radius, self.groups = similarity, radius, {}
        self.shingle = shingle
        for item_id, text in items:
            words = Words([text.lower()])
            n = len(words)
            if not n:
                continue
            width = min(shingle, n)
            group = self.groups.setdefault(n, Items(n, width, max(1, int(np.ceil(similarity * (n - width + 1) - 1e-9)))))
            hashes = words.grams(width)
            group.ids.append(item_id)
            group.weights.append(shingles(text.lower().split(), shingle))
            group.prints.append(simhash(hashes))
            group.hashes.update(hashes.tolist())
        for group in self.groups.values():
            group.close(radius)
        #: by shingle width: 2**22 flags that pass few other hashes, then the hashes themselves
        self.flags: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_width = defaultdict(set)
        for group in self.groups.values():
            by_width[group.width] |= group.hashes
        for width, known in by_width.items():
            known = np.array(sorted(known), np.uint64)
            flags = np.zeros(1 << 22, bool)
            flags[known & np.uint64((1 << 22) - 1)] = True
            self.flags[width] = flags, known

    def leaks(self, texts: list[bytes]) -> list[list[dict]]:
        out: list[list[dict]] = [[] for _ in texts]
        words = Words([t.lower() for t in texts])
        for width, (flags, known) in self.flags.items():
            grams = words.grams(width)
            if not len(grams):
                continue
            at = np.flatnonzero(flags[grams & np.uint64((1 << 22) - 1)])
            at = at[known[np.minimum(np.searchsorted(known, grams[at]), len(known) - 1)] == grams[at]]
            at = at[words.doc[at] == words.doc[at + width - 1]]
            if len(at):
                for group in self.groups.values():
                    if group.width == width:
                        self._windows(words, grams, at, group, out)
        return out

    def _windows(self, words: Words, grams: np.ndarray, at: np.ndarray, group: Items, out: list[list[dict]]) -> None:
        own = at[np.isin(grams[at], group.known)]
        size = group.n_words - group.width + 1  # shingles of a window
        need = group.least_hits
        if len(own) < need:
            return
        # windows that hold the hits number k to k + need - 1 start between these words
        low, high = own[need - 1 :] - size + 1, own[: len(own) - need + 1]
        doc = words.doc[high]
        fits = (low <= high) & (doc == words.doc[own[need - 1 :]])
        low = np.maximum(low, words.first[doc])[fits]
        high = np.minimum(high, words.first[doc + 1] - group.n_words)[fits]
        best: dict[tuple[int, int], tuple[float, int, int]] = {}

        def judge(start: int, n_words: int) -> None:
            for i in group.candidates(simhash(grams[start : start + n_words - group.width + 1]), self.radius):
                found = alike(shingles([w.lower() for w in words.words(start, start + n_words)], self.shingle), group.weights[i])
                key = (int(words.doc[start]), i)
                if found >= self.similarity and (key not in best or found > best[key][0]):
                    best[key] = found, start, n_words

        done = -1
        for a, b in zip(low.tolist(), high.tolist(), strict=True):
            for start in range(max(a, done + 1), b + 1):
                done = start
                judge(start, group.n_words)
        docs, hits = np.unique(words.doc[own], return_counts=True)
        lengths = words.first[docs + 1] - words.first[docs]
        for d in docs[(hits >= need) & (lengths < group.n_words)].tolist():  # shorter than the item: one window
            judge(int(words.first[d]), int(words.first[d + 1] - words.first[d]))
        for (d, i), (found, start, n_words) in sorted(best.items()):
            out[d].append({"item_id": group.ids[i], "similarity": found, "start": start - int(words.first[d]), "n_words": n_words})


def item_runs(benchmark: DataFrame, item_id: str, text: str, most_words: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items in runs of bounded size, one at a time; an item that is longer alone."""
    run, held = [], 0
    for row in benchmark.select(F.col(item_id).cast("long"), F.col(text).cast("string")).toLocalIterator():
        item = (row[0], (row[1] or "").encode())
        words = len(item[1].split())
        if run and held + words > most_words:
            yield run
            run, held = [], 0
        run.append(item)
        held += words
    yield run


KIND = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("start", pa.int32()), ("n_words", pa.int32())]))


def find_leaks(df: DataFrame, benchmark: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), item_id: str = "item_id", item_text: str = "text", shingle: int = 5, similarity: float = 0.8, radius: int = 24, most_words: int = 200_000) -> DataFrame:
    """``keep`` columns and ``leaks``, the items that the row leaks with similarity, first word and number of words; every row stays."""
    check_names(keep, ("leaks",))
    own = [f"__keep{i}" for i in range(len(keep))]
    rows = df.select(*[F.col(k).alias(o) for k, o in zip(keep, own, strict=True)], F.col(text).cast("string").alias("__text"))
    context = df.sparkSession.sparkContext
    runs = item_runs(benchmark, item_id, item_text, most_words)
    first, second = next(runs), next(runs, None)
    if second is None:
        shared = context.broadcast(Index(first, shingle, similarity, radius))

        def judge(part: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(shared.value.leaks(raw(part.column(len(own)))), KIND)], [*own, "leaks"])

        kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
        return map_slices(rows, judge, f"{kinds}leaks {LEAKS}", len(own)).toDF(*keep, "leaks")

    # texts with leaks of a run are written, by digest, before the next run is collected
    found = []
    for items in chain([first, second], runs):
        shared = context.broadcast(Index(items, shingle, similarity, radius))

        def leaking(part: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            texts = raw(part.column(0))
            leaks = shared.value.leaks(texts)
            at = [i for i, x in enumerate(leaks) if x]
            return pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(texts[i]).hexdigest() for i in at], pa.string()), pa.array([leaks[i] for i in at], KIND)], ["__sha", "leaks"])

        found.append(stored(map_slices(rows.select("__text"), leaking, f"__sha string, leaks {LEAKS}", 0).dropDuplicates(["__sha"])))
        shared.destroy()
    every = reduce(DataFrame.unionByName, found).groupBy("__sha").agg(F.array_sort(F.flatten(F.collect_list("leaks"))).alias("leaks"))
    rows = rows.withColumn("__sha", F.sha2(F.coalesce("__text", F.lit("")), 256)).drop("__text").join(every, "__sha", "left")
    return rows.select(*own, F.coalesce("leaks", F.array().cast(LEAKS)).alias("leaks")).toDF(*keep, "leaks")
