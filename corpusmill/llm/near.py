"""Near-duplicates by SimHash ball hashing, verified by exact shingle similarity, and a second route for what fingerprints cannot reach:
texts whose sets of word shingles have a Jaccard similarity of at least 0.8.

Texts with the same words in the same order, A-Z lower-cased, are one node, named by 64 bits of a digest of these words. Every node has a
64-bit SimHash of its shingles. Fingerprints within ``radius`` meet as in ``simhash``: each emits its variants within half the radius, and
pairs that collide are candidates. At a similarity of 0.8, though, fingerprints differ in 10 bits with a deviation of 3, and balls of half of
20 bits have 10**10 variants. So every node also has 32 keys, each a digest of 4 minima of its shingles' hashes. Of a pair at similarity s
each key agrees with probability s ** 4, so a pair at 0.8 has no key in common with probability (1 - 0.8 ** 4) ** 32 < 5e-8, a closer one with less.

Nodes with a key in common are a bucket. First, each is compared with the least of its bucket and with those that its fingerprint meets, and
components are made of the pairs found.
Then buckets that still hold several components are compared in full, in pairs of blocks of ``block`` nodes each, so a task holds two
blocks and no bucket is collected; no bucket is capped. All comparisons are exact, over sets of 64-bit hashes of the shingles.

Shingles are of ``width`` words, the whole sequence where there are fewer. Texts without words are one node that links with no other. An
empty table gives an empty result. The similarity of members of a component to each other can be less: they are linked by others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, chosen, give_back, id_filter, in_arrow, map_slices, raw
from .components import components
from .simhash import fingerprint, links
from .words import Words, mix

BANDS, ROWS = 32, 4
_RANDOM = np.random.default_rng(20250805)
_FLIPS = _RANDOM.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64)
_FACTORS = _RANDOM.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def node(text: Column) -> Column:
    """64 bits that stand for a text's words in their order."""
    line = F.regexp_replace(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), r"[ \t\n\x0B\f\r]+", " ")
    return F.xxhash64(F.trim(line))


def shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts in order, and where each text's begin, with the end."""
    words = Words([t.lower() for t in texts])
    sizes = np.diff(words.first)
    grams = words.grams(width)
    at = np.arange(len(grams))
    at = at[words.doc[at] == words.doc[at + width - 1]] if len(at) else at
    few = np.flatnonzero((sizes > 0) & (sizes < width))
    owner = np.concatenate([words.doc[at], few])
    hashes = np.concatenate([grams[at], words.stretch(words.first[few], words.first[few + 1])])
    if len(few):
        order = np.argsort(owner, kind="stable")
        owner, hashes = owner[order], hashes[order]
    return hashes, np.searchsorted(owner, np.arange(len(texts) + 1))


def keys(hashes: np.ndarray, begins: np.ndarray) -> list[np.ndarray | None]:
    """The keys of each text, None where it has no shingles."""
    own = np.flatnonzero(np.diff(begins))
    out: list[np.ndarray | None] = [None] * (len(begins) - 1)
    if not len(own):
        return out
    least = np.empty((BANDS * ROWS, len(own)), np.uint64)
    space = np.empty_like(hashes)
    for i in range(BANDS * ROWS):
        np.bitwise_xor(hashes, _FLIPS[i], out=space)
        np.multiply(space, _FACTORS[i], out=space)
        least[i] = np.minimum.reduceat(space, begins[own])
    bands = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None], len(own), 1)
    for row in range(ROWS):
        bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + least[row::ROWS])
    for i, k in enumerate(own.tolist()):
        out[k] = np.ascontiguousarray(bands[:, i]).view(np.int64)
    return out


def prints(hashes: np.ndarray, begins: np.ndarray) -> list[int | None]:
    """The fingerprint of each text as a signed number, None where it has no shingles."""
    made = [fingerprint(hashes[a:b]) if b > a else None for a, b in zip(begins[:-1], begins[1:], strict=True)]
    return [f - (1 << 64) if f is not None and f >> 63 else f for f in made]


def _met(each: DataFrame, radius: int) -> DataFrame:
    """Pairs lo, hi of nodes whose fingerprints are within the radius: of equal fingerprints each node with the least, of others the least of each."""
    known = each.where("print IS NOT NULL").select("node", "print", F.min("node").over(Window.partitionBy("print")).alias("first"))
    known = checkpointed(known)
    firsts = known.where("node = first").select(F.col("print").alias("fp"), "node")
    pairs = links(firsts.select("fp"), radius)
    pairs = pairs.join(firsts.select(F.col("fp").alias("a"), F.col("node").alias("x")), "a").join(firsts.select(F.col("fp").alias("b"), F.col("node").alias("y")), "b")
    return known.where("node <> first").select(F.col("first").alias("lo"), F.col("node").alias("hi")).unionByName(pairs.select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")))


def _linked(nodes: list[int], roots: list[int], sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Pairs of ``nodes`` with sets that similar: enough to connect all such pairs, given that equal ``roots`` are connected."""
    n, sizes = len(nodes), np.array([len(s) for s in sets], np.int64)
    shared = np.zeros((n, n), np.float32)
    known, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    place = np.cumsum(counts > 1) - 1
    common = counts[at] > 1
    at, owner = place[at[common]], owner[common]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    for begin in range(0, int(at[-1]) + 1 if len(at) else 0, 2048):
        a, b = np.searchsorted(at, [begin, begin + 2048])
        part = np.zeros((n, 2048), np.float32)
        part[owner[a:b], at[a:b] - begin] = 1
        shared += part @ part.T
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    shared = shared.astype(np.float64)
    out = []
    for i, j in np.argwhere(np.triu(shared / np.maximum(sizes[:, None] + sizes[None] - shared, 1) >= similarity, 1)).tolist():
        a, b = top(roots[i]), top(roots[j])
        if a != b:
            parent[a] = b
            out.append((nodes[i], nodes[j]))
    return out


def _compared(rows: DataFrame, sets: DataFrame, unit: list[str], similarity: float) -> DataFrame:
    """Distinct links ``a``, ``b`` among the nodes of each unit; ``rows`` have the columns of ``unit``, node and root."""
    joined = rows.join(sets, "node").select(*unit, "node", "root", "hashes")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = joined.repartition(n, *unit).sortWithinPartitions(*unit, "node")
    width = len(unit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close() -> None:
            if len(members) > 1:
                links.extend(_linked(*map(list, zip(*members, strict=True)), similarity))

        members, links, seen = [], [], None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns, strict=True):
                if row[:width] != seen:
                    close()
                    members, seen = [], row[:width]
                members.append((row[width], row[width + 1], np.frombuffer(row[width + 2], np.uint64)))
            if len(links) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], ["a", "b"])
                links.clear()
        close()
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], ["a", "b"])
        give_back()

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def near_classes(df: DataFrame, *, text: str = "text", width: int = 5, similarity: float = 0.8, radius: int = 2, block: int = 500, most_bits: int = 1 << 28) -> DataFrame:
    """node and root of every text that is linked to another: texts with equal roots are one group. Others are groups of their own."""

    def make_keys(part: pa.RecordBatch) -> pa.RecordBatch:
        made = shingles(raw(part.column(1)), width)
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(keys(*made), pa.list_(pa.int64())), pa.array(prints(*made), pa.int64())], ["node", "keys", "print"])

    def make_sets(part: pa.RecordBatch) -> pa.RecordBatch:
        hashes, begins = shingles(raw(part.column(1)), width)
        sets = [np.unique(hashes[a:b]).tobytes() for a, b in zip(begins[:-1], begins[1:], strict=True)]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["node", "hashes"])

    texts = df.select(node(F.col(text)).alias("node"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    made = map_slices(texts, make_keys, "node bigint, keys array<bigint>, print bigint", 1, most=500_000)
    each = checkpointed(made.groupBy("node").agg(F.first("keys", ignorenulls=True).alias("keys"), F.first("print", ignorenulls=True).alias("print")))
    every = Window.partitionBy("key")
    rows = each.select("node", F.explode_outer("keys").alias("key")).where("key IS NOT NULL")
    rows = rows.select("key", "node", F.min("node").over(every).alias("hub"), F.max("node").over(every).alias("last"))
    buckets = checkpointed(rows.where("hub < last").select("key", "node", "hub"))
    met = buckets.where("node <> hub").select(F.col("hub").alias("lo"), F.col("node").alias("hi")).unionByName(_met(each, radius))
    met = checkpointed(met.distinct())
    needed = buckets.select("node").unionByName(met.select(F.explode(F.array("lo", "hi")).alias("node"))).distinct()
    # only texts that are to be compared are shuffled: a filter over their nodes tells them from the rest
    marks = df.sparkSession.sparkContext.broadcast(id_filter(needed, "node", most_bits))
    compared = in_arrow(texts, chosen(marks, True), texts.schema).dropDuplicates(["node"])
    sets = checkpointed(map_slices(compared, make_sets, "node bigint, hashes binary", 1))

    pairs = met.select("lo", "hi", F.explode(F.array("lo", "hi")).alias("node"))
    found_links = checkpointed(_compared(pairs.withColumn("root", F.col("node")), sets, ["lo", "hi"], similarity))
    found = components(found_links)
    rooted = buckets.join(found, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    rooted = rooted.select("*", F.min("root").over(every).alias("low"), F.max("root").over(every).alias("high"))
    open_ = rooted.where("low < high").select("key", "node", "root", F.floor((F.row_number().over(every.orderBy("node")) - 1) / block).cast("int").alias("own"))
    units = open_.select("*", F.max("own").over(every).alias("most"))
    units = units.select("key", "node", "root", "own", F.explode(F.sequence(F.lit(0), F.col("most"))).alias("other"))
    units = units.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "node", "root")
    more = checkpointed(_compared(units, sets, ["key", "lo", "hi"], similarity))
    return components(found_links.unionByName(more))
