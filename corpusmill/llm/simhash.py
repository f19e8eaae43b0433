"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A 64-bit fingerprint has a bit where over half of a text's shingle hashes have it. Two fingerprints within radius r share a variant that
is at most r // 2 bits from one and at most r - r // 2 bits from the other. Every distinct fingerprint emits all its variants within
the larger half, marked near when within the smaller; the variants meet in one shuffle. In a variant's bucket each member is within r of
every near member, so linking all to one near member keeps every component, and no bucket is paired out: it holds distinct fingerprints
around one point, 65 at most for radius 2 or 3. Links are made distinct and verified by their differing bits. Components of the links
over distinct fingerprints then give each document the least id it can reach.

Copies of a text share a fingerprint, so groups of any size cost one row.

Rows: null and empty texts have no words and the fingerprint zero, which links like any other. Rows with a null id keep their row and get
the component of their fingerprint. Repeated rows stay repeated. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, map_slices, raw
from .components import components


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 with seed 42 of every shingle of A-Z lower-cased words; of the whole sequence if there are fewer words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(line, 42)], np.uint64)
    starts = np.zeros(len(words) + 1, np.int64)
    starts[1:] = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins, ends = starts[: len(words) - width + 1].tolist(), (starts[width:] - 1).tolist()
    return np.fromiter((digest(line[a:b], 42) for a, b in zip(begins, ends, strict=True)), np.uint64, len(begins))


def fingerprint(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i : i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.flatnonzero(2 * counts > len(hashes))
    return sum(1 << int(b) for b in bits)


def fingerprints(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", width: int = 3) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed 64-bit number."""

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        prints = [fingerprint(shingle_hashes(t, width)) for t in raw(part.column(1))]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return map_slices(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), make, "doc_id bigint, fp bigint", 1)


def ball(radius: int) -> list[int]:
    """Masks of at most ``radius`` bits, as signed numbers."""
    masks = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Distinct pairs ``a``, ``b`` of the distinct fingerprints ``fp`` that differ in at most ``radius`` bits: enough of them to connect all such pairs."""
    near, far = radius // 2, radius - radius // 2
    masks = F.array(*[F.lit(m) for m in ball(far)])
    dealt = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")  # few bytes now, many rows next
    variants = dealt.select("fp", F.explode(masks).alias("mask"))
    variants = variants.select(F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), "fp", (F.bit_count("mask") <= near).alias("near"))
    hub = F.min(F.when(F.col("near"), F.col("fp"))).over(Window.partitionBy("variant"))
    pairs = variants.select(hub.alias("a"), F.col("fp").alias("b")).where("a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", width: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, ``fp`` and component_id, the least doc_id that links lead to."""
    marked = checkpointed(fingerprints(df, text=text, doc_id=doc_id, width=width))
    prints = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(prints.select("fp"), radius))
    rooted = prints.join(found, prints["fp"] == found["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(ids, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")
