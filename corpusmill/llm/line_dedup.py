"""Line deduplication with two Bloom filters, for hashes seen once and seen twice.

Each task adds the keys of its documents' lines to a pair of filters: a key whose bits all stand in the first is added to the second.
Pairs are merged bit by bit: a bit is in the merged second filter if it is in either second filter or in both first ones, so a key that two
tasks have is in it. The merged second filter is broadcast. Only keys that it has are shuffled, as 128-bit digests, to be counted exactly
and to learn which document keeps them; a filter that is too full sends more keys there and changes no result.

Texts are not shuffled but those of documents that may lose a line, which a filter over their ids tells from the rest. Keys that very
many documents have are broadcast instead of joined, so that none fills a task.

The filters have 8 bits for each line that ``lines_per_document`` leads to expect, ``most_bits`` at most, and so a fixed largest size.

A key is a line stripped of blanks at both ends with A-Z lower-cased. Keys of at least ``least_chars`` code points in at least
``least_documents`` documents lose their lines except in the document with the largest id among those that hold them.

Rows: null and empty texts are one empty line. A document without an id keeps all lines and isn't counted. Rows that repeat an id are one
document: they count once for a line, and keep or lose it together. An empty table gives an empty result. Texts go in whole; columns that aren't
named in ``keep`` are not read, and kept ones named text, n_lines or n_dropped are an error that names them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, check_names, checkpointed, chosen, id_filter, in_arrow, map_slices, raw

CHUNK = 1 << 14
PROBES = 4


def line_keys(text: bytes, least_chars: int) -> list[bytes | None]:
    """The digest of each line's key; None for keys that are too short to count."""
    out: list[bytes | None] = []
    for line in text.split(b"\n"):
        key = line.strip(BLANKS)
        if len(key) < least_chars or (not key.isascii() and len(key.decode()) < least_chars):
            out.append(None)
        else:
            out.append(xxhash.xxh3_128_digest(key.lower()))
    return out


class Filters:
    """The once-seen and the twice-seen filter of one task."""

    def __init__(self, bits: int):
        self.mask = np.uint64(bits - 1)
        self.once, self.twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def positions(self, hashes: np.ndarray) -> np.ndarray:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        with np.errstate(over="ignore"):
            return np.stack([(hashes + np.uint64(i) * step) & self.mask for i in range(PROBES)])

    @staticmethod
    def has(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
        return ((filter_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(0)

    @staticmethod
    def put(filter_: np.ndarray, at: np.ndarray) -> None:
        flat = at.ravel()
        np.bitwise_or.at(filter_, flat >> np.uint64(3), np.uint8(1) << (flat & np.uint64(7)).astype(np.uint8))

    def add(self, hashes: np.ndarray) -> None:
        distinct, counts = np.unique(hashes, return_counts=True)
        at = self.positions(distinct)
        self.put(self.twice, at[:, (counts > 1) | self.has(self.once, at)])
        self.put(self.once, at)


def _hashes(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64)[::2] if digests else np.empty(0, np.uint64)


def twice_seen(docs: DataFrame, bits: int, least_chars: int) -> bytes:
    """The merged twice-seen filter over doc_id and text."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(bits)
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                found = [k for t in raw(batch.column(1).slice(begin, 1024)) for k in {*line_keys(t, least_chars)} if k]
                filters.add(_hashes(found))
        for i in range(0, bits // 8, CHUNK):
            once, twice = filters.once[i : i + CHUNK], filters.twice[i : i + CHUNK]
            if once.any():
                yield pa.RecordBatch.from_arrays([pa.array([i // CHUNK], pa.int32()), pa.array([once.tobytes()], pa.binary()), pa.array([twice.tobytes()], pa.binary())], ["chunk", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks come sorted, so that one pair is held at a time."""
        last, once, twice = None, None, None
        for batch in batches:
            for chunk, o, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                o, t = np.frombuffer(o, np.uint8), np.frombuffer(t, np.uint8)
                if chunk != last:
                    if last is not None and twice.any():
                        yield pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([twice.tobytes()], pa.binary())], ["chunk", "twice"])
                    last, once, twice = chunk, o.copy(), t.copy()
                else:
                    twice |= t | (once & o)
                    once |= o
        if last is not None and twice.any():
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([twice.tobytes()], pa.binary())], ["chunk", "twice"])

    tasks = max(1, 2 * docs.sparkSession.sparkContext.defaultParallelism)
    parts = in_arrow(docs.coalesce(tasks), build, "chunk int, once binary, twice binary")
    merged = parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(merge, "chunk int, twice binary")
    whole = np.zeros(bits // 8, np.uint8)
    for row in merged.collect():  # at most bits / 8 bytes, however many documents
        part = np.frombuffer(row["twice"], np.uint8)
        whole[row["chunk"] * CHUNK : row["chunk"] * CHUNK + len(part)] = part
    return whole.tobytes()


def filter_bits(documents: int, lines_per_document: int, most_bits: int) -> int:
    wanted = 8 * max(1, documents) * lines_per_document
    return min(max(1 << 20, 1 << (wanted - 1).bit_length()), most_bits)


def dedup_lines(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), least_chars: int = 20, least_documents: int = 3, lines_per_document: int = 16, most_bits: int = 1 << 28) -> DataFrame:
    """``keep`` columns, ``text`` without the lines that go, n_lines and n_dropped."""
    check_names(keep, ("text", "n_lines", "n_dropped"))
    docs = df.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).cast("string").alias("__text"))
    known = docs.where("__id IS NOT NULL")
    bits = filter_bits(docs.count(), lines_per_document, most_bits)
    shared = df.sparkSession.sparkContext.broadcast(twice_seen(known, bits, least_chars))

    def suspect(part: pa.RecordBatch) -> pa.RecordBatch:
        digests, ids = [], []
        for i, t in zip(part.column(0).to_pylist(), raw(part.column(1)), strict=True):
            own = [k for k in {*line_keys(t, least_chars)} if k]
            digests += own
            ids += [i] * len(own)
        filters = Filters.__new__(Filters)
        filters.mask = np.uint64(bits - 1)
        found = np.flatnonzero(filters.has(np.frombuffer(shared.value, np.uint8), filters.positions(_hashes(digests))))
        return pa.RecordBatch.from_arrays([pa.array([digests[i] for i in found], pa.binary()), pa.array([ids[i] for i in found], pa.int64())], ["key", "__id"])

    suspects = checkpointed(map_slices(known, suspect, "key binary, __id bigint", 1))
    kept = checkpointed(suspects.distinct().groupBy("key").agg(F.count("*").alias("n"), F.max("__id").alias("last")).where(F.col("n") >= least_documents))
    # keys that a thousandth of all suspects have are fewer than a thousand, and are broadcast: none of them fills a task
    often = F.col("n") > F.lit(suspects.count() / 1000)
    hot, cold = F.broadcast(kept.where(often).select("key", "last")), kept.where(~often).select("key", "last")
    lost = suspects.join(hot, "key").unionByName(suspects.join(hot.select("key"), "key", "left_anti").join(cold, "key")).where("__id < last")
    lost = checkpointed(lost.groupBy("__id").agg(F.collect_set("key").alias("__lost")))
    marks = df.sparkSession.sparkContext.broadcast(id_filter(lost, "__id", most_bits))

    own = [f"__keep{i}" for i in range(len(keep))]
    rows = df.select(F.col(doc_id).cast("long").alias("__id"), *[F.col(k).alias(o) for k, o in zip(keep, own, strict=True)], F.col(text).cast("string").alias("__text"))
    none = F.lit(None).cast("array<binary>").alias("__lost")
    # only documents that may lose lines are shuffled; the others, and those without an id, pass where they lie
    apart = lambda wanted: in_arrow(rows, chosen(marks, wanted), rows.schema)
    at_hand = apart(False).select(*own, none, "__text")
    joined = apart(True).join(lost, "__id", "left").select(*own, "__lost", "__text")
    kinds = "".join(f"`__keep{i}` {joined.schema[i].dataType.simpleString()}, " for i in range(len(keep)))

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        texts, lines, dropped = [], [], []
        for gone, t in zip(part.column(part.num_columns - 2).to_pylist(), raw(part.column(part.num_columns - 1)), strict=True):
            lines.append(t.count(b"\n") + 1)
            if gone:
                gone = {*gone}
                stay = [line for line, key in zip(t.split(b"\n"), line_keys(t, least_chars), strict=True) if key not in gone]
                texts.append(b"\n".join(stay))
                dropped.append(lines[-1] - len(stay))
            else:
                texts.append(t)
                dropped.append(0)
        made = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
        return pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *made], [*part.schema.names[: len(keep)], "text", "n_lines", "n_dropped"])

    parts = [map_slices(part, cut, f"{kinds}text string, n_lines bigint, n_dropped bigint", len(keep) + 1) for part in (at_hand, joined)]
    return parts[0].unionByName(parts[1]).toDF(*keep, "text", "n_lines", "n_dropped")
