"""Byte-level BPE: corpus-level merge replay, and decoding.

Texts are split by a pattern, letters and numbers being those of the tokenizer library's Unicode tables. The distinct pieces of a block of
texts that no earlier block of the task had are laid out as one array of tokens. An inverted index leads from the rank of a pair of neighbours to the positions where such a pair stands; a queue hands out the
ranks in order. A merge joins the two tokens at each position of its rank, from left to right, and indexes only the pairs with the
neighbours it touched. Where that makes a pair of a lower rank, the lower rank goes first and the rest of the positions wait. So within each
piece merges come as in a tokenizer: lowest rank first, leftmost first. A piece that is a token itself is that token.

Pieces already encoded are kept from block to block, up to ``CACHE`` of them; then only those of the block at hand stay.

Rows: null is the empty text, which has no tokens. Texts of any length go in whole. Repeated rows and null ids stay; an empty table
gives an empty result; only the named columns are read, and kept ones named as those that are made are an error that names them.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import check_names, give_back, in_arrow, slices

CACHE = 150_000


@dataclass(frozen=True)
class Vocabulary:
    """Ranks by bytes, as in a .tiktoken file, and the pattern that splits texts."""

    ranks: dict[bytes, int]
    pattern: str
    #: code point -> one that stands for it when texts are split
    stands_for: dict[int, str] = field(default_factory=dict)

    @classmethod
    def read(cls, path: str, pattern: str) -> "Vocabulary":
        """From a file on the driver; vocabularies have a fixed size and are broadcast."""
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern, other_classes())

    @cached_property
    def codec(self) -> "Codec":
        """One for each worker; its tables serve every task, its pieces are forgotten with the task."""
        return Codec(self)


@lru_cache
def other_classes() -> dict[int, str]:
    """Code points that are letters or numbers by this library's Unicode tables but not by the tokenizer library's, or the other way about, each
    with one that has the tokenizer library's class in both."""
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    bytes_ = {bytes([i]): i for i in range(256)}
    sets = []
    for kind in (r"\p{L}", r"\p{N}"):
        there = set(bytes(tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=bytes_, special_tokens={}).encode_ordinary(every)).decode())
        sets.append((there, set(regex.findall(kind, every))))
    (letters, ours), (numbers, our_numbers) = sets
    return {ord(c): "\u00aa" if c in letters else "\u00b2" if c in numbers else "\u00a4" for c in (letters ^ ours) | (numbers ^ our_numbers)}


SHIFT = 20  # ranks are below 2**SHIFT


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        self.ranks = ranks = vocabulary.ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.above = max(ranks.values()) + 1
        self.findall, self.finditer = regex.compile(vocabulary.pattern).findall, regex.compile(vocabulary.pattern).finditer
        self.stands_for = vocabulary.stands_for
        self.odd = np.zeros(0x110000, bool)
        self.odd[list(self.stands_for)] = True
        self.forget()
        #: rank of what two tokens make together
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                if (a := ranks.get(token[:cut])) is not None and (b := ranks.get(token[cut:])) is not None:
                    self.pairs[a << SHIFT | b] = rank
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.byte_pairs = np.array([[self.pairs.get(int(a) << SHIFT | int(b), -1) for b in self.bytes] for a in self.bytes], np.int64)

    def split(self, text: str) -> list[str]:
        """The pieces of a text. Where it has code points of another class, these are exchanged while it is split."""
        if text.isascii() or not self.odd[np.frombuffer(text.encode("utf-32-le"), "<u4")].any():
            return self.findall(text)
        return [text[m.start() : m.end()] for m in self.finditer(text.translate(self.stands_for))]

    def forget(self) -> None:
        """No piece is known; ``ids`` holds the tokens of the known ones, one after the other."""
        self.known: dict[str, int] = {}
        self.ids, self.begins, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def tokens_of(self, pieces: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of known pieces, one after the other, and where each piece ends."""
        at = np.fromiter(map(self.known.__getitem__, pieces), np.int64)
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        return self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[at] - ends + sizes, sizes)], ends

    def keep(self, pieces: list[str]) -> None:
        """Forget all but these, which the block at hand has: words that are frequent stay."""
        ids, ends = self.tokens_of(pieces)
        self.known = {p: i for i, p in enumerate(pieces)}
        self.ids, self.sizes = ids, np.diff(ends, prepend=0)
        self.begins = ends - self.sizes

    def learn(self, pieces: list[str]) -> None:
        ids, sizes = self.replay(pieces)
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces)), strict=True))
        self.begins = np.append(self.begins, len(self.ids) + np.cumsum(sizes) - sizes)
        self.ids, self.sizes = np.append(self.ids, ids), np.append(self.sizes, sizes)

    def encode_batch(self, texts: Iterable[str]) -> list[np.ndarray]:
        texts = [self.split(t) for t in texts]
        distinct = set().union(*texts)
        if new := distinct.difference(self.known):
            if len(self.known) + len(new) > CACHE:
                self.keep(sorted(distinct - new))
            self.learn(sorted(new))
        ids, ends = self.tokens_of(chain.from_iterable(texts))
        cuts = np.append(0, ends)[np.cumsum([len(pieces) for pieces in texts[:-1]], dtype=np.int64)] if len(texts) > 1 else []
        return np.split(ids, cuts)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def replay(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all pieces, and how many each has, by one replay of the merges over all of them."""
        coded = [p.encode() for p in pieces]
        data = np.frombuffer(b"".join(coded), np.uint8)
        n = len(data)
        ends = np.cumsum([len(b) for b in coded]) if coded else np.empty(0, np.int64)
        token = self.bytes[data].tolist()
        ahead, back = np.arange(1, n + 1), np.arange(-1, n - 1)
        first = self.byte_pairs[data[:-1], data[1:]] if n > 1 else np.empty(0, np.int64)
        first = np.append(first, -1)[:n]
        for k, b in enumerate(coded):
            if (rank := self.ranks.get(b)) is not None:  # a token as it is
                begin, end = ends[k] - len(b), ends[k]
                first[begin:end] = -1
                token[begin:end] = [rank] + [-1] * (len(b) - 1)
        if n:
            ahead[ends - 1], first[ends - 1] = -1, -1
            back[0], back[ends[:-1]] = -1, -1
        by_rank = np.argsort(first, kind="stable")[np.count_nonzero(first < 0) :]
        cuts = np.flatnonzero(np.diff(first[by_rank])) + 1
        index: list[list[int]] = [[] for _ in range(self.above)]
        standing = by_rank.tolist()
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(standing)], strict=True):
            if b > a:
                index[int(first[standing[a]])] = standing[a:b]
        ahead, back, now = ahead.tolist(), back.tolist(), first.tolist()
        queue, pairs, push = np.unique(first[by_rank]).tolist(), self.pairs.get, heapq.heappush
        while queue:
            rank = heapq.heappop(queue)
            places, index[rank] = index[rank], []
            places.sort()
            high = rank << SHIFT
            for k, i in enumerate(places):
                if now[i] != rank:
                    continue
                j = ahead[i]
                token[i], now[j] = rank, -1
                ahead[i] = after = ahead[j]
                token[j] = -1
                lower = False
                if after >= 0:
                    back[after] = i
                    now[i] = made = pairs(high | token[after], -1)
                    if made >= 0:
                        if not (waiting := index[made]):
                            push(queue, made)
                        waiting.append(i)
                        lower = made <= rank
                else:
                    now[i] = -1
                before = back[i]
                if before >= 0:
                    now[before] = made = pairs(token[before] << SHIFT | rank, -1)
                    if made >= 0:
                        if not (waiting := index[made]):
                            push(queue, made)
                        waiting.append(before)
                        lower = lower or made <= rank
                if lower:
                    if not index[rank] and k + 1 < len(places):
                        push(queue, rank)
                    index[rank] += places[k + 1 :]
                    break
        made = np.array(token, np.int64)
        stay = made >= 0
        counts = np.append(0, np.cumsum(stay))
        return made[stay].astype(np.uint32), np.diff(counts[np.append(0, ends)])


ENCODED = "ids binary, n_tokens bigint, decoded binary"


def encode(df: DataFrame, vocabulary: Vocabulary, *, text: str = "text", keep: tuple[str, ...] = (), rows: int = 1024) -> DataFrame:
    """``keep`` columns with the ids (little-endian unsigned 32-bit numbers), their number and the bytes that they decode to."""
    check_names(keep, ("ids", "n_tokens", "decoded"))
    spark: SparkSession = df.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    chosen = df.select(*[F.col(k) for k in keep], F.col(text).cast("string").alias("__text"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in chosen.schema.fields[:-1])
    at = len(chosen.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value.codec
        for part in slices(batches, at, 1_000_000, rows):
            ids, counts, decoded = [], [], []
            for tokens in codec.encode_batch("" if t is None else t for t in part.column(at).to_pylist()):
                ids.append(tokens.astype("<u4").tobytes())
                counts.append(len(tokens))
                decoded.append(codec.decode(tokens.tolist()))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(ids, pa.binary()), pa.array(counts, pa.int64()), pa.array(decoded, pa.binary())], [*part.schema.names[:-1], "ids", "n_tokens", "decoded"])
        codec.forget()
        give_back()

    return in_arrow(chosen, run, kept + ENCODED)


def decode(df: DataFrame, vocabulary: Vocabulary, *, ids: str = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns with ``decoded``, the bytes of the ids; null where the ids are null."""
    check_names(keep, ("decoded",))
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    chosen = df.select(*[F.col(k) for k in keep], F.col(ids).alias("__ids"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in chosen.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value.codec
        for batch in batches:
            out = [None if b is None else codec.decode(np.frombuffer(b, "<u4").tolist()) for b in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.binary())], [*batch.schema.names[:-1], "decoded"])

    return chosen.mapInArrow(run, kept + "decoded binary")
