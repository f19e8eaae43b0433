"""Document fingerprints from prefix polynomial hashes.

The prefix arrays of a text hold the polynomial hash of each of its prefixes, modulo two primes. Two subtractions and a multiplication give
the hash of any span from them, so equality of any two spans takes constant time, and the longest common extension of two places is found by
binary search (``Prefixes``).

A fingerprint is a text's prefix arrays at places that the text itself chooses: where the hash of the ``WINDOW`` characters that follow ends
in enough zero bits, ``most`` places at most. Shared passages are cut alike wherever they stand, and a sparser choice is part of a denser
one, so fingerprints of texts of any two lengths are compared at the places of the sparser. Likeness looks for the spans of one between those
of the other, extends each common one by binary search over the prefix hashes as far as both agree, and is the smaller share of characters so
covered, from 0 to 1, of the longer text. Texts that repeat themselves offer few such places; so prefix hashes at ``OPENINGS`` even steps or
less are kept as well, and the longest common prefix, by binary search over these, counts where it is longer. Equal texts have equal
fingerprints and a likeness of 1, also empty ones.

The next document is that with the next smaller doc_id; after the last comes the first. Rows of equal id follow each other by a digest
of their text, rows with null ids come last in that order. Rows are dealt to tasks by ranges of this order, and the first row of each range is
sent to the range before, too, so texts are shuffled once and no task sorts all rows. Null texts are empty. Long texts are worked on in blocks
of a bounded number of characters. Columns that are kept must not have the names of those made. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, check_names, give_back, in_arrow, slices, stored

PRIMES = (2**31 - 1, 2**31 - 19)
BASES = (1_203_419_557, 864_203_711)
INVERSES = tuple(pow(b, -1, p) for b, p in zip(BASES, PRIMES, strict=True))
WINDOW = 6
OPENINGS = 16
BLOCK = 1 << 20
MADE = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
_powers: dict[int, list[np.ndarray]] = {}


def _tables(n: int) -> dict[int, list[np.ndarray]]:
    """Powers of both bases (0) and of their inverses (1), at least n of each."""
    if not _powers or len(_powers[0][0]) < n:
        for which, bases in ((0, BASES), (1, INVERSES)):
            _powers[which] = []
            for base, p in zip(bases, PRIMES, strict=True):
                powers = np.ones(1, np.uint64)
                while len(powers) < n:
                    powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), p)) % np.uint64(p)])
                _powers[which].append(powers)
    return _powers


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def prefix_sums(codes: np.ndarray) -> list[np.ndarray]:
    """For both primes the hash of each prefix: the sum of code point + 1 times the base to the power of its place."""
    powers = _tables(len(codes) + 1)[0]
    out = []
    for k, p in enumerate(PRIMES):
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[k][: len(codes)] % np.uint64(p), out=sums[1:])
        out.append(sums % np.uint64(p))
    return out


class Prefixes:
    """The prefix arrays of one text: hashes of spans, equality of spans, longest common extensions."""

    def __init__(self, text: str):
        self.n, self.sums = len(text), prefix_sums(_codes(text))

    def span(self, begin: int, end: int) -> tuple[int, ...]:
        return tuple((int(s[end]) - int(s[begin])) * pow(i, begin, p) % p for s, i, p in zip(self.sums, INVERSES, PRIMES, strict=True))

    def equal(self, begin: int, other: "Prefixes", at: int, length: int) -> bool:
        return self.span(begin, begin + length) == other.span(at, at + length)

    def extension(self, begin: int, other: "Prefixes", at: int) -> int:
        """How many characters agree from ``begin`` here and ``at`` there on."""
        low, high = 0, min(self.n - begin, other.n - at)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(begin, other, at, middle) else (low, middle - 1)
        return low


@dataclass
class Fingerprint:
    """Length, hash of the whole text, hashes of its prefixes at even steps, least number of zero bits at the places that it chooses, and
    these: place, zero bits, hash of the prefix that ends there."""

    n: int
    whole: tuple[int, int]
    openings: list[tuple[int, int]]
    level: int
    places: list[tuple[int, int, int, int]]
    _at: dict[int, tuple[list[int], list[tuple[int, int]], list[tuple[int, int]], dict]] = field(default_factory=dict, compare=False, repr=False)

    def __str__(self) -> str:
        number = lambda a, b: f"{a:08x}{b:08x}"
        steps, places = "".join(number(*h) for h in self.openings), ";".join(f"{at:x}:{bits:x}:{number(a, b)}" for at, bits, a, b in self.places)
        return f"{self.n:x}:{self.level:x}:{number(*self.whole)}/{steps}/{places}"

    @classmethod
    def parse(cls, text: str) -> "Fingerprint":
        head, steps, places = text.split("/")
        number = lambda x: (int(x[:8], 16), int(x[8:], 16))
        n, level, whole = head.split(":")
        chosen = [(int(at, 16), int(bits, 16), *number(h)) for at, bits, h in (x.split(":") for x in places.split(";") if x)]
        return cls(int(n, 16), number(whole), [number(steps[i : i + 16]) for i in range(0, len(steps), 16)], int(level, 16), chosen)

    def cut(self, level: int) -> tuple[list[int], list[tuple[int, int]], list[tuple[int, int]], dict]:
        """At the places of this level, begin and end included: places, prefix hashes, inverse powers, and where each span's hash starts a span."""
        if level not in self._at:
            rows = [(0, 0, 0), *((at, a, b) for at, bits, a, b in self.places if bits >= level), (self.n, *self.whole)]
            at, hashes = [r[0] for r in rows], [r[1:] for r in rows]
            inverse = [(pow(INVERSES[0], x, PRIMES[0]), pow(INVERSES[1], x, PRIMES[1])) for x in at[:-1]]
            starts: dict = {}
            for i in range(len(at) - 1):
                starts.setdefault(_between(at, hashes, inverse, i, 1), []).append(i)
            self._at[level] = at, hashes, inverse, starts
        return self._at[level]


def _between(at, hashes, inverse, i: int, k: int) -> tuple[int, int, int]:
    """Length and hash of the span from the place number i to the k-th after it."""
    (a, b), (c, d), (x, y) = hashes[i], hashes[i + k], inverse[i]
    return at[i + k] - at[i], (c - a) * x % PRIMES[0], (d - b) * y % PRIMES[1]


def _covered(one: tuple, other: tuple) -> int:
    """Characters of one in spans that stand in the other, each extended as far as both agree, from left to right."""
    at, hashes, inverse, _ = one
    total = i = 0
    while i < len(at) - 1:
        best = 0
        for j in other[3].get(_between(at, hashes, inverse, i, 1), ()):
            low, high = 1, min(len(at) - i, len(other[0]) - j) - 1
            while low < high:
                k = (low + high + 1) // 2
                same = _between(at, hashes, inverse, i, k) == _between(*other[:3], j, k)
                low, high = (k, high) if same else (low, k - 1)
            best = max(best, low)
        if best and at[i + best] - at[i] >= WINDOW:
            total += at[i + best] - at[i]
        i += best or 1
    return total


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    if (a.n, a.whole) == (b.n, b.whole):
        return 1.0
    if not a.n or not b.n:
        return 0.0
    level = max(a.level, b.level)
    one, other = a.cut(level), b.cut(level)
    return max(min(_covered(one, other), _covered(other, one)), _opening(a, b)) / max(a.n, b.n)


def step_of(n: int) -> int:
    """The least power of two of which n holds OPENINGS or less."""
    step = 1
    while n // step > OPENINGS:
        step *= 2
    return step


def _opening(a: Fingerprint, b: Fingerprint) -> int:
    """The longest common prefix, to a step of the longer text."""
    step = max(step_of(a.n), step_of(b.n))
    one, other = (x.openings[step // step_of(x.n) - 1 :: step // step_of(x.n)] for x in (a, b))
    low, high = 0, min(len(one), len(other))
    while low < high:
        k = (low + high + 1) // 2
        low, high = (k, high) if one[k - 1] == other[k - 1] else (low, k - 1)
    return low * step


def _window_bits(sums: list[np.ndarray], n: int) -> np.ndarray:
    """32 mixed bits of the window that begins at each place, for the places where one fits."""
    p = np.uint64(PRIMES[0])
    h = (sums[0][WINDOW:] + p - sums[0][: n + 1 - WINDOW]) * _tables(n + 1)[1][0][: n + 1 - WINDOW] % p
    return (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)


def _zeros(bits: np.ndarray) -> np.ndarray:
    """How many zero bits each number ends in, 32 for zero."""
    wide = bits.astype(np.int64) | 1 << 32
    return np.log2((wide & -wide).astype(np.float64)).astype(np.int64)


def _first_level(n: int, most: int) -> int:
    return max(0, (n // most).bit_length() - 2)


def _chosen(n: int, whole: tuple[int, int], openings: list[tuple[int, int]], level: int, rows: list[tuple[int, int, int, int]], most: int) -> Fingerprint:
    while len(rows) > most:
        level += 1
        rows = [r for r in rows if r[1] >= level]
    return Fingerprint(n, whole, openings, level, rows)


def fingerprints(texts: list[str], most: int = 32) -> list[Fingerprint]:
    """Of each text; short ones in groups, long ones in blocks."""
    out: list[Fingerprint | None] = [None] * len(texts)
    group: list[int] = []
    held = 0
    for i, text in enumerate(texts):
        if len(text) > BLOCK:
            out[i] = _of_long(text, most)
            continue
        if held + len(text) > BLOCK:
            _of_group(texts, group, out, most)
            group, held = [], 0
        group.append(i)
        held += len(text)
    _of_group(texts, group, out, most)
    return out


def _of_group(texts: list[str], group: list[int], out: list[Fingerprint | None], most: int) -> None:
    if not group:
        return
    lengths = np.array([len(texts[i]) for i in group], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)])
    n = int(begins[-1])
    sums = prefix_sums(_codes("".join(texts[i] for i in group)))
    inverse = _tables(n + 1)[1]
    prefix = lambda at, begin: [(s[at] + np.uint64(p) - s[begin]) * v[begin] % np.uint64(p) for s, v, p in zip(sums, inverse, PRIMES, strict=True)]
    levels = [_first_level(int(x), most) for x in lengths]
    found = np.empty(0, np.int64)
    if n >= WINDOW:
        bits = _window_bits(sums, n)
        masks = np.repeat(np.array([(1 << x) - 1 for x in levels], np.uint32), lengths)[: len(bits)]
        found = np.flatnonzero((bits & masks) == 0)
        doc = np.searchsorted(begins, found, side="right") - 1
        inside = (found > begins[doc]) & (found + WINDOW <= begins[doc + 1])
        found, doc = found[inside], doc[inside]
        zeros, (h1, h2) = _zeros(bits[found]), prefix(found, begins[doc])
        rows = list(zip((found - begins[doc]).tolist(), zeros.tolist(), h1.tolist(), h2.tolist(), strict=True))
        edges = np.searchsorted(doc, np.arange(len(group) + 1))
    else:
        rows, edges = [], np.zeros(len(group) + 1, np.int64)
    w1, w2 = (x.tolist() for x in prefix(begins[1:], begins[:-1]))
    steps = np.array([step_of(int(x)) for x in lengths], np.int64)
    counts = lengths // steps
    until = np.concatenate([[0], np.cumsum(counts)])
    own = np.repeat(np.arange(len(group)), counts)
    at = begins[own] + (np.arange(until[-1]) - until[own] + 1) * steps[own]
    openings = list(zip(*(x.tolist() for x in prefix(at, begins[own])), strict=True))
    for k, i in enumerate(group):
        out[i] = _chosen(int(lengths[k]), (w1[k], w2[k]), openings[until[k] : until[k + 1]], levels[k], rows[edges[k] : edges[k + 1]], most)


def _of_long(text: str, most: int) -> Fingerprint:
    n, level = len(text), _first_level(len(text), most)
    carried, rows, openings, step = [0, 0], [], [], step_of(n)
    for begin in range(0, n, BLOCK):
        codes = _codes(text[begin : begin + BLOCK + WINDOW - 1])  # windows reach into the next block
        sums = prefix_sums(codes)
        shift = [pow(b, begin, p) for b, p in zip(BASES, PRIMES, strict=True)]
        here = lambda at: [(carried[k] + int(sums[k][at]) * shift[k]) % PRIMES[k] for k in (0, 1)]  # noqa: B023, E731
        if len(codes) >= WINDOW:
            bits = _window_bits(sums, len(codes))[:BLOCK]
            found = np.flatnonzero((bits & np.uint32((1 << level) - 1)) == 0)
            zeros = _zeros(bits[found])
            while len(rows) + len(found) > max(1 << 16, most) and level < 33:  # one passage again and again: fewer places, as at the end
                level += 1
                rows, found, zeros = [r for r in rows if r[1] >= level], found[zeros >= level], zeros[zeros >= level]
            rows += [(begin + at, z, *here(at)) for at, z in zip(found.tolist(), zeros.tolist(), strict=True) if begin + at]
        openings += [tuple(here(at)) for at in range(step - begin % step, min(BLOCK, n - begin) + 1, step)]
        carried = here(min(BLOCK, n - begin))
    return _chosen(n, tuple(carried), openings, level, rows, most)


def _bucket(bounds: list[tuple]):
    @F.pandas_udf("int")
    def at(missing: pd.Series, turned: pd.Series, digest: pd.Series) -> pd.Series:
        return pd.Series([bisect_left(bounds, key) for key in zip(missing, turned, digest, strict=True)], dtype="int32")

    return at


ORDER = ("missing", "turned", "digest")


def _ordered(df: DataFrame, doc_id: str) -> DataFrame:
    """Adds what rows are ordered by: from the largest id to the smallest, then those without, equal ids by a digest."""
    turned = F.coalesce(F.bitwise_not(F.col(doc_id).cast("long")), F.lit(0))
    return df.select("*", F.col(doc_id).isNull().alias("missing"), turned.alias("turned"), F.xxhash64("text").alias("digest"))


def fingerprint_documents(df: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ("doc_id",), most: int = 32, sampled: int = 20) -> DataFrame:
    """The kept columns with n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of each row.

    The edited text has its last ``n_chars // 2`` code points replaced by the first as many of the next document's (all, if it has fewer)."""
    check_names(keep, MADE)
    spark = df.sparkSession
    rows = _ordered(df.select(F.struct(*keep).alias("kept"), F.col(doc_id).alias("id"), as_text(text).alias("text")), "id").drop("id")
    keys = stored(rows.select(*ORDER))
    n, tasks = keys.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, min(4 * tasks, n // 8))
    drawn = sorted(tuple(r) for r in keys.sample(min(1.0, sampled * buckets / max(n, 1)), seed=1).collect())  # about `sampled` for each bucket: only where ranges end depends on it
    bounds = sorted({drawn[len(drawn) * i // buckets] for i in range(1, buckets)}) if drawn else []
    at = _bucket(bounds)(*ORDER)
    firsts = keys.select(F.struct(*ORDER).alias("key"), at.alias("bucket")).groupBy("bucket").agg(F.min("key").alias("key")).orderBy("bucket").collect()  # a row for each range
    before = [(*r["key"], firsts[i - 1]["bucket"]) for i, r in enumerate(firsts)]  # the first range's first row follows the last range
    wanted = spark.createDataFrame(before, "missing boolean, turned bigint, digest bigint, earlier int")
    marked = rows.join(F.broadcast(wanted), list(ORDER), "left").withColumn("bucket", at)
    places = F.array_compact(F.array(F.struct("bucket", F.lit(False).alias("copy")), F.when(F.col("earlier").isNotNull(), F.struct(F.col("earlier").alias("bucket"), F.lit(True).alias("copy")))))
    dealt = marked.select("kept", "text", *ORDER, F.inline(places)).repartition(tasks, "bucket").sortWithinPartitions("bucket", "copy", *ORDER, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # text and fingerprint of the row that waits for its next, with the batch and place of its kept columns
        for batch in slices(batches, 1, 1_000_000):
            texts = ["" if x is None else x.decode("utf-8", "replace") for x in batch.column(1).cast(pa.binary()).to_pylist()]
            copies, prints = batch.column(2).to_pylist(), fingerprints(texts, most)
            pairs = []
            for i, now in enumerate(zip(texts, prints, strict=True)):
                if last is not None:
                    pairs.append((*last, *now))
                last = None if copies[i] else (batch.column(0).slice(i, 1), *now)
            edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for _, a, _, b, _ in pairs]
            made = [(len(a), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), str(p), str(q), likeness(p, q), likeness(p, r)) for (_, a, p, _, r), e, q in zip(pairs, edited, fingerprints(edited, most), strict=True)]
            if made:
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([p[0] for p in pairs]), *(pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True))], ["kept", *MADE])
        give_back()

    kind = rows.schema["kept"].dataType.simpleString()
    schema = f"kept {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_arrow(dealt.select("kept", "text", "copy"), run, schema).select("kept.*", *MADE)
