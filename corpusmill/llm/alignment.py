"""Alignment of two tokenizers: which tokens of one overlap which tokens of the other, and where both end at the same byte.

Tokenising alone runs in Python. It gives, for each text, the ids of both tokenizers and the byte offsets at which their tokens end. From
there on only higher-order functions and aggregations work: ``array_intersect`` of the end arrays gives the cuts, and one sort of both end
arrays gives, for each token of A, how many tokens of B end before it does. With that number ``sequence`` names the B tokens that overlap it,
so links and groups cost time in proportion to the tokens, however long a text is.

Links are counted over the corpus: how many rows hold an id pair linked, once each (rows that repeat a doc_id are documents of their own).
Pairs that many rows hold are looked up by a broadcast of at most ``most_broadcast`` pairs, so no frequent pair is shuffled; pairs beyond are
rare and are joined by a shuffle. Both give the same counts.

Null and empty texts, and texts that either tokenizer does not give back byte for byte, have no tokens: zeros, and an empty digest. Rows
with a null doc_id are kept. Columns that are kept must not have the names of those made. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import gc
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import check_names, give_back, in_arrow, slices, stored

MADE = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "links", "row")
#: Code points below this have the same classes in both libraries that split texts (tested one by one); texts beyond go to the slower one.
SHARED = "ɐ"
SPACE = "▁"
CACHE = 300_000
#: white space before a space
DOUBLE = [chr(c) + " " for c in range(0x3001) if chr(c).isspace()]


@dataclass(frozen=True)
class Tokenizers:
    """Where the files lie, on every executor: A as a tokenizer file and as ranks of the same vocabulary with its pattern, B as a model."""

    a_json: str
    a_ranks: str
    a_pattern: str
    b_model: str


@functools.cache
def byte_letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, loaded once in a worker. ``bytes_a`` and ``bytes_b``: each id's bytes.

    Neither has a token that goes from another character on to a space, so what stands from a space to the next is encoded for itself, once for
    all its occurrences: A encodes it with the space before it, B adds that space. Spaces behind white space and at the end belong to what is
    before them. ``CACHE`` such words are kept, then those of the block at hand."""

    def __init__(self, files: Tokenizers):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(files.a_json)
        self.exact.encode_special_tokens = True
        letters = byte_letters()
        self.bytes_a = [b""] * self.exact.get_vocab_size()
        for entry, id_ in self.exact.get_vocab().items():
            self.bytes_a[id_] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        with open(files.a_ranks, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        if any(self.bytes_a[rank] != token for token, rank in ranks.items()):
            raise ValueError("ranks and tokenizer file are not of one vocabulary")
        self.fast = tiktoken.Encoding("ranks", pat_str=files.a_pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("B has pieces that go on to a space: its words cannot be encoded one by one")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in table], np.int32) for table in (self.bytes_a, self.bytes_b))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.good = np.empty(0, bool)
        self.ids = [np.empty(0, np.int32), np.empty(0, np.int32)]
        self.sizes = [np.empty(0, np.int64), np.empty(0, np.int64)]
        self.begins = [np.empty(0, np.int64), np.empty(0, np.int64)]

    def keep(self, words: list[str]) -> None:
        """Forget all but these."""
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        self.known, self.good = {w: i for i, w in enumerate(words)}, self.good[at]
        for k in (0, 1):
            sizes = self.sizes[k][at]
            self.ids[k], self.sizes[k] = self._ids(k, at), sizes
            self.begins[k] = np.cumsum(sizes) - sizes

    def _ids(self, k: int, at: np.ndarray) -> np.ndarray:
        """A's (0) or B's (1) ids of these words, one after the other."""
        sizes = self.sizes[k][at]
        ends = np.cumsum(sizes)
        return self.ids[k][np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[k][at] - ends + sizes, sizes)]

    def encode_a(self, text: str) -> list[int]:
        if max(text) < SHARED:
            return self.fast.encode_ordinary(text)
        return self.exact.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def learn(self, words: list[str]) -> None:
        whole = [(" " + w).encode() for w in words]
        joined, lengths = b"".join(whole), np.fromiter(map(len, whole), np.int64, len(words))
        good = np.ones(len(words), bool)
        for k, (flat, counts) in enumerate((self._of_words(words, lengths), _flat(self.b.encode(words, num_threads=1)))):
            table, size = ((self.bytes_a, self.size_a), (self.bytes_b, self.size_b))[k]
            ends = np.cumsum(counts)
            self.begins[k] = np.append(self.begins[k], len(self.ids[k]) + ends - counts)
            self.ids[k], self.sizes[k] = np.append(self.ids[k], flat), np.append(self.sizes[k], counts)
            given = np.diff(np.append(0, np.cumsum(size[flat]))[np.append(0, ends)])
            if (given != lengths).any() or b"".join(map(table.__getitem__, flat.tolist())) != joined:  # bytes of all at once, of each only if they differ
                good &= [b"".join(map(table.__getitem__, flat[e - n : e].tolist())) == w for e, n, w in zip(ends.tolist(), counts.tolist(), whole, strict=True)]
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.good = np.append(self.good, good)

    def _of_words(self, words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of all words and how many each has; they are those of a text of these words, one after the other."""
        text = " " + " ".join(words)
        if max(text) >= SHARED or any(w in text for w in DOUBLE) or text[-1:].isspace():
            return _flat([self.encode_a(" " + w) for w in words])
        ids = np.array(self.encode_a(text), np.int32)
        return ids, np.diff(np.searchsorted(np.cumsum(self.size_a[ids]), np.cumsum(lengths)) + 1, prepend=0)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B the ids of all texts, one after the other, and how many each text has: none where either doesn't give it back."""
        split = [words(t) if t else [] for t in texts]
        new = set().union(*split).difference(self.known)
        if new and len(self.known) + len(new) > CACHE:
            self.keep(list(set().union(*split) - new))
        if new:
            self.learn(list(new))
        at = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(split)), np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in split])
        bad = np.zeros(len(texts), bool)
        bad[owner[~self.good[at]]] = True
        at, owner = at[~bad[owner]], owner[~bad[owner]]
        out = []
        for k in (0, 1):
            out.append((self._ids(k, at), np.bincount(owner, weights=self.sizes[k][at], minlength=len(texts)).astype(np.int64)))
        return out


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(counts.sum())), counts


def words(text: str) -> list[str]:
    """A text cut before each space that stands behind another character than white space, without that space."""
    parts = text.split(" ")
    if parts[0] and parts[-1] and not any(pair in text for pair in DOUBLE):
        return parts
    out, closed = [parts[0]], bool(parts[0]) and not parts[0][-1].isspace()
    for i, part in enumerate(parts[1:], 1):
        if closed and (part or i < len(parts) - 1):
            out.append(part)
        else:
            out[-1] += " " + part
        closed = bool(part) and not part[-1].isspace()
    return out


@functools.lru_cache(1)
def pair(files: Tokenizers) -> Pair:
    return Pair(files)


def tokenize_both(df: DataFrame, files: Tokenizers, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``kept`` (a struct of the kept columns), a, a_ends, b and b_ends: ids and the offsets at which they end in space + text, in half bytes."""

    def lists(ids: np.ndarray, counts: np.ndarray, size: np.ndarray) -> tuple[pa.Array, pa.Array]:
        offsets = np.concatenate([[0], np.cumsum(counts)])
        sums = np.concatenate([[0], np.cumsum(size[ids], dtype=np.int64)])
        ends = (2 * (sums[1:] - np.repeat(sums[offsets[:-1]], counts))).astype(np.int32)
        offsets = pa.array(offsets.astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.ListArray.from_arrays(offsets, pa.array(ends))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(files)
        gc.disable()  # words and ids make no cycles, and there are many
        for batch in slices(batches, 1, 1_000_000):
            texts = ["" if x is None else x.decode("utf-8", "replace") for x in batch.column(1).cast(pa.binary()).to_pylist()]
            a, b = both.encode(texts)
            columns = [batch.column(0), *lists(*a, both.size_a), *lists(*b, both.size_b)]
            yield pa.RecordBatch.from_arrays(columns, ["kept", "a", "a_ends", "b", "b_ends"])
        both.forget()
        gc.enable()
        give_back()

    rows = df.select(F.struct(*keep).alias("kept"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["kept"].dataType.simpleString()
    return in_arrow(rows, run, f"kept {kind}, a array<int>, a_ends array<int>, b array<int>, b_ends array<int>")


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once for each row, though functions inside use it for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def either(test: Column, yes: Column, no: Column) -> Column:
    """SQL's if, which is worked out faster than CASE where no code is generated, as within functions of arrays."""
    return F.call_function("if", test, yes, no)


def linked(tokens: DataFrame) -> DataFrame:
    """kept, n_a, n_b, n_groups, groups_sha256 and links (A's id times 2**32 plus B's, one for each overlap) from both tokenizers' arrays."""
    zero = F.lit(0)
    merged = F.sort_array(F.concat("a_ends", F.transform("b_ends", lambda e: e + 1)))  # ends are even: at equal ends A's stands first

    def places(merged: Column) -> Column:
        """For each token of A the first and the last token of B that overlap it, by how many of B end before A's ends do."""
        of_a = F.filter(F.sequence(zero, F.size(merged) - 1), lambda p: F.get(merged, p).bitwiseAND(1) == 0)
        high = F.transform(of_a, lambda p, i: p - i)
        following = lambda high, ends: F.zip_with(high, "a_ends", lambda n, e: n + (F.get(ends, n) == e).cast("int"))
        low = lambda high: let(F.col("b_ends"), lambda ends: F.concat(F.array(zero), following(high, ends)))
        return let(high, lambda high: let(low(high), lambda low: let(F.col("b"), lambda b: made(low, high, b))))

    def made(low: Column, high: Column, b: Column) -> Column:
        overlapping = F.transform(high, lambda h, i: F.sequence(F.get(low, i), h))
        shifted = F.transform("a", lambda id_: F.shiftleft(id_.cast("long"), 32))
        links = F.flatten(F.zip_with(shifted, overlapping, lambda x, js: F.transform(js, lambda j: x + F.get(b, j))))
        cuts = F.filter(F.sequence(zero, F.size("a") - 1), lambda i: F.get(low, i + 1) > F.get(high, i))  # tokens of A that end where one of B ends
        return let(cuts, lambda cuts: F.struct(links.alias("links"), groups(high, cuts).alias("groups")))

    def groups(high: Column, cuts: Column) -> Column:
        """Ids by group: from the token after the last cut to the one at this."""
        after = lambda lasts: F.concat(F.array(zero), F.transform(lasts, lambda i: i + 1))
        several = lambda ids, low, high: F.array_join(F.transform(F.sequence(low, high), lambda j: F.get(ids, j)), ",")
        run = lambda ids, low, high: either(low == high, F.get(ids, low), several(ids, low, high))
        a, b = (F.col(x).cast("array<string>") for x in "ab")

        def joined(low_a: Column, low_b: Column, high_b: Column, a: Column, b: Column) -> Column:
            each = lambda i, g: F.concat(run(a, F.get(low_a, g), i), F.lit("|"), run(b, F.get(low_b, g), F.get(high_b, g)))
            return F.array_join(F.transform(cuts, each), ";")

        high_b = F.transform(cuts, lambda i: F.get(high, i))
        return let(after(cuts), lambda low_a: let(high_b, lambda high_b: let(after(high_b), lambda low_b: let(a, lambda a: let(b, lambda b: joined(low_a, low_b, high_b, a, b))))))

    none = F.size("a") == 0
    rows = tokens.withColumn("made", F.when(~none, let(merged, places)))
    size = lambda c: F.size(c).cast("long")
    return rows.select(
        "kept", size("a").alias("n_a"), size("b").alias("n_b"), size(F.array_intersect("a_ends", "b_ends")).alias("n_groups"),
        F.when(none, "").otherwise(F.sha2("made.groups", 256)).alias("groups_sha256"), F.coalesce("made.links", F.array().cast("array<bigint>")).alias("links"),
    )


def pair_counts(links: DataFrame) -> DataFrame:
    """pair, n (rows that hold it) and best (whether no pair of the same A id has more)."""
    counts = links.select(F.explode(F.array_distinct("links")).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = stored(counts.withColumn("a", F.shiftright("pair", 32)))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))  # at most a pair for each B id in a group


def align(df: DataFrame, files: Tokenizers, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text", most_broadcast: int = 1 << 18) -> DataFrame:
    """The kept columns with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each row."""
    check_names(keep, MADE)
    rows = stored(linked(tokenize_both(df, files, keep=keep, text=text)).withColumn("row", F.monotonically_increasing_id()))
    counts = stored(pair_counts(rows))
    least = threshold(counts, most_broadcast)
    frequent = F.broadcast(counts.where(F.col("n") >= least))  # most_broadcast rows at most
    sums = [F.sum("times").alias("links_"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    single = rows.select("row", F.explode("links").alias("pair"))
    found = single.join(frequent, "pair").withColumn("times", F.lit(1)).groupBy("row").agg(*sums)
    if counts.where(F.col("n") < least).limit(1).count():
        rare = single.join(frequent.select("pair"), "pair", "left_anti").groupBy("row", "pair").agg(F.count("*").alias("times"))
        found = found.unionByName(rare.join(counts.where(F.col("n") < least), "pair").groupBy("row").agg(*sums))
        found = found.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("links_", "n_best", "count_sum")])
    whole = rows.drop("links").join(found, "row", "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return whole.select("kept.*", "n_a", "n_b", "n_groups", number("links_").alias("n_links"), number("n_best").alias("n_best"), number("count_sum").alias("count_sum"), "groups_sha256")


def threshold(counts: DataFrame, most: int) -> int:
    """The least count so that no more than ``most`` pairs reach it."""
    by_size = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count("*").alias("pairs")).orderBy(F.desc("power")).collect()  # 64 rows at most
    total, least = 0, 1
    for row in by_size:
        total += row["pairs"]
        if total > most:
            return 1 << (row["power"] + 1)
    return least
