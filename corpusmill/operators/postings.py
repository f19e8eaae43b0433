"""Postings by block and term, and exact search of many questions that stops early.

Chunks lie in blocks of at most ``block_chunks``, one row each: the chunks, and for each term of the block the chunks that have it. Blocks are
cut where the chunks lie, without a shuffle; among the chunks that a task holds at once, those that share their heaviest term lie together, so
that other terms are heavy in few blocks only. A weight is x times the factor of its term divided by the length of its chunk: TF-IDF weights
are kept as counts, which take a fraction of their bytes, and other weights as they are, with factors and lengths of one.

What a question can reach in a block is the sum of its weights times the largest weights of its terms there. A search goes through the blocks
in tasks: in each, a question first scores its ``first`` most promising blocks of those at hand; of the rest, only blocks that can reach its
n-th best score so far are scored, so no answer is lost. Scores of a block are made in its row, and no more than n rows of a question leave a
task, of which there are a few for each core; so what is shuffled does not grow with the lists of the terms. Questions go in runs of about
``MOST_ASKED`` rows (query and term), collected, broadcast and searched one at a time; each reads all blocks.

Weights that are null, zero or no numbers are left out, and so are null keys and terms; questions without any known term have no answers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.operators.terms import places
from corpusmill.session import stored
from corpusmill.sources.commits import Versions

SLACK = 1e-9
#: rows of questions that are broadcast at once
MOST_ASKED = 1 << 17
#: bytes of Arrow batches that a task holds at once
MOST_BYTES = 16 << 20
#: hits and scores of a block that are made at once (one question at least), and candidates that are ranked at once
CELLS, CANDIDATES = 1 << 20, 1 << 17
#: row groups of a few blocks, as Spark reads up to a whole one into memory
ROW_GROUPS = {"compression": "zstd", "parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "4"}


def rounded(scores: np.ndarray) -> np.ndarray:
    """Sums of one chunk in another order differ in the last bits; ranks are by this."""
    return np.where(np.abs(scores) < 2**53 / 1e9, np.round(scores, 9), scores)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= MOST_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _cut(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Blocks of these chunks. Columns: id, terms (one at least), xs, factors and length."""
    ids, terms, lengths = batch.column("id"), batch.column("terms"), batch.column("length").to_numpy()
    row, flat = places(terms), terms.flatten().dictionary_encode()
    xs, factors = batch.column("xs").flatten().to_numpy(), batch.column("factors").flatten().to_numpy()
    by_name = pc.sort_indices(flat.dictionary)
    names, rank = flat.dictionary.take(by_name), np.empty(len(by_name), np.int64)
    rank[by_name.to_numpy()] = np.arange(len(by_name))
    code, w = rank[flat.indices.to_numpy()], xs * factors / lengths[row]
    top = np.flatnonzero(w == np.maximum.reduceat(w, np.searchsorted(row, np.arange(len(ids))))[row])
    order = np.argsort(code[top[np.searchsorted(row[top], np.arange(len(ids)))]], kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    sort = np.lexsort((place[row], code, place[row] // size))
    edges = np.searchsorted(place[row[sort]] // size, np.arange(-(-len(ids) // size) + 1))
    for b, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        at, chunks = sort[low:high], order[b * size : (b + 1) * size]
        starts = np.flatnonzero(np.diff(code[at], prepend=-1))
        parts = {
            "ids": ids.take(pa.array(chunks)), "lengths": pa.array(lengths[chunks]), "terms": names.take(pa.array(code[at[starts]])), "factors": pa.array(factors[at[starts]]),
            "ends": pa.array(np.append(starts[1:], high - low).astype(np.int32)), "ats": pa.array((place[row[at]] % size).astype(np.int32)), "xs": pa.array(xs[at]),
        }
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in parts.values()], [*parts])


class _Block:
    """A row of the blocks."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        own = lambda name: batch.column(name)[i].values
        self.ids, self.terms, self.ats = own("ids"), own("terms"), own("ats").to_numpy()
        self.ends = own("ends").to_numpy().astype(np.int64)
        self.starts = np.append(0, self.ends[:-1])
        self.w = own("xs").to_numpy() * np.repeat(own("factors").to_numpy(), self.ends - self.starts) / own("lengths").to_numpy()[self.ats]


class _Best:
    """The n best chunks of each question so far, by falling score and rising id; ``least`` is the n-th score."""

    def __init__(self, questions: int, n: int):
        self.n, self.least, self.kept, self.new, self.size = n, np.full(questions, -np.inf), None, [], 0

    def add(self, question: np.ndarray, by: np.ndarray, score: np.ndarray, ids: pa.Array) -> None:
        self.new.append(pa.table({"question": question, "by": by, "score": score, "id": ids}))
        self.size += len(question)
        if self.size >= CANDIDATES:
            self.settle()

    def settle(self) -> None:
        if not self.size:
            return
        rows = pa.concat_tables(self.new)
        others = None
        if self.kept is not None:  # only questions with something new are ranked again
            fresh = np.zeros(len(self.least), bool)
            fresh[rows["question"].to_numpy()] = True
            again = pa.array(fresh[self.kept["question"].to_numpy()])
            others, rows = self.kept.filter(pc.invert(again)), pa.concat_tables([self.kept.filter(again), rows])
        rows = rows.take(pc.sort_indices(rows, [("question", "ascending"), ("by", "descending"), ("id", "ascending")]))
        question = rows["question"].to_numpy()
        rank = np.arange(len(question)) - np.searchsorted(question, question)
        self.least[question[rank == self.n - 1]] = rows["by"].to_numpy()[rank == self.n - 1]
        rows = rows.filter(pa.array(rank < self.n))
        self.kept, self.new, self.size = rows if others is None else pa.concat_tables([others, rows]).combine_chunks(), [], 0


class _Asked:
    """Questions as arrays: which question and term a row has, and its weight."""

    def __init__(self, ids: pa.Array, terms: pa.Array, of: np.ndarray, term: np.ndarray, q: np.ndarray):
        self.ids, self.terms, self.of, self.term, self.q = ids, terms, of, term, q

    def bounds(self, block: _Block) -> np.ndarray:
        """What each question can reach in the block; without a term there, minus infinity. Keeps where its terms lie in the block."""
        where = pc.index_in(block.terms, value_set=self.terms)
        there = where.is_valid().to_numpy(zero_copy_only=False)
        where = where.drop_null().to_numpy()
        block.start, block.n, most = np.zeros(len(self.terms), np.int64), np.zeros(len(self.terms), np.int64), np.zeros(len(self.terms))
        if len(where):
            block.start[where], block.n[where] = block.starts[there], (block.ends - block.starts)[there]
            most[where] = np.maximum(np.maximum.reduceat(block.w, block.starts)[there], 0)  # chunks without the term have 0
        reach = np.bincount(self.of, self.q * most[self.term], len(self.ids))
        return np.where(np.bincount(self.of, block.n[self.term] > 0, len(self.ids)) > 0, reach + np.abs(reach) * 1e-12, -np.inf)

    def score(self, block: _Block, which: np.ndarray, best: _Best) -> None:
        """Scores the block for the questions ``which`` (rising numbers)."""
        size = len(block.ids)
        cells = np.cumsum(np.bincount(self.of, block.n[self.term], len(self.ids))[which] + size)
        for some in np.split(which, np.flatnonzero(np.diff(cells // CELLS)) + 1):
            number = np.full(len(self.ids), -1)
            number[some] = np.arange(len(some))
            pairs = np.flatnonzero((number[self.of] >= 0) & (block.n[self.term] > 0))
            n = block.n[self.term[pairs]]
            at = np.arange(n.sum()) + np.repeat(block.start[self.term[pairs]] - (np.cumsum(n) - n), n)
            cell = np.repeat(number[self.of[pairs]] * size, n) + block.ats[at]
            scores = np.bincount(cell, np.repeat(self.q[pairs], n) * block.w[at], len(some) * size)
            scores[np.bincount(cell, minlength=len(scores)) == 0] = -np.inf
            scores = scores.reshape(len(some), size)
            least = best.least[some]
            if size > best.n and (open_ := np.flatnonzero(least == -np.inf)).size:  # the n-th of the block is a limit as well
                least[open_] = np.partition(scores[open_], size - best.n, axis=1)[:, size - best.n]
            row, place = np.nonzero((scores >= least[:, None] - SLACK) & (scores > -np.inf))
            found = scores[row, place]
            by = rounded(found)
            kept = by >= best.least[some][row]
            if kept.any():
                best.add(some[row[kept]], by[kept], found[kept], block.ids.take(pa.array(place[kept])))


def _searched(batches: Iterator[pa.RecordBatch], shared: Broadcast, n: int, first: int, counts: list[int]) -> _Best:
    """The best of these blocks. Adds to ``counts`` how many blocks were scored and how many hold a term, over all questions."""
    asked = _Asked(*shared.value)
    best = _Best(len(asked.ids), n)
    for batch in _gathered(batches):
        blocks = [_Block(batch, i) for i in range(batch.num_rows)]
        bounds = np.stack([asked.bounds(b) for b in blocks], axis=1)
        counts[1] += int((bounds > -np.inf).sum())
        leading = np.zeros(bounds.shape, bool)
        np.put_along_axis(leading, np.argsort(-bounds, axis=1, kind="stable")[:, :first], True, axis=1)
        for now in (leading, ~leading):
            for b, block in enumerate(blocks):
                which = np.flatnonzero(now[:, b] & (bounds[:, b] > -np.inf) & (bounds[:, b] >= best.least - SLACK))
                counts[0] += len(which)
                if len(which):
                    asked.score(block, which, best)
            best.settle()
    return best


class Postings:
    """Opened where they lie; ``build`` and ``of_lists`` write them."""

    def __init__(self, spark: SparkSession, path: str):
        versions = Versions(spark, path)
        found = versions.numbers()
        if not found:
            raise ValueError(f"no postings in {path}")
        self.blocks = spark.read.parquet(f"{versions.folder(found[-1])}/blocks")

    @classmethod
    def build(cls, weights: DataFrame, path: str, *, key: str = "chunk_id", block_chunks: int = 256, buckets: int | None = None) -> Postings:
        """``weights``: key, term and w. Chunks are dealt to ``buckets`` tasks by a hash of the key; without a number, to as many as Spark has."""
        rows = weights.where("w <> 0 AND NOT isnan(w)").select(F.col(key).alias("id"), "term", "w").where("id IS NOT NULL AND term IS NOT NULL")
        rows = (rows.repartition(buckets, "id") if buckets else rows.repartition("id")).groupBy("id", "term").agg(F.sum("w").alias("w"))
        lists = rows.groupBy("id").agg(F.collect_list(F.struct("term", F.col("w").cast("double").alias("w"))).alias("all"))
        lists = lists.select("id", F.col("all.term").alias("terms"), F.col("all.w").alias("xs"), F.transform("all", lambda _: F.lit(1.0)).alias("factors"), F.lit(1.0).alias("length"))
        return cls.of_lists(lists, path, key="id", block_chunks=block_chunks)

    @classmethod
    def of_lists(cls, lists: DataFrame, path: str, *, key: str = "chunk_id", block_chunks: int = 256) -> Postings:
        """``lists``, a row for each chunk: key, its different terms, xs, their factors (equal for a term wherever it stands) and length."""
        spark, versions = lists.sparkSession, Versions(lists.sparkSession, path)
        rows = lists.select(F.col(key).alias("id"), "terms", "xs", "factors", "length").where("id IS NOT NULL AND size(terms) > 0")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _gathered(batches):
                yield from _cut(batch, block_chunks)

        kind = rows.schema["id"].dataType.simpleString()
        made = rows.mapInArrow(cut, f"ids array<{kind}>, lengths array<double>, terms array<string>, factors array<double>, ends array<int>, ats array<int>, xs array<double>")
        out = versions.aside()
        made.select(F.monotonically_increasing_id().alias("block"), "*").write.options(**ROW_GROUPS).parquet(f"{out}/blocks")
        versions.append(out)
        return cls(spark, path)

    @property
    def entries(self) -> DataFrame:
        """term, block and chunks, the ids and weights (id and w) of the block's chunks that have the term: a row for each term of each block."""

        def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    own = _Block(batch, i)
                    chunks = pa.StructArray.from_arrays([own.ids.take(pa.array(own.ats)), pa.array(own.w)], ["id", "w"])
                    lists = pa.ListArray.from_arrays(pa.array(np.append(0, own.ends).astype(np.int32)), chunks)
                    yield pa.RecordBatch.from_arrays([own.terms, pa.array(np.full(len(own.terms), batch.column("block")[i].as_py())), lists], ["term", "block", "chunks"])

        return self.blocks.mapInArrow(flat, f"term string, block bigint, chunks array<struct<id:{self._kind},w:double>>")

    @property
    def _kind(self) -> str:
        return self.blocks.schema["ids"].dataType.elementType.simpleString()

    def _runs(self, questions: DataFrame, most_asked: int) -> tuple[DataFrame, list[Broadcast]]:
        """The blocks in a few tasks for each core, and the questions run by run, each broadcast when it is asked for."""
        rows = questions.where("q IS NOT NULL AND term IS NOT NULL AND query_id IS NOT NULL").groupBy("query_id", "term").agg(F.sum(F.col("q").cast("double")).alias("q"))
        asked = stored(rows)
        runs = max(1, -(-asked.count() // most_asked))
        context = asked.sparkSession.sparkContext

        def shared(run: int) -> Broadcast:
            own = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(runs)) == run).toArrow().combine_chunks()
            ids, terms = (pc.unique(own[c]) for c in ("query_id", "term"))
            of, term = (pc.index_in(own[c], value_set=v).combine_chunks().to_numpy(zero_copy_only=False) for c, v in (("query_id", ids), ("term", terms)))
            return context.broadcast((ids, terms, of, term, own["q"].to_numpy()))

        return self.blocks.coalesce(4 * context.defaultParallelism), (shared(i) for i in range(runs))

    def search(self, questions: DataFrame, n: int = 10, *, first: int = 2, key: str = "chunk_id", most_asked: int = MOST_ASKED) -> DataFrame:
        """query_id, rank, key and score of the n chunks with the largest sums of q times w, ties by key. ``questions``: query_id, term and q > 0."""
        schema = f"query_id {questions.schema['query_id'].dataType.simpleString()}, id {self._kind}, score double, by double"
        blocks, runs = self._runs(questions, most_asked)
        order, found = Window.partitionBy("query_id").orderBy(F.desc("by"), "id"), None
        for shared in runs:

            def best(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
                if (rows := _searched(batches, shared, n, first, [0, 0]).kept) is not None:
                    ids = shared.value[0].take(rows["question"])
                    yield from pa.table([ids, rows["id"], rows["score"], rows["by"]], ["query_id", "id", "score", "by"]).to_batches(max_chunksize=100_000)

            ranks = blocks.mapInArrow(best, schema).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
            part = stored(ranks.select("query_id", "rank", F.col("id").alias(key), "score"))  # each run is searched before the next is collected
            shared.destroy()
            found = part if found is None else found.union(part)
        return found

    def share_scored(self, questions: DataFrame, n: int = 10, *, first: int = 2) -> float:
        """The share of blocks with a question's term that its search scores."""
        blocks, runs = self._runs(questions, MOST_ASKED)
        total = np.zeros(2)
        for shared in runs:

            def count(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
                _searched(batches, shared, n, first, counts := [0, 0])
                yield pa.RecordBatch.from_pydict({"scored": counts[:1], "all": counts[1:]})

            row = blocks.mapInArrow(count, "scored bigint, all bigint").agg(F.sum("scored"), F.sum("all")).first()
            total += [x or 0 for x in row]
            shared.destroy()
        return float(total[0] / total[1]) if total[1] else 0.0
