"""Terms of chunks as lists: one row for each chunk, so that counting and weighing stay within rows and no term of a chunk is shuffled.

``listed`` reads the texts once. What a term is worth in the corpus comes back to the lists by ``with_frequency``: the frequent terms, which
make most of all places, are broadcast (``MOST`` at most); the others are looked up by a join, each with few chunks. All else is row by row."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import STOPWORDS
from corpusmill.session import stored

MOST = 1 << 17
_WORD, _STOP = re.compile(rb"[a-z][a-z0-9'+-]*"), frozenset(w.encode() for w in STOPWORDS)


def _arrow(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(f, batches)

    return df.mapInArrow(run, schema)


def _schema(df: DataFrame, columns: list[str], more: str) -> str:
    return ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns), more])


def _lists(like: pa.ListArray, values: pa.Array) -> pa.ListArray:
    """The values in lists as long as those of ``like``."""
    return pa.ListArray.from_arrays(pc.subtract(like.offsets, like.offsets[0]), values)


def _counted(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The content terms of each text in the order of first places, and how often each stands there."""
    offsets, terms, ns = [0], [], []
    for text in texts.cast(pa.binary()):
        if text.is_valid:  # lower-casing bytes leaves all beyond ASCII alone
            found = Counter(w for w in _WORD.findall(text.as_py().lower()) if len(w) > 1 and w not in _STOP)
            terms.extend(found)
            ns.extend(found.values())
        offsets.append(len(terms))
    at = pa.array(offsets, pa.int32())
    return pa.ListArray.from_arrays(at, pa.array(terms, pa.binary()).cast(pa.string())), pa.ListArray.from_arrays(at, pa.array(ns, pa.int64()))


def listed(chunks: DataFrame, key: str = "chunk_id", body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, the columns to keep, terms, ns, and first: a row for each chunk, those without terms included.

    Chunks of the same key count as one: all have the terms of all, and ``first`` is true for one of them."""
    columns = [key, *keep]

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *_counted(batch.column(body))], [*columns, "terms", "ns"])

    texts = chunks.select(*columns, F.col(body).cast("string").alias(body))
    rows = stored(_arrow(texts, count, _schema(texts, columns, "terms array<string>, ns array<bigint>")), compression="zstd")
    if rows.groupBy(key).count().where("count > 1").isEmpty():
        return rows.withColumn("first", F.lit(True))
    joined = rows.select(F.col(key).alias("__key"), F.inline(F.arrays_zip("terms", "ns"))).groupBy("__key", "terms").agg(F.sum("ns").alias("ns"))
    joined = joined.groupBy("__key").agg(F.collect_list(F.struct("terms", "ns")).alias("__all"))
    rows = rows.select(*columns, (F.row_number().over(Window.partitionBy(key).orderBy(key)) == 1).alias("first"))
    rows = rows.join(joined, rows[key].eqNullSafe(joined["__key"]), "left")
    none = F.array().cast("array<struct<terms:string,ns:bigint>>")
    return stored(rows.withColumn("__all", F.coalesce("__all", none)).select(*columns, F.col("__all.terms").alias("terms"), F.col("__all.ns").alias("ns"), "first"))


def frequency(lists: DataFrame) -> DataFrame:
    """term and df, in how many chunks it stands."""
    return lists.where("first").select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def inverse(counted: DataFrame, size: int) -> DataFrame:
    """term, df and idf over ``size`` chunks."""
    return counted.select("term", "df", (F.log((1 + F.lit(max(size, 1))) / (1 + F.col("df"))) + 1).alias("idf"))


def frequent(counted: DataFrame, most: int = MOST) -> int:
    """The least df such that no more than ``most`` terms have it or a larger one."""
    sizes = counted.groupBy("df").agg(F.count("*").alias("n")).orderBy(F.desc("df")).toArrow()
    within = np.searchsorted(np.cumsum(sizes["n"].to_numpy()), most, side="right")
    return int(sizes["df"][within - 1].as_py()) if within else 1 << 62


def with_values(lists: DataFrame, values: DataFrame, most: int = MOST, key: str = "chunk_id", then: tuple[Callable[[pa.RecordBatch], pa.RecordBatch], str] | None = None) -> DataFrame:
    """``lists`` with a list xs, the value x of each term. ``values`` (term, df and x) are stored. ``then``, a function of these batches and its
    schema, runs in the same Python worker.

    Where some terms are not broadcast, lists are joined with what was looked up of those; broadcast terms go there as their places in the
    broadcast list, and only the others as text."""
    least = frequent(values, most)
    known = values.where(F.col("df") >= least)
    table = known.select("term", "x").toArrow().combine_chunks()
    columns = lists.columns
    rare = values.where(F.col("df") < least)
    shared = lists.sparkSession.sparkContext.broadcast((table["term"], table["x"]))
    known_of = lambda: tuple(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in shared.value)
    after, schema = then or (lambda batch: batch, _schema(lists, columns, f"xs array<{values.schema['x'].dataType.simpleString()}>"))

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, xs = known_of()
        terms = batch.column("terms")
        return after(pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), _lists(terms, pc.take(xs, pc.index_in(terms.flatten(), value_set=names)))], [*columns, "xs"]))

    if rare.isEmpty():
        return _arrow(lists, look, schema)
    others_of = [c for c in columns if c != "terms"]

    def others(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Terms that are not known, and their places in the list."""
        terms = batch.column("terms")
        flat, row = terms.flatten(), places(terms)
        gone = pc.invert(pc.is_in(flat, value_set=known_of()[0]))
        at = np.arange(len(flat)) - (np.cumsum(np.bincount(row, minlength=len(terms))) - np.bincount(row, minlength=len(terms)))[row]
        return pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(row).filter(gone)), pa.array(at.astype(np.int32)).filter(gone), flat.filter(gone)], ["__key", "at", "term"])

    def coded(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Places of known terms in the broadcast list, -1 for others, and those as text."""
        terms = batch.column("terms")
        flat = terms.flatten()
        codes = pc.fill_null(pc.index_in(flat, value_set=known_of()[0]), -1)
        gone = pc.equal(codes, -1)
        ends = np.concatenate([[0], np.cumsum(np.bincount(places(terms)[gone.to_numpy(zero_copy_only=False)], minlength=len(terms)))])
        texts = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat.filter(gone))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in others_of), _lists(terms, codes), texts], [*others_of, "__codes", "__others"])

    def decoded(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, xs = known_of()
        codes, found = batch.column("__codes"), batch.column("__rare")
        flat = codes.flatten().to_numpy()
        texts, gone = batch.column("__others").flatten(), np.flatnonzero(flat < 0)
        place = flat.astype(np.int64)
        place[gone] = len(names) + np.arange(len(gone))
        terms = pa.concat_arrays([names, texts.cast(names.type)]).take(pa.array(place))
        own = found.flatten()
        start = np.concatenate([[0], np.cumsum(np.bincount(places(codes), minlength=len(codes)))])
        place[gone] = -1
        place[start[places(found)] + own.field(0).to_numpy()] = len(xs) + np.arange(len(own))
        out = pa.concat_arrays([xs, own.field(1).cast(xs.type)]).take(pa.array(place, mask=place < 0))
        parts = {c: batch.column(c) for c in others_of} | {"terms": _lists(codes, terms)}
        return after(pa.RecordBatch.from_arrays([*(parts[c] for c in columns), _lists(codes, out)], [*columns, "xs"]))

    looked = _arrow(lists.where("first").select(key, "terms"), others, f"__key {lists.schema[key].dataType.simpleString()}, at int, term string")
    found = looked.join(rare.select("term", "x"), "term").groupBy("__key").agg(F.collect_list(F.struct("at", "x")).alias("__rare"))
    short = _arrow(lists, coded, _schema(lists, others_of, "__codes array<int>, __others array<string>"))
    none = F.array().cast(found.schema["__rare"].dataType)
    joined = short.join(found, short[key].eqNullSafe(found["__key"]), "left").select(*others_of, "__codes", "__others", F.coalesce("__rare", none).alias("__rare"))
    return _arrow(joined, decoded, schema)


def with_frequency(lists: DataFrame, counted: DataFrame, most: int = MOST, key: str = "chunk_id") -> DataFrame:
    """``lists`` with dfs, in how many chunks each term stands. ``counted`` are stored."""
    return with_values(lists, counted.withColumn("x", F.col("df")), most, key).withColumnRenamed("xs", "dfs")


def places(terms: pa.ListArray) -> np.ndarray:
    """For each value of the lists, the row that it is in."""
    return np.repeat(np.arange(len(terms)), pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False))


def _raw(batch: pa.RecordBatch, dfs: str, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each term's idf over ``size`` chunks and n times idf, and the length of each row of these."""
    ns = batch.column("ns")
    idfs = np.log((1 + max(size, 1)) / (1 + batch.column(dfs).flatten().to_numpy())) + 1
    raw = ns.flatten().to_numpy() * idfs
    return idfs, raw, np.sqrt(np.bincount(places(ns), raw * raw, len(ns)))


def weighed(lists: DataFrame, size: int) -> DataFrame:
    """``lists`` with ws, the TF-IDF weights over ``size`` chunks, of unit length in each row, in place of ns and dfs."""
    columns = [c for c in lists.columns if c not in ("ns", "dfs")]

    def weigh(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, raw, length = _raw(batch, "dfs", size)
        ns = batch.column("ns")
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), _lists(ns, pa.array(raw / length[places(ns)]))], [*columns, "ws"])

    return _arrow(lists, weigh, _schema(lists, columns, "ws array<double>"))


def _once(lists: DataFrame, counted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    return lists.where("first").select(key, "first", "terms", "ns"), counted.withColumn("x", F.col("df"))


def factors(lists: DataFrame, counted: DataFrame, size: int, most: int = MOST, key: str = "chunk_id") -> DataFrame:
    """The weights by what they are made of, a row for each chunk: key, terms, xs (how often each stands there), factors (its idf) and length.
    A weight is x times the factor, divided by the length."""

    def part(batch: pa.RecordBatch) -> pa.RecordBatch:
        idfs, _, length = _raw(batch, "xs", size)
        ns, terms = batch.column("ns"), batch.column("terms")
        xs = ns.flatten().cast(pa.float64())
        return pa.RecordBatch.from_arrays([batch.column(key), terms, _lists(ns, xs), _lists(terms, pa.array(idfs)), pa.array(length)], [key, "terms", "xs", "factors", "length"])

    rows, values = _once(lists, counted, key)
    return with_values(rows, values, most, key, (part, _schema(rows, [key], "terms array<string>, xs array<double>, factors array<double>, length double")))


def weights_of(lists: DataFrame, counted: DataFrame, size: int, most: int = MOST, key: str = "chunk_id") -> DataFrame:
    """key, term and w of lists that aren't weighed; only their terms are looked up."""

    def flat(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, raw, length = _raw(batch, "xs", size)
        at = places(batch.column("terms"))
        return pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(at)), batch.column("terms").flatten(), pa.array(raw / length[at])], [key, "term", "w"])

    rows, values = _once(lists, counted, key)
    return with_values(rows, values, most, key, (flat, _schema(rows, [key], "term string, w double")))


def rows_of(lists: DataFrame, columns: list[str], values: str, name: str) -> DataFrame:
    """The columns, term, and the list ``values`` as the column ``name``: a row for each term of each row."""

    def flat(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = pa.array(places(batch.column("terms")))
        own = [batch.column(c).take(at) for c in columns]
        return pa.RecordBatch.from_arrays([*own, batch.column("terms").flatten(), batch.column(values).flatten()], [*columns, "term", name])

    kind = lists.schema[values].dataType.elementType.simpleString()
    return _arrow(lists.select(*columns, "terms", values), flat, _schema(lists, columns, f"term string, {name} {kind}"))


def weights(lists: DataFrame, key: str = "chunk_id") -> DataFrame:
    """key, term and w of weighed lists."""
    return rows_of(lists.where("first"), [key], "ws", "w")


def cosines(lists: DataFrame, values: DataFrame, most: int = MOST, key: str = "chunk_id") -> DataFrame:
    """key and cosine: the sum of each weighed row's weights times the values (term, df and x, stored) of their terms."""
    rows = with_values(lists.where("first").select(key, "first", "terms", "ws"), values, most, key)

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        ws, xs = batch.column("ws"), batch.column("xs")
        total = np.bincount(places(ws), ws.flatten().to_numpy() * xs.flatten().to_numpy(), len(ws)).astype(np.float64)  # whole numbers without any term
        return pa.RecordBatch.from_arrays([batch.column(key), pa.array(total)], [key, "cosine"])

    return _arrow(rows, add, _schema(rows, [key], "cosine double"))
