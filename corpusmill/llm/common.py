"""What the operators of this subpackage share: tables, durable cuts of the lineage, Arrow batches."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words, and that are stripped from lines: space and U+0009 to U+000D.
BLANKS = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the folder that the cluster names in spark.checkpoint.dir, so that a lost executor loses none of it.

    Only where that setting is absent in local mode, as in tests, a temporary folder takes its place; a cluster without it is an error."""
    _shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def check_names(keep: tuple[str, ...], made: tuple[str, ...]) -> None:
    """Columns that are kept must not have the names of those that an operator makes: nothing could tell the two apart."""
    if clash := sorted(set(map(str.lower, keep)) & set(made)):
        raise ValueError(f"kept columns {', '.join(clash)} have the names of columns that are made; rename them first")


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int = 2_000_000, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the column number ``text`` holds about ``most`` bytes in each, one row at least."""
    for batch in batches:
        column = batch.column(text)
        sizes = [0 if n is None else n for n in pa.compute.binary_length(column).to_pylist()]
        begin, total = 0, 0
        for i, n in enumerate(sizes):
            if i > begin and (total + n > most or i - begin >= rows):
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        if len(sizes) > begin:
            yield batch.slice(begin, len(sizes) - begin)


#: rows of an Arrow batch, where the session sets no other number: texts of a few thousand characters then take a few MB on either side
BATCH_ROWS = 1000


def in_arrow(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: object) -> DataFrame:
    """``mapInArrow`` with batches of BATCH_ROWS rows: every worker of an executor holds some, and so does the JVM for each worker."""
    conf = df.sparkSession._jsparkSession.conf()
    if not conf.contains("spark.sql.execution.arrow.maxRecordsPerBatch"):
        df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df.mapInArrow(f, schema)


def map_slices(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, text: int, most: int = 2_000_000) -> DataFrame:
    """``mapInArrow`` over slices of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, most):
            if (out := f(part)) is not None and out.num_rows:
                yield out
        give_back()

    return in_arrow(df, run, schema)


def give_back() -> None:
    """Freed memory goes back to the system when a task ends: workers wait for their next task beside an executor that needs it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def id_filter(ids: DataFrame, column: str, most_bits: int) -> np.ndarray:
    """A Bloom filter of one probe over distinct bigints: 16 bits for each, ``most_bits`` at most."""
    bits = min(max(1 << 15, 1 << (16 * max(1, ids.count()) - 1).bit_length()), most_bits)
    at = F.expr(f"pmod(xxhash64(`{column}`), {bits}L) + 1")  # bitmaps count from 1
    parts = ids.select((F.bitmap_bucket_number(at) - 1).alias("part"), F.bitmap_bit_position(at).alias("bit"))
    whole = np.zeros(bits // 8, np.uint8)
    for row in parts.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():  # 4 KB each, bits / 8 bytes in all
        part = np.frombuffer(row["bits"], np.uint8)[: len(whole)]
        begin = row["part"] * 4096
        whole[begin : begin + len(part)] = part[: len(whole) - begin]
    return whole


def chosen(marks: Broadcast, wanted: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rows whose number in the first column the filter has, or the others; those without a number are others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = marks.value
        for batch in batches:
            ids = batch.column(0)
            at = spark_hash(ids.fill_null(0).to_numpy(zero_copy_only=False)) % np.int64(8 * len(bits))
            has = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool) & ids.is_valid().to_numpy(zero_copy_only=False)
            rows = batch.filter(pa.array(has == wanted))
            if rows.num_rows:
                yield rows

    return run


def spark_hash(values: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of bigints, with its seed of 42; ``%`` of its results is pmod, as numpy's remainder takes the sign of the divisor."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    with np.errstate(over="ignore"):
        h = np.uint64(42) + p5 + np.uint64(8)
        h = h ^ (turn(values.astype(np.int64).view(np.uint64) * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def as_text(name: str) -> Column:
    """The column as text, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table beside the checkpoints, in the folder that all executors share, and read again; deleted when Python ends.

    Smaller on disk than a checkpoint, and columns and filters are pushed into its scans."""
    spark = df.sparkSession
    folder = _shared_folder(spark)
    path = f"{folder}/corpusmill-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_delete, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _shared_folder(spark: SparkSession) -> str:
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = os.path.join(tempfile.gettempdir(), "corpusmill-checkpoints")  # one machine, as in tests
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended, and its cluster with it
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
