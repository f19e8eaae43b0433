"""A collection of chunks with their vectors that is merged when it is read.

Each upsert or removal writes only its own rows, as a delta: a folder of Parquet files in ``buckets`` buckets by the chunk's id, or the ids that
go. A reader takes from each delta the ids that no later one has. All deltas are bucketed and sorted alike, so these joins move no rows
between tasks. When more than ``most_deltas`` lie there, they are compacted to one.

A delta is written aside and then renamed to the next number, so readers see all of it or nothing, and a writer that is lost leaves nothing that
they see. Of two writers of the same number one takes the next; the higher number counts.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.search import text_embedding, vector_top_k
from corpusmill.sources.commits import Versions

SCHEMA = "chunk_id string, document string, embedding array<float>"
GONE = "__gone"


class Collection:
    """Opened or, with the first upsert, made below ``path``, on any file system that Spark reaches.

    ``embed`` makes a column of vectors from a column of texts; any function, a model's pandas UDF too, may take the place of the default."""

    def __init__(self, spark: SparkSession, path: str, embed: Callable[[Column], Column] = text_embedding, *, buckets: int = 16, most_deltas: int = 8):
        self.spark, self.embed, self.buckets, self.most_deltas = spark, embed, buckets, most_deltas
        self.deltas = Versions(spark, path)

    def versions(self) -> list[int]:
        """Deltas that count, in order: from the last compacted one on."""
        found = self.deltas.numbers()
        whole = [n for n in found if self._facts(n)["whole"]]
        return [n for n in found if not whole or n >= whole[-1]]

    def _facts(self, number: int) -> dict:
        return json.loads(self.deltas.read_text(f"version-{number}/facts.json"))

    def _write(self, rows: DataFrame, whole: bool, before: int | None = None) -> int | None:
        """A new delta of rows with chunk_id and GONE. ``before``: only under this number."""
        aside = self.deltas.aside()
        name = f"corpusmill_{hashlib.md5(aside.encode()).hexdigest()}"
        try:
            rows.repartition(self.buckets, "chunk_id").write.format("parquet").bucketBy(self.buckets, "chunk_id").sortBy("chunk_id").option("path", f"{aside}/rows").saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay
        facts = {"whole": whole, "buckets": self.buckets, "schema": rows.schema.jsonValue()}
        self.deltas.write_text(f"{aside}/facts.json", json.dumps(facts))
        if before is None:
            return self.deltas.append(aside)
        if self.deltas.publish(aside, before):
            return before
        self.deltas.delete(aside.rsplit("/", 1)[1])
        return None

    def _delta(self, number: int) -> DataFrame:
        """Rows of a delta, as a table that tells Spark how they are bucketed and sorted."""
        from pyspark.sql.types import StructType

        facts, folder = self._facts(number), f"{self.deltas.folder(number)}/rows"
        name = f"corpusmill_{hashlib.md5(folder.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(facts["schema"]).fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (chunk_id) SORTED BY (chunk_id) INTO {facts['buckets']} BUCKETS LOCATION '{folder}'")
        return self.spark.table(name)

    def rows(self, versions: list[int] | None = None) -> DataFrame:
        """chunk_id, document, embedding and what else was upserted; no rows before the first upsert. Columns that a delta lacks are null in it."""
        found = self.versions() if versions is None else versions
        if not found:
            return self.spark.createDataFrame([], SCHEMA)
        deltas = [self._delta(n) for n in found]
        out = None
        for i, rows in enumerate(deltas):
            for later in deltas[i + 1 :]:
                rows = rows.join(later.select("chunk_id"), "chunk_id", "left_anti")
            rows = rows.where(f"NOT {GONE}").drop(GONE)
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        return out

    def count(self) -> int:
        return self.rows().count()

    def upsert(self, new: DataFrame) -> int:
        """Rows with chunk_id and document, embedded where they have no embedding, take the place of those with their ids; the others stay. Of
        rows that repeat an id one counts; rows without an id are left out. How many ids were given."""
        new = new.where("chunk_id IS NOT NULL").dropDuplicates(["chunk_id"])
        if "embedding" not in new.columns and "document" in new.columns:
            new = new.withColumn("embedding", self.embed(F.col("document")))
        number = self._write(new.withColumn(GONE, F.lit(False)), whole=False)
        given = self.spark.read.parquet(f"{self.deltas.folder(number)}/rows").count()
        self._keep_few()
        return given

    def remove(self, ids: DataFrame) -> None:
        """Chunks with these ids (chunk_id) go; only the ids are written."""
        gone = ids.select("chunk_id").where("chunk_id IS NOT NULL").distinct()
        self._write(gone.withColumn(GONE, F.lit(True)), whole=False)
        self._keep_few()

    def _keep_few(self) -> None:
        if len(self.versions()) > self.most_deltas:
            self.compact()

    def compact(self) -> bool:
        """One delta in place of all. False where another writer was faster: its delta counts, and nothing is lost. The deltas before the last two
        compacted ones are deleted, as readers may still be at the one before."""
        found = self.versions()
        if len(found) < 2:
            return True
        if self._write(self.rows(found).withColumn(GONE, F.lit(False)), whole=True, before=found[-1] + 1) is None:
            return False
        whole = [n for n in self.deltas.numbers() if self._facts(n)["whole"]]
        for old in self.deltas.numbers():
            if len(whole) > 1 and old < whole[-2]:
                self.deltas.delete(f"version-{old}")
        return True

    def query(self, text: str, n: int = 5, where: Column | None = None) -> DataFrame:
        """chunk_id and score of the n chunks whose vectors are nearest to the text's, among those that ``where`` lets through."""
        asked = self.spark.createDataFrame([(text,)], "document string").select(self.embed(F.col("document")).alias("v")).first()[0]
        return vector_top_k(self.rows(), asked, n, key="chunk_id", embedding="embedding", where=where)
