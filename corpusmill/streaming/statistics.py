"""Document frequencies that follow a stream of changes: documents that arrive, change and go.

A change is a slug, a version and a text; a null text means that the document goes. Each document's version and distinct content terms are
kept as state by its slug; a change gives plus one for each term that is new in it, minus one for each that it no longer has. A version that
is not above the one kept changes nothing, so repeated and late changes do no harm.

A batch writes its sums by term as a folder of its own number; a batch that is repeated after a failure writes the same folder again.
Frequencies are the sums over all folders, merged when they are read. ``compact`` puts those up to a batch into one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from corpusmill.functions.text import content_terms
from corpusmill.sources.commits import Versions

CHANGES = "slug string, version bigint, text string"
DELTAS = "term string, delta bigint"
#: the state store that keeps state of this kind
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class TermDeltas(StatefulProcessor):
    """For each document the changes of its terms; a null term stands for the document itself."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", "version bigint, here boolean, terms array<string>")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        last = None
        for batch in rows:
            for version, here, terms in zip(batch["version"], batch["here"], batch["terms"], strict=True):
                if last is None or version > last[0]:
                    last = int(version), bool(here), [str(t) for t in terms]
        version, was, terms = self.kept.get() if self.kept.exists() else (None, False, [])
        if last is None or version is not None and last[0] <= version:
            return
        self.kept.update(last)
        before, after = set(terms), set(last[2])
        found = [(t, 1) for t in sorted(after - before)] + [(t, -1) for t in sorted(before - after)]
        if was != last[1]:
            found.append((None, 1 if last[1] else -1))
        if found:
            yield pd.DataFrame(found, columns=["term", "delta"])

    def close(self) -> None:
        pass


def change_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Changes from JSON lines that arrive in a folder."""
    return spark.readStream.schema(CHANGES).json(folder)


def follow(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Takes what has arrived into the frequencies below ``path``; started again with the same checkpoint, it goes on where it ended."""
    changes.sparkSession.conf.set(*STORE)
    terms = F.array_distinct(content_terms(F.coalesce("text", F.lit(""))))
    rows = changes.where("slug IS NOT NULL AND version IS NOT NULL").select("slug", "version", F.col("text").isNotNull().alias("here"), terms.alias("terms"))
    deltas = rows.groupBy("slug").transformWithStateInPandas(TermDeltas(), DELTAS, "Update", "None")

    def write(batch: DataFrame, number: int) -> None:
        batch.groupBy("term").agg(F.sum("delta").alias("delta")).where("delta <> 0").write.mode("overwrite").parquet(f"{path}/batches/batch={number}")

    return deltas.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Frequencies:
    """What ``follow`` has written below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.bases = spark, path.rstrip("/"), Versions(spark, f"{path.rstrip('/')}/bases")

    def _sums(self) -> DataFrame:
        upto = (self.bases.numbers() or [0])[-1]  # a base's number is one more than that of its last batch
        batches = self.spark.read.schema(f"{DELTAS}, batch bigint").parquet(f"{self.path}/batches").where(F.col("batch") >= upto).select("term", "delta")
        rows = batches.unionByName(self.spark.read.schema(DELTAS).parquet(self.bases.folder(upto))) if upto else batches
        return rows.groupBy("term").agg(F.sum("delta").alias("df")).where("df <> 0")

    def document_frequency(self) -> DataFrame:
        """term and df over the documents that are there."""
        return self._sums().where("term IS NOT NULL")

    def documents(self) -> int:
        row = self._sums().where("term IS NULL").first()
        return row["df"] if row else 0

    def inverse_frequency(self) -> DataFrame:
        """term, df, idf over the documents that are there, those without terms included."""
        return self.document_frequency().select("term", "df", (F.log((1 + F.lit(max(self.documents(), 1))) / (1 + F.col("df"))) + 1).alias("idf"))

    def compact(self) -> None:
        """The sums of all batches so far as one base."""
        last = self.spark.read.schema(f"{DELTAS}, batch bigint").parquet(f"{self.path}/batches").agg(F.max("batch")).first()[0]
        aside = self.bases.aside()
        self._sums().select("term", F.col("df").alias("delta")).write.parquet(aside)
        if last is None or not self.bases.publish(aside, last + 1):
            self.bases.delete(aside.rsplit("/", 1)[1])
