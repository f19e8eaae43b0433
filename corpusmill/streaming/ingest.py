"""Compilation of documents as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.config import Config
from corpusmill.functions.text import slugify
from corpusmill.operators.segment import with_title
from corpusmill.plans.compile import compile_corpus


def document_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New text files of a folder, each as a document."""
    rows = spark.readStream.schema("value string").option("recursiveFileLookup", "true").text(folder, wholetext=True)
    rows = rows.select(F.input_file_name().alias("path"), F.regexp_replace("value", r"\r\n?", "\n").alias("text"))
    name = F.element_at(F.split("path", "/"), -1)
    rows = rows.withColumn("source_file", name).withColumn("__stem", F.regexp_replace(name, r"\.[^.]*$", ""))
    return with_title(rows.withColumn("slug", slugify(F.col("__stem"))), "text", "__stem").select("slug", "source_file", "title", "text")


def compile_stream(documents: DataFrame, table: str, checkpoint: str, cfg: Config = Config(), created_at: str | None = None) -> StreamingQuery:
    """Appends the records of arriving documents to a Parquet table. Every step works within a document, so no state is kept; a batch that
    is repeated after a failure writes its folder again."""

    def write(batch: DataFrame, number: int) -> None:
        compile_corpus(batch, cfg, created_at=created_at).write.mode("overwrite").parquet(f"{table}/batch={number}")

    return documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
