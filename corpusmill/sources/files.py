"""Text files, wiki exports, chunk files, and the stamp of the last compilation."""

from __future__ import annotations

import json
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusmill.functions.text import slugify
from corpusmill.operators.segment import with_title

SUFFIXES = ("md", "markdown", "txt", "text")
STUB_BACKEND = "StubClassifier"


def whole_files(spark: SparkSession, folder: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """path and text of a folder's files, line ends as line feeds; bytes that aren't UTF-8 become the replacement character."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    rows = (reader.option("pathGlobFilter", glob) if glob else reader).text(folder, wholetext=True)
    return rows.select(F.input_file_name().alias("path"), F.regexp_replace("value", r"\r\n?", "\n").alias("text"))


def discover_documents(spark: SparkSession, folder: str) -> DataFrame:
    """slug, source_file, title, text and path of the documents below a folder; none if there is no such folder."""
    schema = "slug string, source_file string, title string, text string, path string"
    if "://" not in folder and not Path(folder).is_dir():
        return spark.createDataFrame([], schema)
    rows = whole_files(spark, folder)
    rows = rows.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*SUFFIXES))
    name = F.url_decode(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\+", "%2B"))
    rows = rows.withColumn("source_file", name).withColumn("__stem", F.regexp_replace("source_file", r"\.[^.]*$", ""))
    return with_title(rows.withColumn("slug", slugify(F.col("__stem"))), "text", "__stem").select("slug", "source_file", "title", "text", "path")


def discover_pages(spark: SparkSession, folder: str) -> DataFrame:
    """path and html of an export's pages; import_pages leaves out those in folders of chrome."""
    return whole_files(spark, folder, "*.html").withColumnRenamed("text", "html")


@F.pandas_udf(StructType([StructField("record", StringType()), StructField("error", StringType())]))
def _yaml_as_json(heads: pd.Series) -> pd.DataFrame:
    import yaml

    out = []
    for head in heads:
        try:
            record = yaml.safe_load(head)
            out.append((json.dumps(record, default=str), None) if isinstance(record, dict) else (None, "frontmatter is not a mapping"))
        except Exception as e:  # noqa: BLE001  reported in its row
            out.append((None, f"{type(e).__name__}: {e}"))
    return pd.DataFrame(out, columns=["record", "error"])


def parse_chunk_files(files: DataFrame) -> DataFrame:
    """path, record (JSON), body and error of chunk files: frontmatter between the first two fences, then the body, stripped."""
    at = F.locate("\n---\n", F.col("text"), 4)
    opened = F.col("text").startswith("---\n")
    error = F.when(~opened, "no frontmatter fence").when(at == 0, "unterminated frontmatter")
    rows = files.select("path", "text", at.alias("__at"), error.alias("__error"))
    head = F.when(F.col("__error").isNull(), F.substring(F.col("text"), F.lit(5), F.col("__at") - 4))
    rows = rows.withColumn("__y", _yaml_as_json(F.coalesce(head, F.lit(""))))
    body = F.when(F.col("__error").isNull(), F.regexp_replace(F.col("text").substr(F.col("__at") + 5, F.length("text")), r"\A\s+|\s+\z", ""))
    return rows.select("path", F.when(F.col("__error").isNull(), F.col("__y.record")).alias("record"), body.alias("body"), F.coalesce("__error", "__y.error").alias("error"))


def read_chunk_files(spark: SparkSession, folder: str) -> DataFrame:
    return parse_chunk_files(whole_files(spark, folder, "*.md", recursive=False))


def read_backend_stub(index_json: str) -> bool:
    """Whether the last compilation ran without a model; false if that can't be told."""
    try:
        return json.loads(Path(index_json).read_text(encoding="utf-8")).get("backend") == STUB_BACKEND
    except (OSError, ValueError, AttributeError):
        return False
