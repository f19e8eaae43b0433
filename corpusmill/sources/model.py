"""Answers of a chat model for chunks, over an endpoint in the style of OpenAI's. Off unless called."""

from __future__ import annotations

import contextlib
import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.config import Section

SYSTEM = (
    "You classify one chunk of a document. Answer with a single JSON object with the keys chunk_type, summary, topics (a list of objects with "
    "topic and depth), aliases (an object), goal_affinity (a list of objects with domain and weight), utility, authority, confidence and standalone."
)


def prompt() -> Column:
    """Title, heading if there is one, place, and the body in a fence."""
    heading = F.when(F.coalesce("heading", F.lit("")) != "", F.concat(F.lit("Section: "), F.col("heading")))
    place = F.format_string("Chunk: %d of %d", F.col("idx") + 1, F.col("total"))
    return F.concat_ws("\n", F.concat(F.lit("Document: "), F.col("document_title")), heading, place, F.lit('"""'), F.col("body"), F.lit('"""'))


def healthcheck(cfg: Section) -> tuple[bool, str]:
    url = cfg.base_url.rstrip("/") + "/models"
    try:
        with urllib.request.urlopen(url, timeout=8):
            return True, f"reachable: {cfg.base_url}"
    except (OSError, ValueError) as e:
        return False, f"unreachable ({url}): {e}"


class NoAnswer(Exception):
    """An attempt gave nothing that can be used."""


def _attempt(cfg: Section, text: str) -> str:
    body = {"model": cfg.model, "messages": [{"role": "system", "content": SYSTEM}, {"role": "user", "content": text}], "temperature": cfg.temperature, "max_tokens": cfg.max_tokens, "response_format": {"type": "json_object"}}
    head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {cfg.api_key}"} if cfg.api_key else {})
    request = urllib.request.Request(cfg.base_url.rstrip("/") + "/chat/completions", json.dumps(body).encode(), head)
    try:
        with urllib.request.urlopen(request, timeout=cfg.timeout) as reply:
            content = json.load(reply)["choices"][0]["message"]["content"]
    except (OSError, ValueError, LookupError, TypeError) as e:
        raise NoAnswer from e
    if not isinstance(content, str) or "{" not in content:
        raise NoAnswer
    return content


def ask(chunks: DataFrame, cfg: Section, *, parallel: int = 4, pause: float = 0.5, longest_pause: float = 30.0) -> DataFrame:
    """chunk_id and answer, null where each of retries + 1 attempts failed.

    Each task has up to ``parallel`` requests under way. After a failure a request waits ``pause`` seconds, twice as long after each further
    one, ``longest_pause`` at most, times a random share, so that tasks whose server was busy do not all come back at once."""

    def call(text: str) -> str | None:
        for n in range(cfg.retries + 1):
            if n:
                time.sleep(min(longest_pause, pause * 2 ** (n - 1)) * random.uniform(0.5, 1))
            with contextlib.suppress(NoAnswer):
                return _attempt(cfg, text)
        return None

    def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(parallel) as pool:
            for batch in batches:
                yield pd.DataFrame({"chunk_id": batch["chunk_id"], "answer": list(pool.map(call, batch["prompt"]))})

    return chunks.select("chunk_id", prompt().alias("prompt")).mapInPandas(answers, "chunk_id string, answer string")


ANSWERS = "chunk_id string, asked string, answer string"


def ask_on(chunks: DataFrame, cfg: Section, path: str, *, runs: int = 16, **how: float) -> DataFrame:
    """chunk_id and answer of these chunks, from a table of answers below ``path`` that grows: only chunks without an answer there are asked.

    Answers count for the same prompt, model and temperature; a chunk whose text has changed is asked again, and so is one that got no answer.
    Chunks go in ``runs`` parts, each written when it is done, so a run that breaks off has lost one part at most."""
    spark = chunks.sparkSession
    asked = F.sha2(F.concat_ws("\0", F.lit(f"{cfg.model} {cfg.temperature} {cfg.max_tokens}"), F.lit(SYSTEM), prompt()), 256).alias("asked")
    wanted = chunks.select("*", asked)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)

    def known() -> DataFrame:
        there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
        return spark.read.schema(ANSWERS).parquet(path) if there else spark.createDataFrame([], ANSWERS)

    open_ = wanted.join(known().where("answer IS NOT NULL"), ["chunk_id", "asked"], "left_anti")
    for run in range(runs):
        part = open_.where(F.pmod(F.xxhash64("chunk_id"), F.lit(runs)) == run)
        ask(part, cfg, **how).join(part.select("chunk_id", "asked"), "chunk_id").select("chunk_id", "asked", "answer").write.mode("append").parquet(path)
    answered = known().groupBy("chunk_id", "asked").agg(F.max("answer").alias("answer"))
    return wanted.select("chunk_id", "asked").join(answered, ["chunk_id", "asked"], "left").select("chunk_id", "answer")
