"""Getting the package to the executors, and writing tables that several steps read."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that all executors share, by spark.checkpoint.dir; what is written there is deleted when Python ends.

    Only where that setting is absent in local mode, as in tests, a temporary folder takes its place; a cluster without it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"{tempfile.gettempdir()}/corpusmill-checkpoints"
    path = f"{folder}/corpusmill-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def stored(df: DataFrame, **options: str) -> DataFrame:
    """``df`` for several readers: worked out once and written to a scratch folder, so that executors that are lost lose none of it."""
    path = scratch(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: bytes of an Arrow batch, where the session sets no other number: each Python worker of an executor holds some, and what is made of them
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once for each application, so that Python functions can be loaded there."""
    if not spark._jsparkSession.conf().contains("spark.sql.execution.arrow.maxBytesPerBatch"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        root = Path(__file__).resolve().parent
        handle, path = tempfile.mkstemp(prefix="corpusmill-", suffix=".zip")
        os.close(handle)
        with zipfile.ZipFile(path, "w") as target:
            for file in sorted(root.rglob("*.py")):
                target.write(file, f"{root.name}/{file.relative_to(root)}")
        context.addPyFile(path)
    return spark
