"""Folders that appear whole or not at all: written aside, then renamed to the next number."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

LOST = ("FileAlreadyExistsException", "already exists", "ParentNotDirectory")


class Versions:
    """Numbered folders ``version-N`` below ``path``, on any file system that Spark reaches. Readers see those whose rename is done."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self.at("").getFileSystem(self._conf)

    def at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def folder(self, number: int) -> str:
        return f"{self.path}/version-{number}"

    def numbers(self) -> list[int]:
        if not self._files.exists(self.at("")):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(self.at(""))]
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"version-(\d+)", n)))

    def inside(self, number: int) -> list[str]:
        return [s.getPath().getName() for s in self._files.listStatus(self.at(f"version-{number}"))]

    def read_text(self, name: str) -> str:
        stream = self._files.open(self.at(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """A small file, by the driver."""
        stream = self._files.create(self.spark._jvm.org.apache.hadoop.fs.Path(path))
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def aside(self) -> str:
        """A folder of this writer alone; what a writer that was lost leaves there, no reader sees."""
        return f"{self.path}/_writing-{uuid.uuid4().hex}"

    def publish(self, written: str, number: int) -> bool:
        """Rename to that number. False, with nothing changed, if another writer was first."""
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.at("").toUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        if self._files.exists(self.at(f"version-{number}")):
            return False
        try:
            context.rename(self.spark._jvm.org.apache.hadoop.fs.Path(written), self.at(f"version-{number}"), options)
        except Exception as e:
            if any(x in str(e) for x in LOST):
                return False
            raise
        return True

    def append(self, written: str) -> int:
        """Rename to the first free number after the last; where another writer takes it, to the one after."""
        while True:
            number = (self.numbers() or [0])[-1] + 1
            if self.publish(written, number):
                return number

    def delete(self, name: str) -> None:
        self._files.delete(self.at(name), True)
