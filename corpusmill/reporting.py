"""What a run tells about its progress: nothing, plain lines, or one line that is written anew."""

from __future__ import annotations

import sys
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager
from typing import TextIO

from pyspark.sql import SparkSession


class Progress:
    """Says nothing; the others say more."""

    def begins(self, stage: str) -> None:
        pass

    def ends(self, stage: str, seconds: float, note: str) -> None:
        pass

    @contextmanager
    def stage(self, name: str) -> Iterator[list[str]]:
        """A stage of a run. What is put into the list is told at its end."""
        notes: list[str] = []
        self.begins(name)
        began = time.time()
        try:
            yield notes
        finally:
            self.ends(name, time.time() - began, ", ".join(notes))


class Lines(Progress):
    """A line where a stage ends."""

    def __init__(self, out: TextIO | None = None):
        self.out = out or sys.stdout

    def ends(self, stage: str, seconds: float, note: str) -> None:
        print(f"[{stage}] {note or 'done'} ({seconds:.1f} s)", file=self.out, flush=True)


class Live(Lines):
    """Meanwhile, how many of the tasks that Spark has begun are done, on one line."""

    def __init__(self, spark: SparkSession, out: TextIO | None = None, every: float = 0.25):
        super().__init__(out)
        self.tracker, self.every, self.over = spark.sparkContext.statusTracker(), every, threading.Event()
        self.teller: threading.Thread | None = None

    def begins(self, stage: str) -> None:
        self.over.clear()
        self.teller = threading.Thread(target=self._tell, args=(stage,), daemon=True)
        self.teller.start()

    def _tell(self, stage: str) -> None:
        while not self.over.wait(self.every):
            known = [s for i in self.tracker.getActiveStageIds() if (s := self.tracker.getStageInfo(i))]
            print(f"\r[{stage}] {sum(s.numCompletedTasks for s in known)} of {sum(s.numTasks for s in known)} tasks\x1b[K", end="", file=self.out, flush=True)

    def ends(self, stage: str, seconds: float, note: str) -> None:
        self.over.set()
        if self.teller:
            self.teller.join()
        print("\r\x1b[K", end="", file=self.out)
        super().ends(stage, seconds, note)


def progress(plain: bool, spark: SparkSession) -> Progress:
    """Lines if plain is asked for or the output is no terminal."""
    return Lines() if plain or not sys.stdout.isatty() else Live(spark)
