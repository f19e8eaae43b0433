"""URL filter: allow and block entries in a trie over reversed host labels and path segments; the longest match decides.

An entry is a host and a path, written ``host/path``. It fits its host and every subdomain of it when the URL's path starts with the
entry's path. More host labels win, then the longer path; an entry in both lists blocks. URLs that no entry fits get ``default``.

Tries of at most ``max_broadcast_bytes`` are broadcast; a longer list becomes several, which judge every URL one after the other, each
keeping the longer of its own entry and the one found so far. So the verdict does not depend on the size of the list, and a URL is never shuffled.

Rows: a null URL, or one without ``://``, has an empty host and path and no entry fits it. Repeated rows and null ids stay as they are,
an empty table gives an empty result, and other columns of the input are not read. Kept columns named host, path, rule or verdict are an
error that names them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import check_names

PARTS = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url: str | None) -> tuple[str, str]:
    """Host, A-Z lower-cased, and path."""
    found = PARTS.search(url) if url else None
    return (found[1].translate(UPPER), found[2]) if found else ("", "")


def entry(rule: str) -> tuple[str, str]:
    """``host/path`` as the host and the path, which begins with the slash (empty where there is none)."""
    host, slash, path = rule.partition("/")
    return host.translate(UPPER), slash + path


@dataclass
class PathNode:
    """Entries below one run of whole segments; ``tails`` are entries whose last segment is begun only, ``sizes`` their lengths, falling."""

    below: dict[str, "PathNode"] = field(default_factory=dict)
    tails: dict[str, tuple[str, str]] = field(default_factory=dict)
    sizes: list[int] = field(default_factory=list)


@dataclass
class HostNode:
    below: dict[str, "HostNode"] = field(default_factory=dict)
    paths: PathNode | None = None


#: an entry that fits: labels of its host, length of its path, the entry, its verdict
Fit = tuple[int, int, str, str]


class UrlTrie:
    def __init__(self, entries: Iterable[tuple[str, str]]):
        """``entries``: rule and verdict; the later of two that are equal stays."""
        self.root = HostNode()
        for rule, verdict in entries:
            self.add(rule, verdict)

    def add(self, rule: str, verdict: str) -> None:
        host, path = entry(rule)
        node = self.root
        for label in reversed(host.split(".")):
            node = node.below.setdefault(label, HostNode())
        node.paths = node.paths or PathNode()
        at = node.paths
        *whole, tail = path.split("/")
        for segment in whole:
            at = at.below.setdefault(segment, PathNode())
        at.tails[tail] = (rule, verdict)
        if len(tail) not in at.sizes:
            at.sizes = sorted([*at.sizes, len(tail)], reverse=True)

    def match(self, host: str, path: str) -> Fit | None:
        """The longest entry that fits."""
        best, node = None, self.root
        segments = path.split("/")
        for depth, label in enumerate(reversed(host.split(".")), 1):
            node = node.below.get(label)
            if node is None:
                break
            if node.paths is not None and (found := self._longest(node.paths, segments)):
                best = (depth, *found)
        return best

    @staticmethod
    def _longest(at: PathNode, segments: list[str]) -> tuple[int, str, str] | None:
        """Of each length of tails at a node one is looked up, so long lists below one host cost no more than short ones."""
        best, before = None, 0
        for k, segment in enumerate(segments):
            for size in at.sizes:
                if size <= len(segment) and (found := at.tails.get(segment[:size])):
                    best = (before + size, *found)
                    break
            if k + 1 == len(segments) or (below := at.below.get(segment)) is None:
                break
            at, before = below, before + len(segment) + 1
        return best


MADE = ("host", "path", "rule", "verdict")


def entry_runs(allow: Iterable[str], block: Iterable[str], most_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The entries with their verdicts, allow before block, in runs whose tries take about ``most_bytes`` at most."""
    run, held = [], 0
    for rule, verdict in chain(((r, "allow") for r in allow), ((r, "block") for r in block)):
        size = 600 + 2 * len(rule) + 300 * rule.count("/")
        if run and held + size > most_bytes:
            yield run
            run, held = [], 0
        run.append((rule, verdict))
        held += size
    yield run


def filter_urls(df: DataFrame, allow: Iterable[str], block: Iterable[str], *, url: str = "url", keep: tuple[str, ...] = (), default: str = "allow", max_broadcast_bytes: int = 64_000_000) -> DataFrame:
    """``keep`` columns of ``df`` with host, path, rule (null where none fits) and verdict."""
    check_names(keep, MADE)
    own = [f"__keep{i}" for i in range(len(keep))]
    rows = df.select(*[F.col(k).alias(o) for k, o in zip(keep, own, strict=True)], F.col(url).cast("string").alias("__url"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    rows = rows.withColumn("__best", F.lit(None).cast(BEST))
    for run in entry_runs(allow, block, max_broadcast_bytes):
        rows = rows.mapInArrow(_judge(df.sparkSession.sparkContext.broadcast(UrlTrie(run))), f"{kept}`__url` string, `__best` {BEST}")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parts(u) for u in batch.column(len(own)).to_pylist()]
            best = batch.column(len(own) + 1).to_pylist()
            columns = [[h for h, _ in found], [p for _, p in found], [b and b["rule"] for b in best], [b["verdict"] if b else default for b in best]]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], *(pa.array(c, pa.string()) for c in columns)], [*own, *MADE])

    return rows.mapInArrow(split, kept + ", ".join(f"{m} string" for m in MADE)).toDF(*keep, *MADE)


BEST = "struct<labels:int,chars:int,rule:string,verdict:string>"


def _judge(trie: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Puts the trie's best entry for each URL in the place of the one known so far, unless that is longer."""
    kind = pa.struct([("labels", pa.int32()), ("chars", pa.int32()), ("rule", pa.string()), ("verdict", pa.string())])

    def better(host: str, path: str, known: dict | None) -> dict | None:
        found = trie.value.match(host, path) if host else None
        if found is None or (known and (known["labels"], known["chars"]) > found[:2]):
            return known
        return dict(zip(("labels", "chars", "rule", "verdict"), found, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, known = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            best = [better(*parts(u), k) for u, k in zip(urls, known, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(best, kind)], batch.schema.names)

    return run
