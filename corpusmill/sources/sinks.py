"""Chunk files, index files, packs and archives."""

from __future__ import annotations

import json
import shutil
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from pathlib import Path
from typing import Any

from pyarrow import fs
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


#: what stands between two entries of a pack
BETWEEN = ",\n    "


def _yaml(record: dict[str, Any]) -> str:
    import yaml

    return yaml.safe_dump(record, sort_keys=False, allow_unicode=True, width=100, default_flow_style=False)


def chunk_file(record: dict[str, Any], body: str) -> str:
    return f"---\n{_yaml(record)}---\n\n{body.strip()}\n"


@dataclass
class _Attempt(WriterCommitMessage):
    """What one task wrote: a folder of its own, and the names of the files in it."""

    folder: str
    names: list[str]


def _files_of(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), str(Path(folder).absolute()))


class _NamedFiles(DataSourceWriter):
    """Writes each row's text to the file that it names. Each attempt of a task writes to a folder of its own; when all tasks are done, the files
    of those attempts that count are moved into place. A task that is lost or repeated, or a job that fails, leaves no file under its name."""

    def __init__(self, folder: str):
        self.folder, self.job = folder, uuid.uuid4().hex

    def _attempts(self) -> tuple[fs.FileSystem, str, str]:
        files, folder = _files_of(self.folder)
        return files, folder, f"{folder}/_writing-{self.job}"

    def write(self, iterator: Iterator[Any]) -> WriterCommitMessage:
        files, _, attempts = self._attempts()
        own, names = f"{attempts}/{uuid.uuid4().hex}", []
        files.create_dir(own)
        for row in iterator:
            name = row["name"]
            if not name or "/" in name or name in (".", ".."):
                raise ValueError(f"{name!r} is no file name")
            with files.open_output_stream(f"{own}/{name}") as out:
                out.write(row["text"].encode())
            names.append(name)
        return _Attempt(own, names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, folder, attempts = self._attempts()
        moves = [(f"{m.folder}/{name}", f"{folder}/{name}") for m in messages if m for name in dict.fromkeys(m.names)]
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda move: files.move(*move), moves))
        self._clear(files, attempts)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, _, attempts = self._attempts()
        self._clear(files, attempts)

    @staticmethod
    def _clear(files: fs.FileSystem, attempts: str) -> None:
        if files.get_file_info(attempts).type == fs.FileType.Directory:
            files.delete_dir(attempts)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "namedfiles"

    def schema(self) -> str:
        return "name string, text string"

    def writer(self, schema: Any, overwrite: bool) -> DataSourceWriter:
        return _NamedFiles(self.options["path"])


def write_named_files(rows: DataFrame, folder: str) -> None:
    """``name`` and ``text`` of each row as a file."""
    rows.sparkSession.dataSource.register(NamedFiles)
    rows.select("name", "text").write.format("namedfiles").mode("append").save(folder)


def write_chunk_files(records: DataFrame, folder: str, fm: str = "fm", body: str = "body") -> None:
    """One file ``<chunk_id>.md`` for each record; files of the same name are replaced, others stay."""
    as_json = F.to_json(F.struct(F.col(f"{fm}.*")), {"ignoreNullFields": "false"})
    aliases = F.to_json(F.map_from_entries(F.col(f"{fm}.aliases")))
    rows = records.select(F.col(f"{fm}.chunk_id").alias("id"), as_json.alias("record"), aliases.alias("aliases"), F.col(body).alias("body"))

    def render(batches: Iterator[Any]) -> Iterator[Any]:
        for batch in batches:
            texts = [chunk_file({**json.loads(r), "aliases": json.loads(a or "{}")}, b) for r, a, b in zip(batch["record"], batch["aliases"], batch["body"], strict=True)]
            yield batch.assign(name=batch["id"] + ".md", text=texts)[["name", "text"]]

    write_named_files(rows.mapInPandas(render, "name string, text string"), folder)


def index_object(entries: DataFrame, siblings: DataFrame, *, generated_at: str, documents: int, chunks: int) -> dict:
    """The index as one object; a sink for corpora whose index fits the driver. Larger ones keep the tables."""
    near: dict[str, dict[str, float]] = {}
    for row in siblings.orderBy("a", "b").toLocalIterator():
        near.setdefault(row["a"], {})[row["b"]] = row["score"]
    rows = entries.orderBy("document_slug").toLocalIterator()
    named = {r["document_slug"]: {"root_terms": list(r["root_terms"]), "children": list(r["children"]), "siblings": near.get(r["document_slug"], {})} for r in rows}
    return {"generated_at": generated_at, "corpus_stats": {"total_documents": documents, "total_chunks": chunks, "total_entries": len(named)}, "entries": named}


def index_markdown(index: dict, title: str) -> tuple[str, dict[str, int]]:
    """The index as text, and the line of each entry's header."""
    s = index["corpus_stats"]
    text = [f"# {title}", "", f"_Generated: {index['generated_at']}_", "", f"- Documents: {s['total_documents']}  - Chunks: {s['total_chunks']}  - Entries: {s['total_entries']}", ""]
    at = {}
    for slug, entry in sorted(index["entries"].items()):
        at[slug] = len(text) + 1
        near = ", ".join(f"{k} ({v})" for k, v in sorted(entry["siblings"].items())) or "none"
        text += [f"## {slug}", "", f"- **root_terms:** {', '.join(entry['root_terms'])}", f"- **children:** {len(entry['children'])} chunks", f"- **siblings:** {near}", ""]
    return "\n".join(text) + "\n", at


def write_json(value: dict, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, indent=2, ensure_ascii=False, allow_nan=False) + "\n", encoding="utf-8")


def write_pack(chunks: DataFrame, header: dict, path: str) -> int:
    """One JSON object, its chunks in the order of their ids. Returns how many there are.

    Tasks write the entries of ranges of ids as text files, under Spark's protocol for lost and repeated tasks. The file is stitched from these,
    in order, by copying bytes within the file system's client, and renamed into place when it is whole: no row passes the driver."""
    spark = chunks.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path if "://" in path else str(Path(path).absolute()))
    files, aside = target.getFileSystem(spark._jsc.hadoopConfiguration()), f"{target.toString()}.writing-{uuid.uuid4().hex}"
    at = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{aside}/{name}" if name else aside)

    def render(batches: Iterator[Any]) -> Iterator[Any]:
        for batch in batches:
            texts = [json.dumps(json.loads(j), indent=2, ensure_ascii=False, allow_nan=False).replace("\n", "\n    ") for j in batch["j"]]
            yield batch.assign(value=texts)[["value"]]

    counted = Observation()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = chunks.select("id", F.to_json(F.struct(*chunks.columns), {"ignoreNullFields": "false"}).alias("j"))
    rows = rows.repartitionByRange(tasks, "id").sortWithinPartitions("id").select("j").observe(counted, F.count("*").alias("n"))
    try:
        rows.mapInPandas(render, "value string").write.option("lineSep", BETWEEN).text(f"{aside}/entries")
        n = counted.get["n"]
        parts = sorted((s for s in files.listStatus(at("entries")) if s.getPath().getName().startswith("part-")), key=lambda s: int(s.getPath().getName().split("-")[1]))
        parts = [p for p in parts if p.getLen()]
        out = files.create(at("whole"))
        head = json.dumps(header, indent=2, ensure_ascii=False, allow_nan=False)[:-2]
        out.write(bytearray(f'{head},\n  "chunks": ['.encode() + (b"\n    " if n else b"")))
        for i, part in enumerate(parts):
            stream = files.open(part.getPath())
            # the last entry is followed by nothing
            spark._jvm.org.apache.commons.io.IOUtils.copyLarge(stream, out, 0, part.getLen() - (len(BETWEEN) if i == len(parts) - 1 else 0))
            stream.close()
        out.write(bytearray(b"\n  ]\n}\n" if n else b"]\n}\n"))
        out.close()
        files.mkdirs(target.getParent())
        files.delete(target, False)
        files.rename(at("whole"), target)
    finally:
        files.delete(at(""), True)
    return n


def archive_build(*, raw_dir: str, chunks_dir: str, index_json: str, index_md: str, pack_path: str, archive_root: str, pack_id: str, built_at: str) -> Path:
    """Moves sources, chunk files and index to a new folder of the archive and copies the pack there. A taken name gets a number."""
    stamp = built_at.replace("-", "").replace(":", "")
    target, n = Path(archive_root) / f"{pack_id}_{stamp}", 1
    while target.exists():
        n += 1
        target = Path(archive_root) / f"{pack_id}_{stamp}_{n}"
    for source, name in ((raw_dir, "raw"), (chunks_dir, "chunks")):
        (target / name).mkdir(parents=True)
        for item in sorted(Path(source).iterdir()) if Path(source).is_dir() else []:
            shutil.move(str(item), target / name / item.name)
    for file in (index_json, index_md):
        if Path(file).exists():
            shutil.move(file, target / Path(file).name)
    shutil.copy2(pack_path, target / Path(pack_path).name)
    return target
