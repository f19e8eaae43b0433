"""Command line: ingest, query, doctor, import-html and export."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusmill.config import Config, load_config
from corpusmill.functions.text import slug_of
from corpusmill.operators import annotate, html, pack, search, segment
from corpusmill.plans import compile as plan
from corpusmill.reporting import progress
from corpusmill.session import scratch, ship
from corpusmill.sources import files, model, sinks
from corpusmill.sources.collection import Collection


def session() -> SparkSession:
    spark = ship(SparkSession.builder.appName("corpusmill").config("spark.sql.session.timeZone", "UTC").config("spark.sql.maxPlanStringLength", "100000").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.catalog.clearCache()  # files may have changed since another command of this process
    return spark


def _written(df: DataFrame, path: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``df`` from a table that is read from now on, so that no later step computes it again, and aggregates that were worked out while it was written."""
    seen = Observation()
    df.observe(seen, F.count("*").alias("rows"), *[c.alias(k) for k, c in counts.items()]).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), {"rows": 0} | dict.fromkeys(counts, 0) | seen.get


def collection(spark: SparkSession, cfg: Config) -> Collection:
    return Collection(spark, f"{cfg.paths.chroma_dir}/{cfg.embeddings.collection_name}")


def ingest(args: argparse.Namespace, cfg: Config) -> int:
    spark, at = session(), plan.now()
    told = progress(args.plain, spark)
    work = f"{cfg.paths.chroma_dir}/work"
    with told.stage("discover") as notes:
        documents, seen = _written(files.discover_documents(spark, cfg.paths.raw_dir), f"{work}/documents")
        notes.append(f"{(n := seen['rows'])} documents")
    if not n:
        print(f"no documents in {cfg.paths.raw_dir}")
        return 0
    with told.stage("chunk"):
        chunks, _ = _written(plan.first_chunks(segment.chunk_documents(documents, cfg.chunking), args.limit), f"{work}/chunks")
    with told.stage("classify") as notes:
        answers = None
        if not args.stub:
            answers, seen = _written(model.ask_on(chunks, cfg.model, f"{cfg.paths.chroma_dir}/answers"), f"{work}/answers", without=F.count_if(F.col("answer").isNull()))
            notes.append(f"{seen['without']} without an answer")
    whole = plan.full_corpus(documents, cfg, created_at=at, answers=answers, chunks=chunks) if args.full else None
    made = whole.records if whole else plan.compile_corpus(documents, cfg, created_at=at, answers=answers, chunks=chunks)
    with told.stage("records") as notes:
        records, seen = _written(made, f"{work}/records")
        notes.append(f"{(chunks := seen['rows'])} chunks")
    with told.stage("problems") as notes:
        found, seen = _written(annotate.validate_frontmatter(records), f"{work}/problems")
        problems = [r["problem"] for r in found.limit(10).collect()] if seen["rows"] else []
        notes.append(f"{seen['rows']} problems")
    if not args.no_files:
        with told.stage("files"):
            sinks.write_chunk_files(records, cfg.paths.chunks_dir)
    index = {"generated_at": at, "corpus_stats": {"total_documents": n, "total_chunks": chunks, "total_entries": 0}, "entries": {}}
    if whole:
        seen = records.select(F.countDistinct("fm.document_slug")).first()[0]
        index = sinks.index_object(whole.entries, whole.siblings, generated_at=at, documents=seen, chunks=chunks)
        Path(cfg.paths.index_md).write_text(sinks.index_markdown(index, cfg.pack.index_title)[0], encoding="utf-8")
        rows = pack.flat_metadata(records)
        text = records.select(F.col("fm.chunk_id").alias("chunk_id"), pack.embedding_text(F.col("body"), F.col("fm.aliases"), cfg.embeddings.alias_strategy).alias("document"))
        with told.stage("collection") as notes:
            notes.append(f"{collection(spark, cfg).upsert(rows.join(text, 'chunk_id'))} chunks upserted")
        whole.weights.write.mode("overwrite").parquet(f"{cfg.paths.chroma_dir}/weights")
        whole.idf.write.mode("overwrite").parquet(f"{cfg.paths.chroma_dir}/idf")
    sinks.write_json(index | {"backend": files.STUB_BACKEND if args.stub else "ModelClassifier"}, cfg.paths.index_json)
    print(f"{n} documents, {chunks} chunks, {len(problems)} problems shown")
    for p in problems:
        print(f"  {p}")
    return int(bool(problems))


def query(args: argparse.Namespace, cfg: Config) -> int:
    spark = session()
    held = collection(spark, cfg)
    if not held.versions() or not held.count():
        print("nothing to search; run ingest --full first")
        return 1
    found = held.query(args.text, args.n)
    if args.words:
        weights, idf = (spark.read.parquet(f"{cfg.paths.chroma_dir}/{name}") for name in ("weights", "idf"))
        found = search.lexical_top_k(weights, idf, args.text, args.n)
    for row in found.collect():
        print(f"{row['score']:.3f}  {row['chunk_id']}")
    return 0


def doctor(args: argparse.Namespace, cfg: Config) -> int:
    try:
        import yaml  # noqa: F401

        ready = True
    except ImportError:
        ready = False
    print(f"yaml: {'ok' if ready else 'missing'}")
    print(f"model: {model.healthcheck(cfg.model)[1]}")
    for name in ("raw_dir", "chunks_dir", "chroma_dir"):
        folder = Path(getattr(cfg.paths, name))
        print(f"{name}: {folder} ({sum(1 for _ in folder.rglob('*')) if folder.is_dir() else 'absent'})")
    return int(not ready)


def import_html(args: argparse.Namespace, cfg: Config) -> int:
    spark = session()
    kinds = {kind: F.count_if(F.col("status") == kind) for kind in ("converted", "stub", "unparseable")}
    pages, counts = _written(html.import_pages(files.discover_pages(spark, args.folder), min_words=args.min_words), scratch(spark), **kinds)
    done = pages.where("status = 'converted'").select(F.concat("slug", F.lit(".md")).alias("name"), F.concat(F.lit("# "), "title", F.lit("\n\n"), "body", F.lit("\n")).alias("text"))
    sinks.write_named_files(done, args.out or cfg.paths.raw_dir)
    print(f"{counts['converted']} converted, {counts['stub']} stubs, {counts['unparseable']} unparseable")
    if args.verbose:
        for r in pages.where("status = 'unparseable'").select("path").toLocalIterator():
            print(f"  {r['path']}")
    return 0


def parsed_records(parsed: DataFrame) -> DataFrame:
    """``fm`` and body from parsed chunk files; a file that can't be read is an error."""
    kind = "struct<chunk_id:string,document_slug:string,source_file:string,document_title:string,summary:string,status:string,tokens:string,topics:array<struct<topic:string,depth:string>>,aliases:map<string,string>,navigation:struct<current:string>>"
    fm = F.from_json("record", kind)
    aliases = F.transform(F.map_entries(F.coalesce(F.col("r.aliases"), F.create_map().cast("map<string,string>"))), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    rows = parsed.withColumn("record", F.when(F.col("error").isNotNull(), F.raise_error(F.concat("path", F.lit(": "), "error"))).otherwise(F.col("record")))
    return rows.select(fm.alias("r"), "body").select(F.col("r").withField("aliases", aliases).alias("fm"), "body")


def export(args: argparse.Namespace, cfg: Config) -> int:
    spark, at = session(), plan.now()
    chunks = pack.pack_chunks(parsed_records(files.read_chunk_files(spark, cfg.paths.chunks_dir))).persist()
    stats = chunks.agg(F.countDistinct("source.doc").alias("d"), F.count("*").alias("n")).first()
    pack_id = args.id or slug_of(Path(args.out).stem)
    header = pack.pack_header(cfg, pack_id=pack_id, name=args.name or pack_id, description=args.description or f"{stats['d']} documents / {stats['n']} chunks", version=args.pack_version, built_at=at, stub=files.read_backend_stub(cfg.paths.index_json))
    problems = pack.header_problems(header, cfg) + [r["problem"] for r in pack.chunk_problems(chunks).limit(10).collect()]
    if problems:
        print("not written:", *problems, sep="\n  ")
        return 1
    print(f"{sinks.write_pack(chunks, header, args.out)} chunks in {args.out}")
    if args.archive:
        p = cfg.paths
        print(sinks.archive_build(raw_dir=p.raw_dir, chunks_dir=p.chunks_dir, index_json=p.index_json, index_md=p.index_md, pack_path=args.out, archive_root=p.archive_dir, pack_id=pack_id, built_at=at))
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="corpusmill", description=__doc__)
    parser.add_argument("--config")
    commands = parser.add_subparsers(dest="command", required=True)
    c = commands.add_parser("ingest")
    for flag in ("--stub", "--no-files", "--plain", "--full"):
        c.add_argument(flag, action="store_true")
    c.add_argument("--limit", type=int)
    c.set_defaults(run=ingest)
    c = commands.add_parser("query")
    c.add_argument("text")
    c.add_argument("-n", type=int, default=5)
    c.add_argument("--words", action="store_true", help="by TF-IDF of the words instead of vectors")
    c.set_defaults(run=query)
    commands.add_parser("doctor").set_defaults(run=doctor)
    c = commands.add_parser("import-html")
    c.add_argument("folder")
    c.add_argument("--out")
    c.add_argument("--min-words", type=int, default=10)
    c.add_argument("--verbose", action="store_true")
    c.set_defaults(run=import_html)
    c = commands.add_parser("export")
    c.add_argument("--out", required=True)
    c.add_argument("--id")
    c.add_argument("--name")
    c.add_argument("--description")
    c.add_argument("--pack-version", default="1.0.0")
    c.add_argument("--archive", action="store_true")
    c.set_defaults(run=export)
    args = parser.parse_args(argv)
    return args.run(args, load_config(args.config))


if __name__ == "__main__":
    sys.exit(main())
