"""Classification, coercion, validation, packs, pages, files and the command line."""

import http.server
import io
import json
import threading

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusmill.__main__ import main
from corpusmill.config import Config, Index, Section
from corpusmill.operators import annotate, html, index, pack, salience, search, segment
from corpusmill.plans.compile import compile_corpus, first_chunks, full_corpus
from corpusmill.reporting import Lines, Live
from corpusmill.sources import files, model, sinks
from corpusmill.sources.collection import Collection
from corpusmill.streaming.ingest import compile_stream, document_stream

TEXTS = {
    "bread.md": "# Rye Bread\nRye flour and water. Rye bread needs rye sourdough.\n\n## Baking\nBake the bread for an hour. The bread cools slowly. " + "Crust forms early. " * 20,
    "boats.md": "# River Boats\n" + "A boat moves on the river. The river carries every boat slowly downstream. " * 8 + "\n## Locks\n" + "A lock lifts the boat. The lock gate opens for the boat. " * 10,
    "empty.md": "",
}


@pytest.fixture()
def documents(spark):
    rows = [(n[:-3], n, n[:-3].title(), t) for n, t in TEXTS.items()]
    return spark.createDataFrame(rows, "slug string, source_file string, title string, text string")


def test_topic_path_and_specificity(spark):
    rows = spark.sql("SELECT array(named_struct('topic','kimura','depth',0), named_struct('topic','bjj','depth',2), named_struct('topic','grip','depth',0)) AS t")
    assert tuple(rows.select(annotate.topic_path(F.col("t")), annotate.specificity(F.col("t"))).first()) == ("kimura.grip.bjj", 0.667)


def test_compiled_records_are_valid_and_linked(spark, documents):
    rows = compile_corpus(documents, created_at="2026-01-01T00:00:00Z")
    assert annotate.validate_frontmatter(rows).isEmpty()
    fm = {r["fm"]["chunk_id"]: r["fm"] for r in rows.collect()}
    assert len(fm) == 4 and fm["bread_000"]["navigation"]["next"] == "bread_001" and fm["bread_000"]["topics"][0]["topic"] == "rye-bread"
    assert fm["bread_000"]["salience"]["standalone"] is True and fm["bread_000"]["goal_affinity"][0]["domain"] == "general"


def test_full_compilation(spark, documents):
    done = full_corpus(documents, Config(index=Index(root_min_count=2)), created_at="2026-01-01T00:00:00Z")
    fm = [r["fm"] for r in done.records.collect()]
    assert len(fm) == 4 and {f["index_ref"]["line"] for f in fm} == {7, 13}
    assert {f["salience"]["lexical_distinctiveness"] for f in fm} >= {0.0, 1.0}
    assert annotate.validate_frontmatter(done.records).isEmpty()


def test_equal_chunks_are_not_distinct(spark):
    rows = spark.createDataFrame([("a", "same words here"), ("b", "same words here")], "chunk_id string, body string")
    counts = salience.term_counts(rows)
    weights = salience.tfidf(counts, salience.inverse_frequency(counts, rows))
    found = salience.lexical_distinctiveness(rows, weights, salience.centroid(weights, rows)).collect()
    assert [r[1] for r in found] == [0.0, 0.0]


def test_related_against_brute_force(spark):
    import random

    rng = random.Random(4)
    rows = [(f"c{i:02}", f"d{rng.randint(0, 4)}", rng.sample("abcdefgh", rng.randint(0, 4))) for i in range(60)]
    df = spark.createDataFrame(rows, "chunk_id string, document_slug string, names array<string>")
    found = {}
    for r in index.related_chunks(df, topics=F.col("names")).orderBy("chunk_id", "rank").collect():
        found.setdefault(r["chunk_id"], []).append(r["related_id"])
    for c, d, names in rows:
        scored = sorted((-len({*names} & {*n}) / len({*names} | {*n}), o) for o, e, n in rows if e != d and {*names} & {*n})
        assert found.get(c, []) == [o for s, o in scored if -s >= 0.2][:2]


def test_siblings_against_brute_force(spark):
    import math
    import random

    rng = random.Random(5)
    vectors = {f"e{i}": {t: rng.random() for t in rng.sample("abcdefghijkl", 5)} for i in range(25)}
    unit = {e: {t: w / math.sqrt(sum(x * x for x in v.values())) for t, w in v.items()} for e, v in vectors.items()}
    df = spark.createDataFrame([(e, t, w) for e, v in unit.items() for t, w in v.items()], "document_slug string, term string, w double")
    found = {(r["a"], r["b"]): r["score"] for r in index.entry_siblings(df, 0.6).collect()}
    want = {(a, b): s for a in unit for b in unit if a != b and (s := sum(w * unit[b].get(t, 0) for t, w in unit[a].items())) >= 0.6}
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) <= 0.0011 for k in want)


@pytest.mark.parametrize(
    ("answer", "want"),
    [
        ('```json\n{"chunk_type": " Fact ", "confidence": "0.9", "standalone": "no"}\n```', {"chunk_type": "fact", "confidence": 0.9, "standalone": False, "fallback": False}),
        ('So {"confidence": 2, "topics": [{"topic": "A B", "depth": "3"}, {"topic": "a b"}, 7, {"topic": "C", "depth": 9.7}]} ok', {"confidence": 1.0, "topics": [("a-b", 3), ("c", 4)]}),
        ('{"topics": [{"topic": "x", "depth": "2.9"}, {"topic": "y", "depth": 2.9}], "confidence": "NaN", "aliases": {"K 1": " v ", "n": 3}}', {"topics": [("x", 0), ("y", 2)], "confidence": 0.0, "aliases": [("k-1", "v")]}),
        ("[1, 2]", {"fallback": True, "confidence": 0.3, "topics": [("head", 0), ("body", 1), ("text", 1)]}),
        ("", {"fallback": True, "chunk_type": "section", "summary": "Body text here."}),
        (None, {"fallback": True}),
        ('{"aliases": {"zeta": "1", "yam": "2", "xi": "3", "Wu": "4", "alpha": "5", "xi ": "6"}}', {"aliases": [("zeta", "1"), ("yam", "2"), ("xi", "3"), ("wu", "4")], "fallback": False}),
        ('{"aliases": {"b x": "1", "a": "2", "B-X": "3", "日本": "4"}}', {"aliases": [("b-x", "3"), ("a", "2"), ("日本", "4")]}),
        ('{"utility": "procedural", "utility": "orienting", "confidence": NaN, "topics": [{"topic": "Élève", "depth": NaN}, {"topic": "y", "depth": Infinity}]}', {"utility": "orienting", "confidence": 0.0, "topics": [("eleve", 0), ("y", 0)], "fallback": False}),
        ('{"confidence": Infinity, "goal_affinity": [{"domain": "Café Ü", "weight": -1}, {"domain": "日本"}]}', {"confidence": 1.0, "goal_affinity": [("cafe-u", 0.0), ("日本", 0.5)]}),
        ('{"confidence": 1, "summary": "x"', {"fallback": True}),
        ('{"goal_affinity": [{"domain": "Fast Food", "weight": true}, {"domain": " "}, {"weight": 1}]}', {"goal_affinity": [("fast-food", 1.0)]}),
    ],
)
def test_answers_are_coerced(spark, answer, want):
    df = spark.createDataFrame([("c", "d", "Head", "Title", "Body text here. More body.", answer)], "chunk_id string, document_slug string, heading string, document_title string, body string, answer string")
    row = annotate.classify_answers(df).first().asDict()
    for k, v in want.items():
        assert ([tuple(x) for x in row[k]] if isinstance(v, list) else row[k]) == v, k


def test_pack_problems(spark):
    good = ("a", "T", "text")
    df = lambda *rows: spark.createDataFrame(rows, "id string, title string, text string")
    said = lambda d: sorted(r["problem"] for r in pack.chunk_problems(d).collect())
    assert said(df(good)) == []
    assert said(df(good, good)) == ["a: duplicate chunk id"]
    assert said(df(("b", "T", "x" * 8001), ("c", "", "x"), ("", "T", "x"))) == ["b: text length 8001 outside 1..8000", "c: empty title", "chunk with empty id"]
    assert said(df(good).limit(0)) == ["no active chunks to export"]
    header = pack.pack_header(Config(), pack_id="ok", name="n", description="d", version="1", built_at="x", stub=True)
    assert pack.header_problems(header) == [] and len(pack.header_problems(header | {"schema": "?", "id": "Not Valid!", "name": None})) == 3


PAGE = """<html><head><title>Space : Billing Overview</title></head><body><div id="breadcrumb-section">crumbs</div><div id="main-content"><h1>Bills</h1>
<p><strong>Note:</strong> pay <em>soon</em>.</p><ul><li>one<ol><li>deep</li></ol></li><li>two</li></ul><table><tr><th>A</th><th>B</th></tr><tr><td>x|y</td></tr></table>
<p>See <a href="https://example.com">site</a> and <a href="other.html">page</a>.</p><blockquote><p>quoted</p></blockquote><pre>a
 b</pre><div class="pageSection group">Attachments</div> lost tail</div><div id="footer">foot</div></body></html>"""


def test_pages_become_markdown():
    title, body = html.convert_page(PAGE)
    assert title == "Billing Overview"
    for part in ("# Bills", "**Note:** pay *soon*.", "- one\n  1. deep", "- two", "| A | B |\n| --- | --- |\n| x\\|y |  |", "[site](https://example.com) and page.", "> quoted", "```\na\n b\n```"):
        assert part in body, part
    for part in ("crumbs", "foot", "Attachments", "lost tail"):
        assert part not in body


def test_import_counts_and_names(spark):
    stub = "<html><head><title>S : Short</title></head><body>two words</body></html>"
    page = PAGE.replace("</ul>", "</ul>" + "<p>" + "filler " * 10 + "</p>")
    df = spark.createDataFrame([("/x/b.html", page), ("/x/a.html", page), ("/x/c.html", stub), ("/x/d.html", ""), ("/x/attachments/e.html", page)], "path string, html string")
    rows = {r["path"]: (r["status"], r["slug"]) for r in html.import_pages(df).collect()}
    assert rows == {"/x/a.html": ("converted", "billing-overview"), "/x/b.html": ("converted", "billing-overview-2"), "/x/c.html": ("stub", None), "/x/d.html": ("unparseable", None)}


def test_chunk_files_round_trip(spark, documents, tmp_path):
    rows = compile_corpus(documents, created_at="2026-01-01T00:00:00Z")
    sinks.write_chunk_files(rows, str(tmp_path / "chunks"))
    text = (tmp_path / "chunks" / "bread_000.md").read_text()
    assert text.startswith("---\nchunk_id: bread_000\ndocument_slug: bread\n")
    back = {json.loads(r["record"])["chunk_id"]: r["body"] for r in files.read_chunk_files(spark, str(tmp_path / "chunks")).collect()}
    assert back == {r["fm"]["chunk_id"]: r["body"].strip() for r in rows.collect()}


def test_broken_chunk_files_are_told(spark):
    df = spark.createDataFrame([("a", "no fence"), ("b", "---\nx: 1\n"), ("c", "---\n- 1\n---\n\nbody"), ("d", "---\nx: 1\n---\n\nbody\n---\nmore\n")], "path string, text string")
    rows = {r["path"]: r for r in files.parse_chunk_files(df).collect()}
    assert [rows[k]["error"] for k in "abc"] == ["no frontmatter fence", "unterminated frontmatter", "frontmatter is not a mapping"]
    assert rows["d"]["error"] is None and rows["d"]["body"] == "body\n---\nmore"


def test_index_text(spark):
    text, at = sinks.index_markdown({"generated_at": "now", "corpus_stats": {"total_documents": 2, "total_chunks": 3, "total_entries": 2}, "entries": {"b": {"root_terms": ["x"], "children": ["c"], "siblings": {"a": 0.5}}, "a": {"root_terms": ["y", "z"], "children": [], "siblings": {}}}}, "Index")
    assert at == {"a": 7, "b": 13} and text.splitlines()[6] == "## a" and text.splitlines()[12] == "## b" and "a (0.5)" in text
    lines = index.index_lines(spark.createDataFrame([(c,) for c in "hgfedcba"], "document_slug string")).orderBy("document_slug").collect()
    assert [r["line"] for r in lines] == list(range(7, 55, 6))


def test_first_chunks_by_path(spark):
    rows = [("b", "b.md", "B", "text of b", "/r/a/b.md"), ("a", "a.md", "A", "text of a", "/r/z/a.md"), ("c", "c.md", "C", "text of c", "/r/a-b/c.md")]
    df = spark.createDataFrame(rows, "slug string, source_file string, title string, text string, path string")
    first = lambda n: [r["chunk_id"] for r in first_chunks(segment.chunk_documents(df), n).collect()]
    assert first(2) == ["b_000", "c_000"] and len(first(0)) == 3


def test_collection(spark, tmp_path):
    held = Collection(spark, str(tmp_path / "c"))
    rows = lambda *x: spark.createDataFrame(x, "chunk_id string, document string, kind string")
    assert held.count() == 0 and held.versions() == [] and held.query("rye").collect() == []
    assert held.upsert(rows(("a", "rye bread", "x"), ("b", "river boats", "y"), ("b", "river boats", "y"), (None, "lost", "z"))) == 2
    assert held.upsert(rows(("b", "rye flour", "y"), ("c", "the lock", "y"))) == 2 and held.count() == 3
    assert held.upsert(rows(("d", "", "y")).drop("kind")) == 1 and len(held.versions()) == 3  # a delta for each
    assert [r["chunk_id"] for r in held.query("Rye bread", 2).collect()] == ["a", "b"]
    assert [r["chunk_id"] for r in held.query("rye bread", 2, where=F.col("kind") == "y").collect()][0] == "b"


def test_vectors_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(60)] + [(100, None), (101, []), (102, [1.0, 2.0]), (103, [float("nan"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if i is not None and v and len(v) == 3 and np.isfinite(v).all() and any(v)}
    got = {}
    for r in search.vectors_top_k(df.where("vec_id IS NOT NULL").repartition(3), df.where("vec_id % 10 = 0").withColumnRenamed("vec_id", "query_id"), 4, most_queries=4).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(round(r["score"], 9))
    assert got == {q: sorted((round(float(unit[q] @ v), 9) for v in unit.values()), reverse=True)[:4] for q in unit if q % 10 == 0}
    assert search.vectors_top_k(df, df.where("vec_id < 0").withColumnRenamed("vec_id", "query_id")).count() == 0


class _Model(http.server.BaseHTTPRequestHandler):
    calls: list[str] = []

    def _say(self, value):
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(value).encode())

    def do_GET(self):
        self._say({"data": []})

    def do_POST(self):
        asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        said = asked["messages"][-1]["content"]
        self.calls.append(said)
        self._say({"choices": []} if "broken" in said else {"choices": [{"message": {"content": '{"chunk_type": "fact"}'}}]})

    def log_message(self, *_):
        pass


def test_model_is_asked(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Model)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    cfg = Section("model", base_url=f"http://127.0.0.1:{server.server_port}/v1", retries=1)
    rows = [("a", "Title", "Head", 0, 2, "body of a"), ("b", "Title", "", 1, 2, "broken")]
    chunks = spark.createDataFrame(rows, "chunk_id string, document_title string, heading string, idx int, total int, body string")
    assert model.healthcheck(cfg)[0]
    assert {r["chunk_id"]: r["answer"] for r in model.ask(chunks, cfg).collect()} == {"a": '{"chunk_type": "fact"}', "b": None}
    assert len(_Model.calls) == 3 and any("Head" in c and "1 of 2" in c and "body of a" in c for c in _Model.calls)
    server.shutdown()
    server.server_close()
    assert not model.healthcheck(cfg)[0]


def test_progress(spark):
    out = io.StringIO()
    for told in (Lines(out), Live(spark, out, every=0.01)):
        with told.stage("count") as notes:
            notes.append(f"{spark.range(10).count()} rows")
    assert out.getvalue().count("[count] 10 rows (") == 2


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "chunk_id string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 2)], "chunk_id string, v int")
    assert sorted(map(tuple, pack.upsert(old, new).collect())) == [("a", 1), ("b", 2), ("c", 2)]


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.chdir(tmp_path)
    raw = tmp_path / "Data" / "raw"
    raw.mkdir(parents=True)
    for name, text in TEXTS.items():
        (raw / name).write_text(text)
    (raw / "skip.pdf").write_text("x")
    assert main(["query", "rye"]) == 1
    assert main(["ingest", "--stub", "--full", "--plain"]) == 0 and "4 chunks upserted" in capsys.readouterr().out
    assert main(["ingest", "--stub", "--full"]) == 0  # once more: nothing is there twice
    assert Collection(spark, str(tmp_path / "Data" / "chroma" / "chunks")).count() == 4
    assert files.read_backend_stub(str(tmp_path / "Data" / "index.json"))
    assert main(["query", "rye sourdough", "-n", "1"]) == 0 and "bread_000" in capsys.readouterr().out
    assert main(["query", "rye sourdough", "--words"]) == 0 and "bread_000" in capsys.readouterr().out
    assert main(["export", "--out", str(tmp_path / "out" / "my-pack.json"), "--archive"]) == 0
    done = json.loads((tmp_path / "out" / "my-pack.json").read_text())
    assert done["id"] == "my-pack" and done["source"]["stub"] and len(done["chunks"]) == 4 and done["description"].startswith("2 documents / 4 chunks")
    assert not list(raw.iterdir()) and len(list((tmp_path / "Data" / "archive").iterdir())) == 1
    assert main(["ingest", "--stub"]) == 0 and "no documents" in capsys.readouterr().out


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "bread.md").write_text(TEXTS["bread.md"])
    compile_stream(document_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "checkpoint"), created_at="x").awaitTermination()
    (tmp_path / "in" / "boats.md").write_text(TEXTS["boats.md"])
    compile_stream(document_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "checkpoint"), created_at="x").awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).select("fm.chunk_id").collect()) == ["boats_000", "boats_001", "bread_000", "bread_001"]


def test_answers_are_dealt_to_tasks_of_bounded_size(spark, tmp_path):
    """One row group was one task, whose time grew with the table."""
    from corpusmill.plans import queries

    spark.range(0, 400_001, 1, 1).selectExpr("id AS event_id", "'view' AS event_type", "id AS user_id").write.parquet(f"{tmp_path}/events.parquet")
    sizes = queries.answers(spark, str(tmp_path)).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert sum(r["count"] for r in sizes) == 400_001 and max(r["count"] for r in sizes) <= queries.TASK_ROWS + 1


def test_batches_for_python_are_bounded_in_bytes(spark):
    """10,000 rows were one batch, whatever their length."""
    rows = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pd.DataFrame({"n": [len(b)]})

    assert rows.mapInPandas(sizes, "n long").agg(F.max("n")).first()[0] * 20_000 <= 8 << 20
