"""The inverted file, postings with early stop, the collection that is merged when read, streaming frequencies, slugs and ranks."""

import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import salience
from corpusmill.operators.fanout import fan_out
from corpusmill.operators.ann import VectorIndex, recall
from corpusmill.operators.html import convert_page, distinct_slugs
from corpusmill.operators.postings import Postings
from corpusmill.operators.rank import ranked
from corpusmill.operators.search import vectors_top_k
from corpusmill.sources.collection import Collection
from corpusmill.sources.commits import Versions
from corpusmill.streaming import statistics

VECTORS = "vec_id bigint, embedding array<float>"


def answers(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in df.collect())


@pytest.fixture(scope="module")
def groups(spark, tmp_path_factory):
    """3,000 vectors around 30 centres, the same with ids that have no direction or another length, and an index of all."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16))
    rows = [(i, [float(x) for x in centres[i % 30] + 0.2 * rng.normal(size=16)]) for i in range(3000)]
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [1.0] * 15), (5003, [float("nan")] * 16), (None, [1.0] * 16), (5004, rows[0][1])]
    df = spark.createDataFrame(rows, VECTORS).repartition(3).cache()
    return df, VectorIndex.build(df, str(tmp_path_factory.mktemp("index") / "v"), dimensions=16, cells=40)


def test_index_finds_what_a_scan_finds(groups):
    df, held = groups
    asked = df.where("vec_id % 100 = 0 OR vec_id >= 5000").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = vectors_top_k(df.where("size(embedding) = 16 AND vec_id IS NOT NULL"), asked.where("query_id NOT IN (5002)"), 10)
    assert answers(held.nearest(asked, 10)) == answers(exact)
    assert recall(held.probe(asked, 10), exact) >= 0.95
    assert held.vectors(held.cells.tolist()).count() == 3001


def test_probe_reads_few_files(groups):
    df, held = groups
    one = df.where("vec_id = 7").select(F.col("vec_id").alias("query_id"), "embedding")
    assert held.files_read(one, held.probes_for(0.97)) < held.files_read(one, len(held.cells)) / 4


def test_index_of_nothing_and_of_one(spark, tmp_path):
    none = spark.createDataFrame([], VECTORS)
    held = VectorIndex.build(none, str(tmp_path / "none"), dimensions=2)
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, embedding array<float>")
    assert held.nearest(asked, 3).collect() == [] and held.probe(asked, 3).collect() == []
    held = VectorIndex.build(spark.createDataFrame([(9, [0.0, 2.0])], VECTORS), str(tmp_path / "one"), dimensions=2)
    assert answers(held.nearest(asked, 3)) == [(1, 1, 9, 0.0)]
    with pytest.raises(ValueError):
        VectorIndex(spark, str(tmp_path / "absent"))


def test_index_in_blocks_of_queries(groups):
    df, held = groups
    asked = df.where("vec_id < 25").select(F.col("vec_id").alias("query_id"), "embedding")
    assert answers(held.nearest(asked, 3, most_queries=10)) == answers(held.nearest(asked, 3))


def test_postings_equal_all_scores(spark, tmp_path):
    rng = random.Random(4)
    rows = [(f"c{i:03d}", t, rng.choice([0.1, 0.2, 0.5, 1.0])) for i in range(400) for t in {f"t{int(rng.paretovariate(0.6)) % 90}" for _ in range(6)}]
    rows += [("zero", "t1", 0.0), ("none", "t1", None)]
    asked = [(q, f"t{rng.randrange(95)}", rng.choice([1.0, 2.0])) for q in range(30) for _ in range(3)] + [(99, "unknown", 1.0), (98, None, 1.0)]
    held = Postings.build(spark.createDataFrame(rows, "chunk_id string, term string, w double"), str(tmp_path / "p"), block_chunks=8, buckets=4)
    questions = spark.createDataFrame(asked, "query_id bigint, term string, q double")
    weight, want = {(c, t): w for c, t, w in rows if w}, []
    for q in {q for q, _, _ in asked}:
        scores = Counter()
        for q2, t, x in asked:
            if q2 == q:
                for c, t2 in weight:
                    if t2 == t:
                        scores[c] += x * weight[c, t2]
        best = sorted(scores.items(), key=lambda s: (-round(s[1], 9), s[0]))[:5]
        want += [(q, i + 1, c, round(s, 6)) for i, (c, s) in enumerate(best)]
    got = [(r["query_id"], r["rank"], r["chunk_id"], round(r["score"], 6)) for r in held.search(questions, 5).collect()]
    assert sorted(got) == sorted(want)
    assert held.share_scored(questions, 5) < 0.9
    assert held.search(questions.limit(0), 5).collect() == []


def chunks(spark, ids, version):
    return spark.createDataFrame([(i, f"text {i}", version) for i in ids], "chunk_id string, document string, v int")


def state(held):
    return sorted((r["chunk_id"], r["v"]) for r in held.rows().collect())


def test_collection_merges_deltas(spark, tmp_path):
    held = Collection(spark, str(tmp_path / "c"), buckets=4, most_deltas=3)
    assert held.upsert(chunks(spark, "abcdefgh", 1)) == 8
    assert held.upsert(chunks(spark, ["a", "a", "z", None], 2)) == 2
    held.remove(spark.createDataFrame([("b",), ("nobody",)], "chunk_id string"))
    want = [("a", 2)] + [(c, 1) for c in "cdefgh"] + [("z", 2)]
    assert state(held) == want and held.versions() == [1, 2, 3]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in held.rows()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    held.upsert(chunks(spark, "b", 4))
    assert len(held.versions()) == 1 and state(held) == sorted([*want, ("b", 4)])
    assert state(Collection(spark, str(tmp_path / "c"))) == sorted([*want, ("b", 4)])


def test_upsert_writes_only_its_rows(spark, tmp_path):
    held = Collection(spark, str(tmp_path / "c"), buckets=2)
    long = lambda ids, v: chunks(spark, ids, v).withColumn("document", F.concat(*[F.sha2(F.concat("chunk_id", F.lit(f"{i}")), 512) for i in range(9)]))
    held.upsert(long([f"c{i}" for i in range(500)], 1))
    size = lambda n: sum(f.stat().st_size for f in (tmp_path / "c" / f"version-{n}").rglob("*.parquet"))
    held.upsert(long(["c1", "c2"], 2))
    assert size(2) < size(1) / 10 and held.count() == 500


def test_writers_that_are_lost_or_late(spark, tmp_path):
    held = Collection(spark, str(tmp_path / "c"), buckets=2)
    held.upsert(chunks(spark, "ab", 1))
    held.upsert(chunks(spark, "b", 2))
    (tmp_path / "c" / "_writing-lost" / "rows").mkdir(parents=True)  # a writer that ended half-way
    assert state(held) == [("a", 1), ("b", 2)]
    versions = Versions(spark, str(tmp_path / "c"))
    late = tmp_path / "c" / "_writing-late"
    late.mkdir()
    (late / "own").write_text("x")
    assert not versions.publish(str(late), 2) and (late / "own").exists() and not list((tmp_path / "c" / "version-2").glob("_writing*"))
    # an upsert comes between the reading and the rename of a compaction: nothing of it is lost
    found = held.versions
    held.versions = lambda: [1, 2]
    Collection(spark, str(tmp_path / "c"), buckets=2).upsert(chunks(spark, "c", 3))
    assert not held.compact()
    held.versions = found
    assert state(held) == [("a", 1), ("b", 2), ("c", 3)] and held.compact() and state(held) == [("a", 1), ("b", 2), ("c", 3)]


def test_context_around_hits(spark):
    rows = [("a1", "a", 10, 50), ("a2", "a", 20, 60), ("a3", "a", 30, 5), ("a4", "a", 40, None), ("b1", "b", 1, 30), ("b2", "b", 2, 1), ("b3", "b", 3, 1), ("c1", "c", 1, 500), ("x", None, 1, 1)]
    df = spark.createDataFrame(rows, "chunk_id string, document_slug string, idx int, tokens int")
    near = spark.createDataFrame([("a", "b", 0.5), ("a", "c", 0.9), ("b", "a", 0.5)], "a string, b string, score double")
    hits = spark.createDataFrame([("q", "a2"), ("r", "b2"), ("s", "c1"), ("t", "absent")], "query_id string, chunk_id string")
    got = sorted(map(tuple, fan_out(hits, df, near, budget=120, near=1, related=2, each=2).collect()))
    assert got == [
        ("q", 1, "a2", 0, 60), ("q", 2, "a1", 1, 110), ("q", 3, "a3", 1, 115), ("q", 4, "b2", 2, 116),  # c1 and b1 do not fit, what follows does
        ("r", 1, "b2", 0, 1), ("r", 2, "b1", 1, 31), ("r", 3, "b3", 1, 32), ("r", 4, "a1", 2, 82),
    ]


def test_frequencies_follow_changes(spark, tmp_path):
    rng, docs = random.Random(1), {}
    (tmp_path / "in").mkdir()
    held = statistics.Frequencies(spark, str(tmp_path / "out"))
    for batch in range(3):  # each is a start anew from the checkpoint
        changes = []
        for i in range(30):
            slug = f"d{rng.randrange(20)}"
            text = None if rng.random() < 0.25 else " ".join(rng.choice("rye barley wheat oats malt the hops".split()) for _ in range(rng.randrange(6)))
            changes.append({"slug": slug, "version": 100 * batch + i, "text": text})
            docs[slug] = text
            if batch:
                changes.append({"slug": slug, "version": 1, "text": "late"})
        changes += [{"slug": None, "version": 1, "text": "nobody"}]
        (tmp_path / "in" / f"{batch}.json").write_text("\n".join(map(json.dumps, changes)))
        statistics.follow(statistics.change_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        if batch == 1:
            held.compact()
        live = spark.createDataFrame([(k, v) for k, v in docs.items() if v is not None], "chunk_id string, body string")
        want = {r["term"]: r["df"] for r in salience.document_frequency(salience.term_counts(live)).collect()}
        assert {r["term"]: r["df"] for r in held.document_frequency().collect()} == want
        assert held.documents() == live.count()
        idf = {r["term"]: r["idf"] for r in salience.inverse_frequency(salience.term_counts(live), live).collect()}
        assert {r["term"]: pytest.approx(r["idf"]) for r in held.inverse_frequency().collect()} == idf


def test_slugs_are_taken_in_the_order_of_paths(spark):
    rng, rows, want = random.Random(5), [], {}
    for family in range(1000):
        names, seen = [f"g{family}x{end}" for end in ("", "-2", "-3", "-2-2", "-4", "-1", "-02", "-2-3", "-10")], set()
        for i in range(rng.randrange(1, 14)):
            path, own = f"/e/{family:04d}/{i:03d}", rng.choice(names[: rng.randrange(1, 10)])
            taken, n = own, 2
            while taken in seen:
                taken, n = f"{own}-{n}", n + 1
            seen.add(taken)
            rows.append((path, own))
            want[path] = taken
    rng.shuffle(rows)
    got = {r["path"]: r["slug"] for r in distinct_slugs(spark.createDataFrame(rows, "path string, own string").repartition(5), "path", "own").collect()}
    assert got == want


def test_text_behind_a_comment_is_not_the_removed_elements(spark):
    page = '<div id="main-content"><script>x</script>one<!--c-->two<p>three</p><style>y</style>four<?pi?>five</div>'
    assert convert_page(page)[1] == "twothree\n\nfive"


def test_ranks_of_a_key_that_all_rows_have(spark):
    df = spark.createDataFrame([("k", i) for i in range(500)] + [(None, 3), (None, 1), ("l", 9)], "key string, at int").repartition(6)
    got = {(r["key"], r["at"]): r["rank"] for r in ranked(df, ["key"], "at").collect()}
    assert got == {("k", i): i + 1 for i in range(500)} | {(None, 1): 1, (None, 3): 2, ("l", 9): 1}
