"""Postings by block: what a search shuffles, weights by their factors, odd weights, ids and ties, questions run by run."""

import random
from collections import defaultdict

import pytest

from corpusmill.operators import salience
from corpusmill.operators.postings import Postings


def on_disk(spark):
    """Bytes of the shuffle files of this session so far."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_"))


def best(weights, asked, n):
    """By brute force."""
    held, out = defaultdict(list), []
    for c, t, w in weights:
        if w:
            held[t].append((c, w))
    for query in {q for q, _, _ in asked}:
        scores = defaultdict(float)
        for q, t, x in asked:
            if q == query:
                for c, w in held[t]:
                    scores[c] += x * w
        ranked = sorted(scores.items(), key=lambda s: (-round(s[1], 9), s[0]))[:n]
        out += [(query, i + 1, c, round(s, 6)) for i, (c, s) in enumerate(ranked)]
    return sorted(out)


def answers(found):
    return sorted((r["query_id"], r["rank"], r["chunk_id"], round(r["score"], 6)) for r in found.collect())


def test_a_search_does_not_shuffle_its_hits(spark, tmp_path):
    """Before, each chunk that has a term of a question was a row of a shuffle: here 1,000,000 of them."""
    rows = spark.range(0, 2000).selectExpr("concat('c', id) AS chunk_id", "inline(array(struct(concat('own', id) AS term, 0.8D AS w), struct('all' AS term, 0.6D AS w)))")
    held = Postings.build(rows, f"{tmp_path}/postings")
    asked = spark.range(0, 500).selectExpr("id AS query_id", "'all' AS term", "1.0D AS q")
    before = on_disk(spark)
    found = held.search(asked, 2).collect()
    assert on_disk(spark) - before < 1_000_000
    assert len(found) == 1000 and {(r["rank"], r["chunk_id"]) for r in found} == {(1, "c0"), (2, "c1")}


def test_blocks_of_counts_are_small(spark, tmp_path):
    """TF-IDF weights are different numbers of eight bytes each; before, all of them were written."""
    rng = random.Random(5)
    rows = [(f"c{i:04d}", " ".join(f"w{int(rng.paretovariate(0.7)) % 400}x" for _ in range(150))) for i in range(1500)]
    corpus = salience.Corpus(spark.createDataFrame(rows, "chunk_id string, body string"), 50, keep=())
    weights = corpus.weights.count()
    held = Postings.of_lists(corpus.factors, str(tmp_path / "p"))
    assert held.blocks.count() <= 1500 / 256 + 5
    assert sum(f.stat().st_size for f in (tmp_path / "p").rglob("*.parquet")) < 4 * weights


@pytest.mark.parametrize("most", [0, 3, 1 << 17])
def test_factors_make_the_weights(spark, tmp_path, most):
    rows = [("c1", 1, "alpha beta alpha gamma"), ("c2", 2, "beta Delta's delta's x"), ("c3", 3, None), ("c4", 4, "the of"), ("c5", 5, "alpha épsilon beta zeta zeta"), ("c6", 6, ""), (None, 7, "alpha nu"), ("c1", 1, "beta kappa")]
    corpus = salience.Corpus(spark.createDataFrame(rows, "chunk_id string, idx int, body string"), most, keep=("idx",))
    want = {(r["chunk_id"], r["term"]): round(r["w"], 12) for r in corpus.weights.collect() if r["chunk_id"]}
    entries = Postings.of_lists(corpus.factors, str(tmp_path / "p"), block_chunks=2).entries.selectExpr("term", "inline(chunks)").collect()
    assert {(r["id"], r["term"]): round(r["w"], 12) for r in entries} == want and len(entries) == len(want)
    some = corpus.weights_of("idx IN (1, 5)").collect()
    assert {(r["chunk_id"], r["term"]): round(r["w"], 12) for r in some} == {k: w for k, w in want.items() if k[0] in ("c1", "c5")} and len(some) == len({(r["chunk_id"], r["term"]) for r in some})


@pytest.mark.parametrize("block, n", [(3, 1), (8, 5), (256, 400)])
def test_odd_weights_in_runs(spark, tmp_path, block, n):
    """Repeated rows of a chunk and term add up, weights may be below zero or large, ids are numbers, most scores tie."""
    rng = random.Random(6)
    rows = [(i, f"t{int(rng.paretovariate(0.6)) % 40}", rng.choice([0.5, 0.5, 1.0, -0.5, 0.0, 3e7])) for i in range(150) for _ in range(5)]
    asked = [(q, f"t{rng.randrange(42)}", rng.choice([1.0, 2.0])) for q in range(40) for _ in range(4)]
    held = Postings.build(spark.createDataFrame([*rows, (None, "t1", 1.0), (3, None, 1.0), (4, "t1", None), (5, "t1", float("nan"))], "chunk_id bigint, term string, w double"), str(tmp_path / "p"), block_chunks=block, buckets=3)
    questions = spark.createDataFrame([*asked, (None, "t1", 1.0), (3, "t1", None)], "query_id int, term string, q double")
    want = best(rows, asked, n)
    assert answers(held.search(questions, n)) == want
    assert answers(held.search(questions, n, most_asked=25)) == want
    assert 0 < held.share_scored(questions, n) <= 1


def test_no_chunks_or_questions(spark, tmp_path):
    held = Postings.build(spark.createDataFrame([], "chunk_id string, term string, w double"), str(tmp_path / "p"))
    asked = spark.createDataFrame([(1, "a", 1.0)], "query_id int, term string, q double")
    assert held.search(asked).collect() == held.search(asked.limit(0)).collect() == [] and held.share_scored(asked) == 0
