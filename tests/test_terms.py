"""Statistics over lists of terms equal those over long tables, whatever is broadcast, and no text's terms are shuffled."""

import pytest

from corpusmill.operators import index, salience

ROWS = [("c1", "a", "alpha beta alpha gamma"), ("c2", "a", "beta Delta's delta's x"), ("c3", "b", None), ("c4", "b", "the of"), ("c5", "b", "alpha épsilon beta zeta zeta"), ("c6", None, "gamma omega")]


def near(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("again", [[], [("c1", "b", "beta kappa"), ("c2", "a", ""), (None, "a", "alpha nu"), (None, "b", "nu")]])
@pytest.mark.parametrize("most", [0, 2, 1 << 17])
def test_lists_equal_long_tables(spark, most, again):
    df = spark.createDataFrame(ROWS + again, "chunk_id string, document_slug string, body string")
    counts = salience.term_counts(df)
    idf = salience.inverse_frequency(counts, df)
    weights = salience.tfidf(counts, idf)
    middle = salience.centroid(weights, df)
    corpus = salience.Corpus(df, most)
    assert near(corpus.idf.collect()) == near(idf.collect())
    assert near(corpus.weights.collect()) == near(weights.collect())
    assert near(corpus.centroid().select("term", "c").collect()) == near(middle.collect())
    assert near(corpus.distinctiveness().where("chunk_id IS NOT NULL").collect()) == near(salience.lexical_distinctiveness(df, weights, middle).where("chunk_id IS NOT NULL").collect())
    by_slug = counts.join(df.select("chunk_id", "document_slug"), "chunk_id").groupBy("document_slug", "term").sum("n")
    own = salience.Corpus(df.where("chunk_id IS NOT NULL"), most).slug_counts.groupBy("document_slug", "term").sum("n")
    assert near(own.collect()) == near(by_slug.collect())
    if not again:
        entries = df.where("document_slug IS NOT NULL").groupBy("document_slug").agg({"chunk_id": "collect_list"}).toDF("document_slug", "children")
        assert near(index.slug_vectors(corpus.slug_weights, entries).collect()) == near(index.entry_vectors(entries, weights).collect())


def test_no_chunk_at_all(spark):
    corpus = salience.Corpus(spark.createDataFrame([], "chunk_id string, document_slug string, body string"))
    assert corpus.size == 0 and corpus.weights.collect() == corpus.centroid().collect() == corpus.distinctiveness().collect() == []


def test_terms_of_chunks_are_not_shuffled(spark):
    """Before, counting and weighing sent each term of each chunk through three exchanges."""
    df = spark.createDataFrame(ROWS, "chunk_id string, document_slug string, body string")
    plan = salience.Corpus(df).weights._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_rare_heaviest_terms_share_blocks(spark, tmp_path):
    """Each chunk whose heaviest term is its own was a block, so postings were lists of one."""
    from corpusmill.operators.postings import Postings

    rows = spark.range(0, 1000).selectExpr("concat('c', id) AS chunk_id", "inline(array(struct(concat('own', id) AS term, 0.8D AS w), struct('all' AS term, 0.6D AS w)))")
    held = Postings.build(rows, f"{tmp_path}/postings", block_chunks=256)
    assert held.entries.where("term = 'all'").count() <= 4
    asked = spark.createDataFrame([(1, "own7", 1.0), (1, "all", 0.1)], "query_id int, term string, q double")
    assert [(r["rank"], r["chunk_id"]) for r in held.search(asked, 2).orderBy("rank").collect()] == [(1, "c7"), (2, "c0")]
