"""The pipeline's stages, one after the other, against what each should do with what it got."""

import random
import re

import pytest

import corpus_pipeline
from corpusmill.llm import decontaminate, quality

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == [n for n, _ in corpus_pipeline.STAGES] and len(steps) == 5

    good = steps["quality classifier"](spark, docs, SF).cache()
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, model).collect()}
    assert {r["doc_id"] for r in good.collect()} == {i for i, s in scores.items() if s >= corpus_pipeline.LEAST_QUALITY}
    assert good.columns == docs.columns

    lines = steps["line dedup"](spark, good, SF).cache()
    seen: dict[str, list[int]] = {}
    for r in good.collect():
        for k in {x.strip(" \t\n\x0b\x0c\r").lower() for x in r["text"].split("\n")}:
            seen.setdefault(k, []).append(r["doc_id"])
    gone = {k: max(v) for k, v in seen.items() if len(k) >= 20 and len(v) >= 3}
    want = {r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if gone.get(x.strip(" \t\n\x0b\x0c\r").lower(), r["doc_id"]) == r["doc_id"]) for r in good.collect()}
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect()) and lines.columns == docs.columns

    near = steps["simhash near-dedup"](spark, lines, SF).cache()
    rows = sorted(lines.collect(), key=lambda r: r["doc_id"])  # five words, 0.8: what stages on shingles take
    assert sorted(r["doc_id"] for r in near.collect()) == sorted({rows[g]["doc_id"] for g in grouped_by_force([r["text"] for r in rows])})

    clean = steps["benchmark decontamination"](spark, near, SF).cache()
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    leaking = {r["doc_id"] for r in decontaminate.find_leaks(near, bench).where("size(leaks) > 0").collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in near.collect()} - leaking
    items = [re.sub(r"\s+", " ", r["text"]) for r in bench.collect()]
    assert not [r["doc_id"] for r in clean.collect() if any(i in re.sub(r"\s+", " ", r["text"]) for i in items)]

    tokens = steps["byte-level BPE"](spark, clean, SF)
    assert tokens.count() == clean.count()
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()) == sorted(r["doc_id"] for r in clean.collect())


def test_stages_take_nulls_and_empty_tables(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words here", None, None, None), (3, "a " * 50_000, "en", "s", 1), (3, "a " * 50_000, "en", "s", 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for data in (rows, []):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, spark.createDataFrame(data, schema), SF).count() >= 0, name


def grouped_by_force(texts, width=5, least=0.8):
    """Number of each text's group."""
    sets = []
    for t in texts:
        w = re.sub("[A-Z]", lambda m: m.group().lower(), t).split()
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            same = sets[i] == sets[j] if not sets[i] or not sets[j] else len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= least
            if same and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


@pytest.mark.parametrize("block", [500, 7])
def test_near_copies_go(spark, monkeypatch, block):
    rng = random.Random(4)
    word = lambda: "w%d" % rng.randrange(5000)
    texts = ["", "Two words", "two  WORDS", "two words more", "  "]
    for n, copies in ((12, 6), (60, 12), (300, 12), (120, 60)):
        base = [word() for _ in range(n)]
        for _ in range(copies):  # from nearly equal ones to those that are no near copies
            part = list(base)
            for _ in range(rng.randint(0, max(1, n // 25))):
                part[rng.randrange(n)] = word()
            texts.append(" ".join(part))
    rng.shuffle(texts)
    want = set(grouped_by_force(texts))
    assert len(want) < len(texts) - 20 and len(want) > 15
    found = corpus_pipeline.near.near_classes
    monkeypatch.setattr(corpus_pipeline.near, "near_classes", lambda df, **k: found(df, block=block, **k))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = corpus_pipeline.near_stage(spark, docs.repartition(5), SF)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(want)
    assert got.columns == docs.columns


def test_columns_of_any_name_stay(spark):
    rows = [(i, f"some words that are here number {i}", "en", "s", 5, 1, "x", 2.0, "y", 3) for i in range(8)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaks int, n_lines string, score double, node string, row int"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns and {r["row"] for r in got.collect()} <= {3}, name


def test_repeated_ids_with_other_texts_stay(spark):
    long, other = " ".join(f"w{i}" for i in range(50)), " ".join(f"v{i}" for i in range(50))
    rows = [(1, long), (2, long), (2, other), (2, other), (2, other.upper()), (3, "third text of all")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for partitions in (1, 4):
        got = corpus_pipeline.near_stage(spark, docs.repartition(partitions), SF).collect()
        assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, long), (2, other.upper()), (3, "third text of all")]
