"""Text functions and segmentation on small cases worked out by hand."""

import pytest
from pyspark.sql import functions as F

from corpusmill.config import Chunking, Config, load_config
from corpusmill.functions import text as T
from corpusmill.operators import segment


def value(spark, make, text):
    return spark.createDataFrame([(text,)], "t string").select(make(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    ("text", "tokens"),
    [("", 0), ("a", 1), ("word " * 10, 13), ("x" * 290, 72), ("x" * 190, 48), ("one two three four five", 6)],
)
def test_estimate_tokens(spark, text, tokens):
    assert value(spark, T.estimate_tokens, text) == tokens


def test_words_and_terms(spark):
    assert value(spark, T.tokenize, "It's 3rd élève, well-known C++") == ["it's", "rd", "l", "ve", "well-known", "c++"]
    assert value(spark, T.content_terms, "The cat and the Cat of a b") == ["cat", "cat"]


@pytest.mark.parametrize(("text", "slug"), [("Brazilian Jiu-Jitsu!", "brazilian-jiu-jitsu"), ("Élève ﬁn", "eleve-fin"), ("日本", ""), ("--a__b--", "a-b"), (None, None)])
def test_slugify(spark, text, slug):
    assert value(spark, T.slugify, text) == slug


@pytest.mark.parametrize(("text", "title"), [("it's a jiu-jitsu 3rd", "It'S A Jiu-Jitsu 3Rd"), ("élan VITAL", "Élan Vital"), ("", "")])
def test_title_case(spark, text, title):
    assert value(spark, T.title_case, text) == title == (text or "").title()


def test_strip_knows_pythons_white_space(spark):
    odd = "\x1c\x85   a b 　\n"
    assert value(spark, T.strip, odd) == odd.strip()


def test_first_sentence(spark):
    assert value(spark, T.first_sentence, "  One two! Three. Four") == "One two!"
    assert value(spark, T.first_sentence, "x" * 300) == "x" * 240


def cut(spark, text, cfg=Chunking(), stem="my-doc"):
    rows = segment.with_title(spark.createDataFrame([(stem, f"{stem}.md", text)], "slug string, source_file string, text string"))
    return segment.chunk_documents(rows, cfg).orderBy("idx").collect()


def test_sections_titles_and_links(spark):
    body = "word " * 60
    rows = cut(spark, f"before {body}\n# First Title \n{body}\n## Second\n\n{body}")
    assert [r["heading"] for r in rows] == ["", "First Title", "Second"]
    assert {r["document_title"] for r in rows} == {"First Title"}
    assert [r["chunk_id"] for r in rows] == ["my-doc_000", "my-doc_001", "my-doc_002"]
    assert [(r["previous_id"], r["next_id"], r["total"]) for r in rows] == [(None, "my-doc_001", 3), ("my-doc_000", "my-doc_002", 3), ("my-doc_001", None, 3)]


def test_documents_without_text_or_only_headings(spark):
    assert cut(spark, "") == [] and cut(spark, " \n\t\n") == []
    (row,) = cut(spark, "# Only\n## Headings")
    assert row["body"] == "# Only\n## Headings" and row["heading"] == ""
    assert cut(spark, "plain text", stem="it's-a_doc")[0]["document_title"] == "It'S A Doc"


def test_small_chunks_join_the_one_before_but_the_first_does_not_move(spark):
    body = ("word " * 60).strip()
    rows = cut(spark, f"# A\ntiny\n# B\n{body}\n# C\nsmall")
    assert [(r["heading"], r["body"]) for r in rows] == [("A", "tiny"), ("B", f"{body}\n\nsmall")]


def test_paragraphs_are_packed_to_the_target(spark):
    para = ("word " * 100).strip()  # 130 tokens each
    rows = cut(spark, "\n \n".join([para] * 5))
    assert [r["body"].count("\n\n") + 1 for r in rows] == [2, 2, 1]


def test_oversized_paragraphs_split_at_sentences(spark):
    sentence = "Word " + "word " * 98 + "end."
    rows = cut(spark, " ".join([sentence] * 9))
    assert all(r["tokens"] <= 480 for r in rows) and " ".join(r["body"] for r in rows) == " ".join([sentence] * 9)
    (long,) = cut(spark, "word " * 2000)
    assert long["tokens"] > 480  # one sentence stays whole


def test_long_documents_take_time_in_proportion(spark):
    import time

    took = []
    for n in (500, 4000):
        text = "\n\n".join(" ".join(f"Word {i} here." for _ in range(20)) for i in range(n))
        began = time.time()
        rows = cut(spark, text)
        took.append(time.time() - began)
        assert "\n\n".join(r["body"] for r in rows) == text and all(r["tokens"] <= 480 for r in rows)
    assert took[1] < 8 * 3 * max(took[0], 0.5)


def test_headings_can_be_switched_off(spark):
    (row,) = cut(spark, "# A\nx\n# B\ny", Chunking(respect_headings=False))
    assert row["body"] == "# A\nx\n# B\ny"


def test_config(tmp_path):
    (tmp_path / "config").mkdir()
    file = tmp_path / "config" / "settings.toml"
    file.write_text('[chunking]\ntarget_tokens = 100\n[paths]\nraw_dir = "in"\n[other]\nx = 1\n')
    cfg = load_config(file)
    assert cfg.chunking.target_tokens == 100 and cfg.chunking.max_tokens == 480 and cfg.paths.raw_dir == str(tmp_path / "in")
    file.write_text("[chunking]\nunknown = 1\n")
    with pytest.raises(TypeError):
        load_config(file)
    assert Config().salience.related_max == 2
