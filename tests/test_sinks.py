"""Files that several tasks write: all of them or none."""

import json

import pytest
from pyspark.sql import functions as F

from corpusmill.sources import sinks

HEADER = {"schema": "s/1", "name": "Ä"}
CHUNK = "id string, title string, text string, topics array<string>, tokens int"


def plain_pack(chunks, header):
    """The pack as one task would write it."""
    return json.dumps(header | {"chunks": chunks}, indent=2, ensure_ascii=False) + "\n"


@pytest.mark.parametrize("n", [0, 1, 2, 37])
def test_a_stitched_pack_has_the_same_bytes(spark, tmp_path, n):
    rows = [(f"c{i:02d}", f"tit\nle é {i}", ',\n    "', ["a", "b"][: i % 3], None if i == 1 else i) for i in range(n)]
    path = tmp_path / "new" / "pack.json"
    df = spark.createDataFrame(rows, CHUNK).repartition(5)
    assert sinks.write_pack(df, HEADER, str(path)) == n
    assert path.read_text() == plain_pack([dict(zip("id title text topics tokens".split(), r, strict=True)) for r in rows], HEADER)
    assert [p.name for p in path.parent.iterdir() if not p.name.endswith(".crc")] == ["pack.json"]


def test_a_pack_that_fails_leaves_the_old_one(spark, tmp_path):
    path = tmp_path / "pack.json"
    path.write_text("old")
    rows = spark.range(20).select(F.col("id").cast("string"), F.when(F.col("id") == 17, F.raise_error(F.lit("lost"))).otherwise(F.lit("x")).alias("title"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_pack(rows, HEADER, str(path))
    assert path.read_text() == "old" and [p.name for p in tmp_path.iterdir()] == ["pack.json"]


def test_named_files_come_together_or_not_at_all(spark, tmp_path):
    folder = tmp_path / "out"
    folder.mkdir()
    (folder / "kept.md").write_text("kept")
    (folder / "a0.md").write_text("old")
    rows = spark.range(12).select(F.format_string("a%d.md", "id").alias("name"), F.concat(F.lit("text é "), "id").alias("text")).repartition(4)
    bad = rows.unionByName(spark.createDataFrame([("../b.md", "x")], "name string, text string"))
    with pytest.raises(Exception, match="no file name"):
        sinks.write_named_files(bad, str(folder))
    assert sorted(p.name for p in folder.iterdir()) == ["a0.md", "kept.md"] and (folder / "a0.md").read_text() == "old"
    sinks.write_named_files(rows, f"file://{folder}")
    assert sorted(p.name for p in folder.iterdir()) == sorted([*(f"a{i}.md" for i in range(12)), "kept.md"])
    assert (folder / "a0.md").read_text() == "text é 0" and not (tmp_path / "b.md").exists()
