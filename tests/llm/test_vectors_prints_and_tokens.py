"""Clustering, document fingerprints and tokenizer alignment against brute force, the libraries, and the cases that their docstrings define."""

import hashlib
import itertools
import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from corpusmill.llm import alignment, clusters, fingerprints
from corpusmill.llm.queries import tokenizers

DOCS = "doc_id bigint, text string"


def docs(spark, rows, partitions=3):
    return spark.createDataFrame(rows, DOCS).repartition(partitions)


def spoiled(df):
    """With columns of the names that the operators make or use inside."""
    for name in "v cluster n kept a b a_ends row links pair n_a bucket missing turned digest fingerprint id".split():
        if name not in df.columns:
            df = df.withColumn(name, F.lit("7"))
    return df


# --- 11 ---------------------------------------------------------------------------------------------------------------------------------


def lloyd(rows, k, rounds, scale, dimensions):
    finite = lambda v: v is not None and len(v) == dimensions and all(x is not None and x == x and abs(x) != float("inf") for x in v)
    whole = lambda x: max(-(2**63), min(2**63 - 1, int(scale * x // 1)))
    kept = [(i, [whole(x) for x in v]) for i, v in rows if finite(v)]
    name = lambda i: (i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest())
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    far = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c, strict=True))
    for last in [*[False] * rounds, True]:
        own = [min(range(len(centres)), key=lambda c: (far(v, centres[c]), c)) for _, v in kept]
        if not last:
            for c in set(own):
                held = [v for (_, v), o in zip(kept, own, strict=True) if o == c]
                centres[c] = [sum(x) // len(held) for x in zip(*held, strict=True)]
    least = [min(2**63 - 1, far(v, centres[o])) for (_, v), o in zip(kept, own, strict=True)]
    inertia = Counter()
    for o, d in zip(own, least, strict=True):
        inertia[o] += d
    most = lambda x: min(x, 2**63 - 1)
    return sorted(((i, o, d, most(inertia[o]), most(sum(inertia.values())), centres[o]) for (i, _), o, d in zip(kept, own, least, strict=True)), key=repr)


@pytest.mark.parametrize("case", ["plain", "hot", "few", "huge"])
def test_clusters_against_brute_force(spark, case):
    rng = random.Random(case)
    draw = lambda: [rng.choice([-0.5, -0.25, 0.0, 0.1, 0.7]) + rng.random() / 64 for _ in range(4)]
    rows = [(i, draw()) for i in range(5 if case == "few" else 300)]
    if case == "hot":
        rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(1000, 1200)]
    if case == "huge":
        rows += [(1000, [1e30, -1e30, 0.0, 3e9]), (1001, [4e9, 4e9, -4e9, 0.0])]
    rows += [(7, [0.1] * 4), (None, [0.2] * 4), (None, [0.2] * 4), (501, None), (502, []), (503, [0.1] * 3), (504, [None, 0.1, 0.1, 0.1]), (505, [float("nan")] * 4), (506, [float("inf")] * 4)]
    df = spoiled(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4))
    got = clusters.cluster_vectors(df, k=6, rounds=3, scale=64, dimensions=4, hot=10)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == lloyd(rows, 6, 3, 64, 4)


def test_clusters_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>")
    got = clusters.cluster_vectors(df)
    assert got.collect() == [] and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


# --- 12 ---------------------------------------------------------------------------------------------------------------------------------

ALPHABET = "abcde é\n🎉"


def some_text(rng, most=3000):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(most)))


def test_spans_and_extensions():
    rng = random.Random(1)
    for _ in range(30):
        middle, a, b = some_text(rng, 200), some_text(rng, 50), some_text(rng, 50)
        x, y = a + middle + "x", b + middle + "y"
        p, q = fingerprints.Prefixes(x), fingerprints.Prefixes(y)
        assert p.extension(len(a), q, len(b)) == len(middle)
        assert p.equal(len(a), q, len(b), len(middle)) and not p.equal(len(a), q, len(b), len(middle) + 1)
        i, j = sorted(rng.randrange(len(x) + 1) for _ in "ab")
        assert p.span(i, j) == fingerprints.Prefixes(x[i:j]).span(0, j - i)


def test_blocks_change_no_fingerprint(monkeypatch):
    rng = random.Random(2)
    texts = ["", "a", "ab" * 5, "x" * 1000, "line\n" * 300, *(some_text(rng) for _ in range(40))]
    whole = fingerprints.fingerprints(texts)
    monkeypatch.setattr(fingerprints, "BLOCK", 97)
    assert fingerprints.fingerprints(texts) == whole
    for text, print_ in zip(texts, whole, strict=True):
        assert fingerprints.Fingerprint.parse(str(print_)) == print_ and fingerprints.likeness(print_, print_) == 1.0
        p, n = fingerprints.Prefixes(text), len(text)  # each number is the hash of the prefix that ends there
        assert print_.whole == p.span(0, n) and all((a, b) == p.span(0, at) for at, _, a, b in print_.places)
        step = fingerprints.step_of(n)
        assert print_.openings == [p.span(0, at) for at in range(step, n + 1, step)]
        assert len(print_.places) <= 32 and len(print_.openings) <= 16


def test_likeness_follows_common_text():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz     "
    draw = lambda n: "".join(rng.choice(letters) for _ in range(n))
    for _ in range(40):
        a, b, c = draw(900), draw(700), draw(40)
        for x, y, common in ((a + b, b + a, 1600), (a + b, a + c + b, 1600), (a, a + b, 900), (a, b, 0), (c + a, a, 900), ("", a, 0), (a + b, c + b, 700)):
            p, q = fingerprints.fingerprints([x, y])
            near = fingerprints.likeness(p, q)
            assert near == fingerprints.likeness(q, p) and 0 <= near <= 1
            assert common / max(len(x), len(y)) - 0.45 <= near <= common / max(len(x), len(y)) + 0.01


@pytest.mark.parametrize("partitions", [1, 5])
def test_documents_and_their_edits(spark, partitions):
    rng = random.Random(partitions)
    rows = [(i * 7 % 211, some_text(rng, 400)) for i in range(120)] + [(-5, some_text(rng)), (2**62, "last"), (300, "same text"), (301, "same text"), (302, None), (303, ""), (304, "x")]
    rows += [(None, "nobody's"), (None, "nobody's"), (None, "other"), (300, "same id"), (400, "word " * 60_000)]
    got = fingerprints.fingerprint_documents(spoiled(docs(spark, rows, partitions)), keep=("doc_id", "text"), sampled=3).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), xxhash.xxh64((r[1] or "").encode(), seed=42).intdigest() ^ 1 << 63, r[1] or ""))
    want = []
    for (i, raw), (_, following) in zip(order, [*order[1:], order[0]], strict=True):
        text, following = raw or "", following or ""
        n = len(text)
        edited = text[: n - n // 2] + following[: n // 2]
        p, q, r = fingerprints.fingerprints([text, edited, following])
        want.append((i, text, n, hashlib.sha256(edited.encode()).hexdigest(), str(p), str(q), fingerprints.likeness(p, q), fingerprints.likeness(p, r)))
    assert sorted(((g[0], g[1] or "", *g[2:]) for g in got), key=repr) == sorted(want, key=repr)


def test_one_document_and_none(spark):
    (one,) = fingerprints.fingerprint_documents(docs(spark, [(1, "abcd")])).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0
    assert fingerprints.fingerprint_documents(docs(spark, [(1, "a")]).limit(0)).collect() == []
    with pytest.raises(ValueError, match="n_chars"):
        fingerprints.fingerprint_documents(docs(spark, [(1, "a")]).withColumn("n_chars", F.lit(1)), keep=("doc_id", "n_chars"))


# --- 13 ---------------------------------------------------------------------------------------------------------------------------------


def plainly(both, text):
    """Ids of both libraries over the whole text."""
    if not text:
        return [], []
    a, b = both.exact.encode_batch([" " + text], add_special_tokens=False)[0].ids, both.b.encode(text)
    whole = (" " + text).encode()
    joined = lambda ids, table: b"".join(table[i] for i in ids)
    return (a, b) if joined(a, both.bytes_a) == whole == joined(b, both.bytes_b) else ([], [])


def aligned(both, rows):
    links, facts = [], []
    for _, text in rows:
        a, b = plainly(both, text)
        ends_a, ends_b = (list(itertools.accumulate(int(size[i]) for i in ids)) for ids, size in ((a, both.size_a), (b, both.size_b)))
        begin = lambda ends, i: ends[i - 1] if i else 0
        own = [(x, y) for i, x in enumerate(a) for j, y in enumerate(b) if begin(ends_a, i) < ends_b[j] and begin(ends_b, j) < ends_a[i]]
        cuts, groups = sorted(set(ends_a) & set(ends_b)), []
        for low, high in itertools.pairwise([0, *cuts]):
            groups.append("|".join(",".join(str(i) for i, e in zip(ids, ends, strict=True) if low < e <= high) for ids, ends in ((a, ends_a), (b, ends_b))))
        links.append(own)
        facts.append((len(a), len(b), len(cuts), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    counts = Counter(p for own in links for p in set(own))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(n, best.get(a, 0))
    return sorted(((i, *f[:4], sum(counts[p] == best[p[0]] for p in own), sum(counts[p] for p in own), f[4]) for (i, _), own, f in zip(rows, links, facts, strict=True)), key=repr)


ODD = ["a", "b", "é", "ß", "1", "2", "'s", "'", ".", " ", " ", "  ", "\n", "\t", "\r\n", " ", "\x85", "\x1c", " ", "　", "​", "日本", "😀", "<|endoftext|>", "</s>", "<s>", "▁", "<0x41>", "ñ", "ﬁ", "\x00", "Ⅷ", "²", "ǅ", "һ", "٣", "word", " the"]


def test_words_encode_as_whole_texts():
    both, rng = alignment.pair(tokenizers()), random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(14))) for _ in range(6000)] + [chr(c) + x + chr(c) for c in range(1, ord(alignment.SHARED)) for x in ("a", " ", "1", "  a", "'s")]
    for _ in range(2):  # the second time all words are known
        flat = both.encode(texts)
        for k in (0, 1):
            ids, at = flat[k][0].tolist(), 0
            for text, n in zip(texts, flat[k][1].tolist(), strict=True):
                assert ids[at : at + n] == plainly(both, text)[k], repr(text)
                at += n
    assert ["".join(" " + w for w in alignment.words(t)) for t in texts if t] == [" " + t for t in texts if t]


def test_few_kept_words_change_nothing(monkeypatch):
    both, rng = alignment.pair(tokenizers()), random.Random(4)
    monkeypatch.setattr(alignment, "CACHE", 40)
    both.forget()
    for _ in range(30):
        texts = [" ".join(rng.choice(["rye", "barley", "é", "x1", "日本", str(rng.randrange(99))]) for _ in range(rng.randrange(9))) for _ in range(8)]
        for k, (ids, counts) in enumerate(both.encode(texts)):
            assert ids.tolist() == [i for t in texts for i in plainly(both, t)[k]] and counts.tolist() == [len(plainly(both, t)[k]) for t in texts]
    both.forget()


@pytest.mark.parametrize("most", [1 << 18, 20, 0])
def test_alignment_against_brute_force(spark, most):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice(ODD) for _ in range(rng.randrange(25)))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, "the same word"), (202, "the same word"), (202, "the same word"), (203, "unbelievable " * 40), (204, " "), (205, "a�b")]
    got = alignment.align(spoiled(docs(spark, rows)), tokenizers(), most_broadcast=most)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == aligned(alignment.pair(tokenizers()), rows)


def test_alignment_of_long_texts_and_of_nothing(spark):
    rows = [(1, "x" * 50_000 + " and then " * 3_000)]
    (got,) = alignment.align(docs(spark, rows), tokenizers()).collect()
    a, b = plainly(alignment.pair(tokenizers()), rows[0][1])
    assert (got["n_a"], got["n_b"], got["n_links"]) == (len(a), len(b), len(a) + len(b) - got["n_groups"])
    assert alignment.align(docs(spark, rows).limit(0), tokenizers()).collect() == []
    with pytest.raises(ValueError, match="n_links"):
        alignment.align(docs(spark, rows).withColumn("n_links", F.lit(1)), tokenizers(), keep=("n_links",))
