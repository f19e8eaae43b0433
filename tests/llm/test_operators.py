"""The training-data operators against brute force and on the cases that their docstrings define."""

import hashlib
import random
import re
import textwrap
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from corpusmill.llm import bpe, chat, common, decontaminate, license_scan, line_dedup, quality, simhash, substring_dedup, topk, url_filter
from corpusmill.llm.automaton import SuffixAutomaton
from corpusmill.llm.components import components
from corpusmill.llm.queries import vocabulary
from corpusmill.llm.words import Words

DOCS = "doc_id bigint, text string"
#: a column of each name that the operators make or use inside
CLASHING = "key string, n_lines int, leaks int, fp string, variant int, node int, score string, ids int, host int, anchor int, run int, family int, position int, conv_id_ int"


def docs(spark, rows, partitions=3):
    return spark.createDataFrame(rows, DOCS).repartition(partitions)


def clashing(df):
    out = df
    for column in CLASHING.split(", "):
        name, kind = column.split()
        if name not in out.columns:
            out = out.withColumn(name, F.lit("7").cast(kind))
    return out


# --- 1 ----------------------------------------------------------------------------------------------------------------------------------

ALLOW, BLOCK = ["example.net/en/", "org/fr/", "a.b.c/x"], ["net/", "example.com/de/", "c/", "b.c/x/y", "a.b.c/x"]
URLS = [
    None, "", "no scheme", "http://", "http://net", "http://NET/", "https://x.Example.net/en/1?q#f", "https://example.net/e", "http://notexample.com/de/", "http://www.example.com/de/a", "http://a.org/fr/", "http://a.org/fr",
    "http://a.b.c/xyz", "http://z.a.b.c/", "http://b.c/x/y/z", "http://b.c/x/y", "http://c#f", "x://y.c/?://net/", "http://net:80/", "http://.net/", "http://c//", "http://é.net/é",
]


def judged(url):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]) if found else ("", "")
    best = None
    for verdict, rules in (("allow", ALLOW), ("block", BLOCK)):
        for rule in rules:
            h, slash, p = rule.partition("/")
            if host and (host == h or host.endswith("." + h)) and path.startswith(slash + p):
                rank = (h.count("."), len(p), verdict == "block")
                best = max(best or (rank, rule, verdict), (rank, rule, verdict))
    return host, path, best and best[1], best[2] if best else "allow"


@pytest.mark.parametrize("limit", [64_000_000, 0])
def test_urls_with_one_trie_and_with_many(spark, limit):
    df = clashing(spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS[:3])], "page_id bigint, url string"))
    got = url_filter.filter_urls(df, ALLOW, BLOCK, keep=("page_id",), max_broadcast_bytes=limit).orderBy("page_id").collect()
    for r in got:
        assert tuple(r[1:]) == judged((URLS + URLS[:3])[r["page_id"]]), r
    assert len(got) == len(URLS) + 3
    assert url_filter.filter_urls(df.limit(0), ALLOW, BLOCK, max_broadcast_bytes=limit).count() == 0
    both = spark.createDataFrame([("http://net/x",), ("http://net",)], "url string")
    assert [tuple(r) for r in url_filter.filter_urls(both, ["net/"], ["NET/"], max_broadcast_bytes=limit).select("rule", "verdict").collect()] == [("NET/", "block"), (None, "allow")]
    with pytest.raises(ValueError, match="host"):
        url_filter.filter_urls(df, ALLOW, BLOCK, keep=("page_id", "host"))


def test_many_entries_below_one_host():
    trie = url_filter.UrlTrie((f"example.org/{i}", "block") for i in range(100_000))
    at = trie.root.below["org"].below["example"].paths
    assert at.below[""].sizes == [5, 4, 3, 2, 1] and trie.match("a.example.org", "/99999x/y") == (2, 6, "example.org/99999", "block")
    assert trie.match("example.org", "/x") is None


# --- 2 ----------------------------------------------------------------------------------------------------------------------------------


def licences(model, rows):
    """Rows that the model's plain form gives for id and text."""
    return Counter((i, n, family, round(p, 6), round(a, 6), said) for i, t in rows for n, family, p, a, said in model.scan(t))


def found_licences(df):
    return Counter((r["doc_id"], r["paragraph"], r["family"], round(r["probability"], 6), round(r["alike"], 6), r["says"]) for r in license_scan.scan_licenses(df).collect())


def test_licences(spark):
    texts = {
        1: "Some prose.\nReleased under the MIT License.\nMore prose, the license of the driver mit.", 2: "This work is licensed under the GNU General Public License, version 3.", 3: None, 4: "", 5: "Licensed under CC BY-NC 4.0.",
        6: "The license of the driver was renewed. " * 3000, 7: "RELEASED UNDER THE mit license", 8: "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-SA 4.0", 9: "Released under pressure, with the general public.",
        10: "All rights reserved.", 11: "Prose.\n\nThis is not under the MIT License.", 12: "mit freundlichen Gr\u00fc\u00dfen\nEr kam mit ihr.",
    }
    rows = [*texts.items(), (None, texts[5]), (1, texts[1])]
    model = license_scan.fit_licenses()
    got = found_licences(clashing(docs(spark, rows)).drop("family"))
    want = {(1, 1, "MIT"): 2, (2, 0, "GPL"): 1, (5, 0, "CC-BY-NC"): 1, (None, 0, "CC-BY-NC"): 1, (7, 0, "MIT"): 1, (8, 0, "Apache-2.0"): 1, (8, 1, "CC-BY-SA"): 1, (10, 0, "unknown"): 1}
    assert Counter({x[:3]: n for x, n in got.items()}) == Counter(want)
    assert got == licences(model, rows)
    df = clashing(docs(spark, rows))
    assert license_scan.scan_licenses(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="family"):
        license_scan.scan_licenses(df, keep=("doc_id", "family"))


@pytest.mark.parametrize(
    ("family", "says"),
    [("GPL", "GPL-3.0"), ("GPL", "GPL-2.0-only"), ("GPL", "GPL-3.0-or-later"), ("MIT", "MIT"), ("ISC", "ISC"), ("Apache-2.0", "Apache-2.0"), ("MPL-2.0", "MPL-2.0"), ("CC0", "CC0-1.0"), ("BSD", "BSD-3-Clause"), ("LGPL", "LGPL-2.1"), ("AGPL", "AGPL-3.0")],
)
def test_identifiers(family, says):
    assert license_scan.fit_licenses().predict(f"SPDX-License-Identifier: {says}")[0] == family


def test_names_and_denials():
    model = license_scan.fit_licenses()
    for family, names in license_scan.NAMES.items():
        for name in names:
            assert model.predict(f"Licensed under the {name}")[0] == family, name
    for says, want in (("Licensed under GPLv3", "GPL"), ("LGPLv3", "LGPL"), ("This project is MIT licensed.", "MIT"), ("Copyright 2031 Somebody Inc. All rights reserved.", "unknown")):
        assert model.predict(says)[0] == want, says
    for says in ("This is not under the MIT License.", "Not licensed under the BSD License.", "It is no longer available under the ISC License.", "Public transport with a license", "of this and the", "mit"):
        assert model.predict(says)[0] is None, says
    texts = [t for t, _ in license_scan._training()]
    assert len(texts) == len(set(texts)) and not {*texts} & {n for k in license_scan.NOTICES.values() for n in k}


def test_anchors_lose_nothing():
    model = license_scan.fit_licenses()
    line, block = (re.compile(license_scan._holding(a)) for a in (model.anchors, license_scan.block_anchors(0.5)))
    rng = random.Random(2)
    words = sorted(model.weights)
    for _ in range(4000):
        said = " ".join(rng.sample(words, rng.randint(1, 8)))
        assert line.search(said) or model.predict(said)[0] is None
        assert block.search(said) or all(license_scan.alike(k, license_scan.grams(said)) < 0.5 for k in license_scan.FAMILIES)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_licences_of_the_tables(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    got = found_licences(df.repartition(4))
    assert got == licences(license_scan.fit_licenses(), rows)
    assert sum(n for x, n in got.items() if "licen" in x[-1].lower() or "reserved" in x[-1]) >= 0.98 * sum(got.values())


def test_wrapped_licences(spark):
    rows, want, prose = [], Counter(), "Some prose of the day that has nothing to do with it.\nA second line."
    for i, (family, notice) in enumerate((k, n) for k in ("ISC", "MIT", "BSD") for n in license_scan.NOTICES[k]):
        for j, width in enumerate((75, 40)):
            lines = textwrap.fill(notice, width)
            rows += [(10 * i + j, lines), (10 * i + j + 5, f"{prose}\n\n{lines}\n \n{prose}")]
            want[10 * i + j, 0, family] += 1
            want[10 * i + j + 5, 3, family] += 1
    got = license_scan.scan_licenses(docs(spark, rows)).collect()
    found = {(r["doc_id"], r["family"]) for r in got}
    assert found == {(d, f) for d, _, f in want}
    runs = [r for r in got if "\n" in r["says"]]
    assert len(runs) >= 4 and all(want[r["doc_id"], r["paragraph"], r["family"]] for r in runs)


# --- 3 ----------------------------------------------------------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    rng = random.Random(8)
    good = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(3, 80))) + "."
    bad = lambda: rng.choice([good().upper().replace(" ", "!! "), good().replace(" ", " | "), " ".join(w for w in good().split() for _ in range(9))])
    rows = [(i, bad() if i % 4 == 0 else good()) for i in range(1200)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(1100)] + [(3, None), (None, 1)], "doc_id bigint, quality int")
    df = clashing(docs(spark, [*rows, (None, None), (5000, ""), (5001, "word " * 100_000)]))
    model = quality.fit_quality(df, labels)
    got = {r["doc_id"]: r["score"] for r in quality.score_quality(df, model).collect()}
    held = [r[0] for r in df.where(quality.held_out(F.col("doc_id"))).select("doc_id").collect()]
    wrong = [i for i in held if i < 1200 and (got[i] >= 0.5) != (i % 4 != 0)]
    assert len(wrong) <= len(held) * 0.03 and len(got) == 1203 and all(0 <= s <= 1 for s in got.values())
    rules = {s: float(v) for s, v in zip(quality.STATISTICS, df.where("doc_id = 7").select(*[c.cast("double") for c in quality.statistics(F.col("text")).values()]).first(), strict=True)}
    import numpy as np

    assert abs(model.score(np.array([[rules[s] for s in quality.STATISTICS]]))[0] - got[7]) < 1e-9  # compiled as fitted
    assert quality.fit_quality(df, labels.limit(0)).rules == () and quality.score_quality(df.limit(0), model).count() == 0


# --- 4 ----------------------------------------------------------------------------------------------------------------------------------

BLANK = " \t\n\x0b\x0c\r"


def lines_kept(rows, least=20, most=3):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANK))
    holders = {}
    for n, (i, t) in enumerate(rows):
        if i is not None:
            for k in {key(x) for x in (t or "").split("\n")}:
                if len(k) >= least:
                    holders.setdefault(k, set()).add(i)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= most}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or key(x) not in gone or gone[key(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [1 << 20, 1 << 28])
def test_lines(spark, bits):
    rng = random.Random(3)
    pool = [" ".join(rng.choices(["Aé", "b", "ÜC", "dd\u00a0", "E"], k=rng.randint(1, 16))) for _ in range(60)]
    pool += ["x" * 19, "x" * 20, "é" * 19, "é" * 20, "", " " * 30, "\x1c" + "y" * 19]
    rows = [(i, "\n".join(rng.choice(["", "  ", "\t"]) + rng.choice(pool) + rng.choice(["", "\r", "\x0b "]) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    rows += [(100, None), (101, ""), (None, rows[3][1]), (7, rows[9][1]), (102, "z" * 25 + "\n" + "one long line " * 20_000)]
    got = line_dedup.dedup_lines(clashing(docs(spark, rows)), most_bits=bits, lines_per_document=1)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == lines_kept(rows)
    assert line_dedup.dedup_lines(docs(spark, rows).limit(0)).count() == 0
    with pytest.raises(ValueError, match="n_lines"):
        line_dedup.dedup_lines(clashing(docs(spark, rows)), keep=("doc_id", "n_lines"))


def test_a_document_that_repeats_an_id_counts_once(spark):
    line = "the same line of twenty characters and more"
    few, many = [(5, line), (5, line), (3, line)], [(5, line), (5, line), (3, line), (4, line)]
    for rows, want in ((few, [(3, 0), (5, 0), (5, 0)]), (many, [(3, 1), (4, 1), (5, 0), (5, 0)])):
        got = line_dedup.dedup_lines(docs(spark, rows))
        assert sorted((r["doc_id"], r["n_dropped"]) for r in got.collect()) == want
        assert sorted((tuple(r) for r in got.collect()), key=repr) == lines_kept(rows)


def test_documents_that_lose_lines_are_told_from_others(spark):
    import numpy as np

    ids = [0, 1, -1, 7, 2**62, -(2**63), 2**63 - 1, 123456789]
    df = spark.createDataFrame([(i,) for i in ids], "__id bigint")
    assert [r[0] for r in df.select(F.xxhash64("__id")).collect()] == common.spark_hash(np.array(ids)).tolist()
    marks = spark.sparkContext.broadcast(common.id_filter(df, "__id", 1 << 28))
    many = spark.createDataFrame([(i,) for i in [*ids, *range(1000, 5000), None]], "__id bigint").repartition(3)
    chosen, others = (many.mapInArrow(common.chosen(marks, w), many.schema) for w in (True, False))
    assert {*ids} <= {r[0] for r in chosen.collect()} and chosen.count() < 400 and chosen.count() + others.count() == many.count()
    assert others.where("__id IS NULL").count() == 1


def test_filters_never_miss_a_repeat():
    import numpy as np

    one, other = line_dedup.Filters(1 << 14), line_dedup.Filters(1 << 14)
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**64, 300, dtype=np.uint64), rng.integers(0, 2**64, 300, dtype=np.uint64)
    one.add(np.append(a, a[:20]))
    other.add(np.append(b, a[50:80]))
    twice = one.twice | other.twice | (one.once & other.once)
    assert one.has(twice, one.positions(np.append(a[:20], a[50:80]))).all()
    assert one.has(twice, one.positions(rng.integers(0, 2**64, 1000, dtype=np.uint64))).mean() < 0.05


# --- 5 ----------------------------------------------------------------------------------------------------------------------------------


def test_tokens_equal_the_librarys(spark):
    import numpy as np
    import tiktoken

    vocab = vocabulary()
    library = tiktoken.Encoding("own", pat_str=vocab.pattern, mergeable_ranks=vocab.ranks, special_tokens={})
    rng = random.Random(6)
    alphabet = "aaaeeett  \n\tbcéñß١½Ⅷ'sSd!?文字あ🎉\u0300\u200b\xa0<|endoftext|>"
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    rows += [(500, None), (501, ""), (None, "the same"), (502, "the same"), (503, "a" * 20_000), (504, "<|endoftext|> it's")]
    got = bpe.encode(clashing(docs(spark, rows)), vocab, keep=("doc_id", "score")).collect()
    want = {i: t or "" for i, t in rows}
    assert len(got) == len(rows)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == library.encode_ordinary(want[r["doc_id"]]) and len(ids) == r["n_tokens"] and r["decoded"].decode() == want[r["doc_id"]]
    again = bpe.decode(bpe.encode(docs(spark, rows), vocab, keep=("doc_id",)).drop("decoded"), vocab, keep=("doc_id",)).collect()
    assert all(r["decoded"].decode() == want[r["doc_id"]] for r in again)
    assert bpe.encode(docs(spark, rows).limit(0), vocab).count() == 0


def test_every_code_point_is_split_as_by_the_library():
    import tiktoken

    vocab = vocabulary()
    library = tiktoken.Encoding("own", pat_str=vocab.pattern, mergeable_ranks=vocab.ranks, special_tokens={})
    assert vocab.stands_for  # the two have other Unicode tables
    codec, every = vocab.codec, [chr(c) for c in [*range(0x3000), *range(0xA000, 0xD800), *range(0xE000, 0x3FFFF), *sorted(vocab.stands_for)] if not 0xD800 <= c < 0xE000][::1]
    for form in ("a{}b", " {}'s", "!{}?", "1{}2", "\n{} "):
        text = "".join(form.format(c) for c in every)
        assert codec.encode_batch([text])[0].tolist() == library.encode_ordinary(text)
    codec.forget()


def test_few_kept_pieces_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 40)
    rng = random.Random(2)
    texts = [[" ".join(rng.choice(["the", "qzx", "añb", "longerword", f"w{rng.randint(0, 400)}x"]) for _ in range(12)) for _ in range(4)] for _ in range(60)]
    few, fresh = vocabulary().codec, vocabulary()
    for block in texts:
        assert [x.tolist() for x in few.encode_batch(block)] == [x.tolist() for x in bpe.Codec(fresh).encode_batch(block)] if block is texts[-1] else [len(x) for x in few.encode_batch(block)]
        assert len(few.known) <= 40 + len({p for t in block for p in few.split(t)})


def test_a_merge_that_makes_a_lower_rank_goes_first():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 300, b"abc": 260, b"bc": 400, b"cd": 270, b"aa": 280}
    import tiktoken

    library = tiktoken.Encoding("odd", pat_str=r"\w+|\W", mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(bpe.Vocabulary(ranks, r"\w+|\W"))
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcda") for _ in range(rng.randint(0, 12))) for _ in range(500)]
    assert [x.tolist() for x in codec.encode_batch(texts)] == [library.encode_ordinary(t) for t in texts]


# --- 6 ----------------------------------------------------------------------------------------------------------------------------------


def leaks_by_force(text, items, least=0.8):
    words, out = text.lower().split(), []
    for i, item in items:
        own = item.lower().split()
        weights, best = decontaminate.shingles([w.encode() for w in own], 5), (0.0, None)
        for s in range(len(words) - len(own) + 1) if own else ():
            x = decontaminate.alike(decontaminate.shingles([w.encode() for w in words[s : s + len(own)]], 5), weights)
            best = max(best, (x, -s)) if x >= least else best
        if best[1] is not None:
            out.append((i, round(best[0], 9), -best[1]))
    return out


def test_leaks_against_brute_force(spark):
    rng = random.Random(12)
    word = lambda: rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa la mu nu xi".split())
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 5, 12, 30, 30, 45])))) for i in range(25)] + [(90, None), (91, ""), (None, "one two three four five six seven"), (3, "Repeated id words here now then")]
    rows = []
    for i in range(120):
        words = [word() for _ in range(rng.randint(0, 60))]
        for item in rng.sample(items, rng.randint(0, 2)):
            part = (item[1] or "").split()
            for _ in range(rng.randint(0, 2)):
                if part:
                    part[rng.randrange(len(part))] = rng.choice(["odd", "Alpha"])
            at = rng.randint(0, len(words))
            words[at:at] = part
        rows.append((i, " ".join(words)))
    rows += [(200, None), (201, ""), (None, items[9][1].upper()), (5, rows[5][1]), (202, "filler words " * 30_000 + items[20][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    with pytest.raises(ValueError, match="leaks"):
        decontaminate.find_leaks(clashing(docs(spark, rows)), bench, keep=("doc_id", "leaks"))
    for limit in (200_000, 80):  # at once and in runs
        got = decontaminate.find_leaks(clashing(docs(spark, rows)), bench, most_words=limit).collect()
        found = Counter((r["doc_id"], tuple(sorted(((x["item_id"], round(x["similarity"], 9), x["start"]) for x in r["leaks"]), key=repr))) for r in got)
        want = Counter((i, tuple(sorted(leaks_by_force(t or "", [(k, v or "") for k, v in items]) if i != 202 else [(items[20][0], 1.0, 60_000)], key=repr))) for i, t in rows)
        assert found == want
    assert decontaminate.find_leaks(docs(spark, rows), bench.limit(0)).where("size(leaks) > 0").count() == 0


def test_documents_shorter_than_an_item(spark):
    rng = random.Random(21)
    items = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(n))) for i, n in enumerate([59, 30, 30, 12, 5, 4, 3])]
    rows = [(0, " ".join(items[0][1].split()[:55])), (1, ""), (2, None)]
    for i in range(3, 150):
        words = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 8)):
            if words:
                del words[rng.choice([0, -1, rng.randrange(len(words))])]
        rows.append((i, " ".join(words)))
    want = Counter()
    for i, text in rows:
        words = (text or "").split()
        for k, item in items:
            own, best = item.split(), (0.0, None)
            weights = decontaminate.shingles([w.encode() for w in own], 5)
            for s in range(max(1, len(words) - len(own) + 1)):  # at least the whole document
                window = words[s : s + len(own)]
                x = decontaminate.alike(decontaminate.shingles([w.encode() for w in window], 5), weights)
                best = max(best, (x, -s, len(window))) if x >= 0.8 else best
            if best[1] is not None:
                want[i, k, round(best[0], 9), -best[1], best[2]] += 1
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.find_leaks(docs(spark, rows), bench).collect()
    assert Counter((r["doc_id"], x["item_id"], round(x["similarity"], 9), x["start"], x["n_words"]) for r in got for x in r["leaks"]) == want
    assert (0, 0, round(51 / 55, 9), 0, 55) in want


# --- 7 ----------------------------------------------------------------------------------------------------------------------------------


def print_of(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_force(prints, radius):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_against_brute_force(spark, radius):
    rng = random.Random(radius)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    prints = {0, 1, 3, (1 << 63)} | {s ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) & (2**64 - 1) for s in seeds for _ in range(8)}
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp bigint")
    found = simhash.links(df, radius)
    got = {r["node"]: r["root"] for r in components(found).collect()}
    want = groups_by_force({s: p for p, s in signed.items()}, radius)
    parts = lambda m: {frozenset(k for k in want if m.get(k, k) == r) for r in set(m.values()) | {k for k in want if k not in m}}
    assert parts(got) == parts(want)
    for a, b in found.collect():
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= radius


def test_near_duplicates(spark):
    rng = random.Random(9)
    base = [" ".join(rng.choice("Ab cd é\u00a0f gh ij kl".split(" ")) for _ in range(rng.randint(1, 90))) for _ in range(30)]
    rows = [(i, base[rng.randrange(30)] + rng.choice(["", "", " tail"])) for i in range(1, 120)] + [(500, None), (501, ""), (400, " \n"), (502, "one"), (503, "ONE"), (504, "long text of words " * 20_000)]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(clashing(docs(spark, rows))).collect()}
    prints = {i: print_of(t) for i, t in rows}
    want = groups_by_force(prints, 2)
    assert {i: (r["fp"] & (2**64 - 1), r["component_id"]) for i, r in got.items()} == {i: (prints[i], want[i]) for i in prints}
    extra = simhash.near_duplicates(docs(spark, [*rows, (None, base[0]), (500, None)]))
    assert extra.count() == len(rows) + 2 and simhash.near_duplicates(docs(spark, rows).limit(0)).count() == 0


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(0, 300)] + [(1000, 1002), (1001, 1002), (2000, 2000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000, 1002: 1000}


# --- 8 ----------------------------------------------------------------------------------------------------------------------------------


def cut_by_force(rows, width):
    first = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for i, words in split:
        for s in range(len(words) - width + 1):
            k = tuple(words[s : s + width])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, words in split:
        gone = set()
        for s in range(len(words) - width + 1):
            if i is not None and first[tuple(words[s : s + width])] < i:
                gone.update(range(s, s + width))
        out.append((i, " ".join(w for p, w in enumerate(words) if p not in gone), len(words), len(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("width", "gram", "most_runs"), [(6, 3, 256), (6, 3, 2), (5, 5, 256), (1, 16, 4)])
def test_substrings_against_brute_force(spark, width, gram, most_runs):
    rng = random.Random(width + most_runs)
    vocabulary_ = [f"w{i}" for i in range(40)] + ["É\u00a0x", "W1"]
    shared = [[rng.choice(vocabulary_) for _ in range(rng.randint(4, 20))] for _ in range(8)]
    rows = []
    for i in range(70):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(shared) if rng.random() < 0.6 else [rng.choice(vocabulary_) for _ in range(rng.randint(1, 12))]
        rows.append((i * 3, rng.choice([" ", "\n", "\t "]).join(words)))
    rows += [(500, None), (501, ""), (None, rows[5][1]), (9, rows[6][1]), (9, rows[7][1]), (502, "same " * 400), (503, "same " * 500)]
    got = substring_dedup.dedup_substrings(clashing(docs(spark, rows)), width=width, gram=gram, most_runs=most_runs, most_words=50)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == cut_by_force(rows, width)
    assert substring_dedup.dedup_substrings(docs(spark, rows).limit(0)).count() == 0


def test_automaton_windows():
    rng = random.Random(3)
    for _ in range(150):
        texts = [("".join(rng.choice("abc") for _ in range(rng.randint(0, 14))), rng.randint(0, 9)) for _ in range(rng.randint(1, 5))]
        automaton = SuffixAutomaton()
        for t, label in texts:
            automaton.add(t, label)
        asked = "".join(rng.choice("abcd") for _ in range(20))
        for width in (1, 2, 4):
            want = [min((label for t, label in texts if asked[i : i + width] in t), default=None) for i in range(len(asked) - width + 1)]
            assert list(automaton.windows(asked, width)) == want


def test_word_hashes_do_not_depend_on_place():
    w = Words([b"a bb  c\td", b"", b"  x a bb c d", b"bb c d a"])
    assert len(w) == 13 and w.first.tolist() == [0, 4, 4, 9, 13] and w.words(0, 4) == [b"a", b"bb", b"c", b"d"]
    three = w.grams(3)
    assert three[0] == three[5] and three[1] == three[9] and three[0] != three[1]


# --- 9 ----------------------------------------------------------------------------------------------------------------------------------


def test_turns_read_back(spark):
    rng = random.Random(4)
    parts = [*chat.CONTROLS, "\\", "[\\INST]", "<\\\\/s>", "<", "[", "text ", "\n", "é🎉", "/s>", "INST]"]
    for _ in range(3000):
        role = rng.choice(["user", "assistant", "system", "tool", "", None, "odd\nrole [INST]%41"])
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))
        said, a, b = chat.turn(role, text)
        assert [x[:2] for x in chat.parse(said)] == [(role or "", text)] and chat.unescape(said[a:b]) == text
    rows = [(i % 9, rng.choice([0, 1, 1, 2, None]), rng.choice(["user", "assistant", None, "tool"]), rng.choice([None, "", "x </s>", "[INST]"])) for i in range(200)] + [(None, 0, "user", "y" * 300_000)]
    for _ in range(300):  # a whole conversation, read in parts of any size
        turns = [(rng.choice(["user", "assistant", "system", "tool"]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))) for _ in range(rng.randint(0, 6))]
        whole, reader, at, read = chat.BEGIN + "".join(chat.turn(*t)[0] for t in turns), chat.Reader(), 0, []
        while at < len(whole):
            size = rng.randint(1, 30)
            read += reader.feed(whole[at : at + size])
            at += size
        assert [*read, *reader.close()] == turns
    df = clashing(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).repartition(3)
    got = {}
    for r in chat.format_conversations(df).collect():
        got.setdefault(r["conv_id"], []).append(r)
    key = lambda x: (x is not None, x)
    for conv, turns in got.items():
        turns.sort(key=lambda r: r["position"])
        whole = "".join(r["formatted"] for r in turns)
        want = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: tuple((v is not None, v if v is not None else 0) if n == 0 else (v is not None, v or "") for n, v in enumerate(r)))
        assert [x[:2] for x in chat.parse(whole)] == [(r or "", t or "") for _, r, t in want] and key(None) < key(0)
        spans = [chat.unescape(whole[r["loss_from"] : r["loss_to"]]) for r in turns if r["loss_from"] is not None]
        assert spans == [t or "" for _, r, t in want if r == "assistant"]
        assert [r["begins"] for r in turns] == [sum(len(x["formatted"]) for x in turns[:n]) for n in range(len(turns))]
    assert len(got) == 10 and chat.format_conversations(df.limit(0)).count() == 0


# --- 10 ---------------------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("most", [4096, 3])
def test_top_k_against_brute_force(spark, most):
    import math

    rng = random.Random(7)
    rows = [(i, [rng.choice([0.5, -1.25, 0.001, rng.uniform(-2, 2)]) for _ in range(6)]) for i in range(150)]
    rows += [(1000, None), (1001, []), (1002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1003, [math.nan] * 6), (1004, [math.inf] * 6), (None, [1.0] * 6), (7, [2.0] * 6), (1010, [1.0, 2.0]), (1020, [3.0, -1.0]), (1100, rows[3][1]), (1200, [1e30] * 6)]
    df = clashing(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).repartition(4)
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 10 == 0, k=5, block_rows=8, most_queries=most).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    clip = lambda x: max(-(2**63), min(2**63 - 1, x))
    for q, v in whole:
        if q % 10 == 0:
            scored = sorted((-clip(sum(a * b for a, b in zip(v, w, strict=True))), i) for i, w in whole if i != q and len(w) == len(v))[:5]
            want = [(n + 1, i, -s) for n, (s, i) in enumerate(scored)]
            assert [x for x in got.get(q, [])] == want, q
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_blocks_are_left_out():
    import numpy as np

    rng = np.random.default_rng(0)
    vectors = np.floor(rng.normal(size=(400, 8)) * 100)
    vectors[:40] += 500
    best = [topk.Best(10) for _ in range(3)]
    scored = topk.search_blocks(np.arange(400), vectors, np.array([1000, 1001, 1002]), np.full((3, 8), 50.0), best, 20)
    assert scored < 3 * 20 and all(len(b.ids) == 10 for b in best)


def test_digests_are_plain():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_kept_columns_must_not_have_names_that_are_made(spark):
    df = spark.createDataFrame([(1, "some text", 0.5)], "doc_id bigint, text string, score double").withColumn("ids", F.col("score"))
    model = quality.RuleModel.__new__(quality.RuleModel)
    for made in (lambda: bpe.encode(df, vocabulary(), keep=("doc_id", "ids")), lambda: quality.score_quality(df, model, keep=("score",)), lambda: substring_dedup.dedup_substrings(df, keep=("doc_id", "text"))):
        with pytest.raises(ValueError, match="names of columns that are made"):
            made()
