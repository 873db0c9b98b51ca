"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import random

import numpy as np
import pytest

import helpers as H
from patrolspark.llm import (bpe, embed_dedup, exact_dedup, licenses, mixing, pii, quality, simhash, substring_dedup,
                             url_filter)

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
TEXTS = [None, "", " \t\n", "one", "One", "two words", LONG, LONG, "a  b", "a b", "x" * 50_000, "é ß 中 🎉", None]


def frames(spark):
    some = H.docs_frame(spark, TEXTS, {3: None, 4: None, 5: "other"})
    return {
        "cases": some,
        "empty": some.limit(0),
        "repeated": some.unionAll(some.where("doc_id in (0, 3, 6)")),
        "null ids": H.docs_frame(spark, ["p q", "p q", "r", None], ids=[None, 1, None, None]),
        "clashes": H.with_clashes(some),
    }


@pytest.fixture(scope="module")
def cases(spark):
    return frames(spark)


NAMES = ["cases", "empty", "repeated", "null ids", "clashes"]


@pytest.mark.parametrize("name", NAMES)
def test_exact(spark, cases, name):
    df = cases[name]
    rows = df.select("doc_id", "text").collect()
    plain = ["".join((t or "").split(" ")).replace("\t", "").replace("\n", "") for _, t in rows]
    got = exact_dedup.classes(df).collect()
    assert len(got) == len(rows)
    assert sorted(r.text_sha256 for r in got) == sorted(map(H.sha, plain))
    for r in got:
        assert r.group_size == sum(H.sha(p) == r.text_sha256 for p in plain)
    kept = exact_dedup.dedup(df)
    assert kept.columns == df.columns
    assert kept.count() == len(set(plain))


def test_exact_rule(spark):
    df = H.docs_frame(spark, ["a b", "a  b", "ab", "a  b", "c"])
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.classes(df).collect()}
    assert got == {0: (1, 4, False), 1: (1, 4, True), 2: (1, 4, False), 3: (1, 4, False), 4: (4, 1, True)}


def test_exact_small_filter(spark):
    """A filter too small for the rows calls all of them suspect and changes nothing."""
    df = H.docs_frame(spark, [f"t{i % 700}" for i in range(2000)])
    a = sorted(map(tuple, exact_dedup.classes(df, max_bits=64).collect()))
    assert a == sorted(map(tuple, exact_dedup.classes(df).collect()))
    assert exact_dedup.dedup(df, max_bits=64).count() == 700


@pytest.mark.parametrize("name", NAMES)
def test_simhash(spark, cases, name):
    df = cases[name]
    rows = df.select("doc_id", "text").collect()
    prints = [H.fingerprint(t) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    part = H.components(len(rows), pairs)
    low = {p: min((rows[i][0] for i in range(len(rows)) if part[i] == p and rows[i][0] is not None), default=None)
           for p in part}
    want = sorted(((rows[i][0], f"{prints[i]:016x}", low[part[i]]) for i in range(len(rows))), key=repr)
    assert sorted(map(tuple, simhash.near_classes(df).collect()), key=repr) == want
    kept = simhash.dedup(df)
    assert kept.columns == df.columns and kept.count() == len(set(part))


def test_simhash_links(spark):
    """Dense and sparse groups, with tiles and longer keys: same components as brute force."""
    rng = random.Random(7)
    prints = []
    for _ in range(25):
        center = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            p = center
            for b in rng.sample(range(64), rng.randint(0, 4)):
                p ^= 1 << b
            prints.append(p)
    prints = sorted(set(prints) | {0, (1 << 64) - 1, 1 << 63})
    pairs = [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    part = H.components(len(prints), pairs)
    want = {}
    for i, p in enumerate(part):
        want.setdefault(p, set()).add(signed[i])
    want = sorted(sorted(g) for g in want.values() if len(g) > 1)
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    for kw in ({}, {"tile": 5}, {"bucket": 0}, {"bucket": 0, "tile": 3}):
        found = {}
        for r in simhash.components(simhash.links(df, **kw)).collect():
            found.setdefault(r.component, set()).add(r.node)
        assert sorted(sorted(g) for g in found.values()) == want


def test_components_of_a_chain(spark):
    """A long path settles, whatever the order of its numbers."""
    ids = list(range(200))
    random.Random(3).shuffle(ids)
    links = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")
    assert {r.component for r in simhash.components(links).collect()} == {0}


@pytest.mark.parametrize("name", NAMES)
def test_bpe(spark, cases, name):
    df = cases[name]
    coded = bpe.encode(df)
    got = bpe.decode(coded, coded.columns[-1])
    out = got.columns[-1]
    rows = got.select("text", out).collect()
    assert got.columns[:len(df.columns)] == df.columns
    assert all(bytes(d) == (t or "").encode() for t, d in rows)


def test_bpe_equals_merges():
    import base64

    import public_tokenizers
    import tiktoken
    with open(bpe.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(11)
    for _ in range(3000):
        s = "".join(rng.choice("aabbeetth  \n\t.,'s19éß中🎉\u00a0\u2003") for _ in range(rng.randint(0, 50)))
        assert np.frombuffer(bpe.encode_text(s), "<u4").tolist() == enc.encode_ordinary(s)
    for s in ("a" * 100_000, " " * 100_000, "ab" * 30_000):
        assert np.frombuffer(bpe.encode_text(s), "<u4").tolist() == enc.encode_ordinary(s)


@pytest.mark.parametrize("name", NAMES)
def test_licenses(spark, cases, name):
    df = cases[name]
    got = licenses.scan(df)
    assert got.columns[:len(df.columns)] == df.columns and got.count() == df.count()
    assert {r[0] for r in got.select(f"`{got.columns[-1]}`.score").collect()} <= {0.0}


def test_license_spans():
    text = "x Licensed under the Apache License, Version 2.0. y All Rights Reserved; CC-BY and cc by"
    r = licenses.scan_text(text)
    assert r["n_base"] == 3 and r["base_labels"] == "cc-by,reserved" and r["labels"] == "apache-2.0,cc-by,reserved"
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    assert licenses.scan_text(mit)["labels"] == "" and 0.2 < licenses.scan_text(mit)["score"] < 0.4


def test_license_automaton_matches_brute_force():
    rng = random.Random(2)
    vocabulary = "cc by general public license all rights reserved under the mit x 2 0 licensed".split()
    for _ in range(500):
        words = [rng.choice(vocabulary) for _ in range(30)]
        n = sum(words[j:j + len(p.split())] == p.split() for p, _ in licenses.PHRASES for j in range(30))
        assert licenses.scan_text(" ".join(words))["n_base"] == n


@pytest.mark.parametrize("name", NAMES)
def test_pii(spark, cases, name):
    df = cases[name]
    got = pii.find(df)
    assert got.columns[:len(df.columns)] == df.columns
    assert all(r[0] == "" for r in got.select(f"`{got.columns[-1]}`.spans").collect())


def test_pii_linear_and_redacted():
    import time
    began = time.time()
    for s in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "a.b@c.d_" * 20_000):
        pii.base_spans(s)
        pii.proposals(s)
    assert time.time() - began < 20
    judge = pii.Judge(np.zeros((0, 22)), np.zeros(0), np.zeros(0, dtype=bool))
    row = pii._row("to a.b@c.de or +1 (803) 555-5351.", judge)
    assert row[:4] == (1, 0, 0, 1) and row[-1] == "to [email] or [phone]."


@pytest.mark.parametrize("name", NAMES)
def test_quality(spark, cases, name):
    df = cases[name]
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (5, None)], "doc_id long, quality int")
    got = quality.score(df, labels)
    assert got.columns[:len(df.columns)] == df.columns
    score = got.columns[-2]
    assert all(0 <= r[0] <= 1 for r in got.select(score).collect()) and got.count() == df.count()


def test_quality_without_labels(spark, cases):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(cases["cases"], none).collect()} == {0.5}


def test_quality_moments():
    """The fitted Gaussian's log density is the textbook one."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((500, 3)) @ rng.standard_normal((3, 3))
    norm = (x * x).sum(axis=1)
    g = quality.Gaussian.fit(500, 500, x.mean(0), x.T @ x / 500, float((norm ** 2).mean()))
    cov = g.root @ g.root.T
    d = x - g.mean
    want = -0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1]
    assert np.allclose(g.log_density(x), want)


@pytest.mark.parametrize("name", NAMES)
def test_mixing(spark, cases, name):
    df = cases[name]
    got = mixing.draws(df)
    n = mixing.draw_names(df)
    rows = got.select(n["size"], n["taken"], n["target"], n["source_size"]).collect()
    assert len(rows) == df.count()
    assert all(t <= 2 * s and target <= 2 * size for s, t, target, size in rows)
    assert mixing.mix(df).columns == df.columns


def test_mixing_targets(spark):
    rng = random.Random(5)
    texts = [" ".join("w" for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    sources = {i: ("hot" if i % 3 == 0 else rng.choice(["a", "b", "é", None])) for i in range(3000)}
    df = H.docs_frame(spark, texts, sources)
    rows = mixing.draws(df).collect()
    total = sum(len(t.split()) for t in texts)
    by = {}
    for r in rows:
        s = by.setdefault(r.source, [0, r.source_size, r.target])
        s[0] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    assert abs(sum(t for _, _, t in by.values()) - 1.5 * total) < 1e-6 * total
    for taken, size, target in by.values():
        assert abs(taken - target) <= 60 and target <= 2 * size
    again = {r.doc_id: r.taken for r in mixing.draws(df.repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in rows}
    mixed = mixing.mix(df).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in mixed} == {r.doc_id: r.taken // r.size for r in rows if r.taken}


def test_splitting_tree():
    quotas = [1000, 0, 37, 512]
    leaves = mixing.split(quotas, 7)
    assert leaves.sum(axis=0).tolist() == quotas and (leaves >= 0).all()
    assert leaves.sum(axis=1).max() - leaves.sum(axis=1).min() <= 3


@pytest.mark.parametrize("name", NAMES)
def test_substring(spark, cases, name):
    df = cases[name]
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = substring_dedup.repeats(df).collect()
    assert len(got) == len(rows)
    if name in ("cases", "clashes"):
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == H.repeated_words(rows)


def test_substring_groups(spark):
    """Shared passages in different surroundings, small and oversized groups."""
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(40)]
    passages = [[rng.choice(vocabulary) for _ in range(n)] for n in (19, 20, 21, 60, 200)]
    texts = []
    for _ in range(150):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [rng.choice(vocabulary) for _ in range(rng.randint(0, 15))]
            p = rng.choice(passages)
            a = rng.randint(0, 3)
            words += p[a:len(p) - rng.randint(0, 3)]
        texts.append(" ".join(words))
    texts += ["same " * 100, "ab cd " * 40, texts[3], texts[3]]
    want = H.repeated_words(list(enumerate(texts)))
    df = H.docs_frame(spark, texts)
    for kw in ({}, {"group": 3}, {"prefix": 2}):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.repeats(df, **kw).collect()}
        assert got == want


def test_urls(spark):
    urls = [None, "", "no scheme", "http://a.NET/x", "https://net", "https://net/", "http://x.example.net/en/1?q",
            "http://example.net/EN/", "http://anet/", "http://b.org/fr/#t", "http://org/fr", "ftp://e.example.com/de/",
            "http://x.com/a.net/en/", "http://cheap-pills.com/", "http://cheap-pills.com", "http://q/w#net/", "a://b://c.net/d",
            "http://é.org/fr/ü", "http://x.net\n/y", "http://h.com/" + "p" * 20_000]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.host, r.path[:9], r.rule, r.verdict) for r in url_filter.judge(df).collect()}
    block = {3: "net/", 5: "net/", 7: "net/", 11: "example.com/de/"}
    for i, (host, path, rule, verdict) in got.items():
        assert rule == {**block, 6: "example.net/en/", 9: "org/fr/", 17: "org/fr/"}.get(i), urls[i]
        assert verdict == ("block" if i in block or i in (13, 14) else "allow"), urls[i]
    assert got[0][:2] == ("", "") and got[16][:2] == ("b:", "//c.net/d") and got[18][0] == "x.net\n"
    clash = H.with_clashes(df.limit(0).unionAll(df))
    out = url_filter.judge(clash)
    assert out.columns[:len(clash.columns)] == clash.columns and out.count() == len(urls)
    assert url_filter.judge(df.limit(0)).count() == 0


def test_url_words_with_and_without_a_path(spark):
    """The method's words: in a host, as a label of it, in a path however it is written."""
    cases = {"http://casino-x.org": 1, "http://casino-x.org?id=1": 1, "http://casino-x.org/": 1, "http://h.com/VIAGRA": 1,
             "http://h.com/%76iagra": 1, "http://h.com/a/wp%2Dlogin.PHP": 1, "http://h.com/%2576iagra": 0, "http://xxxl-shop.de/": 0,
             "http://www.xxx.de/x": 1, "http://xxx": 1, "http://alphabet.com/x": 0, "http://bet.com": 1, "http://h.com/casin%C3%B3": 0,
             "http://h.com/%ff%fe/viagr%61": 1, "http://h.com?/viagra": 0, "http://h.com/e#/viagra": 0, None: 0}
    df = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id long, url string")
    got = [r.verdict for r in url_filter.judge(df).orderBy("page_id").collect()]
    assert got == ["block" if b else "allow" for b in cases.values()]


def test_url_automaton_matches_brute_force():
    import re
    rng = random.Random(4)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?"]) for _ in range(rng.randint(1, 14))) for _ in range(90)]
    globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
    texts = ["".join(rng.choice("ab/c") for _ in range(rng.randint(0, 20))) for _ in range(200)]
    auto = url_filter.Automaton(globs)
    assert auto.words > 1
    regexes = [re.compile("".join({"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}.get(t, re.escape(t))
                                  for t in re.findall(r"\*\*|.", g))) for g in globs]
    want = [[bool(r.fullmatch(t)) for r in regexes] for t in texts]
    assert auto.match(texts).tolist() == want


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute_vectors(rows, threshold=0.98):
    def sound(r):
        v = r[1]
        return r[0] is not None and r[2] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [r for r in rows if sound(r)]
    near = []
    for a in range(len(good)):
        for b in range(a):
            x, y = (np.array(good[i][1], dtype=np.float32).astype(float) for i in (a, b))
            if good[a][2] == good[b][2] and len(x) == len(y):
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    near.append((a, b))
    part = H.components(len(good), near)
    low = [min(good[j][0] for j in range(len(good)) if part[j] == part[i]) for i in range(len(good))]
    out = [(good[i][0], sum(i in p for p in near), low[i], good[i][0] == low[i]) for i in range(len(good))]
    return out + [(r[0], 0, r[0], True) for r in rows if not sound(r)]


def test_vectors(spark):
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for label in (0, 1, 2):
        for _ in range(12):
            center = rng.standard_normal(16)
            for _ in range(rng.integers(1, 9)):
                v = center + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.15])
                rows.append((int(k), [float(x) for x in v.astype(np.float32)], label))
                k += 1
    rows += [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [1.0] * 15 + [None], 1),
             (1004, [1.0] * 16, None), (1005, [float("inf")] * 16, 0), (1006, [], 0), (None, [1.0] * 16, 1),
             (1007, [1.0] * 3, 1), (1008, [2.0] * 3, 1), (1009, [1e-30] * 3, 1), (1010, [1e30] * 3, 1)]
    want = sorted(brute_vectors(rows), key=repr)
    for kw in ({}, {"window": 8, "block": 32, "tile": 3}):
        got = sorted(map(tuple, embed_dedup.near_classes(vectors(spark, rows), **kw).collect()), key=repr)
        assert got == want


def test_vectors_empty_and_clashing(spark):
    assert embed_dedup.near_classes(vectors(spark, [])).count() == 0
    rows = [(i, [1.0, float(i // 2)], 1) for i in range(6)]
    df = H.with_clashes(vectors(spark, rows))
    got = sorted(map(tuple, embed_dedup.near_classes(df).collect()))
    assert got == sorted(brute_vectors(rows))


def test_vector_recall():
    """Pairs at the threshold meet in a window as often as asked."""
    rng = np.random.default_rng(8)
    n, d = 4000, 32
    x = rng.standard_normal((n, d))
    x /= np.linalg.norm(x, axis=1)[:, None]
    noise = rng.standard_normal((n, d))
    noise -= (noise * x).sum(1)[:, None] * x
    y = 0.98 * x + np.sqrt(1 - 0.98 ** 2) * noise / np.linalg.norm(noise, axis=1)[:, None]
    count = embed_dedup.passes_for(2 * n, 0.98, 0.99, 256)
    keys = embed_dedup.signs(np.concatenate([x, y]), count)
    met = np.zeros(n, dtype=bool)
    for p in range(count):
        rank = np.empty(2 * n, dtype=int)
        rank[np.argsort(keys[:, p], kind="stable")] = np.arange(2 * n)
        met |= np.abs(rank[:n] - rank[n:]) <= 256
    assert met.mean() >= 0.97
