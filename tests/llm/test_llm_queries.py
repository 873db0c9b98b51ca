"""Registered queries against DuckDB SQL or brute force on whole small tables."""

import base64
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import helpers as H
from patrolspark.llm import queries as Q

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages labels".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("select doc_id, coalesce(text, '') from documents order by doc_id").fetchall()


def result(spark, key):
    return {r[0]: r for r in Q.QUERIES[key](spark, SF).collect()}


@pytest.mark.parametrize("key", sorted(Q.ORACLE_SQL))
def test_sql(spark, con, key):
    got = Q.QUERIES[key](spark, SF)
    want = con.execute(Q.ORACLE_SQL[key])
    names = [d[0] for d in want.description]
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_every_query_named():
    assert [re.match(r"op(\d+)_", k)[1] for k in Q.QUERIES] == [str(i) for i in range(1, 14)]


def test_op1(spark, con):
    rows = con.execute("select vec_id, label, embedding from embeddings order by vec_id").fetchall()
    x = np.array([r[2] for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T >= 0.98) & (np.array([r[1] for r in rows])[:, None] == np.array([r[1] for r in rows]))
    np.fill_diagonal(near, False)
    part = H.components(len(rows), np.argwhere(near))
    got = result(spark, "op1_embedding_near_dedup")
    for i, r in enumerate(rows):
        low = rows[part[i]][0]
        assert tuple(got[r[0]]) == (r[0], near[i].sum(), low, low == r[0])


def test_op2(spark, docs):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = result(spark, "op2_byte_bpe")
    for i, t in docs:
        ids = enc.encode_ordinary(t)
        assert tuple(got[i]) == (i, len(ids), H.sha(np.array(ids, dtype="<u4").tobytes()), H.sha(t))


def test_op4(spark, con, docs):
    got = result(spark, "op4_quality_classifier")
    assert sorted(got) == [i for i, _ in docs]
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    labels = con.execute("select doc_id, quality from labels").fetchall()
    right = [got[i].predicted == q for i, q in labels if got[i].held_out]
    assert len(right) >= 5 and sum(right) >= 0.9 * len(right)


def test_op5(spark, docs):
    got = result(spark, "op5_license_scan")
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    for i, t in docs:
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        places = [(j, v) for p, v in phrases.items() for j in range(len(words))
                  if words[j:j + len(p.split())] == p.split()]
        base = sorted({v for _, v in places})
        starts = [j for j, _ in places]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(base)
        assert set(base) <= set(filter(None, r.labels.split(","))) and r.labels.split(",") == sorted(r.labels.split(","))
        assert 0 <= r.score <= 1


def test_op6(spark, docs):
    prints = [H.fingerprint(t) for _, t in docs]
    pairs = [(a, b) for a in range(len(docs)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    part = H.components(len(docs), pairs)
    got = result(spark, "op6_simhash")
    for k, (i, _) in enumerate(docs):
        assert tuple(got[i]) == (i, f"{prints[k]:016x}", docs[part[k]][0])


def brute_pii(text):
    out = []
    for kind, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
                    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, text):
            d = [int(c) for c in m[0] if c.isascii() and c.isdigit()]
            check = sum(v if k % 2 == 0 else sum(divmod(2 * v, 10)) for k, v in enumerate(d[::-1]))
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 13 <= len(d) <= 19 and check % 10 == 0 or kind == "phone" and 9 <= len(d) <= 15):
                out.append((kind, *m.span()))
    return out


def test_op7(spark, docs):
    got = result(spark, "op7_pii")
    for i, t in docs:
        base = brute_pii(t)
        text = [f"{k}:{a}:{b}" for k, a, b in base]
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in
                                                          ("email", "ip", "card", "phone")]
        assert r.base_sha256 == H.sha(",".join(text))
        assert set(text) <= set(r.spans.split(",")) if text else True


def test_op10(spark, docs):
    want = H.repeated_words(docs)
    got = result(spark, "op10_substring_dedup")
    assert {i: tuple(r) for i, r in got.items()} == {i: (i, n, g, H.sha(k)) for i, (n, g, k) in want.items()}
