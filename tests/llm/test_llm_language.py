"""Language identification against a letter-by-letter version, held-out accuracy and odd rows."""

import random
import zlib

import numpy as np
import pytest
import regex

import helpers as H
from patrolspark.llm import language as L
from patrolspark.llm import queries as Q

SF = "/root/testdata/sf0.01"


def brute(text):
    total = np.zeros(L.DIM)
    for w in regex.findall(r"[\p{L}\p{M}]+", text.lower()) if regex.search(r"\p{L}", text) else ():
        c = [ord(x) for x in f" {w} "]
        for i in range(len(c) - 2):
            total += np.roll(L._signs(c[i]), 2).astype(int) * np.roll(L._signs(c[i + 1]), 1) * L._signs(c[i + 2])
    return total


def texts():
    rng = random.Random(5)
    return ["", " 12 ", "a", "Ab  c, déf ß Über x1y", "日本語 テスト", "́́", "café au",
            " ".join("".join(rng.choice("abcdeéß ,1") for _ in range(9)) for _ in range(60))]


def test_bundle_equals_brute_force():
    x = L.bundle(texts(), list(range(len(texts()))), len(texts()))
    for t, row in zip(texts(), x, strict=True):
        assert (brute(t) == row).all(), t


def test_pieces_and_blocks_change_nothing(monkeypatch):
    whole = L.bundle(texts(), [0, 1] * 4, 2)
    for name, value in (("PIECE", 7), ("GRAMS_AT_ONCE", 3), ("TEXTS_AT_ONCE", 2)):
        monkeypatch.setattr(L, name, value)
        assert (L.bundle(texts(), [0, 1] * 4, 2) == whole).all()


def test_held_out_accuracy(spark):
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in Q.op13_language_id(spark, SF).collect()}
    assert sorted(got) == sorted(want)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r.lang_pred == want[i] for i, r in got.items() if r.held_out and want[i]]
    assert len(held) > 200 and sum(held) >= 0.99 * len(held)


def test_held_out_rows_teach_nothing(spark):
    """Wrong languages on the held-out rows, and sources and ids, change no prediction."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spoiled = docs.withColumn("lang", L.F.when(L.held_out(docs["doc_id"]), "xx").otherwise(docs["lang"])).withColumn("source", L.F.lit("s"))
    rows = [sorted(map(tuple, L.predict(d).select("doc_id", "lang_pred", "score").collect())) for d in (docs, spoiled)]
    assert rows[0] == rows[1] and "xx" not in {r[1] for r in rows[0]}


def test_equals_brute_prototypes(spark):
    rows = [(1, "der die das und", "de"), (2, "the and that which", "en"), (3, None, "en"), (4, "and the", None),
            (5, "der und", "de"), (6, "12 3", "fr"), (None, "und das", None), (7, "", "de")]
    got = [(r.doc_id, r.lang_pred, r.score) for r in L.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()]
    learn = {}
    for i, t, lang in rows:
        if t and lang and zlib.crc32(str(i).encode()) % 4 != 2:
            learn[lang] = learn.get(lang, 0) + brute(t)
    learn = {k: v / np.linalg.norm(v) for k, v in learn.items() if v.any()}
    for (i, t, _), (_, lang, score) in zip(rows, got, strict=True):
        own = brute(t or "")
        if not own.any():
            assert (lang, score) == ("und", 0.0)
        else:
            cos = {k: v @ own / np.linalg.norm(own) for k, v in learn.items()}
            best = max(sorted(cos), key=cos.get)
            assert lang == best and score == pytest.approx(min(1, max(0, cos[best])))


def test_odd_tables(spark):
    empty = H.docs_frame(spark, [])
    assert L.predict(empty).collect() == []
    untaught = L.predict(H.docs_frame(spark, ["abc", None]).withColumn("lang", L.F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in untaught} == {("und", 0.0)}
    clash = H.docs_frame(spark, ["the long", "the long"], ids=[1, 1]).withColumn("lang_pred", L.F.lit("own")).withColumn("__x", L.F.lit(1))
    out = L.predict(H.with_clashes(clash)).collect()
    assert out[0] == out[1] and out[0]["lang_pred"] == "own" and out[0]["lang_pred_"] == "en"
    long = L.predict(H.docs_frame(spark, ["ab " * 400_000 + "x" * 100_000])).collect()
    assert long[0].lang_pred == "en"


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGUAGES", 2)
    docs = spark.createDataFrame([(i, "abc", f"l{i}") for i in range(9)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        L.predict(docs)
