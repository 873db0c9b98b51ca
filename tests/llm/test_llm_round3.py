"""Mixing through its tree, and the pipeline on odd tables."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

import helpers as H
import corpus_pipeline as C
from patrolspark.llm import bpe
from patrolspark.llm import mixing as M
from patrolspark.llm import queries as Q

SF = "/root/testdata/sf0.001"


def test_mixing_deals_blocks_as_the_leaves_say(spark, monkeypatch):
    """Of the query's own documents, each shard holds the blocks its leaf has, and no others."""
    seen = []
    real = M.split
    monkeypatch.setattr(M, "split", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text")
    drawn = M.draws(docs).withColumn("shard", F.explode("shards"))
    got = {(r["source"], r["shard"]): r["words"] for r in drawn.groupBy("source", "shard").agg(F.sum("size").alias("words")).collect()}
    leaves = seen[0]
    known = {r["source"]: r["source_size"] for r in drawn.select("source", "source_size").distinct().collect()}
    longest = {r[0]: r[1] for r in drawn.groupBy("source").agg(F.max("size")).collect()}
    for i, name in enumerate(sorted(known, key=lambda s: (s is None, s))):
        for shard in range(M.SHARDS):
            want = leaves[shard, i] * known[name] / M.BLOCKS
            # documents belong to the block of their middle, and the last block is taken in part
            assert abs(got.get((name, shard), 0) - want) <= 2 * longest[name] + known[name] / M.BLOCKS + 1


def test_mixing_takes_what_the_tree_deals(spark, monkeypatch):
    """Without the tree's leaves nothing is taken; with half of them, half the shards' words."""
    real = M.split
    whole = {r.doc_id: r.taken for r in Q.op9_mixing(spark, SF).collect()}
    monkeypatch.setattr(M, "split", lambda *a, **k: 0 * real(*a, **k))
    assert {r.taken for r in Q.op9_mixing(spark, SF).collect()} == {0}

    def half(*a, **k):
        leaves = real(*a, **k)
        leaves[M.SHARDS // 2:] = 0
        return leaves

    monkeypatch.setattr(M, "split", half)
    part = {r.doc_id: r.taken for r in Q.op9_mixing(spark, SF).collect()}
    assert all(part[i] <= whole[i] for i in whole) and 0.4 < sum(part.values()) / sum(whole.values()) < 0.6


CLASH = ("ids", "n_tokens", "round_trip", "__coded", *H.CLASHES)


def run(spark, docs):
    for _, stage in C.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs.limit(0), SF).schema)
    return docs


@pytest.fixture(scope="module")
def prose(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    return [r for r in rows if r.doc_id in good][:12]


def test_pipeline_on_odd_rows(spark, prose):
    own = [tuple(r) for r in prose]
    odd = own + [own[0], (None, own[1][1] + " more of it", "en", None, 1), (9001, None, "en", "s", 0), (9002, "", None, None, 0),
                 (9003, None, None, None, None), (9004, " ".join(own[2][1].split() * 400), "en", "s", 1)]
    docs = spark.createDataFrame(odd, H.DOCS)
    out = run(spark, docs)
    assert out.columns == [*docs.columns, "ids", "n_tokens", "round_trip"]
    rows = out.collect()
    assert rows and all(r.round_trip and r.n_tokens == len(r.ids) // 4 for r in rows)
    assert {r.doc_id for r in rows} <= {r[0] for r in odd}


def test_pipeline_keeps_clashing_columns(spark, prose):
    docs = spark.createDataFrame([tuple(r) for r in prose], H.DOCS)
    plain = run(spark, docs).collect()
    wide = docs.select("*", *[F.concat(F.lit(f"own {c} "), F.col("doc_id")).alias(c) for c in dict.fromkeys(CLASH)])
    out = run(spark, wide)
    assert len(out.columns) == len(set(out.columns)) == len(wide.columns) + 3
    for r in out.collect():
        assert r["ids"] == f"own ids {r['doc_id']}" and r["n_tokens"] == f"own n_tokens {r['doc_id']}" and r["round_trip_"]
    assert sorted((r.doc_id, r.n_tokens) for r in plain) == sorted((r["doc_id"], r["n_tokens_"]) for r in out.collect())


def test_pipeline_on_an_empty_table(spark):
    assert run(spark, spark.createDataFrame([], H.DOCS)).collect() == []


def test_pii_on_texts_it_was_not_trained_on():
    """Spans of every form in new texts, and hardly any in new texts without them."""
    import numpy as np

    from patrolspark.llm import pii
    from test_llm_advice import private_texts

    forms = [lambda a, b, c: f"({200 + c % 700}) {300 + a % 600}-{b:04d}", lambda a, b, c: f"name{c} [at] firm{a} [dot] com",
             lambda a, b, c: f"2a02:{a % 4096:x}:{b:x}:{c:x}:0:0:{a:x}:{c:x}", lambda a, b, c: f"name{c} at firm{a} dot com"]
    rows = []
    for k, form in enumerate(forms):
        rows += [(f"{k}-{i}", *r) for i, t in enumerate(private_texts(form, np.random.default_rng(k))) for r in pii.examples(t)]
    held = np.array([int(r[0].split("-")[1]) % 10 in (3, 4) for r in rows])
    judge = pii.Judge(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), held)
    for k, form in enumerate(forms):
        found = [bool(judge.added(t, pii.base_spans(t))) for t in private_texts(form, np.random.default_rng(100 + k), 200)]
        assert np.mean(found[1::2]) >= 0.95 and np.mean(found[::2]) <= 0.05, k


def test_pii_counts(spark):
    from patrolspark.llm import pii
    text = "mail a@b.com key: d41d8cd98f00b204e9800998ecf8427e and a@c.org"
    got = pii.find(H.docs_frame(spark, [text, None])).select("pii.*").collect()
    for r in got:
        spans = list(filter(None, r.spans.split(",")))
        assert r.n_added == len(spans) - r.n_email - r.n_ip - r.n_card - r.n_phone
        assert r.n_secret == sum(s.startswith("secret:") for s in spans)
    assert got[0].n_email == 2 and got[1].n_added == 0


def test_a_task_leaves_no_remembered_pieces(spark):
    """A Python worker that waits for its next task holds the tables of the vocabulary and no more."""
    texts = spark.createDataFrame([(f"word{i} some more, and {i * 7919} again",) for i in range(400)], "text string")
    assert bpe.round_trip(texts.repartition(8)).agg(F.sum(F.length("coded.ids"))).first()[0] > 0
    assert bpe.encode(texts.repartition(8)).agg(F.sum(F.length("ids"))).first()[0] > 0

    def held(batches):
        for batch in batches:
            yield pd.DataFrame({"n": [bpe._memory.cache_info().currsize], "tables": [bpe.vocabulary.cache_info().currsize]})

    seen = spark.range(0, 64, numPartitions=64).mapInPandas(held, "n int, tables int").toPandas()
    assert seen["tables"].max() >= 1  # such workers were seen
    assert seen["n"].max() == 0
