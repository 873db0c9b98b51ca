"""The pipeline's stages against brute force, each on its own input."""

import helpers as H

import corpus_pipeline as C
from patrolspark.llm import mixing

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    before = docs.collect()
    kept = C.keep_quality(spark, docs, SF)
    assert kept.columns == names
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    rows = kept.collect()
    assert {r.doc_id for r in rows} < {r.doc_id for r in before}
    assert len(good - {r.doc_id for r in rows}) <= 0.02 * len(good)

    docs = spark.createDataFrame(rows, kept.schema)
    exact = C.drop_copies(spark, docs, SF).collect()
    best = {}
    for r in rows:
        key = "".join(H.WORDS.findall(r.text))
        if key not in best or (-len(r.text), r.doc_id) < (-len(best[key].text), best[key].doc_id):
            best[key] = r
    assert sorted(r.doc_id for r in exact) == sorted(r.doc_id for r in best.values())

    docs = spark.createDataFrame(exact, kept.schema)
    near = C.drop_near_copies(spark, docs, SF).collect()
    exact = sorted(exact, key=lambda r: r.doc_id)
    prints = [H.fingerprint(r.text) for r in exact]
    part = H.components(len(exact), [(a, b) for a in range(len(exact)) for b in range(a)
                                     if (prints[a] ^ prints[b]).bit_count() <= 4])
    assert sorted(r.doc_id for r in near) == sorted(exact[p].doc_id for p in set(part))

    docs = spark.createDataFrame(near, kept.schema)
    mixed = C.mix_sources(spark, docs, SF)
    assert mixed.columns == names
    taken = {r.doc_id: r.taken // r.size for r in mixing.draws(docs).collect() if r.taken}
    count = {}
    for r in mixed.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert count == taken

    last = C.tokenize(spark, mixed, SF).collect()
    assert len(last) == sum(taken.values()) and all(r.round_trip for r in last)


def test_run(spark):
    assert [name for name, _ in C.STAGES] == ["quality classifier", "exact dedup", "simhash near-dedup", "mixing", "byte bpe"]
    assert C.run(spark, SF).count() > 100
