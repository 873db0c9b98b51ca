"""Every score of the quality classifier against a plain version: features by loops, densities by inverses."""

import math
import zlib

import numpy as np

from patrolspark.llm import quality as K
from patrolspark.llm import queries as Q

SF = "/root/testdata/sf0.01"


def share(cases, of, start, weight):
    p = (cases + weight * start) / (of + weight)
    return math.log(p / (1 - p))


def brute_features(text):
    words = text.split()
    lines = [x for x in text.split("\n") if x]
    raw = text.encode("utf-8", "replace")
    inked = [b for b in raw if not (9 <= b <= 13 or b == 32)]
    c, w = len(inked), len(words)

    def among(signs):
        return sum(chr(b) in signs for b in inked)

    again, before = 0, set()
    for x in lines:
        again += x in before
        before.add(x)
    per_char, per_word, per_line = 5 * K.WEIGHT, K.WEIGHT, 3
    return [
        math.log((c + K.WEIGHT * 5.0) / (w + K.WEIGHT)),
        share(among("#$%&*+/<=>@[\\]^_`{|}~!"), c, 0.002, per_char),
        share(sum(65 <= b <= 90 for b in inked), c, 0.03, per_char),
        share(sum(48 <= b <= 57 for b in inked), c, 0.003, per_char),
        share(among(".,"), c, 0.03, per_char),
        math.log((len(set(words)) + K.WEIGHT) / (w + K.WEIGHT)),
        share(sum(a == b for a, b in zip(words, words[1:])), w, 0.01, per_word),
        share(sum(not (x[-1].isalnum() or x[-1] in ".,;:") for x in words), w, 0.01, per_word),
        share(among("|"), c, 0.001, per_char),
        share(again, len(lines), 0.01, per_line),
        share(sum(x.isupper() and len(x) > 20 for x in lines), len(lines), 0.01, per_line),
        share(sum(any(s in x for s in "|#$") for x in lines), len(lines), 0.01, per_line)]


def brute_scores(docs, labels):
    x = {i: np.array(brute_features(t)) for i, t in docs.items()}
    learn = {(i, q) for i, q in labels if i in x and q in (0, 1) and zlib.crc32(str(i).encode()) % 5}
    both = np.array([x[i] for i, _ in learn])
    center, scale = both.mean(axis=0), np.sqrt(np.maximum(both.var(axis=0), 1e-6))
    z = {i: (v - center) / scale for i, v in x.items()}
    log_density, prior = [], []
    for k in (0, 1):
        own = np.array([z[i] for i, q in learn if q == k])
        mean, n, d = own.mean(axis=0), len(own), own.shape[1]
        cov = sum(np.outer(v - mean, v - mean) for v in own) / n
        level = np.trace(cov) / d
        spread = sum((cov[a, b] - level * (a == b)) ** 2 for a in range(d) for b in range(d))
        noise = max(0.0, np.mean([(v @ v) ** 2 for v in own]) - (cov ** 2).sum()) / n
        s = min(1.0, noise / spread)
        shrunk = (1 - s) * cov + (s * level + 1e-3) * np.eye(d)
        inverse, half = np.linalg.inv(shrunk), np.linalg.slogdet(shrunk)[1] / 2
        log_density.append({i: -0.5 * (v - mean) @ inverse @ (v - mean) - half for i, v in z.items()})
        prior.append(n / len(learn))
    odds = {i: log_density[1][i] - log_density[0][i] + math.log(prior[1] / prior[0]) for i in x}
    return {i: 1 / (1 + math.exp(-min(500, max(-500, o)))) for i, o in odds.items()}


def test_scores_equal_the_plain_version(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    want = brute_scores(docs, labels)
    got = {r.doc_id: r for r in Q.op4_quality_classifier(spark, SF).collect()}
    assert sorted(got) == sorted(want)
    for i, r in got.items():
        assert math.isclose(r.score, want[i], rel_tol=1e-5, abs_tol=1e-9), i
        assert r.predicted == int(r.score >= 0.3)
    held = [(r.score >= 0.3) == (q == 1) for i, q in labels for r in [got[i]] if r.held_out]
    assert len(held) > 50 and np.mean(held) >= 0.97
