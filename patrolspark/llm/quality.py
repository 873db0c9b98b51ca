"""Quality classifier: regularised quadratic discriminant analysis.

Statistics of the whole text (transformed towards normal shapes) make a short
vector.  Each class has a mean and a covariance, shrunk towards a scaled
identity by the Ledoit-Wolf rule; a score is the logistic of the difference of
the two Gaussian log densities (Mahalanobis distances by cached Cholesky factors)
plus the log prior ratio.

The moments are sums over the labelled rows, added up by Spark: the driver sees
one row per class, whatever the number of documents.  Labels, language, source
and ids are never inputs.

Defined cases: a null or empty text has the statistics of an empty text and a
finite score; labels that are null are not learned from; a document labelled
twice with different labels counts once for each; without labelled rows of both
classes every score is the neutral 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, cut, free_name, small_batches

#: Symbol bytes that running prose seldom has.
_SYMBOLS = np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~!", dtype=np.uint8)
#: Statistics, and the value a share starts from: WEIGHT cases of it are added to
#: each text, so that a few words or lines are weak evidence.
FEATURES = {"word_length": 5.0, "symbols": 0.002, "upper": 0.03, "digits": 0.003, "stops": 0.03, "distinct": 1.0,
            "repeats": 0.01, "bad_ends": 0.01, "pipes": 0.001, "repeated_lines": 0.01, "loud_lines": 0.01,
            "noisy_lines": 0.01}
WEIGHT = 25
FOLDS = 5
THRESHOLD = 0.3


def _shape(name: str, cases: int, of: int, weight: float = WEIGHT) -> float:
    """A share among ``of`` cases, drawn towards its start value, on the logit scale."""
    p = (cases + weight * FEATURES[name]) / (of + weight)
    return float(np.log(p / (1 - p)))


def features(text: str) -> list[float]:
    words = text.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)
    chars = int(counts.sum()) - int(counts[9:14].sum()) - int(counts[32])
    lines = [x for x in text.split("\n") if x]
    repeated = sum(c - 1 for c in Counter(lines).values())
    ends = sum(1 for w in words if not (w[-1].isalnum() or w[-1] in ".,;:"))
    loud = sum(1 for x in lines if x.isupper() and len(x) > 20)
    noisy = sum(1 for x in lines if "|" in x or "#" in x or "$" in x)
    by_char = 5 * WEIGHT
    return [
        float(np.log((chars + WEIGHT * FEATURES["word_length"]) / (n + WEIGHT))),
        _shape("symbols", int(counts[_SYMBOLS].sum()), chars, by_char),
        _shape("upper", int(counts[65:91].sum()), chars, by_char),
        _shape("digits", int(counts[48:58].sum()), chars, by_char),
        _shape("stops", int(counts[46] + counts[44]), chars, by_char),
        float(np.log((len(set(words)) + WEIGHT) / (n + WEIGHT))),
        _shape("repeats", sum(map(eq, words, words[1:])), n),
        _shape("bad_ends", ends, n),
        _shape("pipes", int(counts[124]), chars, by_char),
        _shape("repeated_lines", repeated, len(lines), 3),
        _shape("loud_lines", loud, len(lines), 3),
        _shape("noisy_lines", noisy, len(lines), 3),
    ]


@dataclass
class Gaussian:
    prior: float
    mean: np.ndarray
    root: np.ndarray  # Cholesky factor of the shrunk covariance
    half_log_det: float

    @classmethod
    def fit(cls, n: int, total: int, mean: np.ndarray, second: np.ndarray, fourth: float) -> Gaussian:
        """From the count, mean, mean outer product and mean fourth power of the centred norm."""
        d = len(mean)
        cov = second - np.outer(mean, mean)
        scale = np.trace(cov) / d
        spread = ((cov - scale * np.eye(d)) ** 2).sum()
        noise = max(0.0, fourth - (cov ** 2).sum()) / n
        shrink = min(1.0, noise / spread) if spread > 0 else 1.0
        shrunk = (1 - shrink) * cov + (shrink * scale + 1e-3) * np.eye(d)
        root = np.linalg.cholesky(shrunk)
        return cls(n / total, mean, root, float(np.log(np.diag(root)).sum()))

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = np.linalg.solve(self.root, (x - self.mean).T)
        return -0.5 * (z * z).sum(axis=0) - self.half_log_det


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    classes: list[Gaussian]
    temper: float = 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        if len(self.classes) < 2:
            return np.full(len(x), 0.5)
        z = (x - self.center) / self.scale
        bad, good = self.classes
        odds = good.log_density(z) - bad.log_density(z)
        odds = odds / self.temper + np.log(good.prior / bad.prior)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: CRC-32 of the id as text divisible by FOLDS."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def with_features(docs: DataFrame, text: str, out: str) -> DataFrame:
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([features(t) for t in batch], dtype=object)

    return docs.withColumn(out, apply(F.coalesce(col(docs, text), F.lit(""))))


def _moments(rows: DataFrame, d: int, center: np.ndarray, scale: np.ndarray) -> dict[int, tuple]:
    """Per label: count, mean, mean outer product, mean fourth power; from sums in Spark."""
    center, scale = np.asarray(center), np.asarray(scale)
    width = 1 + d + d * d + 1

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x = (np.array(batch["x"].tolist()).reshape(len(batch), d) - center) / scale
            for label in batch["label"].unique():
                own = x[(batch["label"] == label).to_numpy()]
                norm = (own * own).sum(axis=1)
                sums[int(label)] = sums.get(int(label), np.zeros(width)) + np.concatenate(
                    [[len(own)], own.sum(axis=0), (own.T @ own).ravel(), [(norm ** 2).sum()]])
        for label, s in sums.items():
            yield pd.DataFrame({"label": [label] * width, "k": range(width), "v": s})

    parts = rows.mapInPandas(partial, "label int, k int, v double")
    found: dict[int, np.ndarray] = {}
    for r in parts.groupBy("label", "k").agg(F.sum("v").alias("v")).collect():  # 2 x width rows
        found.setdefault(r["label"], np.zeros(width))[r["k"]] = r["v"]
    return {label: (int(s[0]), s[1:d + 1] / s[0], s[d + 1:-1].reshape(d, d) / s[0], s[-1] / s[0])
            for label, s in found.items()}


def fit(rows: DataFrame) -> Model:
    """From labelled rows (x array<double>, label 0 or 1)."""
    d = len(FEATURES)
    rows = cut(rows)  # one short vector a labelled row, read twice
    raw = _moments(rows, d, np.zeros(d), np.ones(d))
    if set(raw) != {0, 1}:
        return Model(np.zeros(d), np.ones(d), [])
    total = sum(m[0] for m in raw.values())
    center = sum(m[0] * m[1] for m in raw.values()) / total
    square = sum(m[0] * np.diag(m[2]) for m in raw.values()) / total
    scale = np.sqrt(np.maximum(square - center ** 2, 1e-6))
    own = _moments(rows, d, center, scale)
    return Model(center, scale, [Gaussian.fit(own[k][0], total, *own[k][1:]) for k in (0, 1)])


def score(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
          label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with held_out, score and predicted (underscores added if taken)."""
    learn = docs.select(col(docs, doc_id).alias("id"), col(docs, text).alias("text"))
    learn = learn.where(~held_out(F.col("id")))
    known = labels.select(col(labels, doc_id).alias("l_id"), col(labels, label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1)).distinct()
    x = free_name(docs, "__x")
    learn = with_features(learn, "text", "x").select("id", "x")
    model = fit(learn.join(known, F.col("id") == F.col("l_id")).select("x", "label"))
    d = len(FEATURES)

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.score(np.array(batch.tolist()).reshape(len(batch), d)))

    n = {c: free_name(docs, c) for c in ("held_out", "score", "predicted")}
    out = with_features(docs, text, x)
    out = out.withColumn(n["held_out"], held_out(col(docs, doc_id))).withColumn(n["score"], judge(x)).drop(x)
    return out.withColumn(n["predicted"], (F.col(n["score"]) >= threshold).cast("int"))
