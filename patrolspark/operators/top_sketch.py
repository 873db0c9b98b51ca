"""Top codes from mergeable sketches, with exact counts for the candidates.

A sketch of the frequent codes is a few kilobytes whatever the rows and however
many distinct codes there are (vehicles, drones); sketches of parts of a lake are
combined into the sketch of all.  Its estimates miss a count by at most
``error_bound``.  ``top_codes_verified`` counts the sketch's candidates exactly and
proves the answer: if the k-th of these counts is above what any other code can
have, the first k are right.  If not, all codes are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .metrics import COUNT, PERCENT, count_by, percent_of, share_of_total, top_k

TRACKED = 4096
#: A sketch that tracks T items among N rows keeps them in a map of at least T / 0.75
#: slots and is off by at most 3.5 N / slots.
OFF_BY = 3.5 * 0.75
SKETCH = "sketch"


def code_sketch(rows: DataFrame, code: str = "violation_code", by: tuple[str, ...] = (), tracked: int = TRACKED) -> DataFrame:
    """(by…, sketch, n): a sketch of the non-null codes and their number; one row a group."""
    made = [F.expr(f"approx_top_k_accumulate(`{code}`, {int(tracked)})").alias(SKETCH), F.count(F.lit(1)).alias("n")]
    return rows.where(F.col(code).isNotNull()).groupBy(*by).agg(*made)


def merged(sketches: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """One row for all sketches."""
    return sketches.agg(F.expr(f"approx_top_k_combine({SKETCH}, {int(tracked)})").alias(SKETCH), F.sum("n").alias("n"))


def error_bound(n: int, tracked: int = TRACKED) -> float:
    """How far an estimate over ``n`` rows can be off."""
    return OFF_BY * n / tracked


def estimated(sketches: DataFrame, k: int, tracked: int = TRACKED) -> tuple[list[tuple[str, int]], int]:
    """The k codes of largest estimate with it, and the number of rows behind all sketches."""
    if not sketches.limit(1).count():
        return [], 0
    row = merged(sketches, tracked).select("n", F.expr(f"approx_top_k_estimate({SKETCH}, {int(k)})").alias("top")).first()
    return [(r["item"], r["count"]) for r in row["top"] or []], row["n"] or 0


def top_codes_verified(rows: DataFrame, sketches: DataFrame, k: int, code: str = "violation_code",
                       tracked: int = TRACKED) -> tuple[DataFrame, bool]:
    """The k most common codes of ``rows`` (ties by code) with counts and shares, and whether the
    sketches sufficed: then ``rows`` are read for the candidates' counts alone."""
    room = min(tracked, 8 * k)
    found, n = estimated(sketches, room, tracked)
    off = error_bound(n, tracked)
    # a code the estimate leaves out: below the last one listed, or too rare for the list
    others = max(found[-1][1] + off if len(found) == room else 0, 2 * off if n > tracked else 0)
    if len(found) >= k:
        counts = count_by(rows.where(F.col(code).isin([c for c, _ in found])), code)  # at most 8 k codes
        first = top_k(counts, k, tie=code).collect()
        if len(first) == k and first[-1][COUNT] > others:
            known = rows.sparkSession.createDataFrame([(r[code], r[COUNT]) for r in first], f"{code} string, {COUNT} long")
            return known.withColumn(PERCENT, percent_of(COUNT, F.lit(n))), True
    return top_k(share_of_total(count_by(rows, code)), k, tie=code), False
