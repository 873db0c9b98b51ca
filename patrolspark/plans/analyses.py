"""The four violation analyses, directly or from one shared cube.

Input everywhere: a violations frame with ``sending_date`` (timestamp) and
``violation_code`` (string).  Undated rows are dropped first.

Plan shape (checked with ``explain``): scan of two columns with
``isnotnull(sending_date)`` pushed to Parquet → label projection in codegen →
partial hash aggregate → shuffle of one row per key per task → final
aggregate.  Shares use a scalar subquery for the grand total, so no stage
funnels all groups through one task.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import FIRST_ANALYSIS_SEASONS, TOP_CODES
from ..functions.bands import (SEASONS, period_index, period_name, season_index,
                               season_name)
from ..operators.conform import prepared
from ..operators.metrics import COUNT, count_by, share_of_total, top_k, top_per_group

DATE = "sending_date"
CODE = "violation_code"


def labelled(rows: DataFrame) -> DataFrame:
    """Dated rows with ``season`` and ``period`` as band indices (integers;
    names are attached after aggregation, on the few result rows)."""
    return prepared(rows.select(DATE, CODE)).select(
        season_index(DATE).alias("season"), period_index(DATE).alias("period"), CODE)


def named(df: DataFrame) -> DataFrame:
    """Replace band indices by names (after aggregation)."""
    cols = []
    for c in df.columns:
        if c == "season":
            cols.append(season_name("season").alias("season"))
        elif c == "period":
            cols.append(period_name("period").alias("period"))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


# -- direct plans (one scan each) ------------------------------------------

def season_share(rows: DataFrame) -> DataFrame:
    """Q1: winter against summer, share of the two together.

    Counts all four seasons and keeps two of the (at most four) groups: no
    per-row filter, and the shuffle carries one row per season per task
    either way.
    """
    r = labelled(rows)
    keep = [SEASONS.index(s) for s in FIRST_ANALYSIS_SEASONS]
    counts = count_by(r, "season").where(F.col("season").isin(keep))
    return named(share_of_total(counts))


def top_codes(rows: DataFrame, k: int = TOP_CODES) -> DataFrame:
    """Q2: the k most common codes, share of all dated violations."""
    r = prepared(rows.select(DATE, CODE))
    return top_k(share_of_total(count_by(r, CODE)), k)


def period_share(rows: DataFrame) -> DataFrame:
    """Q3: night against day."""
    return named(share_of_total(count_by(labelled(rows), "period")))


def top_code_per_season(rows: DataFrame) -> DataFrame:
    """Q4: most common code of each season, share of that season."""
    return named(top_per_group(count_by(labelled(rows), ["season", CODE]), "season"))


# -- cube path (one scan for all four) -------------------------------------

def violation_cube(rows: DataFrame) -> DataFrame:
    """(season, period, code) → count of non-null codes.

    At most 4 × 2 × distinct codes rows, whatever the input size.
    """
    return named(count_by(labelled(rows), ["season", "period", CODE]))


def _roll(cube: DataFrame, keys) -> DataFrame:
    return cube.groupBy(*keys).agg(F.sum(COUNT).alias(COUNT))


def season_share_from(cube: DataFrame) -> DataFrame:
    c = cube.where(F.col("season").isin(list(FIRST_ANALYSIS_SEASONS)))
    return share_of_total(_roll(c, ["season"]))


def top_codes_from(cube: DataFrame, k: int = TOP_CODES) -> DataFrame:
    return top_k(share_of_total(_roll(cube, [CODE])), k)


def period_share_from(cube: DataFrame) -> DataFrame:
    return share_of_total(_roll(cube, ["period"]))


def top_code_per_season_from(cube: DataFrame) -> DataFrame:
    return top_per_group(_roll(cube, ["season", CODE]), "season")


def run_concurrently(results: dict, action) -> dict:
    """``action(name, df)`` for every answer, submitted together so the small
    result jobs run concurrently (they share the cached cube); returns the
    actions' results by name and raises the first failure."""
    with ThreadPoolExecutor(max_workers=max(1, len(results))) as pool:
        futures = {k: pool.submit(action, k, df) for k, df in results.items()}
        return {k: f.result() for k, f in futures.items()}


def run_all(rows: DataFrame, storage: StorageLevel = StorageLevel.MEMORY_AND_DISK
            ) -> tuple[dict[str, DataFrame], DataFrame]:
    """Q5: all four answers from one scan of ``rows``.

    Returns ``(results, cube)``; the cube is persisted (it is small: bounded
    by bands × codes, not by rows) and the caller unpersists it when done.
    If an executor holding cube blocks is lost, Spark recomputes them from
    lineage.
    """
    return answers_from(violation_cube(rows), storage)


def answers_from(cube: DataFrame, storage: StorageLevel = StorageLevel.MEMORY_AND_DISK
                 ) -> tuple[dict[str, DataFrame], DataFrame]:
    """The four answers from a cube; ``(results, persisted cube)`` as ``run_all``."""
    cube = cube.persist(storage)
    results = {
        "season_share": season_share_from(cube),
        "top5_codes": top_codes_from(cube),
        "period_share": period_share_from(cube),
        "top_code_per_season": top_code_per_season_from(cube),
    }
    return results, cube
