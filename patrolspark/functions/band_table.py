"""Bands as data: labels of a number by any set of intervals.

A band is ``(name, start, end)``: it holds start, but not end, and wraps around
when end is not above start (equal: the whole circle).  Bands may overlap and may
leave gaps.  Their boundaries cut the line into pieces, each held by a fixed set
of bands; the piece of a value is found by a binary search, as a tree of
comparisons that stays in generated code and asks log2(pieces) of them, however
many bands there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..util import as_col

Band = tuple[str, int, int]


@dataclass(frozen=True)
class BandTable:
    """``starts`` are the pieces' first values, in order; ``held`` the names of the bands over each piece.

    Before the first start lies the last piece: values go round."""

    names: tuple[str, ...]
    starts: tuple[int, ...]
    held: tuple[tuple[str, ...], ...]

    @classmethod
    def of(cls, bands: Sequence[Band]) -> BandTable:
        """From bands in any order; where they overlap, names keep the order given."""
        if not bands:
            raise ValueError("a table needs a band")
        starts = sorted({x for _, a, b in bands for x in (a, b)})

        def holds(band: Band, x: int) -> bool:
            _, a, b = band
            return a <= x < b if a < b else x >= a or x < b

        held = tuple(tuple(dict.fromkeys(band[0] for band in bands if holds(band, x))) for x in starts)
        return cls(tuple(dict.fromkeys(b[0] for b in bands)), tuple(starts), held)

    def _search(self, x: Column, values: Sequence[Column]) -> Column:
        """``values[k]`` for the piece k of ``x``; null for a null ``x``."""
        def tree(low: int, high: int) -> Column:  # pieces low..high, where low - 1 stands for the last one
            if low == high:
                return values[low]
            middle = (low + high + 1) // 2
            return F.when(x < self.starts[middle], tree(low, middle - 1)).otherwise(tree(middle, high))

        first = F.when(x < self.starts[0], values[-1]).otherwise(tree(0, len(self.starts) - 1))
        return F.when(x.isNotNull(), first)

    def piece(self, x) -> Column:
        """Number of the piece that holds ``x``."""
        return self._search(as_col(x), [F.lit(k) for k in range(len(self.starts))])

    def labels(self, x) -> Column:
        """Names of all bands that hold ``x``, an empty array in a gap."""
        return self._search(as_col(x), [
            F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>") for names in self.held])

    def index(self, x) -> Column:
        """Place of the first band that holds ``x`` among ``names``; null in a gap."""
        return self._search(as_col(x), [
            F.lit(self.names.index(names[0])) if names else F.lit(None).cast("int") for names in self.held])

    def label(self, x) -> Column:
        """Name of the first band that holds ``x``; null in a gap."""
        return self._search(as_col(x), [F.lit(names[0] if names else None).cast("string") for names in self.held])
