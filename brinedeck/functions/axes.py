"""Regular grid axes as integer arithmetic, so that matching needs no search."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RegularAxis:
    """Axis ``origin + step * i`` for ``i`` in ``0 .. size-1``; ``step`` may be negative."""

    origin: float
    step: float
    size: int

    def coord(self, idx: Column) -> Column:
        return F.lit(float(self.origin)) + idx * F.lit(float(self.step))

    def position(self, x: Column) -> Column:
        """Fractional index, rounded so that points on a node stay on it."""
        return F.round((x - F.lit(float(self.origin))) / F.lit(float(self.step)), 9)

    def nearest(self, x: Column) -> Column:
        """Index of the nearest node; ties to the lower index, outside points to the edge."""
        raw = F.ceil(self.position(x) - F.lit(0.5)).cast("int")
        clipped = F.greatest(F.least(raw, F.lit(self.size - 1)), F.lit(0))
        return F.when(raw.isNotNull(), clipped)

    def at_or_below(self, x: Column) -> Column:
        """Index of the largest coordinate not above x, NULL outside the axis."""
        pos = self.position(x)
        return self._inside((F.floor(pos) if self.step > 0 else F.ceil(pos)).cast("int"))

    def at_or_above(self, x: Column) -> Column:
        """Index of the smallest coordinate not below x, NULL outside the axis."""
        pos = self.position(x)
        return self._inside((F.ceil(pos) if self.step > 0 else F.floor(pos)).cast("int"))

    def first_within(self, x: Column, half: float) -> Column:
        """Lowest index whose coordinate is strictly within ``half`` of x, else NULL."""
        edge = x - F.lit(half) if self.step > 0 else x + F.lit(half)
        idx = F.greatest((F.floor(self.position(edge)) + 1).cast("int"), F.lit(0))
        near = F.round(F.abs(self.coord(idx) - x), 9) < F.lit(half)
        return F.when(near, self._inside(idx))

    def _inside(self, idx: Column) -> Column:
        return F.when((idx >= 0) & (idx < self.size), idx)
