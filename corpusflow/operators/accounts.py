"""Counts of what a run met and left out, taken along by the pass that does the work."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Accounts:
    """Sums of observed counts. A table is watched where it flows; nothing is read twice."""

    def __init__(self) -> None:
        self._seen: list[Observation] = []
        self.known: Counter[str] = Counter()

    def add(self, name: str, number: int) -> None:
        self.known[name] += number

    def watch(self, df: DataFrame, **counts: Column) -> DataFrame:
        """Add the counts, aggregates over all rows, once `df` has been computed."""
        seen = Observation()
        self._seen.append(seen)
        return df.observe(seen, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in counts.items()])

    def totals(self) -> dict[str, int]:
        """All counts by name. To be asked for when everything watched has been computed."""
        total = Counter(self.known)
        for seen in self._seen:
            total.update(seen.get)
        return dict(sorted(total.items()))
