"""Rows that a load refuses: counted in the pass that writes, judged before anything is committed."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Refused(RuntimeError):
    """A load has more of something than it may have; nothing of it is committed."""


class Gate(NamedTuple):
    """Rows for which ``where`` is true are counted as ``name``, left out if ``drop``, and refuse the load beyond ``most``."""

    name: str
    where: Column
    drop: bool = True
    most: int | None = None


class Watched:
    """``df`` without what its gates drop; ``counts`` and ``check`` speak once an action has read it to its end.

    The counts come from the writing tasks themselves, so nothing is read twice.
    """

    def __init__(self, df: DataFrame, gates: list[Gate]):
        self.gates, self._seen = gates, Observation()
        flags = {f"__{k}": F.coalesce(g.where, F.lit(False)) for k, g in enumerate(gates)}
        watched = df.withColumns(flags).observe(self._seen, F.count("*").alias("rows"), *[F.count_if(k).alias(k) for k in flags])
        for k, g in zip(flags, gates):
            if g.drop:
                watched = watched.where(~F.col(k))
        self.df = watched.drop(*flags)

    def counts(self) -> dict[str, int]:
        seen = self._seen.get
        return {g.name: seen.get(f"__{k}") or 0 for k, g in enumerate(self.gates)}

    def check(self) -> dict[str, int]:
        """The counts; raises where a gate has more than it may."""
        counts = self.counts()
        over = [f"{counts[g.name]} {g.name} (at most {g.most})" for g in self.gates if g.most is not None and counts[g.name] > g.most]
        if over:
            raise Refused("; ".join(over))
        return counts
