"""Connected components of an edge table, by alternating star contractions.

The large-star / small-star scheme: each round links every node's larger
neighbours, then its smaller ones, to the least node around.  All rounds are
aggregations and equi-joins on the node, so the state is an edge table that
never outgrows the input and never visits the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All edges of a table that one task may hold -> ``node, root``, by uniting sets."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := above.get(x, x)) != x:
            above[x] = above.get(y, y)
            x = y
        return x

    for f in frames:
        for u, v in zip(f["u"].tolist(), f["v"].tolist()):
            a, b = root(u), root(v)
            if a != b:
                above[max(a, b)] = min(a, b)
    yield pd.DataFrame([(x, root(x)) for x in list(above) if root(x) != x], columns=["node", "root"])


def connected(edges: DataFrame, small: int = 0) -> DataFrame:
    """``edges(u bigint, v bigint)`` -> ``(node, root)``: the least node of its component.

    Nodes without an edge don't appear, nor do roots themselves; loops and
    repeated edges do no harm, and no edges give no rows.  At most ``small``
    edges (counted before) are united in one task instead of rounds.
    """
    now = store.table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(xxhash64(v, u) % 1000003)")).first()
        if mark[0] == 0 or mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        if seen is None and mark[0] <= small:
            return now.coalesce(1).mapInPandas(_joined, "node bigint, root bigint")
        seen, before = mark, now
        now = store.table(_small_star(_large_star(before)), "edges")
        store.drop(before)
