"""Connected components of an edge table by union-find in tasks and star contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import stored


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of each batch: at most one edge per node leaves."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent.setdefault(up, up)
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        pairs = [(x, r) for x in list(parent) if (r := root(x)) != x]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["u", "v"]
        )


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(u, v)`` that has a neighbour; the component
    is its smallest node. Loops and repeated edges do no harm; no edges give no rows.

    Each round turns every node's neighbourhood into stars on its least member, first among
    the larger neighbours, then among the smaller ones, so long chains shrink by a factor per
    round. Least members are combined before the shuffle; a node with very many neighbours
    is a skewed join key, which adaptive execution splits, since both sides are plain scans.
    """
    edges = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v")
    now = stored(edges.mapInArrow(_forest, "u long, v long").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == before:
            break
        before = state
        both = now.union(now.select("v", "u"))
        low = stored(
            both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least"
        ).withColumnRenamed("u", "at")
        large = both.where("v > u").join(low, F.col("u") == F.col("at"))
        large = stored(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "stars")
        low = stored(
            large.groupBy("u").agg(F.min("v").alias("m")), "least"
        ).withColumnRenamed("u", "at")
        small = large.join(low, F.col("u") == F.col("at"))
        now = stored(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("at", "m"))
            .where("u <> v")
            .distinct(),
            "edges",
        )
    nodes = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)
