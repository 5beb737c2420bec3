"""Connected components by alternating star contractions; nothing is collected."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import stored

EDGES_AT_ONCE = 100_000


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of each slice of up to ``EDGES_AT_ONCE``, as stars of the same components."""
    for batch in batches:
        for at in range(0, batch.num_rows, EDGES_AT_ONCE):
            part = batch.slice(at, EDGES_AT_ONCE)
            parent: dict = {}

            def root(x):
                while (up := parent.setdefault(x, x)) != x:
                    parent[x] = parent[up]
                    x = up
                return x

            for a, b in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                r, s = root(a), root(b)
                if r != s:
                    parent[max(r, s)] = min(r, s)
            stars = [(root(x), x) for x in list(parent)]
            stars = [(r, x) for r, x in stars if r != x]
            if stars:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, batch.schema.field(0).type) for column in zip(*stars, strict=True)], names=["u", "v"]
                )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or is a centre, but not both."""
    ends = edges.select(F.col("v").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        edges.select(F.col("u").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    )
    per_node = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return not per_node.agg(F.max(F.col("below") + F.col("above") > 1)).first()[0]


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``edges`` (a, b) that is not its component's
    smallest node. Loops, null ends and repeated edges do no harm. Each round writes its
    edges, so a lost executor costs one round at most; the number of rounds grows with the
    logarithm of the longest path, and slices of edges are contracted before the first."""
    ordered = edges.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    current = stored(ordered.mapInArrow(_contracted, ordered.schema), "edges")
    while not _are_stars(current):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
        large = both.join(least, "u").where("v > u").select(F.col("_m").alias("u"), "v").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("_m"))
        moved = large.join(least, "v").where("u <> _m").select(F.col("_m").alias("u"), F.col("u").alias("v"))
        current = stored(moved.unionByName(least.select(F.col("_m").alias("u"), "v")).distinct(), "edges")
    return current.select(F.col("v").alias("node"), F.col("u").alias("component"))
