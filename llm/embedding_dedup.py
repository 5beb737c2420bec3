"""Near-duplicates among embeddings: products of quantised tiles, rechecked where in doubt.

Vectors of one label (and length) are compared. Each is scaled to unit length in double
precision and quantised to 8-bit steps of its own largest component; the exact norm of what
quantising lost goes along. A product of two quantised vectors then differs from the cosine
by at most |a| |eb| + |ea| |b| + |ea| |eb|. Products of tiles are taken in whole numbers;
pairs certainly below the threshold are dropped, pairs certainly above are linked, and only
pairs in between are computed again in double precision.

Equal vectors of a label are one class with a multiplicity. The classes of a label are dealt
to tiles of about ``TILE`` by a hash, and every pair of tiles is a task of its own, so a label
with a third of all rows is work for many tasks of one size. A task returns numbers of links
per class and the links that join components, never all pairs.

Null labels, null or zero vectors and vectors with null or non-finite components are linked
with nothing: they have no links and are kept. Repeated rows are vectors of their own. An
empty table gives an empty result. Only id, embedding and label are read.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import read, stored
from llm.components import connected_components

TILE = 4096
ROWS_AT_ONCE = 512
THRESHOLD = 0.98
ROUNDING = 1e-9


def usable(embedding: Column) -> Column:
    """Whether a vector can be compared at all."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & ~bad & F.exists(embedding, lambda x: x != 0)


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors, 8-bit steps (as floats), step sizes, norms of the quantised vectors and
    of what they lack."""
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    unit = vectors / largest  # first, so that squares neither overflow nor vanish
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    step = np.abs(unit).max(axis=1, keepdims=True) / 127.0
    steps = np.rint(unit / step)
    near = steps * step
    norm, lost = (np.sqrt((x * x).sum(axis=1)) for x in (near, unit - near))
    return unit, steps.astype(np.int8), step[:, 0], norm, lost


class Links:
    """Numbers of links per row, and the links that join components, of one pair of tiles."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights, self.found = weights, np.zeros(len(weights), np.int64)
        self.parent, self.spanning = list(range(len(weights))), []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(self.found, a, self.weights[b])
        np.add.at(self.found, b, self.weights[a])
        names = np.array([self.root(i) for i in range(len(self.parent))])
        apart = names[a] != names[b]
        for x, y in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            r, s = self.root(x), self.root(y)
            if r != s:
                self.parent[max(r, s)] = min(r, s)
                self.spanning.append((x, y))


def tile_links(vectors: np.ndarray, weights: np.ndarray, sides: np.ndarray, both: bool, threshold: float) -> Links:
    """Links among rows of one tile, or (``both``) between rows of two."""
    unit, steps, step, norm, lost = quantised(vectors)
    links = Links(weights)
    exact = steps.astype(np.float32 if steps.shape[1] * 127 * 127 < 1 << 24 else np.float64)
    left, right = (np.flatnonzero(sides == s) for s in (0, 1)) if both else (np.arange(len(unit)),) * 2
    for at in range(0, len(left), ROWS_AT_ONCE):
        rows = left[at : at + ROWS_AT_ONCE]
        others = right if both else right[at:]
        about = (exact[rows] @ exact[others].T) * np.outer(step[rows], step[others])
        bound = np.outer(norm[rows], lost[others]) + np.outer(lost[rows], norm[others]) + np.outer(lost[rows], lost[others])
        a, b = np.nonzero(about + bound >= threshold - ROUNDING)
        sure = about[a, b] - bound[a, b] >= threshold + ROUNDING
        a, b = rows[a], others[b]
        later = np.ones(len(a), bool) if both else a < b
        a, b, sure = a[later], b[later], sure[later]
        links.add(a[sure], b[sure])
        a, b = a[~sure], b[~sure]
        for part in range(0, len(a), 1 << 16):
            x, y = a[part : part + (1 << 16)], b[part : part + (1 << 16)]
            real = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
            links.add(x[real], y[real])
    return links


def _tile_task(threshold: float):
    def compare(table: pa.Table) -> pa.Table:
        vectors = np.array(table.column("embedding").to_pylist(), np.float64)
        names = table.column("class").to_numpy()
        side, own = table.column("side").to_numpy(), table.column("one").to_numpy()
        both = own[0] != table.column("other").to_numpy()[0]
        links = tile_links(vectors, table.column("copies").to_numpy(), (side != own).astype(int), both, threshold)
        linked = np.flatnonzero(links.found)
        a = [names[linked], links.found[linked], np.full(len(linked), -1)]
        spanning = np.array(links.spanning, np.int64).reshape(-1, 2)
        b = [names[spanning[:, 0]], np.zeros(len(spanning), np.int64), names[spanning[:, 1]]]
        columns = [np.concatenate([x, y]).astype(np.int64) for x, y in zip(a, b, strict=True)]
        joins = pa.array(np.arange(len(columns[0])) < len(linked))
        return pa.table({"class": columns[0], "links": columns[1], "other": pa.array(columns[2]), "counted": joins})

    return compare


def near_duplicates(
    rows: DataFrame,
    threshold: float = THRESHOLD,
    tile: int = TILE,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``rows`` (vec_id, embedding, label)."""
    rows = rows.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.col("label").alias("_label")
    )
    fit = F.coalesce(usable(F.col("embedding")), F.lit(False)) & F.col("_label").isNotNull()
    key = F.when(fit, F.md5(F.concat_ws(",", F.col("embedding").cast("array<string>"))))
    keyed = rows.withColumn("_key", key)
    own = keyed.where("_key IS NOT NULL")
    classes = own.groupBy("_label", "_key").agg(
        F.min("vec_id").alias("class"), F.count(F.lit(1)).alias("copies"), F.any_value("embedding").alias("embedding")
    )
    classes = stored(classes.withColumn("_length", F.size("embedding")), "vector-classes")
    tiles = classes.groupBy("_label", "_length").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("_tiles"))
    dealt = classes.join(stored(tiles, "tiles"), ["_label", "_length"]).withColumn(
        "side", F.pmod(F.xxhash64("class", "_key"), F.col("_tiles")).cast("int")
    )
    paired = dealt.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    paired = paired.select(
        "_label", "_length", F.least("side", "_with").alias("one"), F.greatest("side", "_with").alias("other"),
        "side", "class", "copies", "embedding",
    )
    found = paired.groupBy("_label", "_length", "one", "other").applyInArrow(
        _tile_task(threshold), "class long, links long, other long, counted boolean"
    )
    found = stored(found, "tile-links")
    counts = found.where("counted").groupBy("class").agg(F.sum("links").alias("_links"))
    edges = found.where("NOT counted").select(F.col("class").alias("a"), F.col("other").alias("b"))
    labels = connected_components(edges).withColumnRenamed("node", "class")
    named = classes.select("_label", "_key", "class", "copies").join(counts, "class", "left").join(labels, "class", "left")
    named = named.select(
        "_label", "_key",
        (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "class").alias("component_id"),
    )
    named = stored(named, "class-links")
    linked = own.select("vec_id", "_label", "_key").join(named, ["_label", "_key"]).select("vec_id", "n_links", "component_id")
    alone = keyed.where("_key IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.unionByName(alone)
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))


OP8_SQL = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.low, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(l.low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id LEFT JOIN least l ON l.a = e.vec_id
"""
