"""Links between vectors against all pairs in double precision."""

import numpy as np
import pytest

from llm.embedding_dedup import OP8_SQL, near_duplicates, op8_embedding_dedup, quantised
from checks.compare import difference, duckdb_over

SCHEMA = "vec_id long, embedding array<float>, label int, class string, copies string"


def directly(rows, threshold):
    good = [(i, np.array(v, np.float64), k) for i, v, k in rows
            if k is not None and v and not any(x is None or not np.isfinite(x) for x in v) and any(v)]
    parent = {n: n for n in range(len(rows))}
    at = [n for n, (_, v, k) in enumerate(rows) if k is not None and v and not any(x is None or not np.isfinite(x) for x in v) and any(v)]
    links = [0] * len(rows)

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for x, (_, a, k) in enumerate(good):
        for y in range(x):
            _, b, q = good[y]
            if k == q and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                links[at[x]] += 1
                links[at[y]] += 1
                parent[root(at[x])] = root(at[y])
    least = {}
    for n, (i, _, _) in enumerate(rows):
        least[root(n)] = min(least.get(root(n), i), i)
    return sorted((i, links[n], least[root(n)], i == least[root(n)]) for n, (i, _, _) in enumerate(rows))


def vectors(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, None):
        for _ in range(12):
            base = rng.normal(size=24)
            for _ in range(rng.integers(1, 7)):
                rows.append((base + rng.normal(size=24) * rng.choice([0, 0.02, 0.1, 0.2, 0.3]), label))
    out = [(n, [float(np.float32(x)) for x in v], k) for n, (v, k) in enumerate(rows)]
    out += [(900, None, 0), (901, [], 0), (902, [0.0] * 24, 0), (903, [float("nan")] + [1.0] * 23, 0),
            (904, [None] + [1.0] * 23, 0), (905, [float("inf")] + [1.0] * 23, 1), (906, [1.0, 2.0], 0),
            (907, [2.0, 4.0], 0), (908, [1e-30, 2e-30], 0)]
    return out


@pytest.mark.parametrize("seed, tile", [(1, 4096), (2, 7)])
def test_equals_all_pairs(spark, seed, tile):
    rows = vectors(seed)
    df = spark.createDataFrame([(*r, "c", "n") for r in rows], SCHEMA)
    got = sorted(tuple(r) for r in near_duplicates(df, 0.98, tile).collect())
    assert got == directly(rows, 0.98)
    assert any(r[1] > 1 for r in got)


def test_equals_its_sql(spark):
    got = op8_embedding_dedup(spark, "/root/testdata/sf0.01").toPandas()
    assert difference(got, duckdb_over("/root/testdata/sf0.01").execute(OP8_SQL).df()) is None


def test_error_bounds_hold():
    rng = np.random.default_rng(3)
    unit, steps, step, norm, lost = quantised(rng.normal(size=(200, 32)) * rng.lognormal(size=(200, 1), sigma=20))
    near = steps * step[:, None]
    bound = np.outer(norm, lost) + np.outer(lost, norm) + np.outer(lost, lost)
    assert (np.abs(near @ near.T - unit @ unit.T) <= bound + 1e-12).all()
    assert steps.dtype == np.int8 and bound.max() < 0.1


def test_copies_count_without_being_paired(spark):
    rows = [(n, [1.0, 0.0, 2.0], 3, "c", "n") for n in range(3000)] + [(5000, [1.0, 0.01, 2.0], 3, "c", "n")]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).groupBy("n_links", "component_id").count().collect()
    assert sorted(tuple(r) for r in got) == [(3000, 0, 3001)]


def test_no_vectors(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
