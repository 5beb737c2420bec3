"""The prefix-tree join against all pairs."""

import random
import re

import numpy as np
import pytest

import llm.ngram_join as join
from llm import common
from llm.ngram_join import joined_links, keep_one, near_duplicates, prefix_length

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def linked(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def by_all_pairs(rows):
    """Per row: id, size, smallest id reachable."""
    sets = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i][1], sets[j][1]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(s), least[root(i)]) for i, (d, s) in enumerate(sets))


def corpus(seed):
    """Families with few and many edits, a shared passage, copies, short and empty texts."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = r.choices(words, k=30)
    texts = []
    for _ in range(25):
        base = r.choices(words, k=r.choice([6, 20, 60, 150]))
        texts.append(base)
        for _ in range(r.choice([0, 1, 3, 8])):
            other = list(base)
            for _ in range(r.choice([1, 1, 2, 3])):
                other[r.randrange(len(other))] = r.choice(words)
            texts.append(other if r.random() < 0.6 else other + passage)
    rows = [" ".join(t) for t in texts] + ["", "  ", "one", "ONE", "one two three", "a b c d e", "a b c d e"]
    r.shuffle(rows)
    return list(enumerate(rows)) + [(5000, None)]


@pytest.mark.parametrize("seed, group_bytes", [(1, 4 << 20), (2, 400)])
def test_equals_all_pairs(spark, monkeypatch, seed, group_bytes):
    monkeypatch.setattr(join, "GROUP_BYTES", group_bytes)
    rows = corpus(seed)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == by_all_pairs(rows)


@pytest.mark.parametrize("seed", range(4))
def test_the_walk_joins_exactly_the_components(seed):
    r = np.random.default_rng(seed)
    sets = []
    for _ in range(12):
        base = r.choice(300, size=int(r.integers(1, 40)), replace=False)
        for _ in range(5):
            keep = base[r.random(len(base)) < 0.93]
            extra = r.choice(np.arange(300, 320), size=int(r.integers(0, 3)), replace=False)
            sets.append(np.unique(np.append(keep, extra)).astype(np.uint64))
    sets = [s for s in sets if len(s)]
    parent = list(range(len(sets)))

    def root(parent, i):
        while parent[i] != i:
            i = parent[i]
        return i

    both = [set(s.tolist()) for s in sets]
    for i in range(len(sets)):
        for j in range(i):
            if linked(both[i], both[j]):
                parent[root(parent, i)] = root(parent, j)
    found = list(range(len(sets)))
    for i, j in joined_links(sets, [len(s) for s in sets], list(range(len(sets)))):
        assert linked(both[i], both[j])
        found[root(found, i)] = root(found, j)
    groups = [{frozenset(i for i in range(len(sets)) if root(p, i) == k) for k in range(len(sets))} for p in (parent, found)]
    assert groups[0] == groups[1]


def test_linked_sets_share_a_prefix_ngram():
    for n in range(1, 200):
        p = prefix_length(n)
        assert n - p == -(-75 * n // 100) - 1  # one less than the overlap any partner needs


def test_odd_documents(spark, odd_documents, no_documents):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(odd_documents).collect()}
    assert {(1, 9, 1), (2, 9, 1), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 29996, 7), (8, 29996, 7), (0, 1, 0)} <= got
    assert near_duplicates(odd_documents).count() == 12
    kept = keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 4, 5, 6, 7, 9, 10]
    assert near_duplicates(no_documents).count() == 0 and keep_one(no_documents).count() == 0


def test_a_large_group_of_near_copies_is_one_component(spark):
    rows = [(i, " ".join(f"x{j}" if j != 7 + i % 40 else f"y{i}" for j in range(120))) for i in range(600)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.select("component_id").distinct().collect() == [(0,)]


def test_documents_that_stay_are_not_shuffled(spark):
    rows = [(i, " ".join(f"w{i // 2 if i < 20 else i}x{j}" for j in range(30)), "may", "at") for i in range(200)]
    df = spark.createDataFrame([*rows, (None, None, None, None)], "doc_id int, text string, _may string, _at string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with too many ids that go
    try:
        kept = keep_one(df)
        assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [*range(0, 20, 2), *range(20, 200)]
        assert kept.count() == 191 and kept.schema == df.schema
        branches = kept._jdf.queryExecution().optimizedPlan().toString().split("Join LeftAnti")
        assert len(branches) == 2 and "Union" in branches[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("most", [1 << 27, 1 << 15])
def test_told_apart_loses_no_row(spark, monkeypatch, most):
    monkeypatch.setattr(common, "FILTER_BITS", most)
    df = spark.range(50_000).selectExpr("CAST(IF(id % 10 = 0, NULL, id) AS INT) AS doc_id", "'k' AS _key")
    keys = spark.range(0, 50_000, 7).selectExpr("id AS doc_id")
    may, others = common.told_apart(df, keys, "doc_id")
    assert may.count() + others.count() == 50_000 and may.columns == others.columns == ["doc_id", "_key"]
    assert others.where("doc_id % 7 = 0").count() == 0 and others.where("doc_id IS NULL").count() == 5_000
    assert may.count() < 10_000 or most == 1 << 15


def test_no_task_searches_and_joins_links_at_once(spark, monkeypatch, capsys):
    """Each such task would hold two Python workers, and an executor keeps all it ever had."""
    plans, whole = [], join.connected_components

    def noted(edges):
        edges.explain()
        plans.append(capsys.readouterr().out)
        return whole(edges)

    monkeypatch.setattr(join, "connected_components", noted)
    near_duplicates(spark.createDataFrame(corpus(1), "doc_id long, text string")).collect()
    assert len(plans) == 3
    assert all("Scan parquet" in plan and "MapInArrow" not in plan for plan in plans)
