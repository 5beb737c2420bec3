"""Shards: sizes, slots, checksums and how many copies stay together."""

import zlib

from llm.sharding import shard_documents


def facts(rows):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
    return by_shard


def test_equal_sizes_and_whole_groups(spark):
    rows = [(i, f"text {i % 700} " + "x" * (i % 700 % 50)) for i in range(2000)]
    got = shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    texts = dict(rows)
    assert sorted(r.doc_id for r in got) == list(range(2000))
    assert all(r.size == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got)
    shards = facts(got)
    sizes = [sum(r["size"] for r in s) for s in shards.values()]
    assert len(shards) == 8 and max(sizes) - min(sizes) <= 2 * 70
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards.values())
    where = {}
    for r in got:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert sum(len(s) > 1 for s in where.values()) < 0.1 * len(where)
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}


def test_a_group_larger_than_a_shard_is_spread(spark):
    rows = [(i, "the same long text" if i < 900 else f"other {i}") for i in range(1500)]
    got = shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    sizes = [sum(r["size"] for r in s) for s in facts(got).values()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 40


def test_odd_documents(odd_documents, no_documents):
    got = shard_documents(odd_documents).collect()
    assert len(got) == 12 and all(0 <= r.shard < 16 for r in got)
    assert {(r["size"], r.text_crc32) for r in got if r.doc_id in (4, 5)} == {(1, 0)}
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in facts(got).values())
    assert shard_documents(no_documents).count() == 0
