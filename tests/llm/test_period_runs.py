"""Runs against their definition, word by word."""

import hashlib
import random
import re
import zlib

import pytest

from llm.period_runs import collapsed_words, op12_period_runs, run_report, runs_of, with_runs, word_runs


def by_definition(words, least=12):
    """Every maximal stretch of every period, with the smallest period of each stretch."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, 2 * q):
                found.setdefault((i, length), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def sequences(seed):
    r = random.Random(seed)
    out = []
    for _ in range(250):
        letters = r.choice([1, 2, 2, 3, 5, 30])
        base = [r.randrange(letters) for _ in range(r.randrange(60))]
        for _ in range(r.randrange(4)):
            p, k = r.randrange(1, 9), r.randrange(2, 6)
            unit = [r.randrange(letters) for _ in range(p)]
            at = r.randrange(len(base) + 1)
            base[at:at] = (unit * k)[: p * k - r.randrange(p)]
        out.append(base)
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_of_sequences(seed, least):
    for ids in sequences(seed):
        want = by_definition(ids, least)
        assert runs_of(ids, least) == want
        words = [f"w{x}".encode() for x in ids]
        assert word_runs(words, least) == want


def test_thue_morse_and_fibonacci_words():
    morse = [bin(i).count("1") % 2 for i in range(256)]
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    for ids in (morse, b):
        for least in (2, 12):
            assert runs_of(ids, least) == by_definition(ids, least) == word_runs([b"%d" % x for x in ids], least)


def test_long_stretches_end_in_time():
    words = [b"%d" % (i % 997) for i in range(40_000)]
    assert word_runs(words) == [(0, 40_000, 997)]
    assert word_runs([b"a"] * 30_000) == [(0, 30_000, 1)]
    assert word_runs([b"%d" % i for i in range(40_000)]) == []


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = by_definition(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def documents(seed):
    r = random.Random(seed)
    rows = []
    for i in range(300):
        words = [r.choice("a b c é 日本 \U0001f642".split()) + str(r.randrange(r.choice([1, 3, 50]))) for _ in range(r.randrange(50))]
        rows.append((i, r.choice(["", " ", "\n"]) + r.choice([" ", "\t", "\x0b\x0c"]).join(words)))
    return rows + [(7, None), (None, "a " * 20), (8, ""), (9, " \n"), (10, "x y " * 9 + "z"), (10, "x y " * 9 + "z")]


def test_query_columns_by_definition(spark, tmp_path):
    rows = documents(5)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op12_period_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((expected(*row) for row in rows), key=str)


def test_odd_documents(spark, odd_documents, no_documents):
    clashing = odd_documents.withColumnRenamed("spans", "runs").withColumnRenamed("row_key", "collapsed")
    got = with_runs(clashing)
    assert got.columns == [c for c in clashing.columns if c not in ("runs", "collapsed")] + ["runs", "collapsed"]
    rows = {r.doc_id: r for r in got.collect()}
    assert got.count() == 12 and rows[7].runs == [] and rows[4].collapsed == "" and rows[6].collapsed == ""
    assert with_runs(no_documents).count() == 0 and run_report(no_documents).count() == 0


def test_collapsed_words():
    words = b"a b c a b c a b c a b c d".split()
    assert collapsed_words(words, word_runs(words)) == b"a b c d".split()
