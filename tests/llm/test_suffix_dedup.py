"""Removal of repeats against a count of all windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
import llm.suffix_dedup as dedup
from llm.suffix_dedup import equal_ranks, merged_spans, removal_report, remove_repeats, sliding_min


def by_all_windows(rows, window):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + window] for _, b in texts for i in range(len(b) - window + 1))
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed):
    r = random.Random(seed)

    def prose(n):
        return "".join(r.choice("abcdé \n") for _ in range(n))

    passage, line = prose(90), prose(12) * 9
    texts = [prose(r.randrange(200)) for _ in range(30)]
    texts += [prose(r.randrange(60)) + passage[: r.randrange(30, 90)] + prose(20) for _ in range(12)]
    texts += [prose(10) + line + prose(10) + line[:50], "a" * 300, "b" * 41, "b" * 40, "", None, prose(39)]
    texts += texts[:4]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed, dictionary", [(1, 16 << 20), (2, 200)])
def test_equals_all_windows(spark, monkeypatch, seed, dictionary):
    monkeypatch.setattr(dedup, "DICTIONARY_BYTES", dictionary)
    monkeypatch.setattr(dedup, "SORTED_BYTES", 500)
    rows = corpus(seed)
    got = removal_report(spark.createDataFrame(rows, "doc_id long, text string"), window=40, gram=12)
    found = got.collect()
    assert sorted(tuple(r)[:5] for r in found) == by_all_windows(rows, 40)
    left = {(r.doc_id, r.text) for r in found}
    assert left == {(r.doc_id, r.text) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 40, 12).collect()}


def test_sliding_minimum():
    values = np.random.default_rng(1).integers(0, 1 << 60, 500).astype(np.uint64)
    for width in (1, 2, 7, 499, 500):
        assert sliding_min(values, width).tolist() == [values[i : i + width].min() for i in range(501 - width)]
    assert not len(sliding_min(values, 501))


@pytest.mark.parametrize("window", [1, 3, 8, 9, 40])
def test_ranks_follow_the_strings(window):
    data = np.random.default_rng(2).integers(97, 99, 300).astype(np.uint8)
    ranks = equal_ranks(data, window)
    strings = [bytes(data[i : i + window]) for i in range(len(data) - window + 1)]
    assert len(ranks) == len(strings)
    assert [sorted(set(strings)).index(s) for s in strings] == ranks.tolist()


def test_spans_that_touch_are_one():
    packed = np.array([(s << 32) | e for s, e in ((5, 9), (0, 3), (9, 12), (1, 2), (20, 21))])
    assert merged_spans(packed) == [(0, 3), (5, 12), (20, 21)]


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = removal_report(odd_documents).collect()
    long_size = len(rows[7][1])
    removed = {(r.doc_id, r.n_removed) for r in got}
    assert len(got) == 12 and {(7, long_size), (8, long_size), (1, 0), (4, 0), (5, 0)} <= removed
    stripped = remove_repeats(odd_documents)
    assert stripped.schema == odd_documents.schema
    texts = {r.doc_id: r.text for r in stripped.collect()}
    assert texts[7] == texts[8] == "" and texts[4] is None and texts[10] == rows[10][1]
    assert {r.spans for r in stripped.collect()} == {"s"}
    assert removal_report(no_documents).count() == 0 and remove_repeats(no_documents).count() == 0


def test_repeated_rows_lose_what_they_share(spark):
    df = spark.createDataFrame([(1, "z" * 10 + "x" * 50)] * 2, "doc_id long, text string")
    got = removal_report(df, window=40, gram=12).collect()
    assert [(r.n_removed, r.n_spans) for r in got] == [(60, 1), (60, 1)]


def test_many_repeated_rows_end(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(900)) + "z" * 900
    df = spark.createDataFrame([(1, text)] * 5000 + [(2, "other " * 100)], "doc_id long, text string").repartition(4)
    got = removal_report(df).groupBy("doc_id", "n_removed").count().collect()
    assert sorted(tuple(r) for r in got) == [(1, 1800, 5000), (2, 600, 1)]


def test_a_cut_never_splits_a_character(spark):
    shared = "é" * 30
    df = spark.createDataFrame([(1, "ab" + shared + "c"), (2, "q" + shared + "日")], "doc_id long, text string")
    for r in remove_repeats(df, window=41, gram=12).collect():
        assert "�" not in r.text


def by_all_passages(rows, words):
    texts = {i: [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for i, (_, t) in enumerate(rows)}
    raw = [(t or "").encode() for _, t in rows]

    def passages(i):
        names = [raw[i][a:b] for a, b in texts[i]]
        return [tuple(names[j : j + words]) for j in range(len(names) - words + 1)]

    seen = Counter(x for i in texts for x in passages(i))
    out = []
    for i, (d, t) in enumerate(rows):
        gone = bytearray(len(raw[i]))
        for j, x in enumerate(passages(i)):
            if seen[x] > 1:
                a, b = texts[i][j][0], texts[i][j + words - 1][1]
                gone[a:b] = b"\1" * (b - a)
        out.append((d, t if t is None else bytes(x for x, g in zip(raw[i], gone, strict=True) if not g).decode()))
    return sorted(out)


@pytest.mark.parametrize("seed, dictionary", [(3, 16 << 20), (4, 200)])
def test_short_passages_of_many_words_go(spark, monkeypatch, seed, dictionary):
    monkeypatch.setattr(dedup, "DICTIONARY_BYTES", dictionary)
    monkeypatch.setattr(dedup, "SORTED_BYTES", 500)
    r = random.Random(seed)

    def prose(n):
        return "".join(r.choice(["a", "bé", "c", "the", "日", "dd"]) + r.choice([" ", "\n", "  "]) for _ in range(n))

    passage = prose(40)
    texts = [prose(r.randrange(60)) for _ in range(25)]
    texts += [prose(r.randrange(20)) + " ".join(passage.split()[: r.randrange(9, 40)]) + " " + prose(9) for _ in range(12)]
    texts += [prose(4) + passage + prose(3), "x " * 60, "y " * 11, "z " * 10, "", None, " \n", prose(10)]
    texts += texts[:2]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_repeats(df, window=100_000, passage=10).collect()
    assert sorted(tuple(x) for x in got) == by_all_passages(rows, 10)


def test_the_pipeline_cuts_passages_below_400_bytes(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"one before {passage} one behind"), (2, f"two {passage.replace(' ', chr(10))}"), (3, "w0 w1 w2 alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(passage) < 400
    got = dict(corpus_pipeline.repeats_stage(spark, df, "").collect())
    assert got == {1: "one before  one behind", 2: "two ", 3: "w0 w1 w2 alone"}
