"""Runs of periodic repetition in word sequences, by a suffix automaton with link-cut access.

A run is a stretch of words with smallest period q, at least max(12, 2 q) words long, that no
neighbouring word extends. Each text is treated alone, in these steps:

1. *Stretches.* In a run, at least 6 words in a row come again q words later. Word 6-grams that
   do not come again within half of the stretch they lie in cannot be part of a run; what is
   left after removing them, until nothing changes, are the stretches to search. Equal words
   have equal hashes, so no run is lost by this.
2. *Automaton.* The suffix automaton of a stretch; its suffix links form a tree in which the
   path from the root to a prefix has all suffixes of that prefix.
3. *Access.* As in a link-cut tree, each appended word makes its whole path preferred: the path
   takes the colour of that word's place, and falls into segments by the colours it had, the
   places where those suffixes ended last. As the tree no longer changes, preferred paths are
   kept as stacks of segments on heavy paths rather than in splay trees; the segments met are
   the same, O(log n) per word on average.
4. *Squares to runs.* If a segment's longest suffix has length l, and it ended d words before,
   with d <= l, the last l + d words have the period d, which is the smallest, and cannot be
   extended to the left. The last place where this holds for (start, d) is the run's end.

Nulls and texts without words have no runs, and an empty collapsed text. Texts are read whole;
memory and time follow a text's longest stretch (about 300 bytes a word), so one text of
millions of periodic words is the most a task holds. Repeated rows give equal rows. An empty
table gives an empty result. Columns other than the text pass through; ``runs`` and
``collapsed`` replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from llm.common import bounded_batches, by_bytes, mix64, read

LEAST = 12
SLICE_BYTES = 1 << 20
RUNS = "array<struct<start:long,length:long,period:long>>"
SPACES = r"[\x20\x09-\x0D]+"


def suffix_tree_of(ids: list[int]) -> tuple[list[int], list[int], list[int]]:
    """``(links, lengths, prefixes)``: suffix links and longest lengths of the automaton's
    states, and the state of every prefix."""
    moves: list[dict[int, int]] = [{}]
    links, lengths, prefixes, last = [-1], [0], [], 0
    for word in ids:
        state = len(links)
        links.append(0)
        lengths.append(lengths[last] + 1)
        moves.append({})
        at = last
        while at >= 0 and word not in moves[at]:
            moves[at][word] = state
            at = links[at]
        if at >= 0:
            found = moves[at][word]
            if lengths[found] == lengths[at] + 1:
                links[state] = found
            else:
                twin = len(links)
                links.append(links[found])
                lengths.append(lengths[at] + 1)
                moves.append(moves[found].copy())
                links[found] = links[state] = twin
                while at >= 0 and moves[at].get(word) == found:
                    moves[at][word] = twin
                    at = links[at]
        last = state
        prefixes.append(state)
    return links, lengths, prefixes


def heavy_paths(links: list[int], lengths: list[int]) -> tuple[list[int], list[int]]:
    """The top of each state's heavy path, and the state's place on it."""
    parent, size = np.array(links), np.ones(len(links), np.int64)
    downwards = np.argsort(np.array(lengths), kind="stable").tolist()  # links lead to shorter ones
    weight, heavy = size.tolist(), [-1] * len(links)
    up = parent.tolist()
    for state in reversed(downwards[1:]):
        weight[up[state]] += weight[state]
    for state in downwards[1:]:
        best = heavy[up[state]]
        if best < 0 or weight[state] > weight[best]:
            heavy[up[state]] = state
    top, place = [0] * len(links), [0] * len(links)
    for state in downwards[1:]:
        above = up[state]
        if heavy[above] == state:
            top[state], place[state] = top[above], place[above] + 1
        else:
            top[state] = state
    return top, place


def runs_of(ids: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs in a sequence, by start and period."""
    links, lengths, prefixes = suffix_tree_of(ids)
    top, place = heavy_paths(links, lengths)
    paths: list[list[tuple[int, int, int]]] = [[] for _ in links]  # segments, the topmost last
    ends: dict[tuple[int, int], int] = {}
    for now, state in enumerate(prefixes):
        at, before = state, -1
        while at > 0:  # from the longest suffix up; colours only grow on the way
            head = top[at]
            path, upto = paths[head], place[at]
            found, bottom = [], -1
            while path and path[-1][0] <= upto:
                bottom, *segment = path.pop()
                found.append(segment)
            if path and bottom < upto:  # a segment that goes on below
                found.append((path[-1][1], lengths[at]))
            for colour, longest in reversed(found):
                if colour != before:
                    before = colour
                    apart = now - colour
                    if apart <= longest and longest + apart >= least:
                        ends[now - longest - apart + 1, apart] = now
            path.append((upto, now, lengths[at]))
            at = links[head]
    return sorted((start, end - start + 1, period) for (start, period), end in ends.items())


def stretches(names: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Ranges of positions outside of which there is no run; ``names`` are hashes of words."""
    size = (least + 1) // 2
    n = len(names) - size + 1
    if n < size:
        return []
    grams = np.zeros(n, np.uint64)
    for j in range(size):
        grams = (grams + names[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    again = ordered[1:] == ordered[:-1]
    if not again.any():
        return []
    apart = np.where(again, order[1:] - order[:-1], n + size)
    near = np.empty(n, np.int64)
    near[order] = np.minimum(np.append(apart, n + size), np.insert(apart, 0, n + size))
    limit = np.full(n, len(names) // 2)
    kept = -1
    while True:
        good = np.flatnonzero(near <= limit)
        if not len(good):
            return []
        cuts = np.flatnonzero(np.diff(good) > size)  # covered positions touch up to there
        opens, closes = good[np.append(0, cuts + 1)], good[np.append(cuts, len(good) - 1)] + size
        long_enough = closes - opens >= least
        opens, closes = opens[long_enough], closes[long_enough]
        if not len(opens) or len(good) == kept:
            return list(zip(opens.tolist(), closes.tolist(), strict=True))
        kept = len(good)
        limit = np.zeros(n, np.int64)
        for a, b in zip(opens.tolist(), closes.tolist(), strict=True):
            limit[a : b - size + 1] = (b - a) // 2


def word_runs(words: list[bytes], least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of a list of words, by start and period."""
    if len(words) < least:
        return []
    names = mix64(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64))
    out = []
    for low, high in stretches(names, least):
        known: dict[bytes, int] = {}
        ids = [known.setdefault(word, len(known)) for word in words[low:high]]
        out += [(low + start, length, period) for start, length, period in runs_of(ids, least)]
    return out


def collapsed_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run repeats: of each run, the first period stays."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [word for word, times in zip(words, np.cumsum(gone).tolist(), strict=False) if not times]


def with_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with ``runs``, by start and period in word numbers, and ``collapsed``, the
    words that no run repeats, joined by single spaces."""
    bounded_batches(docs.sparkSession)
    plain = docs.drop("runs", "collapsed")
    at = plain.columns.index("text")
    fields = StructType.fromDDL(f"runs {RUNS}, collapsed string").fields
    schema = StructType(list(plain.schema.fields) + fields)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", SLICE_BYTES):
            found, texts = [], []
            for text in batch.column(at).cast(pa.binary()).to_pylist():
                words = (text or b"").split()  # at the six ASCII space characters
                runs = word_runs(words, least)
                found.append([dict(zip(("start", "length", "period"), run, strict=True)) for run in runs])
                texts.append(b" ".join(collapsed_words(words, runs)))
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, kind), pa.array(texts, pa.binary()).cast(pa.string())],
                names=[*batch.schema.names, "runs", "collapsed"],
            )

    return plain.mapInArrow(find, schema)


def made_periodic() -> Column:
    """The text, of a tenth of the ids with the words from a place on repeating the first few
    of them: the query's input."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(crc / 10)
    words = F.filter(F.split(F.col("text"), SPACES, -1), lambda w: w != "")
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    period = (F.floor((n - a) / (3 + g % 8)) + 1).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, period), F.ceil((n - a) / period).cast("int")))
    periodic = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")
    return F.when((crc % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), periodic).otherwise(F.col("text"))


def run_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its longest run (the first of them), and
    digests of all runs and of the collapsed text."""
    found = with_runs(docs)
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    lines = F.array_join(
        F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), ""
    )
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("_b"), lines.alias("_lines"), "collapsed")
    return found.select(
        "doc_id",
        "n_runs",
        (-F.col("_b.s")).alias("start"),
        F.col("_b.l").alias("length"),
        (-F.col("_b.p")).alias("period"),
        F.expr("(1000 * _b.l) div -_b.p").alias("exponent_milli"),
        F.sha2(F.col("_lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return run_report(docs.select("doc_id", made_periodic().alias("text")))
