"""Collocations: phrases of two and three words that occur together more than by chance.

Counting follows the levels of phrase lengths, and everything is per language.

1. *Words.* Tasks count the words of their texts and Spark adds the counts. A word and its
   language together are one 64-bit symbol from here on.
2. *Bounds.* Tasks hash their pairs to 40 bits and count the hashes, saturated; ranges of hashes
   add the counts of all tasks. A pair whose hash counts less than ``LEAST`` is rare, and so are
   pairs with a rare word: neither is a candidate. The same again for triples whose two pairs
   may be frequent. What passes from level to level is a Bloom filter of at most
   ``FILTER_BITS`` bits: where it errs, there are more candidates, never fewer.
3. *Candidates.* One more pass names the phrases that may be frequent, with what follows each
   pair: these are Apriori-safe. A task's equal ones are one with their number. They are dealt
   by their first two words to ranges of hashes, and the phrases of a range become double-array
   tries of at most ``SHARD_PHRASES`` (those of one pair stay together).
4. *Counting.* All positions of a range advance through its tries at once, level by level, and
   the accepting states are counted with ``bincount``, each as often as its position stands for:
   these counts are exact, whatever the bounds said. A position meets one trie, and the texts
   are not read again, however many candidates there are.

Scores are exact decimals. Null texts have no words; null languages are ``und``. Texts are read
whole, in slices of texts. Repeated rows count as often as they occur. An empty table gives an
empty result. Only text and language are read, whatever else there is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import RollingHash, bounded_batches, by_bytes, mix64, read, stored, task_count, text_buffer

LEAST = 10
INSIDE = 50
TOP = 2000
UNKNOWN = "und"
SLICE_BYTES = 2 << 20
BLOCK = 1 << 21
HASH_BITS = 40
RANGES_PER_TASK = 4
FILTER_BITS, BITS_PER_KEY, PROBES = 1 << 27, 24, 4
FILTER_BLOCK = 1 << 13  # words
SHARD_PHRASES = 1 << 18
_K = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ENDS = np.zeros(256, bool)  # of pieces
_ENDS[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
_GAPS = _ENDS.copy()  # of words
_GAPS[list(b" \t")] = True


@dataclass
class Words:
    """The words of several texts: symbols, whether the next word follows in the same piece,
    and where they are in ``raw``."""

    symbols: np.ndarray
    follows: np.ndarray
    raw: np.ndarray
    opens: np.ndarray
    closes: np.ndarray
    owner: np.ndarray


def words_of(hashes: RollingHash, raw: np.ndarray, starts: np.ndarray, salts: np.ndarray) -> Words:
    """Words of texts; ``salts`` are the hashes of their languages."""
    raw = _LOWER[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[starts] = True
    word = np.append(~_GAPS[raw], False)
    before = np.append(False, word[:-1])
    opens = np.flatnonzero(word & (~before | first))
    closes = np.flatnonzero(before & (~word | first))
    owner = np.searchsorted(starts, opens, side="right") - 1
    names = mix64(hashes.spans(hashes.sums(raw), opens, closes) + (closes - opens).astype(np.uint64))
    symbols = mix64(names + salts[owner])
    piece = np.cumsum(_ENDS[raw])[opens] if len(opens) else opens
    follows = np.zeros(len(opens), bool)
    follows[:-1] = (piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1])
    return Words(symbols, follows, raw, opens, closes, owner)


def _salts(langs: list[str]) -> np.ndarray:
    known: dict[str, int] = {}
    for lang in langs:
        if lang not in known:
            known[lang] = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
    return np.array([known[lang] for lang in langs], np.uint64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    hashes = RollingHash()
    for batch in by_bytes(batches, "text", SLICE_BYTES):
        langs = batch.column("lang").to_pylist()
        yield words_of(hashes, *text_buffer(batch.column("text")), _salts(langs)), langs


def _spelled(raw: np.ndarray, opens: np.ndarray, closes: np.ndarray) -> pa.Array:
    """The bytes of ``raw`` from each of ``opens`` to its one of ``closes``."""
    ends = np.cumsum(closes - opens)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(closes - ends, closes - opens)
    offsets = np.append(0, ends).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(opens), [None, pa.py_buffer(offsets), pa.py_buffer(raw[at])])


def _planes(n: np.ndarray) -> bytes:
    """Whole numbers: all first bytes, then all second ones, since the last are mostly zeros."""
    return n.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def _of_planes(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _merged(parts: list[tuple]) -> tuple:
    """Parts of keys, numbers and further arrays as one, with equal keys once: their numbers
    are added, the others are those of one of them."""
    if len(parts) == 1:
        return parts[0]
    keys, first, of = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
    n = np.zeros(len(keys), np.int64)
    np.add.at(n, of, np.concatenate([p[1] for p in parts]))
    rest = []
    for column in list(zip(*parts, strict=True))[2:]:
        rest.append(pa.concat_arrays(column).take(pa.array(first)) if isinstance(column[0], pa.Array) else np.concatenate(column)[first])
    return keys, n, *rest


def word_counts(docs: DataFrame) -> DataFrame:
    """``symbol, lang, word, n`` of all words of ``docs`` (text, lang). Tasks pack theirs by
    language and ranges of symbols, as they do for ``likely``, and each range adds them up."""
    buckets = RANGES_PER_TASK * task_count(docs.sparkSession)

    def emit(symbols: np.ndarray, n: np.ndarray, code: np.ndarray, words: pa.Array, langs: list[str]) -> Iterator[pa.RecordBatch]:
        bucket = (symbols >> np.uint64(32)).astype(np.int64) * buckets >> 32
        order = np.lexsort((code, bucket))
        bucket, symbols, n, code, words = bucket[order], symbols[order], n[order], code[order], words.take(pa.array(order))
        ends = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1).astype(np.int64)
        raw = memoryview(words.buffers()[2])
        opens = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (code[1:] != code[:-1])))
        rows = []
        for a, b in zip(opens.tolist(), [*opens[1:].tolist(), len(bucket)], strict=True):
            packed = (symbols[a:b].tobytes(), _planes(n[a:b]), _planes(np.diff(ends[a : b + 1])), bytes(raw[ends[a] : ends[b]]))
            rows.append((int(bucket[a]), langs[code[a]], *packed))
        kinds = (pa.int32(), pa.string(), *[pa.binary()] * 4)
        columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "lang", "symbols", "n", "sizes", "words"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[str, int] = {}
        held, size = [], 0
        for words, langs in _slices(batches):
            symbols, at, n = np.unique(words.symbols, return_index=True, return_counts=True)
            code = np.array([codes.setdefault(x, len(codes)) for x in langs], np.int64)[words.owner[at]]
            held.append((symbols, n, code, _spelled(words.raw, words.opens[at], words.closes[at])))
            size += len(symbols)
            if size >= BLOCK // 2:
                held = [_merged(held)]
                size = len(held[0][0])
            if size >= BLOCK // 4 and len(held) == 1:
                yield from emit(*held[0], list(codes))
                held, size = [], 0
        if size:
            yield from emit(*_merged(held), list(codes))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def total(lang: str, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            symbols, n, words = _merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(symbols.view(np.int64)), pa.array([lang] * len(symbols), pa.string()), words.cast(pa.string()), pa.array(n)],
                names=["symbol", "lang", "word", "n"],
            )

        key, parts = None, []
        for batch in batches:
            for at, lang, symbols, n, sizes, words in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if (at, lang) != key and parts:
                    yield from total(key[1], parts)
                    parts = []
                key, closes = (at, lang), np.cumsum(_of_planes(sizes))
                spelled = _spelled(np.frombuffer(words, np.uint8), closes - _of_planes(sizes), closes)
                parts.append((np.frombuffer(symbols, np.uint64), _of_planes(n), spelled))
        if parts:
            yield from total(key[1], parts)

    found = docs.mapInArrow(count, "bucket int, lang string, symbols binary, n binary, sizes binary, words binary")
    found = found.repartition("bucket").sortWithinPartitions("bucket", "lang")
    return found.mapInArrow(add, "symbol long, lang string, word string, n long")


class Bloom:
    """A set of 64-bit values that may hold more than was put in, in bits of a fixed number."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    def holds(self, values: np.ndarray) -> np.ndarray:
        at = np.arange(len(values))
        for j in range(1, PROBES + 1):  # most of what is not there leaves at once
            word, bit = _probe(values[at], len(self.words) * 64, j)
            at = at[(self.words[word] >> bit) & np.uint64(1) == 1]
        out = np.zeros(len(values), bool)
        out[at] = True
        return out


def _probe(values: np.ndarray, bits: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    at = mix64(values * _K + np.uint64(j)) & np.uint64(bits - 1)
    return (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)


def _probes(values: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    return (_probe(values, bits, j) for j in range(1, PROBES + 1))


def bloom(values: DataFrame) -> Bloom:
    """The filter of ``values`` (value long). What reaches the driver are its words at most."""
    bits = 1 << 12
    keys = values.count()
    while bits < min(keys * BITS_PER_KEY, FILTER_BITS):
        bits <<= 1

    block = min(bits // 64, FILTER_BLOCK)

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            for word, bit in _probes(batch.column(0).to_numpy().view(np.uint64), bits):
                np.bitwise_or.at(own, word, np.uint64(1) << bit)
        for at in np.flatnonzero(own.reshape(-1, block).any(axis=1)).tolist():
            part = own[at * block : (at + 1) * block].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([part], pa.binary())], names=["block", "words"])

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own[at] = own.get(at, np.uint64(0)) | np.frombuffer(words, np.uint64)
        for at, words in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([words.tobytes()], pa.binary())], names=["block", "words"])

    parts = values.mapInArrow(set_bits, "block int, words binary").repartition("block")
    words = np.zeros((bits // 64 // block, block), np.uint64)
    for row in parts.mapInArrow(united, "block int, words binary").collect():
        words[row.block] = np.frombuffer(row.words, np.uint64)
    return Bloom(words.ravel())


def _hashed(values: np.ndarray) -> np.ndarray:
    return values >> np.uint64(64 - HASH_BITS)


def _levels(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the pair and the triple at every position, and the number of words, up to
    three, that the piece has from there on."""
    n, s = len(words.symbols), words.symbols
    pairs, triples, room = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.ones(n, np.int8)
    pairs[:-1] = mix64(s[:-1] * _K + s[1:])
    triples[:-2] = mix64(pairs[:-2] * _K + s[2:])
    room += words.follows
    room[:-1] += words.follows[:-1] & words.follows[1:]
    return pairs, triples, room


def _may_be(words: Words, frequent: Bloom, pairs_too: Bloom | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``pairs, triples, level``: hashes, and up to which length the phrase at a position may
    be frequent by what is known of shorter ones."""
    pairs, triples, room = _levels(words)
    single = frequent.holds(words.symbols)
    level = single.astype(np.int8)
    two = single & (room >= 2)
    two[:-1] &= single[1:]
    if pairs_too is None:
        level[two] = 2
        return pairs, triples, level
    at = np.flatnonzero(two)
    two[at] = pairs_too.holds(_hashed(pairs[at]))
    level[two] = 2
    three = two & (room >= 3)
    three[:-1] &= two[1:]
    level[three] = 3
    return pairs, triples, level


def _packed(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    planes = np.diff(hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)[:, : HASH_BITS // 8].T
    return planes.tobytes() + counts.tobytes()


def _unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    wide = HASH_BITS // 8
    n = len(payload) // (wide + 1)
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :wide] = np.frombuffer(payload, np.uint8, wide * n).reshape(wide, n).T
    return np.cumsum(planes.view(np.uint64).ravel(), dtype=np.uint64), np.frombuffer(payload, np.uint8, n, wide * n)


def likely(docs: DataFrame, frequent: Bloom, pairs: Bloom | None = None) -> DataFrame:
    """``value``: hashes that at least ``LEAST`` pairs have (with ``pairs``: triples)."""
    context = docs.sparkSession.sparkContext
    known = context.broadcast((frequent.words, None if pairs is None else pairs.words))
    buckets = RANGES_PER_TASK * task_count(docs.sparkSession)

    def emit(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes, n = np.unique(_hashed(np.concatenate(parts)), return_counts=True)
        n = np.minimum(n, LEAST).astype(np.uint8)
        edges = np.array([(i << HASH_BITS) // buckets for i in range(1, buckets)], np.uint64)
        cuts = [0, *np.searchsorted(hashes, edges).tolist(), len(hashes)]
        rows = [(i, _packed(hashes[a:b], n[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
        bucket, payload = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(payload, pa.binary())], names=["bucket", "payload"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = (None if w is None else Bloom(w) for w in known.value)
        held, parts = 0, []
        for words, _ in _slices(batches):
            of_pairs, of_triples, level = _may_be(words, one, two)
            parts.append(of_pairs[level >= 2] if two is None else of_triples[level >= 3])
            held += len(parts[-1])
            if held >= BLOCK:
                yield from emit(parts)
                held, parts = 0, []
        if held:
            yield from emit(parts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def total(rows: list[bytes]) -> Iterator[pa.RecordBatch]:
            parts = [_unpacked(x) for x in rows]
            hashes, n = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            order = np.argsort(hashes, kind="stable")
            hashes, n = hashes[order], n[order].astype(np.int64)
            opens = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            often = hashes[opens][np.add.reduceat(n, opens) >= LEAST]
            yield pa.RecordBatch.from_arrays([pa.array(often.view(np.int64))], names=["value"])

        bucket, rows = None, []
        for batch in batches:
            for name, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != bucket and rows:
                    yield from total(rows)
                    rows = []
                bucket = name
                rows.append(payload)
        if rows:
            yield from total(rows)

    found = docs.mapInArrow(count, "bucket int, payload binary").repartition("bucket").sortWithinPartitions("bucket")
    return stored(found.mapInArrow(add, "value long"), "likely-phrases")


def double_array(phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(alphabet, base, check, accept)`` of phrases of 2 or 3 symbols, one a row.

    A symbol is its number in the alphabet, spelled by two digits, so that no state has more
    than about the root of the alphabet's size below it. State 0 is the root. From state s,
    digit c leads to t = base[s] + c if check[t] == s. ``accept`` has a phrase's row number at
    its state, else -1."""
    alphabet = np.unique(np.concatenate([phrases[:, :2].ravel(), phrases[sizes == 3, 2]]))
    bits = _digit_bits(alphabet)
    labels = np.searchsorted(alphabet, phrases)
    digits = np.stack([labels >> bits, labels & ((1 << bits) - 1)], axis=2).reshape(len(phrases), -1)
    room = 4 * (digits.size + (1 << bits)) + 64
    base, check, accept = (np.full(room, x, np.int64) for x in (0, -1, -1))
    check[0] = -2

    def place(parents: np.ndarray, children: np.ndarray, owners: np.ndarray) -> np.ndarray:
        """States of children (digits) of ``owners`` (numbers of parents), sorted by owner.

        Nodes with most children come first. Each class of nodes looks on from where the last
        one of its class fitted: places without room for one have none for the next."""
        nonlocal base, check, accept
        states = np.empty(len(children), np.int64)
        opens = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
        counts = np.diff(np.append(opens, len(owners)))
        starts: dict[int, int] = {}
        for i in np.argsort(-counts, kind="stable").tolist():
            size = int(counts[i])
            if size == 1:
                break
            own = children[opens[i] : opens[i] + size]
            kind, step = size.bit_length(), 64
            start = starts.get(kind, 1)
            while True:
                spots = (start + np.arange(step))[:, None] + own[None, :]
                while int(spots[-1, -1]) >= len(check):
                    base, check, accept = (np.append(x, np.full(len(x), y, np.int64)) for x, y in ((base, 0), (check, -1), (accept, -1)))
                good = np.flatnonzero((check[spots] == -1).all(axis=1))
                if len(good):
                    break
                start += step
            starts[kind] = start
            states[opens[i] : opens[i] + size] = spots[good[0]]
            check[spots[good[0]]] = parents[owners[opens[i]]]
            base[parents[owners[opens[i]]]] = start + good[0]
        alone = opens[counts == 1]
        free = np.flatnonzero(check == -1)
        free = free[free > children[alone].max(initial=0)]  # bases stay positive
        if len(free) < len(alone):
            more = len(alone)
            free = np.append(free, len(check) + np.arange(more))
            base, check, accept = (np.append(x, np.full(more, y, np.int64)) for x, y in ((base, 0), (check, -1), (accept, -1)))
        states[alone] = free[: len(alone)]
        check[states[alone]] = parents[owners[alone]]
        base[parents[owners[alone]]] = states[alone] - children[alone]
        return states

    node, states = np.zeros(len(phrases), np.int64), np.zeros(1, np.int64)
    rows = np.arange(len(phrases))
    for level in range(6):
        rows = rows[2 * sizes[rows] > level]
        if not len(rows):
            break
        keys, node_of = np.unique(node[rows] << bits | digits[rows, level], return_inverse=True)
        states = place(states, keys & ((1 << bits) - 1), keys >> bits)
        node[rows] = node_of
        done = rows[2 * sizes[rows] == level + 1]
        accept[states[node[done]]] = done
    used = int(np.flatnonzero(check != -1).max()) + 1
    return alphabet, base[:used].astype(np.int32), check[:used].astype(np.int32), accept[:used].astype(np.int32)


def _digit_bits(alphabet: np.ndarray) -> int:
    return max(1, -(-max(len(alphabet) - 1, 1).bit_length() // 2))


def accepted(trie: tuple[np.ndarray, ...], words: Words) -> np.ndarray:
    """The accepting states' phrase numbers at all positions, all lengths together."""
    return _walked(trie, words.symbols, words.follows, np.arange(len(words.symbols)))[1]


def _walked(trie: tuple[np.ndarray, ...], symbols: np.ndarray, follows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the positions ``starts``, and the accepting states' phrase numbers there."""
    alphabet, base, check, accept = trie
    bits = _digit_bits(alphabet)
    label = np.minimum(np.searchsorted(alphabet, symbols), len(alphabet) - 1)
    known = alphabet[label] == symbols
    of = np.flatnonzero(known[starts])
    at = starts[of]
    state, places, out = np.zeros(len(at), np.int64), [], []
    for size in (1, 2, 3):
        for shift in (bits, 0):
            reached = base[state] + (label[at + size - 1] >> shift & ((1 << bits) - 1))
            good = reached < len(check)
            good[good] = check[reached[good]] == state[good]
            of, at, state = of[good], at[good], reached[good]
        ends = accept[state] >= 0
        places.append(of[ends])
        out.append(accept[state[ends]])
        for further in (follows[at + size - 1], None):
            further = known[at + size] if further is None else further
            of, at, state = of[further], at[further], state[further]
    return np.concatenate(places), np.concatenate(out)


def _packed_positions(n: np.ndarray, phrases: np.ndarray, sizes: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Positions by ranges of their pairs' hashes: each pair once, then what follows it."""
    hashes = mix64(phrases[:, 0] * _K + phrases[:, 1])
    order = np.argsort(hashes, kind="stable")
    hashes, n, phrases, sizes = hashes[order], n[order], phrases[order], sizes[order]
    bucket = (hashes >> np.uint64(32)).astype(np.int64) * buckets >> 32
    first = np.append(True, (phrases[1:, :2] != phrases[:-1, :2]).any(axis=1))
    opens = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    rows = []
    for a, b in zip(opens.tolist(), [*opens[1:].tolist(), len(bucket)], strict=True):
        pairs, thirds = phrases[a:b][first[a:b], :2], phrases[a:b][sizes[a:b] == 3, 2]
        rows.append((int(bucket[a]), pairs.tobytes(), thirds.tobytes(), (sizes[a:b] + first[a:b] * np.int8(4)).tobytes(), _planes(n[a:b])))
    columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 4), strict=True)]
    yield pa.RecordBatch.from_arrays(columns, names=["bucket", "pairs", "thirds", "kinds", "n"])


def _unpacked_positions(pairs: bytes, thirds: bytes, kinds: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.frombuffer(kinds, np.int8)
    phrases, sizes = np.zeros((len(kind), 3), np.uint64), kind & 3
    phrases[:, :2] = np.frombuffer(pairs, np.uint64).reshape(-1, 2)[np.cumsum(kind >= 4) - 1]
    phrases[sizes == 3, 2] = np.frombuffer(thirds, np.uint64)
    return phrases, sizes, _of_planes(n)


def _counted(phrases: np.ndarray, sizes: np.ndarray, n: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Phrases, their sizes and how often positions accept them, by tries of about ``most``
    phrases. Positions are rows of a pair and, where ``sizes`` is 3, what follows it; each stands
    for ``n``. All rows of a pair meet one trie."""
    order = np.lexsort((phrases[:, 2], sizes, phrases[:, 1], phrases[:, 0]))
    phrases, sizes, n = phrases[order], sizes[order], n[order]
    pair = np.append(True, (phrases[1:, :2] != phrases[:-1, :2]).any(axis=1))
    opens = np.flatnonzero(pair | np.append(True, (phrases[1:, 2] != phrases[:-1, 2]) | (sizes[1:] != sizes[:-1])))
    phrases, sizes, n, pair = phrases[opens], sizes[opens], np.add.reduceat(n, opens), pair[opens]
    trie = np.cumsum(pair + (sizes == 3)) // max(most, 1)
    trie = trie[np.flatnonzero(pair)][np.cumsum(pair) - 1]
    cuts = [*np.flatnonzero(np.append(True, trie[1:] != trie[:-1])).tolist(), len(trie)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        own, three = phrases[a:b], sizes[a:b] == 3
        twos = own[pair[a:b]]
        twos[:, 2] = 0
        named, lengths = np.concatenate([twos, own[three]]), np.repeat(np.array([2, 3], np.int8), [len(twos), int(three.sum())])
        follows = np.stack([np.ones(b - a, bool), three, np.zeros(b - a, bool)], axis=1).ravel()
        at, number = _walked(double_array(named, lengths), own.ravel(), follows, np.arange(0, 3 * (b - a), 3))
        counts = np.zeros(len(named), np.int64)
        np.add.at(counts, number, n[a:b][at])
        yield named, lengths, counts


def phrase_counts(docs: DataFrame, frequent: Bloom, pairs: Bloom, triples: Bloom) -> DataFrame:
    """``s1, s2, s3, a``: how often each phrase occurs that may be frequent and does so ``LEAST``
    times; ``s3`` is null for pairs. Tasks pack their positions by ranges of hashes, as they do
    for ``likely``, and each range builds its tries and counts with them."""
    known = docs.sparkSession.sparkContext.broadcast((frequent.words, pairs.words, triples.words))
    buckets, least, most = RANGES_PER_TASK * task_count(docs.sparkSession), LEAST, SHARD_PHRASES

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, three = (Bloom(w) for w in known.value)
        held, size = [], 0
        for words, _ in _slices(batches):
            of_pairs, of_triples, level = _may_be(words, one, two)
            at = np.flatnonzero(level >= 2)
            sizes = np.full(len(at), 2, np.int8)
            longer = np.flatnonzero(level[at] >= 3)
            sizes[longer[three.holds(_hashed(of_triples[at[longer]]))]] = 3
            keys, first, n = np.unique(np.where(sizes == 3, of_triples[at], of_pairs[at]), return_index=True, return_counts=True)
            at, sizes = at[first], sizes[first]
            s = np.append(words.symbols, np.zeros(2, np.uint64))
            held.append((keys, n, np.stack([s[at], s[at + 1], np.where(sizes == 3, s[at + 2], np.uint64(0))], axis=1), sizes))
            size += len(keys)
            if size >= BLOCK:
                held = [_merged(held)]
                size = len(held[0][0])
            if size >= BLOCK // 2 and len(held) == 1:
                yield from _packed_positions(*held[0][1:], buckets)
                held, size = [], 0
        if size:
            yield from _packed_positions(*_merged(held)[1:], buckets)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def total(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            for phrases, sizes, a in _counted(*(np.concatenate(x) for x in zip(*parts, strict=True)), most):
                often = a >= least
                s, two = phrases[often].view(np.int64), sizes[often] == 2
                columns = [pa.array(s[:, 0].copy()), pa.array(s[:, 1].copy()), pa.array(s[:, 2].copy(), mask=two), pa.array(a[often])]
                yield pa.RecordBatch.from_arrays(columns, names=["s1", "s2", "s3", "a"])

        bucket, parts = None, []
        for batch in batches:
            for at, *packed in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if at != bucket and parts:
                    yield from total(parts)
                    parts = []
                bucket = at
                parts.append(_unpacked_positions(*packed))
        if parts:
            yield from total(parts)

    found = docs.mapInArrow(name, "bucket int, pairs binary, thirds binary, kinds binary, n binary")
    found = found.repartition("bucket").sortWithinPartitions("bucket")
    return found.mapInArrow(walk, "s1 long, s2 long, s3 long, a long")


def _floor_ratio(a: str, left: str, right: str) -> Column:
    whole = "DECIMAL(13,0)"
    return F.expr(
        f"(CAST({a} AS {whole}) * CAST({a} AS {whole}) * CAST(1000000 AS DECIMAL(7,0)))"
        f" div (CAST({left} AS {whole}) * CAST({right} AS {whole}))"
    )


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` of each language."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    words = stored(word_counts(docs), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    words = words.where(F.col("n") >= LEAST)
    frequent = bloom(words.select("symbol"))
    pairs = bloom(likely(docs, frequent))
    triples = bloom(likely(docs, frequent, pairs))
    counts = stored(phrase_counts(docs, frequent, pairs, triples), "frequent-phrases")
    two, three = counts.where("s3 IS NULL").drop("s3"), counts.where("s3 IS NOT NULL")

    def spelled(phrases: DataFrame, size: int) -> DataFrame:
        for i in range(1, size + 1):
            own = words.select(F.col("symbol").alias(f"s{i}"), *([F.col("lang")] if i == 1 else []), F.col("word").alias(f"w{i}"), F.col("n").alias(f"n{i}"))
            phrases = phrases.join(own, f"s{i}")
        return phrases

    left = two.withColumnRenamed("a", "l2")
    right = two.select(F.col("s1").alias("s2"), F.col("s2").alias("s3"), F.col("a").alias("r1"))
    three = stored(three.join(left, ["s1", "s2"]).join(right, ["s2", "s3"]), "frequent-triples")
    inside = three.select("s1", "s2", "a").unionByName(three.select(F.col("s2").alias("s1"), F.col("s3").alias("s2"), "a"))
    inside = inside.groupBy("s1", "s2").agg(F.max("a").alias("_longer"))
    two = two.join(inside, ["s1", "s2"], "left").where(
        F.col("_longer").isNull() | (100 * F.col("_longer") < INSIDE * F.col("a"))
    )
    of_two = spelled(two.drop("_longer"), 2).withColumn("score", _floor_ratio("a", "n1", "n2"))
    of_two = of_two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"), "score")
    of_three = spelled(three, 3)
    of_three = of_three.withColumns({"_1": _floor_ratio("a", "n1", "r1"), "_2": _floor_ratio("a", "l2", "n3")})
    early = F.col("_1") <= F.col("_2")
    of_three = of_three.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        F.when(early, F.col("n1")).otherwise(F.col("l2")).alias("l"),
        F.when(early, F.col("r1")).otherwise(F.col("n3")).alias("r"),
        F.least("_1", "_2").alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = of_two.unionByName(of_three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents").select("text", "lang"))


OP13_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM pieces),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM lists WHERE len(ws) > 0),
counts AS (
  SELECT lang, k, phrase, count(*) AS f
  FROM (SELECT lang, unnest([1, 2, 3]) AS k,
               unnest([ws[i], CASE WHEN i + 1 <= len(ws) THEN ws[i] || ' ' || ws[i + 1] END,
                       CASE WHEN i + 2 <= len(ws) THEN ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] END]) AS phrase
        FROM places)
  WHERE phrase IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE k > 1 AND f >= {LEAST}),
cuts AS (
  SELECT c.lang, c.size, c.phrase, c.a, cut, x.f AS l, y.f AS r,
         (1000000::HUGEINT * c.a::HUGEINT * c.a::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS cut FROM candidates) c
  JOIN counts x ON x.lang = c.lang AND x.k = c.cut AND x.phrase = array_to_string(c.ws[1:c.cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.k = c.size - c.cut AND y.phrase = array_to_string(c.ws[c.cut + 1:c.size], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS phrase, a FROM candidates WHERE size = 3)
  GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON b.lang = i.lang AND b.phrase = i.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < {INSIDE} * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) <= {TOP}
"""
