"""SentencePiece BPE encoding by a table of prefixes, and decoding.

The text is cut where no piece of the vocabulary crosses: before every run of word marks, and
between characters that pieces join to letters and all others. Each distinct chunk is encoded
once and kept for as long as it comes again. In a chunk, every prefix has one last token: the longest
automaton match at its end whose predecessor (the last token of the prefix before the match)
stays apart from it when the two are merged alone. The ids follow backwards from the end.
Which pairs stay apart is a property of the vocabulary; a worker keeps its first answers up to
a fixed number. Chunks are kept in two generations of at most ``KEPT_CHUNKS``: what was not
asked for while a whole generation passed is forgotten. Each new chunk is decoded once; a
text whose chunks all decode to themselves does so too, others are decoded as a whole.

Nulls encode as empty texts; empty texts have no ids. Repeated rows are encoded again and
give the same ids. An empty table gives an empty result. Extra columns are not read, and
columns of the result replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import bounded_batches, by_bytes, read

MARK = "▁"
MODEL = "piece_bpe_32k.model"
KEPT_CHUNKS = 150_000
KEPT_PAIRS = 300_000
LONG_CHUNK = 64


class PrefixTable:
    """Encoder and decoder of one model, built from the model file's bytes."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        if spec.normalizer_spec.name != "identity" or spec.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models that leave the text as it is are supported")
        self.dummy_prefix = spec.normalizer_spec.add_dummy_prefix
        self.rank: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.surface: list[str | int] = []
        self.byte_ids = [0] * 256
        for number, piece in enumerate(spec.pieces):
            if piece.type == piece.NORMAL:
                self.rank[piece.piece] = -piece.score
                self.ids[piece.piece] = number
                self.surface.append(piece.piece.replace(MARK, " "))
            elif piece.type == piece.BYTE:
                value = int(piece.piece[3:5], 16)
                self.byte_ids[value] = number
                self.surface.append(value)
            else:
                self.surface.append("")
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("a piece holds a word mark after another character")
        self.automaton = ahocorasick.Automaton()
        for piece, number in self.ids.items():
            self.automaton.add_word(piece, number)
        self.automaton.make_automaton()
        self.piece_of = {number: piece for piece, number in self.ids.items()}
        self.sizes = {number: len(piece) for piece, number in self.ids.items()}
        self.whole: dict[int, bool] = {}
        self.apart: dict[int, bool] = {}
        self.chunk_ids: dict[str, str] = {}
        self.earlier_ids: dict[str, str] = {}
        self.odd: set[str] = set()  # chunks that do not decode to themselves
        self.cut = self._cuts()

    def _cuts(self) -> re.Pattern:
        """Chunks of a marked text: letters and whatever pieces join to them, or none of these,
        each with the marks before them."""
        joined: dict[str, set[str]] = {}
        for piece in self.ids:
            for a, b in zip(piece, piece[1:], strict=False):
                if a != MARK:
                    joined.setdefault(a, set()).add(b)
                    joined.setdefault(b, set()).add(a)
        inside = {c for c in joined if c.isalpha()}
        todo = list(inside)
        while todo:
            new = joined[todo.pop()] - inside
            inside |= new
            todo += new
        if not inside:
            return re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        letters = re.escape("".join(sorted(inside)))
        return re.compile(f"{MARK}*(?:[{letters}]+|[^{letters}{MARK}]+)|{MARK}+")

    def merged(self, symbols: list[str]) -> list[str]:
        """Merges adjacent symbols, best score first and leftmost among equals: the
        definition of the encoding, used for pairs and for runs of marks."""
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        alive = list(symbols)
        heap: list[tuple[float, int, str, int]] = []

        def offer(left: int) -> None:
            right = after[left]
            if left >= 0 and right < len(alive):
                rank = self.rank.get(alive[left] + alive[right])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, alive[left] + alive[right], right))

        for i in range(len(symbols) - 1):
            offer(i)
        while heap:
            _, left, piece, right = heapq.heappop(heap)
            if not alive[left] or after[left] != right or alive[left] + alive[right] != piece:
                continue
            alive[left], alive[right] = piece, ""
            after[left] = after[right]
            if after[right] < len(alive):
                before[after[right]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return [x for x in alive if x]

    def alone(self, number: int) -> bool:
        """Whether a piece's own characters merge to it."""
        known = self.whole.get(number)
        if known is None:
            piece = self.piece_of[number]
            known = self.whole[number] = self.merged(list(piece)) == [piece]
        return known

    def stays_apart(self, left: int, right: int) -> bool:
        """Whether merging the characters of two pieces gives just these two."""
        first, second = self.piece_of[left], self.piece_of[right]
        known = self.merged(list(first + second)) == [first, second]
        if len(self.apart) < KEPT_PAIRS:
            self.apart[left << 32 | right] = known
        return known

    def pieces(self, chunk: str) -> list[str]:
        """The pieces of a chunk, characters outside the vocabulary standing alone."""
        last = [-1] * (len(chunk) + 1)  # of each prefix: -1 is a character of no piece
        apart, sizes, done = self.apart, self.sizes, -1
        for end, number in self.automaton.iter(chunk):  # by end, longest first
            if end == done:
                continue
            start = end + 1 - sizes[number]
            left = last[start]
            if start == 0 or left < 0:
                good = self.alone(number)
            else:
                good = apart.get(left << 32 | number)
                if good is None:
                    good = self.stays_apart(left, number)
            if good:
                last[end + 1] = number
                done = end
        out, at = [], len(chunk)
        while at:
            number = last[at]
            piece = self.piece_of[number] if number >= 0 else chunk[at - 1]
            out.append(piece)
            at -= len(piece)
        return out[::-1]

    def of_chunk(self, chunk: str) -> str:
        """Ids as text."""
        numbers: list[int] = []
        words = chunk.lstrip(MARK)
        marks = len(chunk) - len(words)
        if marks > 1:  # marks have equal scores among themselves: merged by the definition
            head = self.mark_run(marks - 1 if self.joins_mark(words) else marks)
            rest = (MARK if self.joins_mark(words) else "") + words
            parts = head + (self.pieces(rest) if rest else [])
        else:
            parts = self.pieces(chunk)
        for piece in parts:
            number = self.ids.get(piece)
            numbers += [number] if number is not None else [self.byte_ids[b] for b in piece.encode()]
        return ",".join(map(str, numbers))

    def joins_mark(self, words: str) -> bool:
        """Whether the word takes the mark before it: runs of marks merge after all else."""
        return bool(words) and len(self.pieces(MARK + words)[0]) > 1

    @lru_cache(maxsize=4096)  # noqa: B019  one table lives as long as its task
    def mark_run(self, count: int) -> list[str]:
        return self.merged([MARK] * count)

    def decode(self, numbers: list[int], whole: bool = True) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD one by one."""
        out: list[str] = []
        pending = bytearray()

        def flush() -> None:
            at = 0
            while at < len(pending):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(pending[at : at + size]).decode())
                        break
                    except UnicodeDecodeError:
                        size = 0
                if not size:
                    out.append("�")
                    size = 1
                at += size
            pending.clear()

        for number in numbers:
            surface = self.surface[number]
            if isinstance(surface, int):
                pending.append(surface)
                continue
            if pending:
                flush()
            out.append(surface)
        if pending:
            flush()
        text = "".join(out)
        return text[1:] if whole and self.dummy_prefix and text[:1] == " " else text

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids, SHA-256 of the decoded text."""
        if not text:
            return 0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest()
        marked = (MARK if self.dummy_prefix else "") + text.replace(" ", MARK)
        chunks = self.cut.findall(marked)
        names = list(map(self.chunk_ids.get, chunks))
        if None in names:
            for i, name in enumerate(names):
                if name is None:
                    names[i] = self.kept(chunks[i])
        ids = ",".join(names)
        if self.odd and not self.odd.isdisjoint(chunks):
            decoded = self.decode(list(map(int, ids.split(","))))
        else:
            decoded = marked.replace(MARK, " ")
            decoded = decoded[1:] if self.dummy_prefix and decoded[:1] == " " else decoded
        return ids.count(",") + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    def kept(self, chunk: str) -> str:
        """Ids of a chunk, from the earlier generation or computed."""
        name = self.chunk_ids.get(chunk) or self.earlier_ids.get(chunk)
        if name is None:
            name = self.of_chunk(chunk)
            if self.decode(list(map(int, name.split(","))), False) != chunk.replace(MARK, " "):
                self.odd.add(chunk)
        if len(chunk) <= LONG_CHUNK:
            if len(self.chunk_ids) >= KEPT_CHUNKS:
                self.earlier_ids, self.chunk_ids = self.chunk_ids, {}
            self.chunk_ids[chunk] = name
        return name

    def encode(self, text: str) -> list[int]:
        marked = (MARK if self.dummy_prefix else "") + text.replace(" ", MARK) if text else ""
        return [int(x) for chunk in self.cut.findall(marked) for x in self.of_chunk(chunk).split(",")]


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=2)
def prefix_table(model: bytes) -> PrefixTable:
    """One table per worker process; what it has learned serves the process's next tasks."""
    return PrefixTable(model)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def token_digests(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``.

    ``model_path`` is read on the driver (half a megabyte); tasks get its bytes.
    """
    bounded_batches(docs.sparkSession)
    model = model_bytes(model_path or default_model())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(model)
        for batch in by_bytes(batches, "text", 1 << 20):
            rows = [table.digest(text or "") for text in batch.column("text").to_pylist()]
            counts, ids, decoded = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        encode, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def token_ids(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """``doc_id, ids array<int>, decoded`` for every row of ``docs``."""
    model = model_bytes(model_path or default_model())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(model)
        for batch in by_bytes(batches, "text", 1 << 20):
            ids = [table.encode(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([table.decode(x) for x in ids])],
                names=["doc_id", "ids", "decoded"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        encode, "doc_id long, ids array<int>, decoded string"
    )


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(read(spark, sf_dir, "documents"))
