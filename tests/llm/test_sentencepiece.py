"""Encoding and decoding against the library."""

import hashlib
import random

import pytest
import sentencepiece

from llm.sentencepiece_codec import PrefixTable, default_model, model_bytes, token_digests, token_ids


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=default_model())


@pytest.fixture(scope="module")
def table():
    return PrefixTable(model_bytes(default_model()))


def texts():
    r = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz ethino  s.,;ABÉ日\U0001f642\n1230▁"
    out = ["", " ", "  hello   world  ", "\t\n a▁b  ▁", "\x00 a", " " * 70 + "x" + " " * 33, "a" * 3000, "�"]
    out += ["".join(r.choice(letters) for _ in range(r.randint(1, 60))) for _ in range(800)]
    out += ["a" + " " * n + "b" + " " * n for n in range(1, 80)]
    return out


def test_ids_and_texts_are_the_librarys(library, table):
    pieces = list(table.ids)
    r = random.Random(4)
    for text in texts() + ["".join(r.choices(pieces, k=6)) for _ in range(800)]:
        ids = library.encode(text)
        assert table.encode(text) == ids, repr(text)
        assert table.decode(ids) == library.decode(ids), repr(text)


def test_digests_are_those_of_ids_and_decoded_texts(library, table):
    for text in texts():
        ids = library.encode(text)
        names = [",".join(map(str, ids)), library.decode(ids)]
        want = (len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in names))
        assert table.digest(text) == want, repr(text)


def test_bytes_that_are_no_text_decode_as_in_the_library(library, table):
    numbers = [table.byte_ids[b] for b in (0xE6, 0x97, 0xFF, 0xC3, 0xA9, 0x41, 0xF0, 0x9F)]
    assert table.decode(numbers) == library.decode(numbers)


def test_odd_documents(spark, library, odd_documents, no_documents):
    rows = {r.text: r.doc_id for r in odd_documents.collect()}
    got = token_digests(odd_documents).collect()
    assert len(got) == 12 and sum(r.n_tokens for r in got) == sum(len(library.encode(r.text or "")) for r in odd_documents.collect())
    assert len(rows) < 12 and token_digests(no_documents).count() == 0
    for r in token_ids(odd_documents.where("doc_id = 10")).collect():
        assert r.ids == library.encode(r.decoded)
