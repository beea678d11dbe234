"""Ids of long and odd texts against the library, and odd tables."""

from __future__ import annotations

import random

import pytest
import sentencepiece

from tripmill.llm import sentencepiece_codec as sp
from tripmill.llm.shared import tokenizer_file


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_file())


def texts():
    r = random.Random(4)
    letters = "etaoinshrdlu"
    return [
        "", " ", "   two  blanks ", "a\tb\nc", "日本語のテキスト", "é" * 70, "x" * 3000, "ab" * 2000,
        "".join(r.choice(letters) for _ in range(100_000)),
        "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(100_000)),
        "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(20_000)),
        " ".join("".join(r.choice(letters) for _ in range(r.randrange(1, 12))) for _ in range(150_000)),
        "word " * 200_000,
    ]


def test_ids_equal_the_library(library):
    tool = sp.Codec(tokenizer_file())
    for _ in range(2):  # the second time from the words that are known by then
        for text, ids in zip(texts(), tool.encode(texts())):
            assert ids.tolist() == library.encode(text)
            assert tool.decode(ids.tolist()) == text


def test_known_words_keep_to_their_room(monkeypatch):
    monkeypatch.setattr(sp, "CACHE_BYTES", 20_000)
    tool = sp.Codec(tokenizer_file())
    want = sp.Codec(tokenizer_file()).encode(["often"])[0].tolist()
    for k in range(30):
        tool.encode([" ".join(f"word{k}x{i}" for i in range(40)), "often"])
        assert tool.kept <= 10_000 + 300 and len(tool.recent) + len(tool.older) < 130
    assert tool.encode(["often"])[0].tolist() == want


def test_odd_tables(spark, library):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "no key"), (4, "x" * 20_000), (5, "one two " * 100_000)]
    frame = spark.createDataFrame([(k, t, "kept", 7, 8) for k, t in rows], "doc_id long, text string, answer string, Token_Ids int, decoded int")
    coded = sp.encode(frame, tokenizer_file(), exact="round_trip")
    assert coded.columns == ["doc_id", "text", "answer", "decoded", "token_ids", "round_trip"]
    found = coded.collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.round_trip and row.answer == "kept" and row.decoded == 8
        assert row.token_ids == (None if row.text is None else library.encode(row.text))
    back = sp.decode(coded, tokenizer_file())
    assert back.columns == ["doc_id", "text", "answer", "token_ids", "round_trip", "decoded"]
    assert back.where("NOT decoded <=> text").count() == 0
    empty = sp.encode(frame.limit(0), tokenizer_file(), exact="round_trip")
    assert empty.count() == 0 and sp.decode(empty, tokenizer_file()).count() == 0
