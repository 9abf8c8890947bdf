"""Cuts that leave the library's ids as they are, and a memory that stays bounded."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from highwater.llm import bpe

PARTS = [
    *"abzAZ09.,;:!?'\"()-_/#*$%&|<>@[]^`{}~ \t\n\r\x0b\x0c\x1c\x85  　​‍́",
    *"éßÀ×÷ñøǿ²½Ⅷ٣漢字かなカ한글жЯΩאبไ🙂👨‍👩‍👧。、！？：；，（）",
    "'s", "'t", "'re", "'LL", "it's", "don't,", "'", "''", "<|endoftext|>", "<|", "|>", "endoftext", "  ", " ,", ", ", "word", "1,000.5",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_random_texts_have_the_library_s_counts(library):
    draw = random.Random(5)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 40))) for _ in range(20_000)]
    encoder = bpe.Encoder(list)
    for at in range(0, len(texts), 500):
        for text, found in zip(texts[at : at + 500], encoder.encode(texts[at : at + 500]), strict=True):
            assert [i for piece in found for i in piece] == library.encode(text, add_special_tokens=False).ids, text


def test_special_tokens_are_not_cut():
    assert "<|endoftext|>" in bpe.cut("one,two <|endoftext|>")[1]
    assert bpe.cut("one,two it's. 漢字。漢") == ["one", ",two", " it's", ".", " 漢字", "。漢"]


def test_long_pieces_are_not_kept():
    encoder = bpe.Encoder(len)
    draw = random.Random(1)
    for _ in range(20):
        encoder.encode(["".join(draw.choices("漢字仮名交文", k=5000)), "short words are kept"])
    assert set(encoder.known) == {"short", " words", " are", " kept"}


def test_the_memory_has_a_bound(monkeypatch):
    monkeypatch.setattr(bpe, "KEEP_BYTES", 20_000)
    encoder = bpe.Encoder(len)
    most = 0
    for k in range(60):
        encoder.encode([" ".join(f"w{k}x{j}" for j in range(40))])
        most = max(most, sum(len(p.encode()) + bpe.PIECE_BYTES for p in encoder.known))
    assert 10_000 < most <= 20_000 + bpe.SHORT * 4 + bpe.PIECE_BYTES
