"""Words coded together have the ids of texts coded alone, with few texts for the tokenizer."""

import sys

import numpy as np
import pyarrow as pa
import pytest

from spanforge.llm import arrow_tokens
from spanforge.llm.arrow_tokens import WordCoder

ODD = ["", None, "  ", "a", "don't it's we're, I'll.", "x<|endoftext|>y <|startoftext|> z.", "İstanbul, İ. i̇. ß. ﬁ é́, ́abc abć.", "a b.　c!", "日本語。 中文, ٣٤ x٣.", "'sx. s' '.s .,; !a!", "A&B& #a# a#", "\x85a\x1cb. \x0b\x0c c", "가 각. カﾞ, 😂 😂. a😂", "a" * 3000 + "!!!"]


class Counted:
    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_words_are_coded_together():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    coder = WordCoder(public_tokenizers.path("word_bpe_49k.json"), "uint16")
    tokenizer = coder.tokenizer
    coder.tokenizer = counted = Counted(tokenizer)
    letters = "abcdefghij"
    words = [f"{x}{y}{z}" for x in letters for y in letters for z in letters]
    texts = [*ODD, " ".join(words), ", ".join(words), "! ".join(x.upper() for x in words)]
    for _ in range(2):  # the second time from the store
        got = [np.frombuffer(x, "uint16").tolist() for x in coder.code(pa.array(texts))]
        assert got == [tokenizer.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert counted.texts < 200


def test_words_in_the_store_take_no_step_each():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    coder = WordCoder(public_tokenizers.path("word_bpe_49k.json"), "uint16")
    letters = "abcdefghijklmnop"
    words = [f"{x}{y}{z}" for x in letters for y in letters for z in letters]
    texts = pa.array([" ".join(words), ", ".join(words), None, "!? ".join(words)])
    first, calls = [bytes(x) for x in coder.code(texts)], []
    sys.setprofile(lambda frame, event, value: calls.append(event))
    again = coder.code(texts)
    sys.setprofile(None)
    assert [bytes(x) for x in again] == first
    assert len(calls) < len(words)


def test_a_full_store_lets_words_go(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(arrow_tokens, "STORE_WORDS", 40)
    coder = WordCoder(public_tokenizers.path("word_bpe_49k.json"), "uint16")
    for k in range(6):
        texts = [*(ODD if k == 0 else []), *(f"often{'!' * k} {'.' * (k + 7)} {x}{y}{'zwvuts'[k]}{'?' * (k + 6)}" for x in "abcde" for y in "fghij")]
        got = [np.frombuffer(x, "uint16").tolist() for x in coder.code(pa.array(texts))]
        assert got == [coder.tokenizer.encode(x or "", add_special_tokens=False).ids for x in texts]
    coder._forget()
    assert len(coder.words) == len(coder.ids) == len(coder.single) == len(coder.uses) == 20
    assert "often" in coder.words.to_pylist()


def test_parts_go_over_batches():
    sizes = [3, 0, 50, 2000, 1, None, *[7] * 400, 900, 0, 1100, 1100, *[0] * 60]
    rows = [(k, None if n is None else "x" * n) for k, n in enumerate(sizes)]
    batches = [pa.record_batch({"doc_id": [k for k, _ in rows[x : x + 5]], "text": pa.array([t for _, t in rows[x : x + 5]], pa.string())}) for x in range(0, len(rows) + 5, 5)]
    parts = [(keys, texts.to_pylist()) for keys, texts in arrow_tokens._by_bytes(iter(batches), 1000)]
    assert [x for keys, texts in parts for x in zip(keys, texts, strict=True)] == rows
    assert all(len(keys) == 1 or sum(len(x or "") for x in texts) <= 1000 for keys, texts in parts)
    assert 30 < len(parts) < 60 and all(len(keys) <= 16 for keys, _ in parts)
