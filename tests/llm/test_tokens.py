import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from weftline.llm import tokens
from weftline.llm.tokens import Encoder

ODD = ["", None, " ", "  ", "a", " a", "a ", "a  b", "a   b ", "x\n y", "x \ny", "x\n\ny \n z", "tab\tb\t c", "it's we'll I'M", "\x1c a\x1cb", "\x85a b\x85", "\xa0 a\xa0b c\xa0", "é é ́a ΑΣ Σ İ", "\x01 a\x01b \x01\x01 c", "<|endoftext|> a <|endoftext|>", "日本 語。x 😀😀 y", "1234 12.5 a1b2", " a b　c", "word,\nNext\n\nPara  two", "don't 's 't", "a\r\nb \r\n c"]


def texts():
    rng = random.Random(5)
    pool = ["the", "of", "ing", "Zq", "\n", "", "  ", "x,", "…", "é", "'s", "12", "\t", "\x1d", "ſ", "ﬁ"]
    return ODD + [" ".join(rng.choice(pool) + rng.choice(pool) for _ in range(rng.randint(1, 60))) for _ in range(300)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_equals_library(name):
    e = Encoder(public_tokenizers.path(name))
    assert e.strategy in ("space", "word")
    ref = Tokenizer.from_file(public_tokenizers.path(name))
    ref.encode_special_tokens = True
    ts = texts()
    for lo in range(0, len(ts), 40):
        ids, sizes = e.encode(pa.array(ts[lo : lo + 40]), 7)
        got = np.split(ids, np.cumsum(sizes)[:-1])
        want = [x.ids for x in ref.encode_batch([t or "" for t in ts[lo : lo + 40]], add_special_tokens=False)]
        for t, g, w in zip(ts[lo:], got, want):
            assert g.tolist() == [*w, 7], repr(t)


def test_small_store(monkeypatch):
    """Words that were dropped are learnt again."""
    monkeypatch.setattr(tokens, "KEPT", 10)
    monkeypatch.setattr(tokens, "YOUNG", 30)
    test_equals_library("byte_bpe_50k.json")
    test_equals_library("word_bpe_49k.json")


def test_no_texts():
    ids, sizes = Encoder(public_tokenizers.path("byte_bpe_50k.json")).encode(pa.array([], pa.string()), 7)
    assert len(ids) == len(sizes) == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_strings_of_added_tokens(name):
    """The encoder of the operators gives them the ids that the library's default gives."""
    e = tokens.encoder(public_tokenizers.path(name))
    ref = Tokenizer.from_file(public_tokenizers.path(name))
    some = ["<|endoftext|>", "<|ENDOFTEXT|>", "a<|endoftext|>b", "a<|startoftext|> B\n<|endoftext|>", "x <|StartOfText|> y", "<|endof", "text|>", "", None, "plain  Text 12"]
    ts = some + texts() + some
    ids, sizes = e.encode(pa.array(ts), 7)
    got = np.split(ids, np.cumsum(sizes)[:-1])
    want = [x.ids for x in ref.encode_batch([t or "" for t in ts], add_special_tokens=False)]
    for t, g, w in zip(ts, got, want):
        assert g.tolist() == [*w, 7], repr(t)
    plain = Encoder(public_tokenizers.path(name)).encode(pa.array(["<|endoftext|>"]))[0]
    assert plain.tolist() != want[0]
