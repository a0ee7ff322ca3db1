"""BPE encoding of every character, and of random strings, against the library."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    with open(PATH) as f:
        return Tokenizer.from_file(PATH), bpe.Codec(f.read())


def differing(both, texts):
    lib, codec = both
    codec.words.clear()
    want = lib.encode_batch(texts, add_special_tokens=False)
    return [t for t, e in zip(texts, want, strict=True) if np.frombuffer(codec.encode(t), "<u4").tolist() != e.ids]


@pytest.mark.parametrize("form", ["{}", "a{}b", "1{}"])
def test_every_code_point(both, form):
    for lo in range(0, 0x110000, 0x4000):
        texts = [form.format(chr(c)) for c in range(lo, lo + 0x4000) if not 0xD800 <= c < 0xE000]
        assert differing(both, texts) == []


def test_random_strings(both):
    rng = random.Random(12)
    common = ["a", "é", "Σ", "σ", "İ", "ß", "ŉ", "1", "½", "'s", "'", " ", " ", "\n", "\x1c", "\x85", "\xa0", "　", "़", "̧", "́", "͏", "힣", "ᅡ", "日", "<|endoftext|>", "<|"]

    def character():
        c = rng.choice([rng.randrange(0x250), rng.randrange(0x3000), rng.randrange(0x20000), rng.randrange(0x110000)])
        return rng.choice(common) if rng.random() < 0.5 or 0xD800 <= c < 0xE000 else chr(c)

    texts = ["".join(character() for _ in range(rng.randrange(1, 25))) for _ in range(20_000)]
    assert differing(both, texts) == []
