"""Cross-tokenizer alignment against the libraries and the definition."""

import random

import numpy as np
import public_tokenizers
import pytest

from tessera.llm import token_links as tl

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [tl.BLOCK_BYTES, 2000])
def test_equals_definition(spark, messy, messy_rows, block_bytes):
    rows = [(r[0], r[1]) for r in messy_rows]
    rows += [(500, "a b <|endoftext|> <s> </s> <0x41> ▁x"), (501, "日本語テキスト 𝄞𝄞 ͸ 🙂"), (502, "  two  spaces\t\ttabs\r\n"), (503, "ﬁ ½ Å é"), (504, "\x00\x01 nul"), (505, "👩‍👩‍👧‍👦" * 50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = tl.align_documents(df, tl.read_spec(spark, A), tl.read_model(spark, B), block_bytes)
    assert result(got) == sorted(tl.brute_force(rows, A, B), key=repr)


def test_clashing_columns_odd_ids_and_no_rows(messy, odd_ids, empty):
    assert result(tl.align_files(messy, A, B)) == result(tl.align_files(messy.select("doc_id", "text"), A, B))
    assert result(tl.align_files(odd_ids, A, B)) == sorted(tl.brute_force([(r.doc_id, r.text) for r in odd_ids.collect()], A, B), key=repr)
    assert tl.align_files(empty, A, B).count() == 0


def random_side(rng, lengths, most):
    """Token rows that spell ``lengths`` bytes each, and the width of every id."""
    width = np.arange(most + 1)
    rows = []
    for n in lengths:
        ids = []
        while n:
            ids.append(rng.randint(1, min(most, n)))
            n -= ids[-1]
        rows.append(np.array(ids, np.int32))
    return rows, width


@pytest.mark.parametrize("wide", [tl.WIDE, 1])
def test_walk_and_links(monkeypatch, wide):
    monkeypatch.setattr(tl, "WIDE", wide)
    rng = random.Random(3)
    lengths = [rng.choice([0, 1, 5, 40, 300]) for _ in range(60)]
    (ra, wa), (rb, wb) = random_side(rng, lengths, 9), random_side(rng, lengths, 7)
    a, b = tl.Tokens.of(ra, wa), tl.Tokens.of(rb, wb)
    got, steps = {}, 0
    for cuts in tl.walk(a, b):
        steps += 1
        for link, times in tl.group_links(a, b, cuts):
            for x, t in zip(link.tolist(), [1] * len(link) if times is None else times.tolist(), strict=True):
                key = (x >> tl.DOC_SHIFT, x >> tl.PAIR_BITS & 2**17 - 1, x & 2**tl.PAIR_BITS - 1)
                got[key] = got.get(key, 0) + t
    want = {}
    for d, (x, y) in enumerate(zip(ra, rb, strict=True)):
        ea, eb = np.cumsum(x), np.cumsum(y)
        cut = np.intersect1d(ea, eb)
        ga, gb = np.searchsorted(cut, ea), np.searchsorted(cut, eb)
        for i, g in enumerate(ga):
            for j in np.flatnonzero(gb == g):
                key = (d, int(x[i]), int(y[j]))
                want[key] = want.get(key, 0) + 1
    assert got == want and steps <= max(map(len, ra)) + max(map(len, rb))


def test_chunks_encode_like_whole_texts():
    rng = random.Random(8)
    parts = ["a", "The", "été", "日本", "𝄞", "1", "23", "'s", "...", "<|endoftext|>", "<s>", "▁", " ", " ", " ", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "᠎", "​", " ", " ", "　", "\x00", "ͅ", "\U000e0001"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(4000)] + [None]
    sides = tl.Sides.load(open(A).read(), open(B, "rb").read())
    encoder = tl.Encoder(sides, *(np.array(list(map(len, t))) for t in (sides.bytes_a, sides.bytes_b)))
    assert encoder.cut
    a, b = encoder.of(texts)
    a2, b2 = encoder.of(texts[::-1])  # from what is remembered
    whole = dict(zip(filter(None, texts), encoder.whole(list(filter(None, texts))), strict=True))
    for i, t in enumerate(texts):
        x, y = whole.get(t) or ([], [])
        assert a[i].tolist() == list(x) == a2[-1 - i].tolist() and b[i].tolist() == list(y) == b2[-1 - i].tolist(), t
