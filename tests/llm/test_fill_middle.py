"""Fill-in-middle against the definition by regular expressions."""

import random

import numpy as np

from tessera.llm import fill_middle as fim

ALPHABET = ["a", "b", "é", "日", "𝄞", " ", " ", "\n", "\t", "\x0b", "\x0d", "\x08", "\x0e", "\x1f", "\x7f", "\x85", "\xa0", "!", "<", "P", "S", "M", ">", "<S>"]


def test_equals_definition(spark, messy, messy_rows, empty):
    want = fim.brute_force([(r[0], r[1]) for r in messy_rows])
    got = fim.digest(fim.transform(messy)).collect()
    assert sorted(map(tuple, got)) == sorted(want, key=lambda r: r[0])
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.digest(fim.transform(empty)).count() == 0


def test_odd_ids(odd_ids):
    want = fim.brute_force([(r.doc_id, r.text) for r in odd_ids.collect()])
    assert sorted(map(tuple, fim.digest(fim.transform(odd_ids)).collect()), key=repr) == sorted(want, key=repr)


def test_random_strings_in_one_slice():
    rng = random.Random(1)
    rows = [(rng.randrange(10**6), "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40)))) for _ in range(20_000)]
    got = fim.transform_slice([r[0] for r in rows], [r[1].encode() for r in rows])
    for row, n, form, p, m, out in zip(rows, *got, strict=True):
        want = fim.brute_force([row])[0]
        assert (n, form, p, m) == want[1:5], row
        assert fim.hashlib.sha256(out).hexdigest() == want[5], row


def test_every_unit_end_and_select():
    rng = random.Random(2)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(k)).encode() for k in range(300)]
    x, first = fim.words_of(texts)
    ends = fim.unit_ends(texts, x, first)
    upto = np.cumsum(np.bitwise_count(ends), dtype=np.int64)
    k = np.arange(1, upto[-1] + 1)
    word, byte = fim.select(ends, upto, k)
    marked = np.flatnonzero(ends.view(np.uint8) & 0x80)
    assert (word * 8 + byte).tolist() == marked.tolist()


def test_slices_bound_bytes(monkeypatch):
    monkeypatch.setattr(fim, "SLICE", 100)
    texts = [b"x" * n for n in (50, 50, 1, 500, 0, 0, 99, 1, 1)]
    parts = list(fim._slices(list(range(9)), texts))
    assert [t for _, p in parts for t in p] == texts and [i for p, _ in parts for i in p] == list(range(9))
    assert all(sum(map(len, p)) <= 100 or len([t for t in p if t]) == 1 for _, p in parts)


def test_restore_of_texts_with_marks(spark):
    texts = ["<P>", "a <S> b", "x<M>", "<P", "a < P> b c d e f g", "<<S", "P> <S"]
    df = spark.createDataFrame([(i, t) for i in range(40) for t in texts], "doc_id bigint, text string")
    out = fim.transform(df)
    back = out.select("doc_id", fim.restore(out["output"], out["form"]).alias("text")).collect()
    assert sorted(map(tuple, back)) == sorted((i, t) for i in range(40) for t in texts)
