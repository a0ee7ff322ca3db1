"""The trained character models against a plain Kneser-Ney, and their size."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import language_id as li


def plain(texts):
    """p(gram) of interpolated Kneser-Ney, by dictionaries; grams are tuples of
    four units."""
    top = Counter(tuple(int(g >> np.uint64(48 - 16 * k)) & 0xFFFF for k in range(4)) for t in texts for g in li.grams(t))
    levels = {4: top}
    for k in (3, 2, 1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    off = {}
    for k, c in levels.items():
        n1, n2 = (sum(v == x for v in c.values()) for x in (1, 2))
        off[k] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.75
    total = {k: Counter() for k in levels}
    taken = {k: Counter() for k in levels}
    for k, c in levels.items():
        for g, n in c.items():
            total[k][g[:-1]] += n
            taken[k][g[:-1]] += min(n, off[k])

    def p(gram, k, uniform):
        if k == 0:
            return uniform
        g = gram[4 - k:]
        lower = p(gram, k - 1, uniform)
        if not total[k][g[:-1]]:
            return lower
        return (max(levels[k][g] - off[k], 0) + taken[k][g[:-1]] * lower) / total[k][g[:-1]]

    return p, set(top), {g[0] for g in levels[1]}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    return {lang: ["".join(rng.choice(parts) + (" " if rng.random() < 0.4 else "") for _ in range(rng.randrange(5, 80))) for _ in range(60)]
            for lang, parts in {"aa": ["la", "le", "re", "ó"], "bb": ["tsch", "ung", "ver", "ß"], "cc": ["日本", "語", "の", "𝄞"]}.items()}


@pytest.fixture(scope="module")
def rows(spark, texts):
    return spark.createDataFrame([(lang, t) for lang, ts in texts.items() for t in ts], "lang string, text string").repartition(4)


def test_equals_plain_kneser_ney(rows, texts):
    model = li.train(rows)
    of = {lang: plain(ts) for lang, ts in texts.items()}
    units = set().union(*(u for _, _, u in of.values()))
    assert model.uniform == 1 / (len(units) + 1) and model.langs == sorted(texts)
    grams = list(set().union(*(g for _, g, _ in of.values())))[:600] + [(32, 97, 98, 99), (1, 2, 3, 4)]
    packed = np.array([sum(u << (48 - 16 * k) for k, u in enumerate(g)) for g in grams], np.uint64)
    got = model.log_probs(packed)
    for j, lang in enumerate(model.langs):
        want = [math.log(of[lang][0](g, 4, model.uniform)) for g in grams]
        assert np.allclose(got[:, j], want, atol=1e-9)


def test_training_in_spark_equals_in_memory(rows, texts):
    a = li.train(rows)
    b = li.estimate({lang: li._tally(np.concatenate([li.grams(t) for t in ts])) for lang, ts in texts.items()})
    for x, y in zip(a.probs + a.backs, b.probs + b.backs, strict=True):
        assert np.array_equal(x.starts, y.starts) and np.array_equal(x.keys, y.keys) and np.allclose(x.values, y.values)


def test_discounts_are_those_of_all_grams(rows):
    """What is left out changes no probability of what is stored, and goes to
    the shorter context."""
    full, cut = li.train(rows), li.train(rows, max_grams=90)
    for k, (x, y) in enumerate(zip(full.probs, cut.probs, strict=True)):
        for j in range(3):
            keys = y.keys[y.starts[j]:y.starts[j + 1]]
            assert len(keys) <= 90 and (k > 1 or len(keys))
            assert np.allclose(x.look(j, keys, -1.0), y.look(j, keys, -2.0))
            ctx = np.unique(keys >> np.uint64(16))
            stored = [y.values[y.starts[j]:y.starts[j + 1]][keys >> np.uint64(16) == c].sum() for c in ctx]
            assert np.allclose(cut.backs[k].look(j, ctx, 1.0), 1 - np.array(stored))
    assert len(cut.probs[-1].keys) < len(full.probs[-1].keys)


def test_model_grows_with_the_sum_of_its_languages():
    rng = np.random.default_rng(1)

    def size(languages):
        counts = {f"l{i:02d}": (np.unique(rng.integers(0, 2**63, 20_000, dtype=np.uint64)), None) for i in range(languages)}
        model = li.estimate({g: (k, rng.integers(1, 5, len(k))) for g, (k, _) in counts.items()})
        return sum(x.nbytes for part in model.arrays()[2:] for t in part for x in t)

    small, large = size(2), size(8)
    assert 3.5 * small < large < 4.5 * small and large < 8 * 8 * 20_000 * 16 * 1.01


def test_no_gram_is_left_out_of_a_large_language(spark):
    """A language of very many grams, all of them rare: all are stored."""
    rng = random.Random(5)
    texts = ["".join(chr(0x4E00 + rng.randrange(20_000)) for _ in range(13_000)) for _ in range(10)]
    model = li.train(spark.createDataFrame([("zz", t) for t in texts] + [("aa", "la le li")], "lang string, text string"))
    keys, n = li._tally(np.concatenate([li.grams(t) for t in texts]))
    full = li.estimate({"zz": (keys, n), "aa": li._tally(li.grams("la le li"))})
    assert len(keys) > 120_000 and np.array_equal(model.probs[-1].keys[model.probs[-1].starts[1]:], keys)
    for x, y in zip(model.probs + model.backs, full.probs + full.backs, strict=True):
        assert np.array_equal(x.keys, y.keys) and np.allclose(x.values, y.values)
