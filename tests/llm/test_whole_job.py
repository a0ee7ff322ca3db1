"""Cases in which an operator did less than its whole job."""

import random
import string
import zlib

import numpy as np
import pytest

from tessera.llm import line_dedup, quality_rules, toxicity


def words(rng, n):
    return ["".join(rng.choices(string.ascii_lowercase, k=rng.randrange(3, 8))) for _ in range(n)]


# --- 2 quality: a rule that fires on a third of clean rows -------------------

@pytest.mark.parametrize("kind", ["capitals", "marks", "symbols"])
def test_quality_keeps_a_hot_source(spark, kind):
    rng = random.Random(7)
    change = {"capitals": str.upper, "marks": lambda t: t.replace(" ", "! ", 12), "symbols": lambda t: t.replace(" ", " # ", 6)}[kind]
    rows = []
    for i in range(900):
        text = " ".join(words(rng, 50))
        rows.append((i, change(text) if i % 3 == 0 else text))
    rows += [(1000 + i, " ".join(w + " | || $" for w in words(rng, 30))) for i in range(60)]
    rows += [(2000 + i, " ".join([*words(rng, 45), *["again"] * 25])) for i in range(60)]
    rows += [(3000 + i, " ".join(w.upper() + "!!" for w in words(rng, 60))) for i in range(60)]
    got = {r.doc_id: r.kept for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert np.mean([k for d, k in got.items() if d < 1000 and d % 3 == 0]) > 0.97
    assert np.mean([k for d, k in got.items() if d < 1000 and d % 3]) > 0.97
    assert not any(k for d, k in got.items() if d >= 1000)


@pytest.mark.parametrize("rule", range(9))
@pytest.mark.parametrize("share", [0.05, 0.15, 0.34])
def test_em_estimates_a_poor_rule(rule, share):
    """Three rules see each kind of junk: fewer do not identify a class."""
    rng = np.random.default_rng(rule)
    n = 40_000
    kind = rng.choice(3, n, p=[0.84, 0.1, 0.06])  # 0 clean, 1 and 2 unlike kinds of junk
    votes = np.where(rng.random((n, 9)) < 0.99, 1, 0)
    for k, at in ((1, [0, 1, 2]), (2, [3, 4, 5])):
        for r in at:
            votes[kind == k, r] = np.where(rng.random((kind == k).sum()) < 0.95, -1, 0)
    hot = (kind == 0) & (rng.random(n) < share / 0.84)
    votes[hot, rule] = -1
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    good, _, whole = quality_rules.fit(patterns, counts.astype(float))
    kept = good[at.ravel()] >= 0.5
    assert kept[hot].mean() > 0.97 and kept[kind == 0].mean() > 0.97
    assert (~kept[kind > 0]).mean() > 0.97 and abs(whole - 0.84) < 0.03


# --- 1 line dedup: short shared passages ------------------------------------

@pytest.mark.parametrize("n", [2, 3, 4, 6, 10, 20])
def test_shared_passages_go_whole(spark, n):
    rng = random.Random(n)

    def lines(k):
        return [" ".join(words(rng, 6)) for _ in range(k)]

    rows, want = [], {}
    for p in range(40):
        passage = lines(n)
        for copy in range(3):
            before, after = lines(3), lines(3)
            rows.append((3 * p + copy, "\n".join([*before, *passage, *after])))
            want[3 * p + copy] = "\n".join([*before, *([] if copy else passage), *after])
    rows += [(1000, None), (1001, ""), (1002, "x"), (1003, "a\nb\na\nb\na\nc"), (1004, "\n\n\n\n")]
    want |= {1000: None, 1001: "", 1002: "x", 1003: "a\nb\nc", 1004: "\n\n\n\n"}
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), all_starts=True).collect()
    assert {r.doc_id: r.text for r in got} == want
    assert all(r.n_removed == (n if r.doc_id % 3 else 0) for r in got if r.doc_id < 1000)


# --- 7 toxicity: words in few rows ------------------------------------------

def rare_rows(per_word, n=1200, toxic=120, length=12, seed=3):
    """(rows, labels): every toxic word is in ``per_word`` training rows and
    in one held-out row, and is the only signal there."""
    rng = random.Random(seed)
    ids = iter(range(10**6))
    clean = [f"w{i}" for i in range(200)]
    rows, labels = [], []

    def add(label, word, held):
        d = next(i for i in ids if (zlib.crc32(str(i).encode()) % 4 == 2) == held)
        w = rng.choices(clean, k=length)
        rows.append((d, " ".join([*w[:length // 2], *([word] if word else []), *w[length // 2:]])))
        labels.append((d, label))

    for k in range(toxic // per_word):
        for _ in range(per_word):
            add(1, f"bad{per_word}x{k}", False)
        add(1, f"bad{per_word}x{k}", True)
    for i in range(n - toxic):
        add(0, None, i % 4 == 0)
    return rows, labels


@pytest.mark.parametrize("per_word", [3, 4])
def test_toxicity_learns_rare_words(spark, per_word):
    rows, labels = rare_rows(per_word, length=2)
    docs, marks = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    truth = dict(labels)
    out = [(r.predicted, truth[r.doc_id]) for r in toxicity.predict(docs, marks).collect() if r.held_out]
    assert np.mean([p for p, t in out if t]) > 0.7 and np.mean([p for p, t in out if not t]) < 0.05



# --- pipeline: exact copies -------------------------------------------------

def test_pipeline_leaves_one_of_exact_copies(spark, tmp_path):
    import corpus_pipeline as P

    rng = random.Random(9)

    def prose(k):
        return "\n".join(" ".join(words(rng, 8)) for _ in range(k))

    rows = []
    for g in range(12):  # groups of 5 copies, of 2 to 13 lines
        text = prose(g + 2)
        rows += [(100 * g + i, text) for i in range(5)]
    first, second = prose(6), prose(6)
    rows += [(5000, first), (5001, second), (5002, f"{first}\n{second}"), (5003, prose(4)), (None, prose(5))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'en' lang", "'src0' source", "length(text) n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = P.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in got), key=lambda d: (d is not None, d)) == [None, *(100 * g for g in range(12)), 5000, 5001, 5003]
    assert all(r.n_tokens > 0 for r in got)
