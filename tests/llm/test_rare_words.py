"""Toxicity: words that few labelled rows hold.  Substring dedup: rows without ids."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import substring_dedup, toxicity


def made_up(n, share, rows_a_word, n_clean, seed=0):
    """Training rows and held-out rows of 12 clean words, toxic ones with one
    more word that ``rows_a_word`` training rows hold."""
    rng = random.Random(seed)
    words = [f"c{i}" for i in range(3000)]
    weights = [1 / (i + 10) for i in range(3000)]

    def text(extra=None):
        out = rng.choices(words, weights, k=12)
        if extra is not None:
            out.insert(rng.randrange(13), f"tox{extra}x")
        return " ".join(out)

    toxic = range(int(n * share) // rows_a_word)
    rows = [(text(w), 1) for w in toxic for _ in range(rows_a_word)]
    rows += [(text(), 0) for _ in range(n - len(rows))]
    rng.shuffle(rows)
    return rows, [text(w) for w in toxic], [text() for _ in range(n_clean)]


@pytest.mark.parametrize("n, share, rows_a_word, n_clean, least, alarms", [
    (1200, 0.1, 3, 270, 0.5, 20), (1200, 0.1, 6, 270, 0.85, 6), (12_000, 0.03, 3, 3880, 0.15, 40), (12_000, 0.03, 6, 3880, 0.9, 20), (12_000, 0.03, 10, 3880, 0.95, 20)])
def test_words_in_few_rows_are_learned(n, share, rows_a_word, n_clean, least, alarms):
    rows, toxic, clean = made_up(n, share, rows_a_word, n_clean)
    at, found = toxicity.stream([(toxicity.features(t), y) for t, y in rows])
    w = np.zeros(toxicity.BIAS + 1)
    w[at] = found

    def hits(texts):
        return sum(toxicity.probability(w[toxicity.features(t)].sum()) >= toxicity.THRESHOLD for t in texts)

    assert hits(toxic) >= least * len(toxic) and hits(clean) <= alarms
    assert len(at) < 0.3 * len(np.unique(np.concatenate([toxicity.features(t) for t, _ in rows])))


def test_train_streams_the_sample(spark):
    rows, *_ = made_up(400, 0.1, 8, 0)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id bigint, toxic int")
    order = {r.doc_id: r.o for r in labels.select("doc_id", F.xxhash64("doc_id").alias("o")).collect()}
    want = toxicity.stream([(toxicity.features(rows[i][0]), rows[i][1]) for i in sorted(order, key=order.get)])
    got = toxicity.train(docs, labels)
    assert np.array_equal(got[0], want[0]) and np.allclose(got[1], want[1])


def test_substring_dedup_of_rows_without_ids(spark):
    """Rows that share an id or have none are documents in the order of their
    texts' hashes; equal rows are one document."""
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(None, f"{' '.join(f'w{rng.randrange(50)}' for _ in range(30))} {passage} tail{i}") for i in range(200)]
    rows += [(5, r[1]) for r in rows[:20]] + rows[:50] + [(None, None), (None, ""), (7, passage)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    keyed = df.select("doc_id", "text", F.xxhash64("doc_id", F.col("text").cast("binary")).alias("row")).distinct().collect()
    docs = sorted(keyed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.row))
    found = substring_dedup.brute_force([(k, r.text) for k, r in enumerate(docs)])
    want = {(r.doc_id, r.text): found[k] for k, r in enumerate(docs)}
    got = substring_dedup.digest(substring_dedup.remove_repeats(df)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((d, *want[d, t]) for d, t in rows), key=repr)
