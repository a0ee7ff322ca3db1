"""Neighbour votes: against the definition, held-out labels, odd rows."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import neighbour_votes as nv

SF = "/root/testdata/sf0.1"


def good(rng, n=60):
    return " ".join(rng.choice("red stone river walks under seven lights over the old bridge".split()) for _ in range(n)).capitalize() + "."


def junk(rng, n=60):
    return rng.choice([lambda: good(rng, n).upper().replace(" ", "!! "), lambda: good(rng, n).replace(" ", "### "), lambda: " ".join(w for w in good(rng, n // 6).split() for _ in range(8))])()


def labelled(rng, n):
    return [(good(rng), 1) if rng.random() < 0.7 else (junk(rng), 0) for _ in range(n)]


def test_equals_definition(spark):
    rng = random.Random(4)
    rows = [(i, t, y) for i, (t, y) in enumerate(labelled(rng, 400))]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] < 300], "doc_id bigint, quality int")
    order = {r.doc_id: r.o for r in labels.select("doc_id", F.xxhash64("doc_id").alias("o")).collect()}
    sample = sorted(rows[:300], key=lambda r: order[r[0]])
    want = nv.brute_force([r[1:] for r in sample], [r[1] for r in rows])
    got = {r.doc_id: r.score for r in nv.score(docs, nv.train(docs, labels)).collect()}
    assert np.abs(np.array([got[i] for i in range(400)]) - want).max() < 0.02
    assert sum((got[r[0]] >= nv.THRESHOLD) == r[2] for r in rows[300:]) >= 98


def test_vote_takes_the_nearest_of_all_blocks(monkeypatch):
    rng = np.random.default_rng(0)
    x, q, y = nv.unit(rng.normal(size=(500, 8))), nv.unit(rng.normal(size=(40, 8))), rng.integers(0, 2, 500).astype(float)
    whole = nv.vote(q, x, y, 7)
    monkeypatch.setattr(nv, "BLOCK", 60)
    assert np.array_equal(nv.vote(q, x, y, 7), whole)
    c = q @ x.T
    near = np.argsort(-c, 1)[:, :7]
    want = (np.take_along_axis(c, near, 1) * y[near]).sum(1) / np.take_along_axis(c, near, 1).sum(1)
    assert np.abs(whole - want).max() < 1e-3


def test_odd_rows(spark, messy, odd_ids, empty):
    labels = spark.createDataFrame([(i, i % 3 and 1, 0) for i in range(60)] + [(None, 0, 0), (70, None, 0), (71, 5, 0), (3, 0, 0), (400, 1, 0)], "doc_id bigint, quality int, toxic int")
    for docs in (messy, odd_ids):
        out = nv.predict(docs, labels).collect()
        assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
        model = nv.train(docs, labels.where(~nv.held_out()))
        base = model[1].mean()
        blank = {r.doc_id for r in docs.where("text is null or trim(text) = ''").collect()}
        assert blank <= {r.doc_id for r in out if abs(r.score - base) < 1e-9}
    by_text = {}
    for r in nv.predict(messy, labels).join(messy.select("doc_id", "text"), "doc_id").collect():
        by_text.setdefault(r.text, set()).add(round(r.score, 3))
    assert all(len(s) == 1 for s in by_text.values())
    assert nv.predict(empty, labels).count() == 0
    assert {r.score for r in nv.predict(messy, labels.where("1 = 0")).collect()} == {0.5}


def test_labels_of_held_out_rows_do_not_matter(spark, messy):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    other = spark.createDataFrame([(i, 1 - i % 2 if zlib.crc32(str(i).encode()) % 4 == 2 else i % 2) for i in range(60)], "doc_id bigint, quality int")
    a, b = (sorted((r.doc_id, r.score) for r in nv.predict(messy, x).collect()) for x in (labels, other))
    assert a == b


@pytest.mark.skipif(not os.path.exists(SF), reason="test data missing")
def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = nv.predict(docs, labels).where("held_out").join(labels, "doc_id").groupBy("quality", "predicted").count().collect()
    n = {(r.quality, r.predicted): r["count"] for r in out}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.98 and n[0, 0] / (n[0, 0] + n.get((0, 1), 0)) > 0.93
