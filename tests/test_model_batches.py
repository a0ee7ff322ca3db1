"""VEC-2: a model is loaded once per Python worker; batches hold texts of like length."""

import random

import numpy as np
from pyspark.sql import functions as F

from tessera.functions.vectors import length_batches, model_embedder


def test_loads_and_padding(spark, tmp_path):
    loads, padding = str(tmp_path / "loads"), str(tmp_path / "padding")

    def load():
        import os

        with open(loads, "a") as f:
            f.write(f"{os.getpid()}\n")

        def model(texts):
            with open(padding, "a") as f:
                f.write(f"{len(texts) * max(map(len, texts))} {sum(map(len, texts))}\n")
            return np.array([[len(t), t.count("a")] for t in texts], np.float32)

        return model

    rng = random.Random(1)
    rows = [(i, "ab" * rng.choice([1, 5, 50, 700])) for i in range(3000)] + [(5000, None), (5001, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(24)
    embed = model_embedder(load, dim=2, batch_rows=16)
    for _ in range(3):  # 72 tasks
        got = {r.doc_id: r.v for r in df.select("doc_id", embed(F.col("text")).alias("v")).collect()}
    assert got == {i: [float(len(t or "")), float((t or "").count("a"))] for i, t in rows}
    pids = open(loads).read().split()
    assert len(pids) == len(set(pids)) < 72
    filled, used = np.array([list(map(int, x.split())) for x in open(padding)]).sum(0)
    assert used / filled > 0.75  # 0.3 in the order of the rows


def test_batches_are_bounded():
    rng = random.Random(2)
    lengths = [rng.choice([0, 1, 3, 10, 90, 5000]) for _ in range(500)]
    got = list(length_batches(lengths, 32, 1000))
    assert sorted(i for b in got for i in b) == list(range(500))
    assert all(len(b) <= 32 and (len(b) == 1 or len(b) * max(lengths[i] for i in b) <= 1000) for b in got)
    assert list(length_batches([], 32, 1000)) == []
