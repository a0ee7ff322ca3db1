"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features are the presence of words, pairs of neighbours and pairs that skip
one word (lower case; everything but ASCII letters, digits and characters
beyond ASCII parts words), hashed into 2**BITS coordinates, and a bias.  Training
is FTRL-proximal with per-coordinate rates and L1: most weights are exactly
zero, so the broadcast model holds the others only, at most 2**BITS.

The classifier is fitted on a bounded sample: labelled rows in the order of a
hash, about ``max_rows`` of them, as one stream in one task, ``ROUNDS`` times
over.  (Cut into shards whose states are averaged, words in few rows are lost.)
Their coordinates are computed in all tasks before.  A coordinate that one row
holds gains at most one a round, so L1 lies just above the number of rounds:
what a single row holds keeps the weight zero, and a word in a few rows does
not.  Scoring covers every row, in tasks.

Rows: NULL and empty texts have the bias alone, so score the base rate; labels
that are NULL or belong to NULL ids are not learned from; the largest label of
a doc_id counts, and of rows that share a doc_id one text (the one of smallest
hash) is learned from; without any label the score is 0.5; repeated rows score
alike; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import POLY, batch, list_slices, map_arrow, mix, word_hashes, written

BITS = 20
ROUNDS, MAX_ROWS = 15, 12_000
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1.1 * ROUNDS, 0.0
THRESHOLD = 0.3
#: The skipped distances of pairs.
GAPS = (1, 2)
BIAS = 2**BITS

_PARTS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def features(text: str | None) -> np.ndarray:
    """Sorted distinct coordinates; the bias comes last."""
    h = word_hashes((text or "").lower().encode().translate(_PARTS))
    parts = [h, *(h[:-g] * np.uint64(POLY) + h[g:] + np.uint64(g) for g in GAPS if len(h) > g)]
    at = (mix(np.concatenate(parts)) >> np.uint64(64 - BITS)).astype(np.int64)
    return np.append(np.unique(at), BIAS)


class Ftrl:
    """State (z, n) of every coordinate."""

    def __init__(self, z: np.ndarray, n: np.ndarray, l1: float):
        self.z, self.n, self.l1 = z, n, l1

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, l1 = self.z[at], np.where(at == BIAS, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = probability(w.sum()) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def probability(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _coordinates(batches):
    schema = pa.schema([("order", pa.int64()), ("label", pa.int32()), ("at", pa.list_(pa.int32()))])
    for b in batches:
        yield batch(schema, b.column("order"), b.column("label"), [features(t.as_py()).astype(np.int32) for t in b.column("text")])


def stream(rows: list[tuple[np.ndarray, int]], rounds: int = ROUNDS, l1: float = L1) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, weights) that are not zero, after ``rounds`` over the rows."""
    model = Ftrl(np.zeros(BIAS + 1), np.zeros(BIAS + 1), l1)
    for _ in range(rounds):
        for at, label in rows:
            model.learn(at, label)
    w = model.weights(np.arange(BIAS + 1))
    at = np.flatnonzero(w)
    return at, w[at]


def _fit(table: pa.Table) -> pa.Table:
    table = table.sort_by([("order", "ascending")]).combine_chunks()
    at, lo, hi = list_slices(table.column("at").chunk(0))
    found, w = stream([(at[i:j], y) for i, j, y in zip(lo, hi, table.column("label").to_pylist(), strict=True)])
    return pa.table({"at": pa.array(found, pa.int32()), "w": pa.array(w, pa.float64())})


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, weights) that are not zero.  ``labels`` (doc_id, toxic)."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    share = min(1.0, max_rows / max(1, known.count()))
    known = known.withColumn("order", F.xxhash64("doc_id"))
    chosen = known.where(F.pmod("order", F.lit(2**30)) < int(share * 2**30)).where("label in (0, 1)")
    # about max_rows short rows, a bound
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = written(rows.groupBy("doc_id", "label", "order").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "toxic-sample")
    found = map_arrow(rows.select("order", "label", "text"), _coordinates, "order bigint, label int, at array<int>")
    weights = found.groupBy().applyInArrow(_fit, "at int, w double").toArrow()  # at most 2**BITS + 1 rows
    return tuple(weights.column(c).to_numpy() for c in ("at", "w"))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, score) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        w = np.zeros(BIAS + 1)
        w[shared.value[0]] = shared.value[1]
        for b in batches:
            yield batch(schema, b.column("doc_id"), [float(probability(w[features(t.as_py())].sum())) for t in b.column("text")])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_arrow(rows, run, "doc_id bigint, score double")


def held_out():
    """Rows that nothing is learned from: crc32(doc_id) mod 4 is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    model = train(docs, labels.where(~held_out()).select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
