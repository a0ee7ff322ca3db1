"""VEC-1/3/4, AGG-13/14: embeddings and vector arithmetic as expressions.

Default embedder (offline, deterministic): the first ``max_words`` words of
the reduced text, punctuation deleted, lower-cased, each hashed to one of
``dim`` buckets (first 8 hex digits of its MD5, modulo ``dim``); the vector is
the bucket counts (sum pooling).  Kept sparse as ``(id, bucket, cnt)`` rows so
a document only carries its non-zero buckets; cosines are computed from the
exact integer counts (``dot / sqrt(|a|^2 |b|^2)``), so every engine agrees.
A user model plugs in instead through :func:`model_embedder`.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import has_token, split_words, strip_punctuation

EMBED_DIM = 768        # fixed value: embedding width
EMBED_MAX_WORDS = -1   # words embedded per document: all of them


def word_bucket(word, dim: int = EMBED_DIM) -> Column:
    w = F.col(word) if isinstance(word, str) else word
    return (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % dim).cast("int")


def embed_words(text, max_words: int = EMBED_MAX_WORDS) -> Column:
    """The words of the reduced text (STR-9), only the first ``max_words`` if
    that is positive, before normalisation.  Reducing (right-strip lines, drop empty ones, join with
    spaces) only changes whitespace, so these are the first words of the
    whitespace split of the text itself."""
    t = F.col(text) if isinstance(text, str) else text
    words = split_words(t)
    return F.slice(words, 1, max_words) if max_words > 0 else words


def hash_embed(df: DataFrame, id_col: str, text_col: str, max_words: int = EMBED_MAX_WORDS,
               dim: int = EMBED_DIM) -> DataFrame:
    """VEC-1 / AGG-13: sparse sum-pooled hash embedding (id, bucket, cnt):
    each embedded word has its punctuation deleted and is lower-cased; words
    left empty are skipped.

    Per-document work (explode + partial aggregate) stays in the task that
    holds the document; the exchange carries at most ``dim`` rows per doc."""
    # explode_outer: see build_index (no inferred size filter below the spread)
    words = (df.select(F.col(id_col).alias("id"), F.explode_outer(embed_words(text_col, max_words)).alias("w0"))
             .where(has_token("w0")).select("id", F.lower(strip_punctuation("w0")).alias("w")))
    return (words.groupBy("id", word_bucket("w", dim).alias("bucket"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("cnt")))


def sparse_norms(sparse: DataFrame) -> DataFrame:
    """AGG-14: squared L2 norm per id (exact for counts)."""
    return sparse.groupBy("id").agg(F.sum(F.col("cnt") * F.col("cnt")).alias("sq"))


def dot(a, b) -> Column:
    """VEC-4 building block: inner product of two array columns (double)."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(ca.cast("array<double>"), cb.cast("array<double>"), lambda x, y: x * y),
                       F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v) -> Column:
    """VEC-3: unit vector; a zero vector stays zero."""
    c = F.col(v) if isinstance(v, str) else v
    n = l2_norm(c)
    return F.transform(c.cast("array<double>"), lambda x: F.when(n == 0, F.lit(0.0)).otherwise(x / n))


def cosine(a, b) -> Column:
    """VEC-4: cosine similarity; NULL when either vector is zero (Q17)."""
    d = dot(a, b)
    den = l2_norm(a) * l2_norm(b)
    return F.when(den == 0, F.lit(None).cast("double")).otherwise(d / den)


def _kept(key: str, load):
    """What ``load()`` gave under ``key`` in this Python process.  Spark keeps its
    Python workers from task to task, but unpickles functions for each; so the
    store hangs on a module of its own.  The last two models are kept."""
    store = sys.modules.setdefault("tessera_kept_models", types.ModuleType("tessera_kept_models")).__dict__.setdefault("models", {})
    if key not in store:
        while len(store) > 1:
            del store[next(iter(store))]
        store[key] = load()
    return store[key]


def length_batches(lengths: list[int], batch_rows: int, batch_chars: int) -> Iterator[list[int]]:
    """Places of texts in batches of like length, shortest first: at most
    ``batch_rows`` texts that take ``batch_chars`` when all are filled up to
    the longest of them (or one longer text)."""
    batch: list[int] = []
    for i in sorted(range(len(lengths)), key=lengths.__getitem__):
        if batch and (len(batch) >= batch_rows or (len(batch) + 1) * lengths[i] > batch_chars):
            yield batch
            batch = []
        batch.append(i)
    if batch:
        yield batch


def model_embedder(load_model, dim: int, batch_rows: int = 64, batch_chars: int = 1 << 20):
    """VEC-2: wrap a user model as an iterator-of-batches Arrow UDF.

    ``load_model()`` runs once per Python worker, whatever the number of tasks
    that it serves, and must return a callable ``list[str] -> ndarray (n, dim)``.
    It is given texts of like length at once (:func:`length_batches`), so that a
    model that fills a batch up to its longest text wastes little.  Use it on
    the reduced texts: ``df.select(udf(reduced_text('text', 512)))``."""
    from pyspark.sql import types as T

    key = uuid.uuid4().hex  # one per embedder

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _kept(key, load_model)
        for texts in batches:
            vals = texts.fillna("").tolist()
            out: list = [None] * len(vals)
            for at in length_batches(list(map(len, vals)), batch_rows, batch_chars):
                rows = np.asarray(model([vals[i] for i in at]), dtype=np.float32).reshape(-1, dim)
                for i, row in zip(at, rows, strict=True):
                    out[i] = row
            yield pd.Series(out)

    return _embed
