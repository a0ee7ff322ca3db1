"""Helpers shared by the operators: words, hashes, Arrow batches, written tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Rows of one Arrow batch: a batch of long texts must fit a Python worker.
BATCH_ROWS = 1000
#: Stands for a NULL id in keys; NULL ids sort before all others.
NULL_ID = -(2**63)
#: Odd multipliers of the polynomial hashes and of the finaliser (fixed values of splitmix64).
MIX_A, MIX_B, MIX_C = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
POLY = 0xD1342543DE82EF95


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def id_key(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("bigint"), F.lit(NULL_ID))


def from_key(column: str) -> Column:
    return F.when(F.col(column) != F.lit(NULL_ID), F.col(column))


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow`` with batches of at most BATCH_ROWS rows (and, in bytes,
    of ``spark.sql.execution.arrow.maxBytesPerBatch``, which is Spark's own
    bound).  The row bound is a session setting, which stays lowered: cutting
    larger batches inside the task would need memory for the whole of them."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared checkpoint folder:
    cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_hashes(text: bytes | None) -> np.ndarray:
    """64-bit hash of every word ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text."""
    if not text:
        return np.empty(0, np.uint64)
    words = text.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_B)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_C)
    return x ^ (x >> np.uint64(31))


def rolled(h: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash (mod 2**64) of every window of ``width`` word hashes."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for k in range(1, width):
        out *= np.uint64(POLY)
        out += h[k:k + n]
    return mix(out)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values, by doubling."""
    n = len(x) - width + 1
    if n <= 0:
        return np.empty(0, x.dtype)
    span, cur = 1, x
    while span * 2 <= width:
        cur = np.minimum(cur[:-span], cur[span:])
        span *= 2
    return np.minimum(cur[:n], cur[width - span:width - span + n])


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Boolean mask of the n positions covered by windows at ``starts``:
    overlapping windows merge into maximal intervals."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:n]) > 0


def as_i64(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_slices(col: pa.Array):
    """(values, starts, ends) of a list<int64> column; NULL lists are empty."""
    off = col.offsets.to_numpy()
    return col.values.to_numpy(zero_copy_only=False), off[:-1], off[1:]


def batch(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
