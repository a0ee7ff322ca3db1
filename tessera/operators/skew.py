"""Joins against a per-key table when some keys are hot.

``skew_split_join(big, small, key, size_col)``: ``small`` has one row per key
and knows how many ``big`` rows share it (``size_col``).  Keys above
``hot_rows`` are few by construction (their sizes add up to at most
``|big|``, so there are at most ``|big| / hot_rows`` of them).  Their keys and
their rows of ``small`` are written once and broadcast if the written bytes
stay below ``MAX_BROADCAST_BYTES``; the matching ``big`` rows join them where
they are, without a shuffle.  All other keys hold at most ``hot_rows`` rows
each, so the shuffle join of the rest has no hot partition.  Hot rows are told
apart by joins, never by literal lists, so keys of any type will do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_path, shuffles_freed

DEFAULT_HOT_ROWS = 200_000
MAX_BROADCAST_BYTES = 32 << 20


def written_bytes(df: DataFrame) -> int:
    """Spark's size statistic of a scan of written files: their bytes."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def write_once(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` as a table in the shared folder (survives a lost executor)."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_vectors(df: DataFrame, name: str) -> DataFrame:
    """``write_once`` for vectors, in zstd: counts take far fewer bytes than in a
    checkpoint."""
    return write_once(df, name, compression="zstd")


DEAL_BYTES = 2 << 20  # estimated bytes of documents (ids and texts, stored) of a task
UNKNOWN_BYTES = 1 << 44
MOST_DEALT = 20       # tasks for every shuffle partition at most


def deal_parts(df: DataFrame) -> int | None:
    """Partitions that ``dealt`` makes of ``df``: small ones, so that a task's
    counts fit its memory; the estimate is Spark's of the plan, where it has one."""
    spark = df.sparkSession
    size = written_bytes(df)
    if size >= UNKNOWN_BYTES:
        return None
    most = MOST_DEALT * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(-(-size // DEAL_BYTES), most), spark.sparkContext.defaultParallelism)


def dealt(df: DataFrame, key: str = "doc_id", parts: int | None = None) -> DataFrame:
    """``df`` hash-partitioned by ``key``.  Documents travel once, and what is
    counted per document after it needs no exchange: a word's counts are several
    times as large as the word."""
    parts = parts or deal_parts(df)
    return df.repartition(parts, key) if parts else df.repartition(key)


def skew_split_join(big: DataFrame, small: DataFrame, key: str, size_col: str,
                    hot_rows: int = DEFAULT_HOT_ROWS, max_bytes: int = MAX_BROADCAST_BYTES,
                    sizes: DataFrame | None = None) -> DataFrame:
    """``sizes`` (key, size_col): a cheap (materialised) table to find the hot
    keys with; by default ``small`` itself, whose plan then runs once for the
    detection."""
    src = sizes if sizes is not None else small
    keys = write_once(src.where(F.col(size_col) > hot_rows).select(key), "hot-keys")
    if keys.isEmpty():
        return big.join(small, key)
    if written_bytes(keys) > max_bytes:
        return big.join(small, key)  # AQE splits skewed partitions
    hot = write_once(small.join(F.broadcast(keys), key, "left_semi").select(*small.columns), "hot-rows")
    if written_bytes(hot) > max_bytes:
        return big.join(small, key)
    out = big.join(F.broadcast(hot), key)
    cold = (big.join(F.broadcast(keys), key, "left_anti")
            .join(small.join(F.broadcast(keys), key, "left_anti"), key))
    return out.unionByName(cold)
