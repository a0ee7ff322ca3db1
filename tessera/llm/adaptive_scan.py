"""Approximate nearest neighbours: inverted lists with an adaptive dimension scan.

Index.  k-means centroids are fitted on a bounded sample (``SAMPLE`` rows by
hash); *every* valid row goes to the list of its nearest centroid.  Lists are
cut into blocks of about ``BLOCK`` rows by a hash of the id, so a list that
holds a third of all rows is many tasks.

Search.  A query probes its nearest lists; how many is set once from measured
recall: for ``PROBES`` sample queries the true neighbours come from a brute
force pass over all rows, and ``n_probe`` is the smallest number of lists that
holds ``TARGET`` of them.  In a block the vectors are turned by a random
rotation and stored by column blocks.  The distance is summed block by block;
after each, a row whose partial distance, scaled to all dimensions, exceeds the
query's k-th best distance by more than the test's margin (1 + EPSILON /
sqrt(dimensions seen)) is dropped.  Survivors get the exact distance on the
original vectors in double precision, which alone decides rank and score.

Rows: vectors that are NULL, empty, zero, of another length than the most
frequent one, or hold NULL or non-finite components take no part; NULL ids take
no part; rows that share an id are one candidate at its smallest distance;
ties go to the smaller id; other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._common import batch, list_slices, map_arrow, written

SAMPLE, PROBES, TARGET = 20_000, 64, 0.96
LISTS, BLOCK = 64, 2048
COLUMNS, EPSILON = 8, 2.1
#: Ends of the runs that a block is scanned in: the first is summed to the
#: end, each later one starts from the bound that those before it gave.
RUNS = (64, 512)


def valid(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v, dim): rows that take part, v as array<double>."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    rows = rows.where(F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0))
    return rows.withColumn("dim", F.size("v"))


def _matrix(col: pa.Array) -> np.ndarray:
    values, lo, hi = list_slices(col)
    return values[lo[0]:hi[-1]].reshape(len(lo), -1) if len(lo) else np.empty((0, 0))


def _sq(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y, for ranking lists."""
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T, 0)


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of x to q, in double precision."""
    d = x - q
    return np.sqrt((d * d).sum(1))


def centroids(x: np.ndarray, lists: int, seed: int = 7, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm on a bounded sample."""
    x = np.unique(x, axis=0)
    c = x[np.random.default_rng(seed).permutation(len(x))[:lists]]
    for _ in range(rounds):
        near = _sq(x, c).argmin(1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(c))
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))[0]


class Best:
    """The k smallest (distance, id) of distinct ids."""

    def __init__(self, k: int):
        self.k, self.d, self.i = k, np.empty(0), np.empty(0, np.int64)

    def add(self, d: np.ndarray, i: np.ndarray) -> None:
        d, i = np.concatenate((self.d, d)), np.concatenate((self.i, i))
        order = np.lexsort((i, d))
        d, i = d[order], i[order]
        first = np.sort(np.unique(i, return_index=True)[1])[:self.k]
        self.d, self.i = d[first], i[first]

    def bound(self) -> float:
        return float(self.d[-1]) if len(self.d) == self.k else np.inf


def scan(ids: np.ndarray, x: np.ndarray, blocks: list[np.ndarray], query: int, q: np.ndarray, turned: np.ndarray, best: Best) -> None:
    """Adaptive dimension scan of one block for one query."""
    dim = x.shape[1]
    ends = [min(e, len(ids)) for e in RUNS] + [len(ids)]
    for lo, hi in zip([0, *ends], ends, strict=False):
        at, r = np.arange(lo, hi), best.bound()
        at = at[ids[at] != query]
        if np.isfinite(r):
            part, seen = np.zeros(len(at)), 0
            for col in blocks:
                step = col[at] - turned[seen:seen + col.shape[1]]
                part += (step * step).sum(1)
                seen += col.shape[1]
                # rotated single precision: a relative slack keeps ties in
                stay = np.sqrt(part * (dim / seen)) <= r * (1 + (EPSILON / np.sqrt(seen) if seen < dim else 1e-4)) + 1e-9
                at, part = at[stay], part[stay]
        best.add(exact(x[at], q), ids[at])


def _assign(shared):
    schema = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.float64())), ("list", pa.int32())])

    def run(batches):
        for b in batches:
            x = _matrix(b.column("v"))
            yield batch(schema, b.column("vec_id"), b.column("v"), _sq(x, shared.value).argmin(1) if len(x) else [])

    return run


def _probe(shared, n_probe: int):
    schema = pa.schema([("query_id", pa.int64()), ("q", pa.list_(pa.float64())), ("list", pa.int32())])

    def run(batches):
        for b in batches:
            x = _matrix(b.column("v"))
            if len(x):
                near = np.argsort(_sq(x, shared.value), 1, kind="stable")[:, :n_probe]
                rows = np.repeat(np.arange(len(x)), near.shape[1])
                yield batch(schema, b.column("vec_id").take(pa.array(rows)), b.column("v").take(pa.array(rows)), near.ravel())

    return run


def _search(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        out = []
        if left.num_rows and right.num_rows:
            x = _matrix(left.column("v").chunk(0))
            ids = left.column("vec_id").to_numpy()
            turn = rotation(x.shape[1])
            y = (x @ turn).astype(np.float32)
            blocks = [np.ascontiguousarray(y[:, j:j + COLUMNS]) for j in range(0, y.shape[1], COLUMNS)]
            q = _matrix(right.column("q").chunk(0))
            turned = (q @ turn).astype(np.float32)
            for i, query in enumerate(right.column("query_id").to_pylist()):
                best = Best(k)
                scan(ids, x, blocks, query, q[i], turned[i], best)
                out += [(query, int(v), float(d)) for d, v in zip(best.d, best.i, strict=True)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 3, schema, strict=True)], schema=schema)

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    one = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return one.withColumn("rank", rank).where(F.col("rank") <= k)


def _true(shared, k: int):
    """Brute force for the sample queries: a task's k nearest each."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("list", pa.int32())])

    def run(batches):
        best = {q: Best(k) for q, _ in shared.value}
        where: dict[int, int] = {}
        for b in batches:
            x, ids = _matrix(b.column("v")), b.column("vec_id").to_numpy()
            lists = b.column("list").to_numpy()
            for q, v in shared.value:
                at = ids != q
                best[q].add(exact(x[at], v), ids[at])
                where |= {int(i): int(lists[np.flatnonzero(ids == i)[0]]) for i in best[q].i if i in ids}
        for q, f in best.items():
            if len(f.i):
                yield batch(schema, [q] * len(f.i), f.i, f.d, [where[int(i)] for i in f.i])

    return run


def n_probe(indexed: DataFrame, shared, queries: list[tuple[int, np.ndarray]], k: int, target: float) -> int:
    """The smallest number of lists that holds ``target`` of the true
    neighbours of the sample queries."""
    held = indexed.sparkSession.sparkContext.broadcast(queries)
    found = map_arrow(indexed, _true(held, k), "query_id bigint, vec_id bigint, score double, list int")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    true = found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "list").collect()  # k rows a sample query
    order = {q: np.argsort(np.argsort(_sq(v[None], shared.value)[0], kind="stable")) for q, v in queries}
    need = np.sort([order[r[0]][r[1]] + 1 for r in true])
    return int(need[min(len(need) - 1, int(np.ceil(target * len(need))))]) if len(need) else 1


def search(embeddings: DataFrame, queries: DataFrame, k: int = 10, lists: int = LISTS, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row of
    ``queries`` among all other rows of ``embeddings``."""
    spark = embeddings.sparkSession
    rows = valid(embeddings)
    dim = [r[0] for r in rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()]
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not dim:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.col("dim") == dim[0]).select("vec_id", "v")
    wanted = valid(queries).where(F.col("dim") == dim[0]).select("vec_id", "v").dropDuplicates(["vec_id"])
    by_hash = rows.orderBy(F.xxhash64("vec_id"), "vec_id")
    sample = np.array([r[0] for r in by_hash.select("v").limit(SAMPLE).collect()])  # bounded by SAMPLE
    tried = [(r[0], np.array(r[1])) for r in wanted.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PROBES).collect()]
    shared = spark.sparkContext.broadcast(centroids(sample, lists))
    indexed = written(map_arrow(rows, _assign(shared), "vec_id bigint, v array<double>, list int"), "vector-lists")
    probes = n_probe(indexed, shared, tried, k, target)
    sizes = indexed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    sizes = F.broadcast(sizes)  # a row per list
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    left = indexed.join(sizes, "list").withColumn("block", block).select("list", "block", "vec_id", "v")
    asked = map_arrow(wanted, _probe(shared, probes), "query_id bigint, q array<double>, list int")
    right = asked.join(sizes, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("list", "block", "query_id", "q")
    found = left.groupBy("list", "block").cogroup(right.groupBy("list", "block")).applyInArrow(_search(k), "query_id bigint, vec_id bigint, score double")
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
