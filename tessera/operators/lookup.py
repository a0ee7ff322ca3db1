"""Small ranked key sets and point lookups into large tables.

Hits, rerank candidates and snippet documents are small, ranked sets, while
the table they index (documents with their text) is the largest in the
system.  A broadcast join would still scan the whole table; when the set is
bounded (checked by a limited collect) it is kept as a local relation (its
plan is not re-run downstream) and its keys become a pushed-down filter.
Parquet reduces a long ``IN`` list to the range from its smallest to its
largest value, which prunes nothing; so the sorted keys are also given as an
OR of at most ``MAX_RANGES`` short ranges, cut at the largest gaps, which the
scan tests one by one against the statistics of every row group and page.  A
long scattered list on a table sorted by the key is dealt to several scans, each
with a run of the sorted keys (``pruned``): every scan tests its keys one by one
and reads the pages that can hold one.  Beyond the bound everything stays
distributed (semi-join, AQE picks the strategy).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LOCAL_ROWS = 10_000
MAX_RANGES = 64
MAX_SCANS = 32
#: Rows of a Parquet page of tables that are looked up by key: what a key costs.
PAGE_ROWS = 1000


def materialize_small(df: DataFrame, max_rows: int = MAX_LOCAL_ROWS) -> DataFrame | None:
    """``df`` as a local relation when it has at most ``max_rows`` rows."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def settle(df: DataFrame, max_rows: int = MAX_LOCAL_ROWS) -> DataFrame:
    """``df`` for several uses without running its plan at each: a local
    relation if small (one run), else its reliable checkpoint (a second run)."""
    from tessera.session import reliable_checkpoint

    return materialize_small(df, max_rows) or reliable_checkpoint(df)


def ranges(values: list, most: int = MAX_RANGES) -> list[tuple]:
    """At most ``most`` (first, last) ranges that cover the sorted values:
    numbers are cut at the largest gaps, other values into even runs."""
    v = sorted(set(values))
    if len(v) <= most:
        return [(x, x) for x in v]
    if isinstance(v[0], (int, float)):
        cuts = sorted(sorted(range(1, len(v)), key=lambda i: v[i - 1] - v[i])[:most - 1])
    else:
        cuts = [len(v) * i // most for i in range(1, most)]
    edges = [0, *cuts, len(v)]
    return [(v[a], v[b - 1]) for a, b in zip(edges, edges[1:], strict=False) if a < b]


def key_filter(key: str, values: list, most: int = MAX_RANGES) -> Column:
    """Rows whose ``key`` is one of ``values``, in a form that prunes."""
    v = [x for x in values if x is not None]
    if not v:
        return F.lit(False)
    c = F.col(key)
    near = reduce(lambda x, y: x | y, (c == F.lit(a) if a == b else c.between(F.lit(a), F.lit(b)) for a, b in ranges(v, most)))
    return near & c.isin(v) if len(set(v)) > most else near


def pruned(table: DataFrame, key: str, values: list, scans: int = MAX_SCANS) -> DataFrame:
    """Rows of a stored table, sorted by ``key``, whose key is one of ``values``:
    at most ``scans`` scans of MAX_RANGES keys or short ranges each.  Every key is
    in one scan, so rows come once."""
    v = sorted({x for x in values if x is not None})
    n = max(1, min(scans, -(-len(v) // MAX_RANGES)))
    size = max(1, -(-len(v) // n))
    parts = [table.where(key_filter(key, v[i:i + size])) for i in range(0, max(1, len(v)), size)]
    return reduce(DataFrame.unionAll, parts)


def lookup(table: DataFrame, keys: DataFrame, key: str = "doc_id",
           max_keys: int = MAX_LOCAL_ROWS) -> DataFrame:
    """Rows of ``table`` whose ``key`` appears in ``keys[key]``."""
    ks = keys.select(key).distinct().limit(max_keys + 1).collect()
    if len(ks) <= max_keys:
        return table.where(key_filter(key, [r[key] for r in ks]))
    return table.join(keys.select(key).distinct(), key, "left_semi")
