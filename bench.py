"""Headline benchmark.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.  Every timed run executes its
plan to completion with the ``noop`` sink (all rows computed, nothing
collected); after one warm-up run the median of ``$BENCH_REPEATS`` (default
3) timed runs is reported.

Two kinds of entries:
* registry queries (``tessera.plans.catalog``), end to end from the raw
  tables: tokenising, index build, search, rerank, kNN;
* ``index_build`` (documents -> range-partitioned, sorted Parquet index, the
  reference's offline step) and ``*@index`` queries that run against that
  stored index, as the reference's query scripts do.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "postings_tf",
    "bool_flagship",
    "bool_batch",
    "hit_snippets",
    "ml_search_all",
    "knn_topk",
    "near_duplicates",
    "near_duplicates_lsh",
    "index_build",
    "bool_flagship@index",
    "bool_batch@index",
    "ml_search_all@index",
]


def _to_noop(df) -> None:
    """Execute a DataFrame's plan to completion without collecting it."""
    df.write.format("noop").mode("overwrite").save()


def indexed_queries(spark, sf_dir):
    """Work items for the stored-index entries (the index is written once,
    outside the timed region; ``index_build`` times that write itself)."""
    from tessera.operators import boolean as B
    from tessera.operators import index as I
    from tessera.operators.rerank import ml_search
    from tessera.plans.catalog import BATCH_COUNT, BATCH_QUERIES, FLAGSHIP_QUERY, ML_QUERIES, _queries_df
    from tessera.session import scratch_path
    from tessera.sources.corpus import read_corpus

    docs = read_corpus(spark, sf_dir)
    path = scratch_path(spark, "bench-index")
    I.write_index(I.build_index(docs), path)

    def stored():
        return I.read_index(spark, path)

    return {
        "index_build": lambda: I.write_index(I.build_index(read_corpus(spark, sf_dir)),
                                             scratch_path(spark, "bench-index-build")),
        "bool_flagship@index": lambda: _to_noop(B.boolean_search(stored(), FLAGSHIP_QUERY, count=10)),
        "bool_batch@index": lambda: _to_noop(B.boolean_search(stored(), _queries_df(spark, BATCH_QUERIES),
                                                              count=BATCH_COUNT)),
        "ml_search_all@index": lambda: _to_noop(ml_search(stored(), docs, _queries_df(spark, ML_QUERIES),
                                                          match="all")),
    }


def duckdb_times(names, sf_dir, cpus, repeats) -> dict[str, float]:
    """Medians of the same entries' SQL statements on the same files, taken in
    the same run ($BENCH_DUCKDB=1); entries that compare all pairs of documents
    are left out, as their statements spill without bound."""
    import duckdb

    from tessera.plans.catalog import ORACLE
    from tessera.sources.corpus import TABLES

    con = duckdb.connect(config={"threads": int(cpus)})
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    out = {}
    for name in names:
        if name in ORACLE and not name.startswith("near_duplicates"):
            times = []
            for _ in range(repeats + 1):
                t0 = time.perf_counter()
                con.execute(ORACLE[name]).fetchall()
                times.append(time.perf_counter() - t0)
            out[name] = round(statistics.median(times[1:]), 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from tessera.plans.catalog import QUERIES
    from tessera.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="tessera-bench")
    names = only or HEADLINE
    fns = {n: (lambda f=QUERIES[n]: _to_noop(f(spark, sf_dir))) for n in names if n in QUERIES}
    if any("@" in n or n == "index_build" for n in names):
        extra = indexed_queries(spark, sf_dir)
        fns.update({n: extra[n] for n in names if n in extra})
    times: dict[str, float] = {}
    for name in names:
        if name not in fns:
            continue
        fn = fns[name]

        def run() -> float:
            t0 = time.perf_counter()
            fn()
            return time.perf_counter() - t0

        run()
        times[name] = round(statistics.median(run() for _ in range(repeats)), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    try:
        sf_val: float | str = float(sf)
    except ValueError:
        sf_val = sf
    more = {"duckdb": duckdb_times(names, sf_dir, cpus, repeats)} if os.environ.get("BENCH_DUCKDB") else {}
    print(json.dumps(more | {
        "metric": "headline_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_val,
        "cpus": int(cpus),
        "repeats": repeats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
