"""Plan properties the scale design relies on (checked on executed plans)."""

import contextlib
import io
import re

from tessera.operators import boolean as B
from tessera.operators import index as I

SF = "/root/testdata/sf0.01"


def plan_of(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_search_on_stored_index(spark, tmp_path):
    from tessera.sources.corpus import read_corpus

    path = str(tmp_path / "idx")
    I.write_index(I.build_index(read_corpus(spark, SF)), path)
    idx = I.read_index(spark, path)
    plan = plan_of(B.boolean_search(idx, "the AND of OR der AND und", count=10))
    # the query terms reach both Parquet scans (postings and term stats)
    assert len(re.findall(r"PushedFilters: \[[^\]]*EqualTo\(term", plan)) == 2
    # partial top-k before the exchange, final after it
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    # no sort-merge join: literals are broadcast
    assert "SortMergeJoin" not in plan
    # shuffles: one on (query_id, doc_id) for scoring, one on query_id for top-k
    hashed = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    keys = sorted({re.sub(r",\s*\d+$", "", re.sub(r"#\d+L?", "", h)).replace(" ", "") for h in hashed})
    assert keys == ["query_id", "query_id,doc_id"], keys


def test_index_build_single_hash_exchange(spark):
    from tessera.sources.corpus import read_corpus

    plan = plan_of(I.build_index(read_corpus(spark, SF)).postings)
    assert len(re.findall(r"Arguments: hashpartitioning", plan)) == 1
    # tokenising is not pushed into the scan (no inferred size filter there)
    scan = [l for l in plan.splitlines() if l.startswith("DataFilters")]
    assert not any("split" in l for l in scan)


def rows_read(df) -> int:
    """Rows that the scans of a plan without exchange gave out."""
    df = df.select("*")
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        total += leaves.apply(i).metrics().apply("numOutputRows").value()
    return total


def test_lookups_read_few_rows(spark, tmp_path):
    """Rows that the scan gives out for 5, 20 and 1,000 ids, of 5,000 in 50
    files; an ``IN`` list alone reads all of them from 11 ids on."""
    import random

    from tessera.operators.lookup import key_filter, lookup

    path = str(tmp_path / "t")
    spark.range(5000).selectExpr("id doc_id", "concat('w', lpad(id, 5, '0')) term").repartitionByRange(50, "doc_id").write.parquet(path)
    table = spark.read.parquet(path)
    rng = random.Random(1)
    for n, most in ((5, 600), (20, 2200)):
        ids = rng.sample(range(5000), n)
        keys = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
        assert sorted(r.doc_id for r in lookup(table, keys).collect()) == sorted(ids)
        assert rows_read(lookup(table, keys)) <= most
        assert rows_read(table.where(key_filter("term", [f"w{i:05d}" for i in ids]))) <= most
    near = [*range(700, 1200), *range(4000, 4500)]
    hit = table.where(key_filter("doc_id", near))
    assert hit.count() == 1000 and rows_read(hit) <= 1400


def test_one_word_reads_its_row_groups(spark, tmp_path):
    from tessera.sources.corpus import read_corpus

    path = str(tmp_path / "idx")
    I.write_index(I.build_index(read_corpus(spark, SF)), path, num_partitions=40)
    idx = I.read_index(spark, path)
    plan = plan_of(B.term_postings(idx, "the"))
    assert len(re.findall(r"PushedFilters: \[[^\]]*EqualTo\(term,the\)", plan)) == 2


def test_porter_search_keeps_stemmer_off_token_stream(spark):
    """The stemmed vocabulary is materialised: filtering postings by stems
    must not put the Python stemmer into the search plan (it would run per
    token occurrence, carrying each document's word array)."""
    from pyspark.sql import functions as F

    from tessera.sources.corpus import read_corpus

    idx = I.build_index(read_corpus(spark, "/root/testdata/sf0.001"), "porter")
    plan = plan_of(idx.postings.where(F.col("term").isin("licens", "queen")))
    assert "ArrowEvalPython" not in plan
