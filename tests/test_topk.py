"""Top k by block bounds and clauses from their rarest literal."""

import random

import pytest

from tessera.operators import boolean as B
from tessera.operators import index as I
from tessera.operators import topk

QUERIES = ["the", "the AND of", "rare3", "the AND rare3", "the AND of OR rare1 AND w5", "the AND NOT of", "NOT NOT the AND rare2", "the OR of OR w1 OR w2",
           "nowhere", "the AND nowhere", "NOT the", "NOT the OR rare1", "the AND the", "AND the", "", "w3 AND w4 AND w5 AND NOT rare1", "NOT nowhere AND w9"]


def corpus(n=3000, seed=4):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    out = []
    for i in range(n):
        t = ["the"] * rnd.randrange(4) + ["of"] * rnd.randrange(3) + rnd.choices(words, [1 / (k + 1) for k in range(200)], k=rnd.randrange(5, 40))
        if i % 500 == 7:
            t += ["the"] * 60  # a few documents far above the rest
        if i % 700 == 3:
            t.append(f"rare{i % 4}")
        rnd.shuffle(t)
        out.append((i, " ".join(t)))
    return out


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("topk") / "index")
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string").repartition(4)
    I.write_index(I.build_index(docs), path, block_docs=50, hot_df=20)
    return I.read_index(spark, path)


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.doc_id, r.score) for r in df.collect())


@pytest.mark.parametrize("count", [1, 10])
def test_equals_boolean_search(spark, index, count):
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id bigint, query string")
    assert rows_of(topk.top_hits(index, queries, count)) == rows_of(B.boolean_search(index, queries, count))


def test_blocks_below_the_kth_score_are_skipped(index):
    seen = {}
    got = rows_of(topk.top_hits(index, "the", 3, seen=seen))
    assert got == rows_of(B.boolean_search(index, "the", 3)) and len(got) == 3
    assert seen["blocks"] == 60 and seen["scored"] <= 12


def test_rows_follow_the_rarest_word(spark, index):
    queries = spark.createDataFrame([(0, "the AND rare3")], "query_id bigint, query string")
    literals, _ = B.parse_boolean(queries)
    df = {r.term: r.df for r in index.term_stats().where("term in ('the', 'rare3')").collect()}
    lits = topk._literals(index, literals.collect(), df, index.num_docs())
    chosen = spark.createDataFrame([(0, b) for b in range(60)], "query_id bigint, block bigint")
    got = topk.block_matches(index, lits, chosen).count()
    assert df["the"] > 1500 and got <= 2 * df["rare3"]
    assert B.literal_matches(index, literals).count() > 1500


def test_few_posting_rows_are_read(spark, tmp_path):
    """Row groups of 300 postings: a search reads those of its blocks."""
    from test_plans import rows_read

    path = str(tmp_path / "index")
    docs = spark.createDataFrame([(i, " ".join(["the"] * (50 if i in (78, 4100, 9000) else 1 - i % 2) + [f"w{i % 5}"] * 9)) for i in range(10_000)], "doc_id bigint, text string")
    keep = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "300")
    try:
        I.write_index(I.build_index(docs), path, block_docs=100)
    finally:
        spark.conf.set("spark.sql.files.maxRecordsPerFile", keep)
    idx = I.read_index(spark, path)
    lits = topk._literals(idx, B.parse_boolean(spark.createDataFrame([(0, "the")], "query_id bigint, query string"))[0].collect(), {"the": 5000}, 10_000)
    bound = topk.block_bounds(topk.bounds(idx, ["the"], {"the"}), lits)
    best = sorted(bound.collect(), key=lambda r: -r.bound)[:3]
    assert sorted(r.block for r in best) == [0, 41, 90]
    scan = idx.postings.where(topk._scan_filter(idx, [("the", r.block) for r in best]))
    assert scan.count() == 150 and rows_read(scan) <= 2000
    assert rows_of(topk.top_hits(idx, "the", 3)) == rows_of(B.boolean_search(idx, "the", 3))


def test_index_without_blocks_and_many_literals(spark, index, monkeypatch):
    docs = spark.createDataFrame(corpus(60), "doc_id bigint, text string")
    idx = I.build_index(docs)
    assert rows_of(topk.top_hits(idx, "the AND of", 5)) == rows_of(B.boolean_search(idx, "the AND of", 5))
    monkeypatch.setattr(B, "MAX_PUSHDOWN_TERMS", 1)
    assert rows_of(topk.top_hits(index, "the AND of", 5)) == rows_of(B.boolean_search(index, "the AND of", 5))
    assert topk.top_hits(index, "AND", 5).count() == 0
