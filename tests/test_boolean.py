"""Golden micro-corpus (FIXTURES §3) and posting-list algebra."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import boolean as B
from tessera.operators import index as I

GOLDEN = [
    ("rain", [(0, 0.666667), (2, 0.5), (4, 0.333333)]),
    ("rain AND moon", [(2, 1.0), (4, 0.666667)]),
    ("rain OR dog", [(3, 0.792481), (0, 0.666667), (2, 0.5), (1, 0.396241), (4, 0.333333)]),
    ("NOT rain", [(1, 0.0), (3, 0.0), (5, 0.0)]),
    ("sun AND NOT rain", [(1, 0.25)]),
    ("rain AND moon OR dog", [(2, 1.0), (3, 0.792481), (4, 0.666667), (1, 0.396241)]),
    ("rain OR rain", [(0, 1.333333), (2, 1.0), (4, 0.666667)]),
    ("rain AND rain", [(0, 1.333333), (2, 1.0), (4, 0.666667)]),
    ("NOT NOT sun", [(0, 0.0), (1, 0.0), (4, 0.0)]),
    ("rain sun", [(0, 0.666667), (2, 0.5), (4, 0.333333)]),
    ("foo NOT rain", [(1, 0.0), (3, 0.0), (5, 0.0)]),
    ("star OR NOT moon", [(5, 2.584963), (0, 0.0), (3, 0.0)]),
    ("zzz", []),
    ("zzz OR sun", [(0, 0.333333), (4, 0.333333), (1, 0.25)]),
    ("dog's", []),
]
INVALID = ["", "AND rain", "rain OR", "NOT"]


@pytest.fixture(scope="module")
def micro_index(micro_docs):
    return I.build_index(micro_docs, "lower")


def test_postings(micro_index):
    got = {(r.term, r.doc_id): r.tf for r in micro_index.postings.collect()}
    want = {("rain", 0): 2, ("rain", 2): 1, ("rain", 4): 1, ("sun", 0): 1, ("sun", 1): 1, ("sun", 4): 1,
            ("moon", 1): 1, ("moon", 2): 1, ("moon", 4): 1, ("dog", 1): 1, ("dog", 3): 1, ("dogs", 3): 1,
            ("star", 5): 1}
    assert got == want
    lens = {r.doc_id: r.doc_len for r in micro_index.doc_stats.collect()}
    assert lens == {0: 3, 1: 4, 2: 2, 3: 2, 4: 3, 5: 1}


def test_golden_batch(spark, micro_index):
    rows = [(i, q) for i, (q, _) in enumerate(GOLDEN)] + [(100 + i, q) for i, q in enumerate(INVALID)]
    qdf = spark.createDataFrame(rows, "query_id bigint, query string")
    hits = B.boolean_search(micro_index, qdf, count=None).collect()
    by_q = {}
    for r in sorted(hits, key=lambda r: (r.query_id, r.rank)):
        by_q.setdefault(r.query_id, []).append((r.doc_id, round(r.score, 6)))
    for i, (q, want) in enumerate(GOLDEN):
        assert by_q.get(i, []) == want, q
    for i in range(len(INVALID)):
        assert 100 + i not in by_q
    status = {r.query_id: r.status for r in B.search_status(micro_index, qdf).collect()}
    assert all(status[100 + i] == "invalid" for i in range(len(INVALID)))
    assert all(status[i] == "ok" for i in range(len(GOLDEN)))


def test_single_query_string(micro_index):
    hits = B.boolean_search(micro_index, "rain AND moon", count=1).collect()
    assert [(r.rank, r.doc_id) for r in hits] == [(1, 2)]


def _as_dict(df):
    return {r.doc_id: round(r.score, 6) for r in df.collect()}


def test_posting_algebra(micro_index):
    rain = B.term_postings(micro_index, "rain")
    moon = B.term_postings(micro_index, "moon")
    dog = B.term_postings(micro_index, "dog")
    st = micro_index.doc_stats
    assert _as_dict(B.and_postings(rain, moon)) == {2: 1.0, 4: 0.666667}
    assert _as_dict(B.or_postings(rain, dog)) == {3: 0.792481, 0: 0.666667, 2: 0.5, 1: 0.396241, 4: 0.333333}
    assert _as_dict(B.not_postings(rain, st)) == {1: 0.0, 3: 0.0, 5: 0.0}
    # Q2 fix: document 0 survives "NOT x AND y"
    assert set(_as_dict(B.not_and_postings(moon, rain))) == {0}
    assert set(_as_dict(B.not_or_postings(rain, moon, st))) == {1, 2, 3, 4, 5}


def test_flat_dnf_equals_algebra(spark, micro_index):
    """Property: the one-aggregation plan equals composing JN-1..JN-3."""
    import random

    words = ["rain", "sun", "moon", "dog", "star", "zzz"]
    rnd = random.Random(7)
    st = micro_index.doc_stats
    cache = {w: B.term_postings(micro_index, w) for w in words}

    def lit_df(neg, w):
        p = cache[w]
        return B.not_postings(p, st) if neg else p

    cases = []
    for qi in range(12):
        clauses = []
        for _ in range(rnd.randint(1, 2)):
            clauses.append([(rnd.random() < 0.3, rnd.choice(words)) for _ in range(rnd.randint(1, 2))])
        text = " OR ".join(" AND ".join(("NOT " if n else "") + w for n, w in c) for c in clauses)
        cases.append((qi, text, clauses))
    qdf = spark.createDataFrame([(i, t) for i, t, _ in cases], "query_id bigint, query string")
    hits = B.boolean_search(micro_index, qdf, count=None).collect()
    got = {}
    for r in hits:
        got.setdefault(r.query_id, {})[r.doc_id] = round(r.score, 6)
    for qi, text, clauses in cases:
        total = None
        for c in clauses:
            acc = lit_df(*c[0])
            for lit in c[1:]:
                acc = B.and_postings(acc, lit_df(*lit))
            total = acc if total is None else B.or_postings(total, acc)
        assert got.get(qi, {}) == _as_dict(total), text


def test_merge_postings(micro_docs, micro_index):
    a = I.build_index(micro_docs.where(F.col("doc_id") < 3))
    b = I.build_index(micro_docs.where(F.col("doc_id") >= 3))
    merged = I.merge_index(a, b)
    key = lambda df: sorted(tuple(r) for r in df.select("term", "doc_id", "tf", "doc_len").collect())
    assert key(merged.postings) == key(micro_index.postings)


def test_merge_adds_up_a_cut_document(spark):
    a = I.build_index(spark.createDataFrame([(0, "rain sun"), (1, "star")], "doc_id bigint, text string"))
    b = I.build_index(spark.createDataFrame([(0, "rain"), (2, "sun")], "doc_id bigint, text string"))
    m = I.merge_index(a, b)
    assert sorted(tuple(r) for r in m.postings.collect()) == [
        ("rain", 0, 2, 3), ("star", 1, 1, 1), ("sun", 0, 1, 3), ("sun", 2, 1, 1)]
    assert sorted(tuple(r) for r in m.doc_stats.collect()) == [(0, 3), (1, 1), (2, 1)]
    assert {r.term: r.df for r in m.term_stats().collect()} == {"rain": 1, "star": 1, "sun": 2}
    with pytest.raises(ValueError):
        I.merge_index(a, I.Index(b.postings, b.doc_stats, "porter"))


def test_posting_chunks_concatenate(micro_index):
    rows = I.posting_lists(micro_index.postings, chunk=2).collect()
    assert max(len(r.postings) for r in rows) <= 2
    whole = {r.term: r.postings for r in I.posting_lists(micro_index.postings).collect()}
    got = {}
    for r in sorted(rows, key=lambda r: (r.term, r.chunk)):
        got.setdefault(r.term, []).extend(r.postings)
    assert got == whole


def test_large_query_table_path_equals_the_small_one(spark, micro_index, monkeypatch):
    """With the literal bound at 0 everything is a shuffle join: same hits, no
    nested loop or cartesian product over documents."""
    qs = spark.createDataFrame([(i, q) for i, (q, *_) in enumerate(
        [("rain AND moon OR dog",), ("NOT rain",), ("star OR NOT moon",), ("zzz",), ("NOT moon AND NOT dog",)])], "query_id bigint, query string")
    want = sorted(tuple(r) for r in B.boolean_search(micro_index, qs, count=None).collect())
    monkeypatch.setattr(B, "MAX_BROADCAST_LITERALS", 0)
    hits = B.boolean_search(micro_index, qs, count=None)
    assert sorted(tuple(r) for r in hits.collect()) == want
    lits, _ = B.parse_boolean(qs)
    plan = B.literal_matches(micro_index, lits)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan.split("== Physical Plan ==")[1]


@pytest.mark.parametrize("keys", [[("hot", 50), ("cold", 1)], [(7, 50), (8, 1)], [((1, 2), 50), ((1, 3), 1)]])
def test_skew_split_join_keys(spark, keys):
    from tessera.operators.skew import skew_split_join

    kind = {str: "string", int: "bigint", tuple: "struct<a:int,b:int>"}[type(keys[0][0])]
    big = spark.createDataFrame([(k, i) for k, n in keys for i in range(n)], f"k {kind}, v bigint")
    small = spark.createDataFrame([(k, f"tag{n}", n) for k, n in keys], f"k {kind}, tag string, n bigint")
    want = sorted(repr(r) for r in big.join(small, "k").collect())
    for kw in ({"hot_rows": 1}, {"hot_rows": 10}, {"hot_rows": 10, "max_bytes": 0}, {"hot_rows": 1000}):
        assert sorted(repr(r) for r in skew_split_join(big, small, "k", "n", **kw).collect()) == want


def test_skew_split_join_hot_path(spark):
    from tessera.operators.skew import skew_split_join

    big = spark.createDataFrame([("hot", i) for i in range(50)] + [("cold", 1), ("x", 2)], "k string, v bigint")
    small = spark.createDataFrame([("hot", "H", 50), ("cold", "C", 1), ("x", "X", 1)], "k string, tag string, n bigint")
    want = sorted(tuple(r) for r in big.join(small, "k").collect())
    got = sorted(tuple(r) for r in skew_split_join(big, small, "k", "n", hot_rows=5).select(*big.join(small, "k").columns).collect())
    assert got == want


def test_rank_all_matches_window(spark, micro_index):
    qdf = spark.createDataFrame([(0, "NOT star"), (1, "rain OR sun OR moon")], "query_id bigint, query string")
    all_ranked = {(r.query_id, r.rank): (r.doc_id, r.score) for r in B.boolean_search(micro_index, qdf, count=None).collect()}
    top = {(r.query_id, r.rank): (r.doc_id, r.score) for r in B.boolean_search(micro_index, qdf, count=100).collect()}
    assert all_ranked == top and len(all_ranked) == 9


def test_measured_facts_sf001(spark):
    """Numbers measured independently in FIXTURES §2 (documents, sf0.01)."""
    import os

    import pytest

    sf = "/root/testdata/sf0.01"
    if not os.path.exists(sf):
        pytest.skip("test data missing")
    from tessera.sources.corpus import read_corpus

    idx = I.build_index(read_corpus(spark, sf))
    q = spark.createDataFrame([(0, "the AND of OR der AND und"), (1, "the AND of"), (2, "der AND und"),
                               (3, "NOT the"), (4, "queen")], "query_id bigint, query string")
    hits = {r.query_id: r.n_hits for r in B.search_status(idx, q).collect()}
    assert hits == {0: 683, 1: 569, 2: 117, 3: 385, 4: 23}
    top = [(r.doc_id, round(r.score, 9)) for r in B.boolean_search(idx, "queen", count=5).orderBy("rank").collect()]
    assert top == [(664, 0.050158731), (754, 0.049474748), (510, 0.041228957), (10, 0.038597321), (644, 0.03127714)]
    assert idx.postings.count() == 249825
    assert idx.postings.select("term").distinct().count() == 68785
