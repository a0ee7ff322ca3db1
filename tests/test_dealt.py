"""Documents dealt by id: texts are exchanged, not postings."""

import re

from tessera.operators import boolean as B
from tessera.operators import index as I


def exchanges(df) -> set[str]:
    """Columns that the plan exchanges rows by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)}


def parts(spark):
    return [spark.createDataFrame([(1, "a b, c\nb"), (1, "a b, c\nb"), (None, "b -"), (2, None), (3, "--"), (4, "C " * 40)], "doc_id bigint, text string"),
            spark.createDataFrame([(1, "b z"), (5, "q")], "doc_id bigint, text string")]


def test_index_and_merge_exchange_documents_only(spark):
    a, b = map(I.build_index, parts(spark))
    assert exchanges(a.postings) == exchanges(a.staged) == {"doc_id"}
    assert exchanges(I.merge_index(a, b).postings) == {"doc_id"}
    rows = sorted(map(tuple, I.merge_index(a, b).postings.where("doc_id = 1").collect()))
    assert rows == [("a", 1, 2, 10), ("b", 1, 5, 10), ("c", 1, 2, 10), ("z", 1, 1, 10)]


def test_written_index_keeps_repeated_documents(spark):
    for docs in parts(spark):
        index = I.build_index(docs)
        kept = index.materialized()
        for x, y in ((index.postings, kept.postings), (index.doc_stats, kept.doc_stats), (index.postings, index.scanned)):
            assert x.columns == y.columns and sorted(map(str, x.collect())) == sorted(map(str, y.collect()))


def test_search_makes_a_term_once_per_word(spark, monkeypatch):
    import tessera.session as S

    seen, keep = [], S.reliable_checkpoint
    monkeypatch.setattr(S, "reliable_checkpoint", lambda df: (seen.append(df._jdf.queryExecution().executedPlan().toString()), keep(df))[1])
    index = I.build_index(parts(spark)[0])
    B.boolean_search(index, "a AND b OR c AND b OR z", count=10).collect()
    plan = next(p for p in seen if "RLIKE" in p)
    assert re.search(r" IN \(a,b,c,z\)", plan) and " OR " not in plan
