"""The registered queries and the pipeline on the smallest tables."""

import os
import re

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data missing")


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_all_are_registered():
    import __spark_entry__ as E

    names = [n for n in E.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert len(names) == len({n.split("_")[0] for n in names}) and {n.split("_")[0] for n in names} == {"pipeline", *(f"op{i}" for i in range(1, 14))}


@pytest.mark.parametrize("name", ["op1_line_dedup", "op8_mixing", "op13_fill_middle"])
def test_oracles(spark, name):
    import duckdb

    import __spark_entry__ as E

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    res = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted((tuple(r[i] for i in order) for r in res.fetchall()), key=repr)
    assert rows(E.queries()[name](spark, SF)) == want


def test_contract_columns(spark):
    import __spark_entry__ as E

    want = {"op2_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
            "op3_language_id": {"doc_id", "held_out", "lang_pred", "score"}, "op4_adaptive_scan": {"query_id", "rank", "vec_id", "score"},
            "op5_ngram_join": {"doc_id", "n_shingles", "component_id"}, "op6_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
            "op7_toxicity": {"doc_id", "held_out", "score", "predicted"}, "op9_substring_dedup": {"doc_id", "n_words", "n_removed", "kept_sha256"},
            "op11_neighbour_votes": {"doc_id", "held_out", "score", "predicted"},
            "op12_token_links": {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"},
            "op13_fill_middle": {"doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"}}
    for name, cols in want.items():
        assert cols <= set(E.queries()[name](spark, SF).columns), name


def test_pipeline_stages(spark, messy, empty, tmp_path):
    """Every stage on messy rows and on none: against the operators' brute
    force, on what the stage before it left."""
    import corpus_pipeline as P

    from tessera.llm import ngram_join

    for start in (messy, empty):
        docs = start
        for k, (name, stage) in enumerate(P.STAGES):
            before = docs
            out = stage(spark, docs, SF)
            path = str(tmp_path / f"{start.count()}-{k}")
            out.write.parquet(path)
            docs = spark.read.schema(out.schema).parquet(path)
            if k < len(P.STAGES) - 1:
                assert docs.columns == start.columns, name
            if k == 2:
                groups = ngram_join.brute_force([(r.doc_id, r.text) for r in before.collect()])
                assert sorted(r.doc_id for r in docs.collect()) == sorted(d for d, (_, c) in groups.items() if c == d)
            if k in (1, 3, 4):
                assert docs.count() == before.count()


def test_near_copies_reach_the_join(spark):
    """Line dedup leaves near copies whole, and the join takes them out; shared
    passages go from documents that are otherwise their own."""
    import random

    import corpus_pipeline as P

    rng = random.Random(7)

    def line():
        return " ".join(f"w{rng.randrange(5000)}" for _ in range(12))

    passage = [line() for _ in range(4)]
    texts = [[line() for _ in range(20)] for _ in range(30)]
    rows = [(i, "\n".join(t)) for i, t in enumerate(texts)]
    for i in range(10):  # one word of one line is another one
        t = texts[i][:]
        t[10] = t[10] + " edited"
        rows.append((100 + i, "\n".join(t)))
    rows += [(200 + i, "\n".join([*(line() for _ in range(12)), *passage])) for i in range(5)]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    freed = P.lines(spark, docs, SF).cache()
    got = {r.doc_id: r.text for r in freed.collect()}
    assert all(got[100 + i] == dict(rows)[100 + i] for i in range(10))
    assert sum(passage[0] in t for t in got.values()) == 1
    kept = {r.doc_id for r in P.near_duplicates(spark, freed, SF).collect()}
    assert kept == {*range(30), *range(200, 205)}


def test_lines_of_a_spared_document_that_stays_go(spark):
    """More than half its lines are an earlier document's, too few for the
    join: the repeated lines go all the same."""
    import random

    import corpus_pipeline as P

    rng = random.Random(8)
    first, own = ([" ".join(f"w{rng.randrange(5000)}" for _ in range(12)) for _ in range(n)] for n in (12, 8))
    rows = [(1, "\n".join(first)), (2, "\n".join([*first[:10], *own]))]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: (r.text, r.n_chars) for r in P.near_duplicates(spark, P.lines(spark, docs, SF), SF).collect()}
    assert got == {1: (rows[0][1], len(rows[0][1])), 2: ("\n".join(own), len("\n".join(own)))}


def test_near_duplicates_of_shared_ids(spark):
    """Two texts under one id (or none): only the one that is a copy goes."""
    import corpus_pipeline as P

    text = " ".join(f"a{i}" for i in range(60))
    other = " ".join(f"b{i}" for i in range(60))
    rows = [(1, text), (2, text + " more"), (2, other), (None, other + " end"), (None, "quite alone here"), (None, None), (3, None), (1, text)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, P.near_duplicates(spark, docs, SF).collect()), key=repr)
    assert got == sorted([(1, text), (1, text), (None, other + " end"), (None, "quite alone here"), (None, None), (3, None)], key=repr)


def test_pipeline_keeps_the_mixture_order(spark, messy, tmp_path):
    import corpus_pipeline as P

    from tessera.llm import mixing

    out = P.mixture(spark, messy, SF)
    want = [r.doc_id for r in mixing.mix(messy).orderBy("mix_slot", "doc_id").collect()]
    assert [r.doc_id for r in out.collect()] == want


def test_pipeline_runs(spark):
    import corpus_pipeline as P

    got = P.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256", "mix_slot", "on_target"] and got.count() > 100
    slots = [r.mix_slot for r in got.collect()]
    assert len(set(slots)) > 3 and None not in slots
    assert P.ORACLE_SQL is None
