"""Words are cut, looked up, chunked, merged and stemmed without needless work."""

import sys

from pyspark.sql import functions as F

from tessera.functions import porter
from tessera.functions import text as T
from tessera.operators import index as I


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list:
    return sorted(map(str, df.collect()))


def docs(spark):
    return spark.createDataFrame([(1, "The the, t-h-e thé (queen) --"), (2, "THE. Queen's King Ab a ''a"), (2, "the"), (203, None), (None, "a the"), (204, "")],
                                 "doc_id bigint, text string")


def test_words_are_cut_at_every_whitespace_character_and_no_other(spark):
    """F20-F28: Java's pattern of whitespace turns letters away first."""
    assert "&&" in T.JAVA_WS_RUN
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    text = spark.createDataFrame([("".join(f"x{chr(c)}y" for c in points[i:i + 5000]),) for i in range(0, len(points), 5000)], "text string")
    words = text.select(F.sort_array(T.split_words("text")).alias("w")).collect()
    assert sorted(w for r in words for w in r["w"]) == sorted(w for r in text.collect() for w in r["text"].split())


def test_lookup_folds_only_words_that_may_be_terms(spark):
    """F20, F21"""
    index, terms = I.build_index(docs(spark)), ["the", "a", "king", "queens", "queen's", "thé", "", "zz"]
    assert rows(index.of_terms(terms)) == rows(index.postings.where(F.col("term").isin(terms)))
    words = spark.createDataFrame([(w,) for w in ["the", "THE", "tab", "a", "ab", "xyz", "--", "t-h", "\u212aing", "...x"]], "w string")
    passed = words.where(T.may_be_term("w", ["the", "a", "king"])).collect()
    assert [r.w for r in passed] == ["the", "THE", "a", "t-h", "\u212aing", "...x"]


def test_small_chunks_are_counted_where_their_documents_lie(spark):
    """F25"""
    index = I.build_index(docs(spark))
    lists = I.posting_lists(index, chunk=100)
    assert rows(lists) == rows(I.posting_lists(index.postings, chunk=100))
    assert "hashpartitioning(chunk" in plan(lists) and "hashpartitioning(term" not in plan(lists)


def test_merge_takes_lengths_to_the_postings(spark, monkeypatch):
    """the postings of both blocks are not exchanged, nor sorted."""
    monkeypatch.setattr(I, "deal_parts", lambda df: 7)
    merged = plan(I.merge_index(I.build_index(docs(spark)), I.build_index(docs(spark))).postings)
    assert "hashpartitioning(doc_id" in merged and ", 4)" not in merged
    assert "ShuffledHashJoin" in merged and "SortMergeJoin" not in merged


def test_frequent_terms_go_to_the_stored_postings(spark, tmp_path, monkeypatch):
    """postings are not exchanged for the score blocks."""
    asked, real = [], F.broadcast
    monkeypatch.setattr(F, "broadcast", lambda df: (asked.append(df.columns), real(df))[1])
    I.write_index(I.build_index(docs(spark)), str(tmp_path / "i"), block_docs=2, hot_df=2)
    assert asked == [["term"]]
    blocks = I.read_index(spark, str(tmp_path / "i")).score_blocks
    assert rows(blocks.where("term = 'the'").select("block", F.round("max_w", 6).alias("w"))) == rows(
        spark.createDataFrame([(0, 0.5), (1, 1.0), (None, 0.5)], "block bigint, w double"))


def test_only_changed_forms_are_joined(spark, monkeypatch):
    """F22"""
    written, real = [], I.write_once
    monkeypatch.setattr(I, "write_once", lambda df, name, **o: (written.append((name, rows(df))), real(df, name, **o))[1])
    text = spark.createDataFrame([(1, "Running runs box boxes box")], "doc_id bigint, text string")
    postings = I.build_index(text, "porter").postings
    assert "hashpartitioning(doc_id" in plan(postings) and "hashpartitioning(term" not in plan(postings)
    found = {(r.term, r.tf) for r in postings.collect()}
    assert found == {("run", 2), ("box", 3)}
    assert all("token='box'" not in r for r in dict(written)["changed-forms"])


def test_words_without_a_suffix_keep_their_letters(spark, monkeypatch):
    """the shortcut gives the stems of the steps."""
    letters = "abcdefghijklmnopqrstuvwxyzé9"
    words = spark.createDataFrame([(stem + c,) for stem in ("", "a", "hop", "fall", "yyy", "toy", "relation") for c in letters], "w string")
    short = rows(words.select("w", porter.porter_stem("w").alias("s")))
    monkeypatch.setattr(porter, "ENDS", list(letters))
    assert short == rows(words.select("w", porter.porter_stem("w").alias("s")))


def test_small_score_blocks_are_exchanged_once(spark, tmp_path, monkeypatch):
    """by range alone, with the same blocks."""
    found = []
    for most in (I.SMALL_BLOCK, 0):
        monkeypatch.setattr(I, "SMALL_BLOCK", most)
        I.write_index(I.build_index(docs(spark)), str(tmp_path / str(most)), block_docs=2, hot_df=1)
        found.append(rows(I.read_index(spark, str(tmp_path / str(most))).score_blocks))
    assert found[0] == found[1] and len(found[0]) > 5
