"""CMP-5 / STR-8: text snippets for hits.

For every hit and every query word (operator words removed, FLT-5), find the
first occurrence in the lower-cased text of the normalised word at a word
boundary, extended by following word characters (so a stem matches its longer
forms).  The snippet shows up to ``offset`` characters before the match
(``truncated`` when more text precedes it), the match itself in the original
case, and the rest of that line.  Words with no occurrence give
``found = false`` (printed as ``-``).

Word boundaries are spelled out (``\\b`` semantics of Python's ``re`` over
letters, digits and ``_``) and the word is regex-quoted (Q10 fix).  The whole
snippet is one native ``regexp_extract`` per (hit, word) row; only the hits'
documents are read, via a join on doc id with the (small, ranked) hit table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import (NON_WORD_CHAR, OP_AND, OP_NOT, OP_OR, WORD_CHAR, pretty_name,
                                    regex_quote, split_words)
from tessera.operators.lookup import lookup, settle

SNIPPET_OFFSET = 20  # fixed value: characters of context before a match


def snippet_pattern(word) -> F.Column:
    """Regex with groups (prefix)(boundary char)(match)(rest of line)."""
    w = F.col(word) if isinstance(word, str) else word
    starts_word = w.rlike("^" + WORD_CHAR)
    ends_word = w.rlike(WORD_CHAR + "$")
    lead = F.when(starts_word, F.lit("(^|" + NON_WORD_CHAR + ")")).otherwise(F.lit("(" + WORD_CHAR + ")"))
    tail = F.when(ends_word, F.lit(WORD_CHAR + "*")).otherwise(F.lit(WORD_CHAR + "+"))
    return F.concat(F.lit("(?s)^(.*?)"), lead, F.lit("("), regex_quote(w), tail, F.lit(")([^\n]*)"))


def snippets(hits: DataFrame, docs: DataFrame, words: DataFrame,
             offset: int = SNIPPET_OFFSET, analyzer: str = "lower", normalize=None) -> DataFrame:
    """hits(query_id, rank, doc_id, score) x words(query_id, word_no, word)
    -> one snippet row per (hit, word).

    The word is matched in its index form: lower-cased (``analyzer='lower'``)
    or Porter-stemmed (``'porter'``, so the stem ``licens`` also finds
    ``license``); ``normalize`` overrides with any column function."""
    if normalize is not None:
        norm = normalize
    elif analyzer == "porter":
        from tessera.functions.porter import porter_stem

        norm = porter_stem
    else:
        norm = F.lower
    w = words.select("query_id", "word_no", "word", norm(F.col("word")).alias("nword"))
    # Hits are a ranked top-k table (#queries x count): their documents are
    # fetched by a pushed-down id filter, not by scanning every text.
    hits = settle(hits)
    h = hits.join(lookup(docs.select("doc_id", "path", "text"), hits), "doc_id")
    rows = h.join(w, "query_id").withColumn("__pat", snippet_pattern("nword"))
    # the four groups of the first match; hits are a small table
    group = lambda i: F.expr(f"regexp_extract(lower(text), __pat, {i})")
    rows = rows.withColumn("__parts", F.when(F.expr("lower(text) rlike __pat"), F.array(*map(group, range(1, 5)))))
    found = F.col("__parts").isNotNull()
    start = F.length(F.col("__parts")[0]) + F.length(F.col("__parts")[1])  # 0-based match start
    mlen = F.length(F.col("__parts")[2])
    alen = F.length(F.col("__parts")[3])
    before_start = F.greatest(start - offset, F.lit(0))
    out = rows.select(
        "query_id", "rank", "doc_id", "score", "word_no", "word",
        pretty_name("path").alias("pretty_name"),
        F.round(F.col("score"), 3).alias("relevance"),
        found.alias("found"),
        F.when(found, start > offset).otherwise(F.lit(False)).alias("truncated"),
        F.when(found, F.substring(F.col("text"), before_start + 1, start - before_start)).alias("before"),
        F.when(found, F.substring(F.col("text"), start + 1, mlen)).alias("match_text"),
        F.when(found, F.substring(F.col("text"), start + mlen + 1, alen)).alias("after"),
    )
    return out


def query_words(queries: DataFrame) -> DataFrame:
    """FLT-5: (query_id, word_no, word) of the non-operator words of a query."""
    ws = queries.select("query_id", F.posexplode(split_words("query")).alias("word_no", "word"))
    return ws.where(~F.col("word").isin(OP_AND, OP_OR, OP_NOT)).select(
        "query_id", F.col("word_no").cast("bigint").alias("word_no"), "word")
