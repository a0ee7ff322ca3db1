"""CMP-4: Boolean retrieval ranked by tf-idf, for one query or a table of them.

Semantics (flat DNF, no brackets): a query splits on ``OR`` into clauses and
each clause on ``AND`` into literals.  In a literal, ``n`` = number of ``NOT``
words and the term is the first word after the last ``NOT`` (first word if
there is none; later words are ignored).  Odd ``n``: negative literal; even
``n``: positive, scoring its tf-idf only when ``n = 0``.  A clause hits a
document when all its positive literals hit and no negative one does; a clause
made of negative literals only ranges over every document with score 0.  The
document score is the sum over hitting clauses of the sum of their scoring
literals (a repeated literal counts twice).  A query with an empty operand
(``AND x``, ``x OR``, ``NOT``, empty) is ``invalid`` and has no hits.

tf-idf of a (term, doc): ``tf / doc_len * log2(N / df)``.

Plan: the query table becomes a literal table (per-row array expressions:
running counts of operator words), which is size-checked before it is
broadcast.  Postings — and, for a stored index, document frequencies — are
read for the query terms only (the terms reach the Parquet scans as short
ranges when the set is small enough to list, see ``lookup.key_filter``).  Matches of every literal of
every query go through one union and two aggregations keyed by (query,
clause, doc) and (query, doc) that share one exchange; ranking is a
per-query ``row_number`` that Spark turns into a partial + final
``WindowGroupLimit``, so no task ever holds all hits of a hot query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.porter import porter_stem
from tessera.functions.text import OP_AND, OP_NOT, OP_OR, split_words, strip_punctuation
from tessera.operators.index import Index
from tessera.operators.lookup import key_filter, pruned

# Size bounds for the driver-side shortcuts; beyond them the plan stays fully
# distributed (shuffle joins, AQE decides broadcast from measured sizes).
MAX_BROADCAST_LITERALS = 200_000
MAX_PUSHDOWN_TERMS = 5_000
UNIVERSE_SALTS = 512
SCORE_DIGITS = 9


def normalize_query_word(word, analyzer: str, normalize_query: bool = False):
    """Query-side term normalisation (JN-6 / STR-3 / STR-4).

    By default punctuation is *not* stripped from query words (Q5: ``dog's``
    never matches the index term ``dogs``); ``normalize_query`` strips it."""
    w = strip_punctuation(word) if normalize_query else word
    if analyzer == "porter":
        return porter_stem(w)
    if analyzer == "lower":
        return F.lower(w)
    return w


def parse_boolean(queries: DataFrame, analyzer: str = "lower",
                  normalize_query: bool = False) -> tuple[DataFrame, DataFrame]:
    """STR-10 / WIN-7: queries(query_id, query) -> (literals, status).

    literals: query_id, clause_no, lit_no, term, n_not, negative, scoring
    status:   query_id, status ('ok' | 'invalid'), n_literals

    Each query is parsed by per-row array expressions: the literal number of
    a word is the running count of ``AND``/``OR`` words up to it, the clause
    number of a literal the running count of ``OR`` among the operators
    before it.  No shuffle, no window: a table of queries is parsed where it
    lies, whatever its size.
    """
    is_op = lambda t: t.isin(OP_AND, OP_OR)
    toks = split_words("query")
    ops = F.filter(toks, is_op)
    # literal number of every word: operators seen so far (running count)
    lit_of = F.transform(toks, lambda t, i: F.size(F.filter(F.slice(toks, 1, i + 1), is_op)))
    tagged = F.zip_with(toks, lit_of, lambda t, n: F.struct(t.alias("tok"), n.alias("lit")))

    def literal(n):
        words = F.transform(F.filter(tagged, lambda z: (z["lit"] == n) & ~is_op(z["tok"])),
                            lambda z: z["tok"])
        from_end = F.array_position(F.reverse(words), OP_NOT)  # 1-based from the end, 0 if none
        first_after = F.when(from_end == 0, F.lit(1)).otherwise(F.size(words) - from_end + 2)
        return F.struct(
            n.alias("lit_no"),
            F.size(F.filter(F.slice(ops, 1, n), lambda o: o == OP_OR)).alias("clause_no"),
            F.size(F.filter(words, lambda w: w == OP_NOT)).alias("n_not"),
            F.try_element_at(words, first_after.cast("int")).alias("word"),
        )

    lits_arr = F.transform(F.sequence(F.lit(0), F.size(ops)), literal)
    parsed = queries.select("query_id", lits_arr.alias("lits"), (F.size(ops) + 1).alias("n_slots"))
    ok = F.forall("lits", lambda x: x["word"].isNotNull())
    status = parsed.select("query_id", F.when(ok, F.lit("ok")).otherwise(F.lit("invalid")).alias("status"),
                           F.col("n_slots").cast("bigint").alias("n_literals"))
    lit = parsed.where(ok).select("query_id", F.explode("lits").alias("l")).select("query_id", "l.*")
    literals = lit.select(
        "query_id", F.col("clause_no").cast("bigint").alias("clause_no"), F.col("lit_no").cast("bigint").alias("lit_no"),
        normalize_query_word(F.col("word"), analyzer, normalize_query).alias("term"),
        F.col("n_not").cast("int").alias("n_not"),
        ((F.col("n_not") % 2) == 1).alias("negative"),
        (F.col("n_not") == 0).alias("scoring"))
    return literals, status


def _num_docs_df(index: Index, num_docs: int | None) -> DataFrame:
    """AGG-5 as a one-row relation (stored N, else computed inside the plan)."""
    num_docs = num_docs if num_docs is not None else index.stored_num_docs
    if num_docs is not None:
        return index.postings.sparkSession.createDataFrame([(float(num_docs),)], "N double")
    return index.doc_stats.agg(F.count(F.lit(1)).cast("double").alias("N"))


def literal_matches(index: Index, literals: DataFrame, num_docs: int | None = None) -> DataFrame:
    """Every (literal, doc) match with its contribution.

    Returns query_id, clause_no, doc_id, n_pos, pos_hit, neg_hit, contrib.

    The literal table is size-checked with one bounded collect: when it has at
    most ``MAX_BROADCAST_LITERALS`` rows it is re-created as a local relation
    and broadcast, and its distinct terms (if few enough) become a pushed-down
    ``term IN (...)`` filter.  Otherwise every step stays a distributed join
    whose strategy AQE picks from measured sizes.
    """
    spark = index.postings.sparkSession
    n_df = _num_docs_df(index, num_docs)
    rows = literals.limit(MAX_BROADCAST_LITERALS + 1).collect()
    small = len(rows) <= MAX_BROADCAST_LITERALS
    postings = index.postings
    term_stats = index.stored_term_stats
    if small:
        n_pos: dict[tuple, int] = {}
        for r in rows:
            key = (r["query_id"], r["clause_no"])
            n_pos[key] = n_pos.get(key, 0) + (0 if r["negative"] else 1)
        lits = spark.createDataFrame(
            [tuple(r) + (n_pos[(r["query_id"], r["clause_no"])],) for r in rows],
            T.StructType(literals.schema.fields + [T.StructField("n_pos", T.IntegerType())]))
        clause_meta = spark.createDataFrame([k + (v,) for k, v in n_pos.items()],
                                            T.StructType([literals.schema["query_id"], literals.schema["clause_no"],
                                                         T.StructField("n_pos", T.IntegerType())]))
        has_neg_only = any(v == 0 for v in n_pos.values())
        terms = sorted({r["term"] for r in rows if r["term"] is not None})
        if len(terms) <= MAX_PUSHDOWN_TERMS:
            if term_stats is not None:  # stored, sorted by term
                postings, term_stats = (pruned(t, "term", terms) for t in (postings, term_stats))
            else:
                # one IN: a term is computed from its word once, not per query term
                postings = index.of_terms(terms)
    else:
        clause_meta = (literals.groupBy("query_id", "clause_no")
                       .agg(F.sum((~F.col("negative")).cast("int")).alias("n_pos")))
        lits = literals.join(clause_meta, ["query_id", "clause_no"])
        has_neg_only = True
    postings = postings.where(F.col("term").isNotNull())
    if term_stats is None and small:
        # Index built inside this query (not read from storage): its postings
        # of the query terms feed both the df aggregation and the matches, so
        # materialise them once (reliable checkpoint in the shared folder)
        # instead of tokenising the corpus twice.
        from tessera.session import reliable_checkpoint

        postings = reliable_checkpoint(postings)
    # df of the query terms only: partial aggregation collapses hot terms
    # before the exchange; one row per query term comes out.
    df_t = term_stats if term_stats is not None else postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    lits = lits.join(df_t, "term", "left").crossJoin(F.broadcast(n_df))
    lits = F.broadcast(lits) if small else lits

    m = postings.join(lits, "term")
    idf = F.log2(F.col("N") / F.col("df"))
    contrib = F.when(F.col("scoring"), F.col("tf") / F.col("doc_len") * idf).otherwise(F.lit(0.0))
    matches = m.select(
        "query_id", "clause_no", "doc_id", "n_pos",
        F.when(F.col("negative"), 0).otherwise(1).alias("pos_hit"),
        F.when(F.col("negative"), 1).otherwise(0).alias("neg_hit"),
        contrib.alias("contrib"),
    )
    if not has_neg_only:
        return matches
    # Clauses with negative literals only range over all documents.  The
    # clause list is small (size-checked above); every emitted row is a
    # candidate hit of such a clause, so the output is proportional to the
    # answer, never to all pairs of anything.
    neg_only = clause_meta.where(F.col("n_pos") == 0)
    docs = index.doc_stats.select("doc_id")
    if small:
        ranged = docs.crossJoin(F.broadcast(neg_only))
    else:  # an equi-join on a salt: documents are dealt out, clauses copied
        salts = F.lit(UNIVERSE_SALTS)
        dealt = docs.withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts).cast("int"))
        ranged = dealt.join(neg_only.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))), "salt")
    universe = ranged.select(
        "query_id", "clause_no", "doc_id", "n_pos",
        F.lit(0).alias("pos_hit"), F.lit(0).alias("neg_hit"), F.lit(0.0).alias("contrib"))
    return matches.unionByName(universe)


def score_hits(matches: DataFrame) -> DataFrame:
    """Clause test and score sum -> (query_id, doc_id, score).

    Both aggregations are keyed by (query_id, doc_id, ...): repartitioning once
    on (query_id, doc_id) satisfies both, so the plan has a single exchange."""
    per_clause = (matches.repartition("query_id", "doc_id")
                  .groupBy("query_id", "doc_id", "clause_no")
                  .agg(F.sum("pos_hit").alias("pos_hits"), F.sum("neg_hit").alias("neg_hits"),
                       F.sum("contrib").alias("cscore"), F.max("n_pos").alias("n_pos"))
                  .where((F.col("pos_hits") == F.col("n_pos")) & (F.col("neg_hits") == 0)))
    return per_clause.groupBy("query_id", "doc_id").agg(F.sum("cscore").alias("score"))


def rank_hits(hits: DataFrame, count: int | None = 10, part: str = "query_id",
              score: str = "score", rank_col: str = "rank") -> DataFrame:
    """WIN-2 / SRT-4 / SRT-5: rank by score desc (rounded to 9 digits so every
    engine agrees), ties by doc id; keep the first ``count``.

    With a ``count`` the per-query ``row_number <= count`` runs as a partial
    top-k before the exchange.  Without one, every hit is ranked by a global
    range-partitioned sort and ordinal offsets (:func:`rank_all`), so a query
    matching a third of the corpus is never sorted inside one task."""
    rounded = F.round(F.col(score), SCORE_DIGITS)
    if count is None:
        return rank_all(hits.withColumn(score, rounded), part, score, rank_col)
    w = Window.partitionBy(part).orderBy(rounded.desc(), F.col("doc_id").asc())
    out = hits.withColumn(score, rounded).withColumn(rank_col, F.row_number().over(w).cast("bigint"))
    return out.where(F.col(rank_col) <= count)


def rank_all(hits: DataFrame, part: str = "query_id", score: str = "score",
             rank_col: str = "rank") -> DataFrame:
    """Rank every hit within its ``part`` by (score desc, doc_id asc) without
    a per-part window: global ordinal over the sorted hits minus the first
    ordinal of the part (per-part minimum: partial aggregation; joined back
    with a hot-key split)."""
    from tessera.operators.skew import skew_split_join
    from tessera.sources.corpus import ordinal

    o = ordinal(hits, [F.col(part).asc(), F.col(score).desc(), F.col("doc_id").asc()], "_ord")
    starts = o.groupBy(part).agg(F.min("_ord").alias("_start"), F.count(F.lit(1)).alias("_n"))
    j = skew_split_join(o, starts, part, "_n")
    return j.withColumn(rank_col, (F.col("_ord") - F.col("_start") + 1).cast("bigint")).drop("_ord", "_start", "_n")


def boolean_search(index: Index, queries, count: int | None = 10,
                   normalize_query: bool = False) -> DataFrame:
    """CMP-4: hits(query_id, rank, doc_id, score) for a query string or a
    table queries(query_id, query)."""
    if isinstance(queries, str):
        spark = index.postings.sparkSession
        queries = spark.createDataFrame([(0, queries)], "query_id bigint, query string")
    literals, _ = parse_boolean(queries, index.analyzer, normalize_query)
    hits = score_hits(literal_matches(index, literals))
    return rank_hits(hits, count).select("query_id", "rank", "doc_id", "score")


def search_status(index: Index, queries: DataFrame, normalize_query: bool = False) -> DataFrame:
    """FLT-10 / AGG-9 / Q14: per query its status and hit count
    (``invalid`` queries and queries with nothing found have 0 hits)."""
    literals, status = parse_boolean(queries, index.analyzer, normalize_query)
    hits = score_hits(literal_matches(index, literals))
    counts = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_hits"))
    return (status.join(counts, "query_id", "left")
            .select("query_id", "status", F.coalesce("n_hits", F.lit(0)).cast("bigint").alias("n_hits")))


# --- JN-1..JN-6: the posting-list algebra as standalone operators -----------
# A scored posting list is a DataFrame (doc_id BIGINT, score DOUBLE) with one
# row per document.  Both sides may be large, so these are shuffle joins on the
# unique doc id (no hot key); Catalyst/AQE choose the strategy.

def term_postings(index: Index, word: str, num_docs: int | None = None,
                  normalize_query: bool = False) -> DataFrame:
    """JN-6 + MTH-1: scored posting list of one query word (unknown: empty)."""
    spark = index.postings.sparkSession
    n = num_docs if num_docs is not None else index.num_docs()
    term = spark.createDataFrame([(word,)], "word string").select(
        normalize_query_word(F.col("word"), index.analyzer, normalize_query)).first()[0]
    # a literal: Parquet reads only the row groups that can hold the term
    p = index.postings.where(F.col("term") == F.lit(term))
    stats = index.stored_term_stats
    df_t = (p.groupBy("term").agg(F.count(F.lit(1)).alias("df")) if stats is None
            else stats.where(F.col("term") == F.lit(term)))
    return (p.join(F.broadcast(df_t), "term")  # one row
            .select("doc_id", (F.col("tf") / F.col("doc_len") * F.log2(F.lit(float(n)) / F.col("df")))
                    .alias("score")))


def and_postings(p1: DataFrame, p2: DataFrame) -> DataFrame:
    """JN-1 / SET-1: documents in both, scores summed."""
    return (p1.alias("a").join(p2.alias("b"), "doc_id", "inner")
            .select("doc_id", (F.col("a.score") + F.col("b.score")).alias("score")))


def or_postings(p1: DataFrame, p2: DataFrame) -> DataFrame:
    """JN-2 / SET-2: documents in either; scores summed where in both."""
    return (p1.alias("a").join(p2.alias("b"), "doc_id", "full_outer")
            .select("doc_id", (F.coalesce("a.score", F.lit(0.0)) + F.coalesce("b.score", F.lit(0.0)))
                    .alias("score")))


def not_postings(p: DataFrame, doc_stats: DataFrame) -> DataFrame:
    """JN-3 / SET-3: every document not in ``p``, score 0."""
    return (doc_stats.select("doc_id").join(p.select("doc_id"), "doc_id", "left_anti")
            .select("doc_id", F.lit(0.0).alias("score")))


def not_and_postings(not_p: DataFrame, p: DataFrame) -> DataFrame:
    """JN-4 / SET-4: ``NOT x AND y`` as a difference: y's documents (with y's
    scores) minus x's.  A plain anti-join, so document 0 is kept (Q2 fix)."""
    return p.join(not_p.select("doc_id"), "doc_id", "left_anti").select("doc_id", "score")


def not_or_postings(not_p: DataFrame, p: DataFrame, doc_stats: DataFrame) -> DataFrame:
    """JN-5: ``NOT x OR y``."""
    return or_postings(not_postings(not_p, doc_stats), p)
