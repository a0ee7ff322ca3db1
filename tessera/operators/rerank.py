"""CMP-7: "ML" search — Boolean candidates (L0) reranked by embedding cosine.

Query syntax ``word word NOT(word word)``: the words before the first ``NOT``
token must all match (``match='all'``, what the reference code does; ``'any'``
ORs them as its README describes), every word after it excludes documents.
Candidates are ranked by tf-idf; the best ``l0`` are reranked by the cosine
between their embedding and the embedding of the positive query text; the
best ``l1`` are returned with their L0 rank, tf-idf and cosine.

Plan: Boolean matching is the one-aggregation plan of
:mod:`tessera.operators.boolean`; the L0 cut is a per-query top-k
(``WindowGroupLimit``) *before* any vector work, so embeddings are computed
or joined for at most ``#queries x l0`` documents (broadcast-sized by
construction).  Cosines come from a join on the embedding bucket of the
sparse query and candidate vectors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import ml_negative_words, ml_positive
from tessera.functions.vectors import EMBED_MAX_WORDS, cosine, hash_embed, sparse_norms
from tessera.operators import boolean as B
from tessera.operators.index import Index
from tessera.operators.lookup import lookup, settle

L0_SIZE = 100  # fixed value: candidates reranked
L1_SIZE = 20   # fixed value: results shown


def parse_ml(queries: DataFrame, match: str = "all") -> DataFrame:
    """STR-11/STR-12/STR-13: query_id, query, positive, negative (array),
    boolean (the positive part as a Boolean conjunction / disjunction)."""
    op = " AND " if match == "all" else " OR "
    pos = ml_positive("query")
    return queries.select(
        "query_id", "query",
        pos.alias("positive"),
        ml_negative_words("query").alias("negative"),
        F.replace(pos, F.lit(" "), F.lit(op)).alias("boolean"),
    )


def l0_candidates(index: Index, parsed: DataFrame, l0: int = L0_SIZE) -> DataFrame:
    """query_id, doc_id, tfidf, l0_rank (0-based) of the best ``l0`` matches.

    ``NOT x AND y`` (JN-4) is planned as negative literals: every negative
    word is added to every clause of the positive part, so one literal table
    drives one pass over the postings and a document is dropped when it
    contains any negative word (a plain anti-join in effect; document 0 is
    not special, Q2 fix).  Negative words are terms, never operators."""
    lits, _ = B.parse_boolean(parsed.select("query_id", F.col("boolean").alias("query")), index.analyzer)
    clauses = lits.select("query_id", "clause_no").distinct()
    neg = parsed.select("query_id", F.posexplode("negative").alias("i", "word"))
    neg_lits = neg.join(clauses, "query_id").select(
        "query_id", "clause_no", (F.lit(1_000_000) + F.col("i")).cast("bigint").alias("lit_no"),
        B.normalize_query_word(F.col("word"), index.analyzer).alias("term"),
        F.lit(1).alias("n_not"), F.lit(True).alias("negative"), F.lit(False).alias("scoring"))
    hits = B.score_hits(B.literal_matches(index, lits.unionByName(neg_lits)))
    ranked = B.rank_hits(hits, l0, rank_col="l0_rank")
    return ranked.select("query_id", "doc_id", F.col("score").alias("tfidf"),
                         (F.col("l0_rank") - 1).alias("l0_rank"))


def _ranked(scored: DataFrame, l1: int) -> DataFrame:
    """SRT-7/SRT-8/WIN-3: best ``l1`` by cosine; ties and NULL cosines (zero
    or missing vectors, ranked last) keep L0 order (Q20)."""
    w = Window.partitionBy("query_id").orderBy(F.col("cos_sim").desc_nulls_last(), F.col("l0_rank").asc())
    out = scored.withColumn("rank", (F.row_number().over(w) - 1).cast("bigint")).where(F.col("rank") < l1)
    return out.select("query_id", "rank", "doc_id", F.col("l0_rank").cast("bigint").alias("l0_rank"),
                      "tfidf", "cos_sim")


def rerank(candidates: DataFrame, cand_vecs: DataFrame, query_vecs: DataFrame,
           l1: int = L1_SIZE) -> DataFrame:
    """Cosine rerank of L0 candidates by sparse vectors: cand_vecs (id =
    doc_id, bucket, cnt), query_vecs (id = query_id, bucket, cnt)."""
    qn = sparse_norms(query_vecs).withColumnRenamed("id", "query_id").withColumnRenamed("sq", "q_sq")
    dn = sparse_norms(cand_vecs).withColumnRenamed("id", "doc_id").withColumnRenamed("sq", "d_sq")
    qv = query_vecs.select(F.col("id").alias("query_id"), "bucket", F.col("cnt").alias("q_cnt"))
    dv = cand_vecs.select(F.col("id").alias("doc_id"), "bucket", F.col("cnt").alias("d_cnt"))
    pairs = candidates.select("query_id", "doc_id").join(qv, "query_id").join(dv, ["doc_id", "bucket"])
    dots = pairs.groupBy("query_id", "doc_id").agg(F.sum(F.col("q_cnt") * F.col("d_cnt")).alias("dot"))
    scored = (candidates.join(dots, ["query_id", "doc_id"], "left")
              .join(qn, "query_id", "left").join(dn, "doc_id", "left"))
    den = F.sqrt(F.col("q_sq").cast("double") * F.col("d_sq").cast("double"))
    cos = F.when(den > 0, F.coalesce(F.col("dot"), F.lit(0)).cast("double") / den)
    return _ranked(scored.withColumn("cos_sim", F.round(cos, 6)), l1)


def rerank_dense(candidates: DataFrame, cand_vecs: DataFrame, query_vecs: DataFrame, l1: int = L1_SIZE) -> DataFrame:
    """The same by dense vectors: cand_vecs (id = doc_id, vec), query_vecs
    (id = query_id, vec).  A candidate without a vector stays, ranked last."""
    dv = cand_vecs.select(F.col("id").alias("doc_id"), F.col("vec").alias("d_vec"))
    qv = query_vecs.select(F.col("id").alias("query_id"), F.col("vec").alias("q_vec"))
    scored = candidates.join(dv, "doc_id", "left").join(qv, "query_id", "left")
    return _ranked(scored.withColumn("cos_sim", F.round(cosine("d_vec", "q_vec"), 6)), l1)


def _sparse_rows(vectors: DataFrame) -> DataFrame:
    """(id, bucket, cnt) from that, or from (id, idx, val) as ``embed_corpus`` returns."""
    if "idx" not in vectors.columns:
        return vectors
    return vectors.select("id", F.explode(F.arrays_zip("idx", "val")).alias("e")).select(
        "id", F.col("e.idx").alias("bucket"), F.col("e.val").alias("cnt"))


def ml_search(index: Index, docs: DataFrame, queries, l0: int = L0_SIZE, l1: int = L1_SIZE,
              match: str = "all", max_words: int = EMBED_MAX_WORDS, doc_vectors: DataFrame | None = None,
              query_vectors: DataFrame | None = None) -> DataFrame:
    """CMP-7: queries(query_id, query) or a query string (query_id 0) -> reranked hits.

    doc_vectors: optional precomputed document embeddings, sparse (id, bucket,
    cnt) or (id, idx, val), or dense (id, vec); by default the L0 candidates
    are embedded on the fly (only they are read).  query_vectors: optional
    embeddings of the queries (id = query_id) in the same form; dense document
    vectors need them, else the positive words are hash-embedded."""
    if isinstance(queries, str):
        queries = index.postings.sparkSession.createDataFrame([(0, queries)], "query_id bigint, query string")
    parsed = parse_ml(queries, match)
    cands = settle(l0_candidates(index, parsed, l0))
    if doc_vectors is not None:
        doc_vectors = lookup(doc_vectors, cands.select(F.col("doc_id").alias("id")), "id")
        if "vec" in doc_vectors.columns:
            if query_vectors is None:
                raise ValueError("dense document vectors need query_vectors")
            return rerank_dense(cands, doc_vectors, query_vectors, l1)
        doc_vectors = _sparse_rows(doc_vectors)
    else:
        doc_vectors = hash_embed(lookup(docs, cands), "doc_id", "text", max_words)
    qvecs = _sparse_rows(query_vectors) if query_vectors is not None else hash_embed(parsed, "query_id", "positive", max_words=-1)
    return rerank(cands, doc_vectors, qvecs, l1)
