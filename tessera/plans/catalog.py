"""Named queries: each takes (spark, sf_dir) and returns a DataFrame over the
given tables; ``ORACLE`` holds the DuckDB statement computing the same rows.

Every query runs on whole tables and whole texts.  Column names and types
match between a query and its oracle (BIGINT counts and ids, DOUBLE scores
rounded to 9 digits, cosines to 6).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import boolean as B
from tessera.operators import index as I
from tessera.plans.sqltext import (
    ML_QUERY_SPLIT, NON_WORD_CHAR, PUNCTUATION, SPLITLINES_BREAK, WHITESPACE, WORD_CHAR,
    boolean_ctes, index_ctes, q, ranked_sql, stemmed_index_ctes, tokens_sql, values_sql, words_sql)
from tessera.sources.corpus import read_corpus, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- fixed query texts -------------------------------------------------------
FLAGSHIP_QUERY = "the AND of OR der AND und"

# The golden micro-corpus queries (FIXTURES §3) with corpus words substituted:
# rain->the, sun->of, moon->and, dog->der, star->queen; plus invalid ones.
BATCH_QUERIES = [
    (0, "the"),
    (1, "the AND and"),
    (2, "the OR der"),
    (3, "NOT the"),
    (4, "of AND NOT the"),
    (5, "the AND and OR der"),
    (6, "the OR the"),
    (7, "the AND the"),
    (8, "NOT NOT of"),
    (9, "the of"),
    (10, "foo NOT the"),
    (11, "queen OR NOT and"),
    (12, "zzzz"),
    (13, "zzzz OR license"),
    (14, "queen's"),
    (15, ""),
    (16, "AND the"),
    (17, "the OR"),
    (18, "NOT"),
]
BATCH_COUNT = 10


def _index(spark, sf_dir, analyzer="lower") -> I.Index:
    return I.build_index(read_corpus(spark, sf_dir), analyzer)


def _queries_df(spark, rows) -> DataFrame:
    return spark.createDataFrame(rows, "query_id bigint, query string")


# --- index family ------------------------------------------------------------

@register("tokens_count", f"""
SELECT doc_id, CAST(len({tokens_sql('text')}) AS BIGINT) AS n_tokens FROM documents""")
def tokens_count(spark, sf_dir):
    """STR-1/STR-2: number of index tokens per document."""
    from tessera.functions.text import index_tokens
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", F.size(index_tokens("text")).cast("bigint").alias("n_tokens"))


@register("postings_tf", f"WITH {index_ctes()} SELECT term, doc_id, tf FROM tf")
def postings_tf(spark, sf_dir):
    """AGG-1: term frequency per (term, doc)."""
    return _index(spark, sf_dir).postings.select("term", "doc_id", "tf")


@register("posting_lists", f"""WITH {index_ctes()}
SELECT term, CAST(doc_id // 100 AS BIGINT) AS chunk, list(doc_id ORDER BY doc_id) AS doc_ids,
       list(tf ORDER BY doc_id) AS tfs FROM tf GROUP BY term, doc_id // 100""")
def posting_lists(spark, sf_dir):
    """AGG-2 / SRT-3 / ARR-1: nested posting list per term, in chunks of 100
    doc ids (several per common term), docs ascending."""
    p = I.posting_lists(_index(spark, sf_dir), chunk=100)
    return p.select("term", "chunk", F.col("postings.doc_id").alias("doc_ids"), F.col("postings.tf").alias("tfs"))


@register("term_df", f"WITH {index_ctes()} SELECT term, df FROM dfs")
def term_df(spark, sf_dir):
    """AGG-4: document frequency per term."""
    return _index(spark, sf_dir).term_stats().select("term", F.col("df").cast("bigint").alias("df"))


@register("doc_word_count", f"WITH {index_ctes()} SELECT doc_id, doc_len FROM dl")
def doc_word_count(spark, sf_dir):
    """AGG-6: whitespace word count of the raw text."""
    return I.doc_stats(read_corpus(spark, sf_dir))


@register("tfidf_scores", f"WITH {index_ctes()} SELECT term, doc_id, round(score, 9) AS score FROM sc")
def tfidf_scores(spark, sf_dir):
    """MTH-1 / JN-7 / AGG-5: tf-idf of every posting.  The df join is keyed
    by term and a stop word is a hot key: terms whose df exceeds the hot-row
    bound are broadcast, the rest shuffle-joined (``skew_split_join``)."""
    from tessera.operators.skew import skew_split_join

    idx = _index(spark, sf_dir).materialized()
    n = idx.num_docs()
    return (skew_split_join(idx.postings, idx.term_stats(), "term", "df")
            .select("term", "doc_id",
                    F.round(F.col("tf") / F.col("doc_len") * F.log2(F.lit(float(n)) / F.col("df")), 9)
                    .alias("score")))


def _cut_documents(docs: DataFrame) -> list[DataFrame]:
    """Every document in two: its even and its odd lines."""
    def part(odd: int):
        lines = F.filter(F.split("text", "\n", -1), lambda x, i: i % 2 == odd)
        return docs.withColumn("text", F.array_join(lines, "\n"))

    return [part(0), part(1)]


@register("postings_merge", f"WITH {index_ctes()} SELECT term, doc_id, tf, doc_len FROM tf JOIN dl USING (doc_id)")
def postings_merge(spark, sf_dir):
    """AGG-3 / SET-5: two blocks that hold the even and the odd lines of every
    document, indexed separately, then merged: tf and length add up."""
    a, b = map(I.build_index, _cut_documents(read_corpus(spark, sf_dir)))
    return I.merge_index(a, b).postings.select("term", "doc_id", "tf", "doc_len")


@register("merged_term_df", f"WITH {index_ctes()} SELECT term, df FROM dfs")
def merged_term_df(spark, sf_dir):
    """AGG-4 of the merged index: a document in both blocks counts once."""
    a, b = map(I.build_index, _cut_documents(read_corpus(spark, sf_dir)))
    return I.merge_index(a, b).term_stats().select("term", "df")


# --- Boolean search ----------------------------------------------------------

@register("bool_flagship", f"""WITH {index_ctes()},
c1 AS (SELECT a.doc_id, a.score + b.score AS s FROM sc a JOIN sc b ON a.doc_id = b.doc_id
       WHERE a.term = 'the' AND b.term = 'of'),
c2 AS (SELECT a.doc_id, a.score + b.score AS s FROM sc a JOIN sc b ON a.doc_id = b.doc_id
       WHERE a.term = 'der' AND b.term = 'und'),
hits AS (SELECT 0 AS query_id, doc_id, sum(s) AS score FROM (SELECT * FROM c1 UNION ALL SELECT * FROM c2) GROUP BY doc_id)
{ranked_sql('hits', 10)}""")
def bool_flagship(spark, sf_dir):
    """CMP-4: ``the AND of OR der AND und``, top 10 by tf-idf."""
    return B.boolean_search(_index(spark, sf_dir), FLAGSHIP_QUERY, count=10)


@register("bool_batch", f"""WITH {index_ctes()}, {boolean_ctes(values_sql(BATCH_QUERIES, 'query_id, query'))}
{ranked_sql('H', BATCH_COUNT)}""")
def bool_batch(spark, sf_dir):
    """CMP-4 over a table of queries (STR-10, WIN-7, AGG-8, SRT-4/5)."""
    return B.boolean_search(_index(spark, sf_dir), _queries_df(spark, BATCH_QUERIES), count=BATCH_COUNT)


def _stored_index(spark, sf_dir):
    from tessera.session import scratch_path

    path = scratch_path(spark, "index")
    I.write_index(_index(spark, sf_dir), path, block_docs=64, hot_df=32)
    return I.read_index(spark, path)


@register("bool_flagship_topk", ORACLE["bool_flagship"])
def bool_flagship_topk(spark, sf_dir):
    """SRT-5: the flagship's ten hits from the score bounds of a stored index."""
    from tessera.operators.topk import top_hits

    return top_hits(_stored_index(spark, sf_dir), FLAGSHIP_QUERY, count=10)


@register("bool_batch_topk", ORACLE["bool_batch"])
def bool_batch_topk(spark, sf_dir):
    """SRT-5 / CMP-4 over a table of queries: blocks below the k-th score are
    skipped, clauses start from their rarest word."""
    from tessera.operators.topk import top_hits

    return top_hits(_stored_index(spark, sf_dir), _queries_df(spark, BATCH_QUERIES), count=BATCH_COUNT)


@register("query_status", f"""WITH {index_ctes()}, {boolean_ctes(values_sql(BATCH_QUERIES, 'query_id, query'))}
SELECT CAST(ST.query_id AS BIGINT) AS query_id, ST.status,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_hits
FROM ST LEFT JOIN (SELECT query_id, count(*) AS n FROM H GROUP BY query_id) c ON c.query_id = ST.query_id""")
def query_status(spark, sf_dir):
    """FLT-10 / AGG-9 / Q14: status and hit count of every query."""
    return B.search_status(_index(spark, sf_dir), _queries_df(spark, BATCH_QUERIES))


# --- snippets ----------------------------------------------------------------

def _snippet_sql(hits_sql: str, words_rel: str, offset: int = 20) -> str:
    """Snippet CTEs over HT(query_id, rank, doc_id, score) and a words
    relation (query_id, word_no, word); the pattern is built per word in SQL."""
    lead = (f"CASE WHEN regexp_matches(lower(word), {q('^' + WORD_CHAR)}) THEN {q('(^|' + NON_WORD_CHAR + ')')} "
            f"ELSE {q('(' + WORD_CHAR + ')')} END")
    tail = (f"CASE WHEN regexp_matches(lower(word), {q(WORD_CHAR + '$')}) THEN {q(WORD_CHAR + '*')} "
            f"ELSE {q(WORD_CHAR + '+')} END")
    pat = f"'(?s)^(.*?)' || {lead} || '(\\Q' || lower(word) || '\\E' || {tail} || ')([^' || chr(10) || ']*)'"
    return f"""HT AS ({hits_sql}),
W AS (SELECT query_id, word_no, word, {pat} AS pat FROM {words_rel}),
R AS (SELECT HT.query_id, HT.rank, HT.doc_id, HT.score, W.word_no, W.word, d.source, d.text,
             regexp_matches(lower(d.text), W.pat) AS found,
             length(regexp_extract(lower(d.text), W.pat, 1)) + length(regexp_extract(lower(d.text), W.pat, 2)) AS st,
             length(regexp_extract(lower(d.text), W.pat, 3)) AS ml,
             length(regexp_extract(lower(d.text), W.pat, 4)) AS al
      FROM HT JOIN documents d ON d.doc_id = HT.doc_id JOIN W ON W.query_id = HT.query_id)
SELECT CAST(query_id AS BIGINT) AS query_id, rank, doc_id, score, CAST(word_no AS BIGINT) AS word_no, word,
       source || ' - ' || CAST(doc_id AS VARCHAR) AS pretty_name, round(score, 3) AS relevance, found,
       CASE WHEN found THEN st > {offset} ELSE false END AS truncated,
       CASE WHEN found THEN substring(text, greatest(st - {offset}, 0) + 1, st - greatest(st - {offset}, 0)) END AS before,
       CASE WHEN found THEN substring(text, st + 1, ml) END AS match_text,
       CASE WHEN found THEN substring(text, st + ml + 1, al) END AS after
FROM R"""


_FLAGSHIP_HITS_SQL = f"""WITH {index_ctes()},
c1 AS (SELECT a.doc_id, a.score + b.score AS s FROM sc a JOIN sc b ON a.doc_id = b.doc_id
       WHERE a.term = 'the' AND b.term = 'of'),
c2 AS (SELECT a.doc_id, a.score + b.score AS s FROM sc a JOIN sc b ON a.doc_id = b.doc_id
       WHERE a.term = 'der' AND b.term = 'und'),
hits AS (SELECT 0 AS query_id, doc_id, sum(s) AS score FROM (SELECT * FROM c1 UNION ALL SELECT * FROM c2) GROUP BY doc_id)"""


@register("hit_snippets", _FLAGSHIP_HITS_SQL + ", " + _snippet_sql(
    ranked_sql("hits", 10), values_sql([(0, 0, "the"), (0, 2, "of"), (0, 4, "der"), (0, 6, "und")],
                                       "query_id, word_no, word")))
def hit_snippets(spark, sf_dir):
    """CMP-5 / STR-8 / FLT-5 / PRJ-1 / PRJ-6: snippets of the flagship hits."""
    from tessera.operators.snippets import query_words, snippets

    docs = read_corpus(spark, sf_dir)
    idx = I.build_index(docs)
    qdf = _queries_df(spark, [(0, FLAGSHIP_QUERY)])
    hits = B.boolean_search(idx, qdf, count=10)
    return snippets(hits, docs, query_words(qdf))


# --- ML search: hash embedding + cosine rerank ------------------------------

ML_QUERIES = [
    (0, "the of"),
    (1, "der und NOT(die)"),
    (2, "que la NOT (el para)"),
    (3, "license NOT gnu"),
    (4, "the NOTHING"),
    (5, "in to NOT(the a)"),
    (6, "licensed work"),
]


def _ml_split_sql(expr: str, group: int) -> str:
    return f"regexp_extract({expr}, {q(ML_QUERY_SPLIT)}, {group})"


def _ml_parsed_sql(queries_sql: str) -> str:
    m = f"regexp_matches(query, {q(ML_QUERY_SPLIT)})"
    return f"""MP AS (SELECT query_id, query,
       CASE WHEN {m} THEN {_ml_split_sql('query', 1)} ELSE query END AS positive,
       CASE WHEN {m} THEN {words_sql("regexp_replace(" + _ml_split_sql('query', 2) + ", '[()]', '', 'g')")}
            ELSE []::VARCHAR[] END AS negative
FROM {queries_sql})"""


def _bucket_sql(w: str) -> str:
    return f"CAST(CAST(('0x' || substr(md5({w}), 1, 8)) AS BIGINT) % 768 AS INTEGER)"


def _embed_words_sql(text: str, max_words: int | None) -> str:
    ws = words_sql(text)
    if max_words:
        ws = f"({ws})[1:{max_words}]"
    return (f"list_filter(list_transform({ws}, lambda w: lower(translate(w, {q(PUNCTUATION)}, ''))), "
            f"lambda w: w <> '')")


def _ml_search_sql(rows, match: str, l0: int = 100, l1: int = 20) -> str:
    return f"WITH {_ml_ctes(rows, match, l0, l1)} SELECT * FROM MLR"


def _ml_ctes(rows, match: str, l0: int = 100, l1: int = 20) -> str:
    op = " AND " if match == "all" else " OR "
    return f"""{index_ctes()},
{_ml_parsed_sql(values_sql(rows, 'query_id, query'))},
BQ AS (SELECT query_id, replace(positive, ' ', {q(op)}) AS query FROM MP),
{boolean_ctes('BQ')},
NEG AS (SELECT query_id, lower(unnest(negative)) AS term FROM MP),
EX AS (SELECT DISTINCT NEG.query_id, tf.doc_id FROM NEG JOIN tf ON tf.term = NEG.term),
H2 AS (SELECT * FROM H WHERE NOT EXISTS (SELECT 1 FROM EX WHERE EX.query_id = H.query_id AND EX.doc_id = H.doc_id)),
CA AS (SELECT query_id, doc_id, round(score, 9) AS tfidf,
              row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) - 1 AS l0_rank
       FROM H2 QUALIFY l0_rank < {l0}),
DW AS (SELECT doc_id AS id, unnest({_embed_words_sql('text', None)}) AS w FROM documents
       WHERE doc_id IN (SELECT doc_id FROM CA)),
DV AS (SELECT id, {_bucket_sql('w')} AS bucket, count(*) AS cnt FROM DW GROUP BY ALL),
QEW AS (SELECT query_id AS id, unnest({_embed_words_sql('positive', None)}) AS w FROM MP),
QEV AS (SELECT id, {_bucket_sql('w')} AS bucket, count(*) AS cnt FROM QEW GROUP BY ALL),
DN AS (SELECT id, sum(cnt * cnt) AS sq FROM DV GROUP BY id),
QEN AS (SELECT id, sum(cnt * cnt) AS sq FROM QEV GROUP BY id),
DT AS (SELECT CA.query_id, CA.doc_id, sum(QEV.cnt * DV.cnt) AS dot
       FROM CA JOIN QEV ON QEV.id = CA.query_id JOIN DV ON DV.id = CA.doc_id AND DV.bucket = QEV.bucket
       GROUP BY ALL),
RS AS (SELECT CA.*, round(CASE WHEN QEN.sq * DN.sq > 0 THEN coalesce(DT.dot, 0) / sqrt(CAST(QEN.sq AS DOUBLE) * DN.sq) END, 6) AS cos_sim
       FROM CA LEFT JOIN DT ON DT.query_id = CA.query_id AND DT.doc_id = CA.doc_id
       LEFT JOIN QEN ON QEN.id = CA.query_id LEFT JOIN DN ON DN.id = CA.doc_id),
MLR AS (SELECT CAST(query_id AS BIGINT) AS query_id,
       row_number() OVER (PARTITION BY query_id ORDER BY cos_sim DESC NULLS LAST, l0_rank) - 1 AS rank,
       doc_id, CAST(l0_rank AS BIGINT) AS l0_rank, tfidf, cos_sim
FROM RS QUALIFY rank < {l1})"""


@register("ml_search_all", _ml_search_sql(ML_QUERIES, "all"))
def ml_search_all(spark, sf_dir):
    """CMP-7 (match all positive words, the code's behaviour): L0 Boolean
    candidates, hash-embedding cosine rerank, L1 cut (JN-4/JN-8, VEC-4,
    SRT-6/7/8, WIN-3)."""
    from tessera.operators.rerank import ml_search

    docs = read_corpus(spark, sf_dir)
    return ml_search(I.build_index(docs), docs, _queries_df(spark, ML_QUERIES), match="all")


@register("ml_search_any", _ml_search_sql(ML_QUERIES, "any"))
def ml_search_any(spark, sf_dir):
    """CMP-7 with match any (the README's description, Q3)."""
    from tessera.operators.rerank import ml_search

    docs = read_corpus(spark, sf_dir)
    return ml_search(I.build_index(docs), docs, _queries_df(spark, ML_QUERIES), match="any")


@register("ml_parse", f"""WITH {_ml_parsed_sql("(SELECT * FROM " + values_sql(ML_QUERIES, 'query_id, query') + " UNION ALL SELECT item_id + 1000000, text FROM benchmark)")}
SELECT CAST(query_id AS BIGINT) AS query_id, positive, negative, replace(positive, ' ', ' AND ') AS boolean,
       regexp_replace(regexp_replace(query, 'NOT', '', 'g'), '[()]', '', 'g') AS reduced
FROM MP""")
def ml_parse(spark, sf_dir):
    """STR-11/STR-12/STR-13: split ML queries into positive / negative words,
    the Boolean conjunction and the snippet words; the query table is the
    fixed ML queries plus every text of the ``benchmark`` table."""
    from tessera.functions.text import query_reduce
    from tessera.operators.rerank import parse_ml

    bench = read_table(spark, sf_dir, "benchmark").select(
        (F.col("item_id") + 1000000).alias("query_id"), F.col("text").alias("query"))
    p = parse_ml(_queries_df(spark, ML_QUERIES).unionByName(bench))
    return p.select(F.col("query_id").cast("bigint"), "positive", "negative", "boolean",
                    query_reduce("query").alias("reduced"))


@register("reduced_text", f"""SELECT doc_id,
  array_to_string(list_filter(list_transform(string_split_regex(text, '\\r\\n|\\r|\\n'),
        lambda x: regexp_replace(x, {q(WHITESPACE + '+$')}, '')),
        lambda x: x <> ''), ' ') AS reduced,
  array_to_string(({words_sql('text')})[1:512], ' ') AS reduced_512
FROM documents""")
def reduced_text_q(spark, sf_dir):
    """SRC-3 / STR-9: reduced text, whole and cut to the first 512 words."""
    from tessera.functions.text import reduced_text

    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", reduced_text("text").alias("reduced"), reduced_text("text", 512).alias("reduced_512"))


@register("hash_embedding", f"""SELECT id AS doc_id, bucket, CAST(count(*) AS BIGINT) AS cnt
FROM (SELECT doc_id AS id, {_bucket_sql('w')} AS bucket
      FROM (SELECT doc_id, unnest({_embed_words_sql('text', None)}) AS w FROM documents))
GROUP BY ALL""")
def hash_embedding(spark, sf_dir):
    """CMP-8 / VEC-1 / AGG-13: sparse sum-pooled hash embedding of every
    document, whole texts."""
    from tessera.functions.vectors import hash_embed

    d = read_table(spark, sf_dir, "documents")
    return hash_embed(d, "doc_id", "text").withColumnRenamed("id", "doc_id")


@register("l2_normalize", """SELECT vec_id,
  list_transform(embedding::DOUBLE[], lambda x: round(CASE WHEN n = 0 THEN 0.0 ELSE x / n END, 6)) AS unit,
  round(n, 6) AS norm
FROM (SELECT vec_id, embedding, sqrt(list_reduce(list_transform(embedding::DOUBLE[], lambda x: x * x), lambda a, b: a + b, 0.0)) AS n
      FROM embeddings)""")
def l2_normalize_q(spark, sf_dir):
    """VEC-3 / AGG-14: unit vectors of the embeddings table (zero stays zero)."""
    from tessera.functions.vectors import l2_norm, l2_normalize

    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.transform(l2_normalize("embedding"), lambda x: F.round(x, 6)).alias("unit"),
                    F.round(l2_norm("embedding"), 6).alias("norm"))


@register("rerank_given_vectors", f"""WITH {index_ctes()},
C AS (SELECT 0 AS query_id, doc_id, round(score, 9) AS tfidf,
             row_number() OVER (ORDER BY round(score, 9) DESC, doc_id) - 1 AS l0_rank
      FROM sc WHERE term = 'the' QUALIFY l0_rank < 100),
QV AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = 0),
S AS (SELECT C.*, round(list_reduce(list_transform(list_zip(e.embedding::DOUBLE[], QV.qv), lambda p: p[1] * p[2]), lambda a, b: a + b, 0.0)
                  / (sqrt(list_reduce(list_transform(e.embedding::DOUBLE[], lambda x: x * x), lambda a, b: a + b, 0.0))
                     * sqrt(list_reduce(list_transform(QV.qv, lambda x: x * x), lambda a, b: a + b, 0.0))), 6) AS cos_sim
      FROM C LEFT JOIN embeddings e ON e.vec_id = C.doc_id CROSS JOIN QV)
SELECT CAST(query_id AS BIGINT) AS query_id,
       row_number() OVER (ORDER BY cos_sim DESC NULLS LAST, l0_rank) - 1 AS rank,
       doc_id, CAST(l0_rank AS BIGINT) AS l0_rank, tfidf, cos_sim
FROM S""")
def rerank_given_vectors(spark, sf_dir):
    """CMP-7 / JN-8 / VEC-4 with given dense vectors: the L0 candidates of
    ``the``, reranked by the cosine of their row of ``embeddings`` (vec_id =
    doc_id) to the vector vec_id = 0 as the query's; all 100 candidates, those
    without a vector last."""
    from tessera.operators.rerank import ml_search

    docs = read_corpus(spark, sf_dir)
    emb = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return ml_search(I.build_index(docs), docs, "the", l0=100, l1=100, doc_vectors=emb, query_vectors=emb.where(F.col("id") == 0))


# --- kNN and near-duplicates -------------------------------------------------

KNN_K = 5
GIVEN_THRESHOLD = 0.4  # the given embeddings table has no pair above 0.99


def _given_vectors(spark, sf_dir) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))


_GIVEN_PAIRS_SQL = """E AS (SELECT vec_id, embedding::DOUBLE[] AS v, list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) AS sq
      FROM embeddings),
C AS (SELECT a.vec_id AS doc_id, b.vec_id AS neighbor_id,
             round(CASE WHEN a.sq * b.sq > 0 THEN list_dot_product(a.v, b.v) / sqrt(a.sq * b.sq) END, 6) AS cos_sim
      FROM E a JOIN E b ON a.vec_id <> b.vec_id)"""


@register("knn_topk", f"""WITH {_GIVEN_PAIRS_SQL}
SELECT doc_id, neighbor_id, row_number() OVER (PARTITION BY doc_id ORDER BY cos_sim DESC, neighbor_id) AS rank, cos_sim
FROM C WHERE cos_sim IS NOT NULL QUALIFY rank <= {KNN_K - 1}""")
def knn_topk(spark, sf_dir):
    """JN-10 / VEC-5 / SRT-9 / WIN-4: exact k = 5 (self included) nearest
    neighbours of every vector of the embeddings table."""
    from tessera.operators.pivots import knn_pruned

    return knn_pruned(_given_vectors(spark, sf_dir), k=KNN_K)


@register("knn_topk_cells", ORACLE["knn_topk"])
def knn_topk_cells(spark, sf_dir):
    """VEC-5 with small cells: home cells split twice, bounds from the home
    cell, visits to the cells of the pivot tree within them."""
    from tessera.operators.pivots import knn_pruned

    return knn_pruned(_given_vectors(spark, sf_dir), k=KNN_K, cell_rows=32, fanout=8)


@register("knn_threshold", f"""WITH {_GIVEN_PAIRS_SQL}
SELECT doc_id, neighbor_id, row_number() OVER (PARTITION BY doc_id ORDER BY cos_sim DESC, neighbor_id) AS rank, cos_sim
FROM C WHERE cos_sim > {GIVEN_THRESHOLD} QUALIFY rank <= {KNN_K - 1}""")
def knn_threshold(spark, sf_dir):
    """VEC-6 / FLT-6: exact neighbours with cosine strictly above 0.4."""
    from tessera.operators.duplicates import find_duplicates

    return find_duplicates(_given_vectors(spark, sf_dir), k=KNN_K, threshold=GIVEN_THRESHOLD, dim=None)


def _dup_pairs_sql(threshold: float = 0.99, k: int = KNN_K) -> str:
    return f"""V AS (SELECT id, bucket, count(*) AS cnt FROM (
        SELECT doc_id AS id, {_bucket_sql('w')} AS bucket
        FROM (SELECT doc_id, unnest({_embed_words_sql('text', None)}) AS w FROM documents)) GROUP BY ALL),
NQ AS (SELECT id, sum(cnt * cnt) AS sq FROM V GROUP BY id),
DP AS (SELECT a.id AS doc_id, b.id AS neighbor_id, sum(a.cnt * b.cnt) AS dot
       FROM V a JOIN V b ON a.bucket = b.bucket AND a.id <> b.id GROUP BY ALL),
CS AS (SELECT doc_id, neighbor_id, round(dot / sqrt(CAST(na.sq AS DOUBLE) * nb.sq), 6) AS cos_sim
       FROM DP JOIN NQ na ON na.id = DP.doc_id JOIN NQ nb ON nb.id = DP.neighbor_id),
NB AS (SELECT doc_id, neighbor_id, row_number() OVER (PARTITION BY doc_id ORDER BY cos_sim DESC, neighbor_id) AS rank, cos_sim
       FROM CS WHERE cos_sim > {threshold} QUALIFY rank <= {k - 1}),
DOCP AS (SELECT doc_id, source, source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path FROM documents)"""


def _doc_neighbors(spark, sf_dir, method="exact") -> DataFrame:
    """The near-duplicate table, materialised once (reliable checkpoint) as
    the reference caches its duplicate map: the views join it several times."""
    from tessera.operators.duplicates import embed_corpus, find_duplicates
    from tessera.session import reliable_checkpoint

    docs = read_corpus(spark, sf_dir)
    return reliable_checkpoint(find_duplicates(embed_corpus(docs), method=method))


@register("near_duplicates", f"WITH {_dup_pairs_sql()} SELECT * FROM NB")
def near_duplicates(spark, sf_dir):
    """CMP-9 exact: documents' hash embeddings, k = 5, cosine > 0.99."""
    return _doc_neighbors(spark, sf_dir, "exact")


@register("near_duplicates_cells", f"WITH {_dup_pairs_sql(0.9)} SELECT * FROM NB")
def near_duplicates_cells(spark, sf_dir):
    """CMP-9 / VEC-6 at 0.9 with small cells and blocks: many pivots, guests
    in foreign cells and cut cells; the oracle is the plain pair search."""
    from tessera.operators.duplicates import embed_corpus, find_duplicates

    vectors = embed_corpus(read_corpus(spark, sf_dir))
    return find_duplicates(vectors, threshold=0.9, collapse_copies=False, cell_rows=100, block_rows=64)


@register("near_duplicates_tree", f"WITH {_dup_pairs_sql(0.9)} SELECT * FROM NB")
def near_duplicates_tree(spark, sf_dir):
    """VEC-6 / CMP-9 with at most 8 pivots a level: cells are split by pivots
    of their own until none holds more than 48 home vectors."""
    from tessera.operators.duplicates import embed_corpus, find_duplicates

    vectors = embed_corpus(read_corpus(spark, sf_dir))
    return find_duplicates(vectors, threshold=0.9, collapse_copies=False, cell_rows=24, max_pivots=8, split_rows=48)


@register("near_duplicates_lsh", f"WITH {_dup_pairs_sql()} SELECT * FROM NB")
def near_duplicates_lsh(spark, sf_dir):
    """CMP-9 / VEC-6 scalable path: SimHash LSH candidates (bands derived
    from the threshold), exact cosine re-check.  Its oracle is the exact
    result: LSH can only miss pairs (recall is tested against the exact
    path), so any missed pair shows up as a mismatch."""
    return _doc_neighbors(spark, sf_dir, "lsh")


@register("duplicate_report", f"""WITH {_dup_pairs_sql()},
KEEP AS (SELECT doc_id FROM NB WHERE rank = 1 AND neighbor_id > doc_id)
SELECT NB.doc_id, p.path, NB.rank, NB.neighbor_id, q.path AS neighbor_path
FROM NB JOIN KEEP USING (doc_id) JOIN DOCP p ON p.doc_id = NB.doc_id JOIN DOCP q ON q.doc_id = NB.neighbor_id""")
def duplicate_report_q(spark, sf_dir):
    """CMP-10 / FLT-7 / JN-9 / SNK-6: the duplicate report groups."""
    from tessera.operators.duplicates import duplicate_report

    return duplicate_report(_doc_neighbors(spark, sf_dir), read_corpus(spark, sf_dir))


@register("duplicate_report_lines", f"""WITH {_dup_pairs_sql()},
KEEP AS (SELECT doc_id FROM NB WHERE rank = 1 AND neighbor_id > doc_id)
SELECT p.path AS line FROM KEEP JOIN DOCP p USING (doc_id)
UNION ALL
SELECT chr(9) || q.path FROM NB JOIN KEEP USING (doc_id) JOIN DOCP q ON q.doc_id = NB.neighbor_id""")
def duplicate_report_lines(spark, sf_dir):
    """SNK-6: the report written as text and read back, line by line."""
    from tessera.operators.duplicates import duplicate_report, write_report
    from tessera.session import scratch_path

    path = scratch_path(spark, "duplicate-report")
    write_report(duplicate_report(_doc_neighbors(spark, sf_dir), read_corpus(spark, sf_dir)), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


SOURCE_NAMES = [(0, "SRC3"), (1, "scr3"), (2, "zzzzzzzzzz"), (3, "src1")]


@register("duplicates_of_source", f"""WITH {_dup_pairs_sql()},
QN AS (SELECT * FROM {values_sql(SOURCE_NAMES, 'query_id, name')}),
SRC AS (SELECT DISTINCT source FROM documents),
BEST AS (SELECT query_id, name, source, levenshtein(lower(name), lower(source)) AS distance FROM QN CROSS JOIN SRC
         QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, source) = 1),
OKB AS (SELECT * FROM BEST WHERE distance <= length(name) // 2)
SELECT CAST(OKB.query_id AS BIGINT) AS query_id, OKB.source, CAST(OKB.distance AS BIGINT) AS distance,
       NB.doc_id, p.path, NB.rank, NB.neighbor_id, q.path AS neighbor_path
FROM OKB JOIN DOCP p ON p.source = OKB.source JOIN NB ON NB.doc_id = p.doc_id JOIN DOCP q ON q.doc_id = NB.neighbor_id""")
def duplicates_of_source_q(spark, sf_dir):
    """CMP-11 / JN-11 / STR-14 / AGG-11 / FLT-8 / FLT-9: duplicates of the
    documents of a fuzzily named source."""
    from tessera.operators.duplicates import duplicates_of_source

    names = spark.createDataFrame(SOURCE_NAMES, "query_id bigint, name string")
    return duplicates_of_source(_doc_neighbors(spark, sf_dir), read_corpus(spark, sf_dir), names)


@register("duplicates_of_document", f"""WITH {_dup_pairs_sql()},
QP AS (SELECT doc_id AS query_id, '/data/corpus/' || path AS req FROM DOCP),
HIT AS (SELECT QP.query_id, d.doc_id FROM QP JOIN DOCP d
        ON d.path = array_to_string(string_split(QP.req, '/')[-2:], '/'))
SELECT CAST(HIT.query_id AS BIGINT) AS query_id, NB.doc_id, p.path, NB.rank, NB.neighbor_id, q.path AS neighbor_path
FROM HIT JOIN NB ON NB.doc_id = HIT.doc_id JOIN DOCP p ON p.doc_id = NB.doc_id JOIN DOCP q ON q.doc_id = NB.neighbor_id""")
def duplicates_of_document_q(spark, sf_dir):
    """CMP-12 / PRJ-3 / JN-12: every document looked up by a user path
    (``/data/corpus/<source>/<id>.txt``) and its duplicates."""
    from tessera.operators.duplicates import duplicates_of_document

    docs = read_corpus(spark, sf_dir)
    paths = docs.select(F.col("doc_id").alias("query_id"), F.concat(F.lit("/data/corpus/"), "path").alias("path"))
    return duplicates_of_document(_doc_neighbors(spark, sf_dir), docs, paths)


@register("source_ranges", """WITH O AS (SELECT source, row_number() OVER (ORDER BY source || '/' || CAST(doc_id AS VARCHAR) || '.txt') - 1 AS o
FROM documents)
SELECT source, min(o) AS start, max(o) + 1 AS "end", count(*) AS n_docs FROM O GROUP BY source""")
def source_ranges_q(spark, sf_dir):
    """AGG-10 / WIN-5 / D14: first ordinal, end and size of each source over
    documents ordered by path (ordinals from the distributed WIN-1)."""
    from tessera.operators.duplicates import source_ranges
    from tessera.sources.corpus import ordinal

    docs = ordinal(read_corpus(spark, sf_dir).select("source", "path"), "path", "doc_ord")
    return source_ranges(docs).select("source", "start", "end", F.col("n_docs").cast("bigint"))


@register("doc_ordinal", """SELECT doc_id, source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path,
  row_number() OVER (ORDER BY source || '/' || CAST(doc_id AS VARCHAR) || '.txt') - 1 AS doc_ord FROM documents""")
def doc_ordinal(spark, sf_dir):
    """WIN-1 / SRT-1: dense ordinal of documents by sorted path, computed
    without a single-partition window."""
    from tessera.sources.corpus import ordinal

    return ordinal(read_corpus(spark, sf_dir).select("doc_id", "path"), "path", "doc_ord")


FUZZY_NAMES = [(0, "smal rng"), (1, "abc"), (2, "red widgett"), (3, "BLUE BOLT")]


@register("fuzzy_name", f"""WITH QN AS (SELECT * FROM {values_sql(FUZZY_NAMES, 'query_id, name')}),
NM AS (SELECT DISTINCT p_name AS match FROM part),
BEST AS (SELECT query_id, name AS query, match, levenshtein(lower(name), lower(match)) AS distance FROM QN CROSS JOIN NM
         QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, match) = 1)
SELECT CAST(query_id AS BIGINT) AS query_id, query, match, CAST(distance AS BIGINT) AS distance
FROM BEST WHERE distance <= length(query) // 2""")
def fuzzy_name(spark, sf_dir):
    """JN-11 / STR-14 / AGG-11 / FLT-9: closest part name by edit distance."""
    from tessera.operators.fuzzy import fuzzy_lookup

    names = spark.createDataFrame(FUZZY_NAMES, "query_id bigint, name string")
    return fuzzy_lookup(names, read_table(spark, sf_dir, "part"), "p_name")


@register("fuzzy_name_segments", ORACLE["fuzzy_name"])
def fuzzy_name_segments(spark, sf_dir):
    """JN-11 by the segment index: near names first, the rest by length bands."""
    from tessera.operators.fuzzy import nearest_names

    names = spark.createDataFrame(FUZZY_NAMES, "query_id bigint, name string")
    return nearest_names(names, read_table(spark, sf_dir, "part"), "p_name")


STATUS_NAMES = [(0, "src0"), (1, "SRC1"), (2, "srx12"), (3, "unheard of"), (4, "s"), (5, "sources")]


@register("source_status", f"""WITH QN AS (SELECT * FROM {values_sql(STATUS_NAMES, 'query_id, name')}),
NM AS (SELECT DISTINCT source AS match FROM documents WHERE source IS NOT NULL),
BEST AS (SELECT query_id, name, match, levenshtein(lower(name), lower(match)) AS distance FROM QN CROSS JOIN NM
         QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, match) = 1)
SELECT CAST(query_id AS BIGINT) AS query_id, CASE WHEN distance <= length(name) // 2 THEN 'ok' ELSE 'not_found' END AS status,
       CASE WHEN distance <= length(name) // 2 THEN match END AS source, CASE WHEN distance <= length(name) // 2 THEN CAST(distance AS BIGINT) END AS distance
FROM BEST""")
def source_status(spark, sf_dir):
    """FLT-10: whether a requested source is found, and which one."""
    from tessera.operators import duplicates

    names = spark.createDataFrame(STATUS_NAMES, "query_id bigint, name string")
    return duplicates.source_status(read_corpus(spark, sf_dir), names)


# --- Boolean operators as standalone posting-list algebra (JN-1..JN-5) -------

def _term_sc_sql(term: str, alias: str) -> str:
    return f"{alias} AS (SELECT doc_id, score FROM sc WHERE term = {q(term)})"


def _algebra(spark, sf_dir, *words):
    idx = _index(spark, sf_dir).materialized(list(words))  # several lookups read them
    n = idx.num_docs()
    return idx, (lambda w: B.term_postings(idx, w, num_docs=n))


def _scored(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.round("score", 9).alias("score"))


@register("bool_and", f"""WITH {index_ctes()}, {_term_sc_sql('the', 'A')}, {_term_sc_sql('of', 'Bq')}
SELECT A.doc_id, round(A.score + Bq.score, 9) AS score FROM A JOIN Bq USING (doc_id)""")
def bool_and(spark, sf_dir):
    """JN-1 / SET-1: ``the AND of`` as an inner join with summed scores."""
    _, t = _algebra(spark, sf_dir, "the", "of")
    return _scored(B.and_postings(t("the"), t("of")))


@register("bool_or", f"""WITH {index_ctes()}, {_term_sc_sql('der', 'A')}, {_term_sc_sql('und', 'Bq')}
SELECT coalesce(A.doc_id, Bq.doc_id) AS doc_id, round(coalesce(A.score, 0) + coalesce(Bq.score, 0), 9) AS score
FROM A FULL OUTER JOIN Bq ON A.doc_id = Bq.doc_id""")
def bool_or(spark, sf_dir):
    """JN-2 / SET-2: ``der OR und`` as a full outer join."""
    _, t = _algebra(spark, sf_dir, "der", "und")
    return _scored(B.or_postings(t("der"), t("und")))


@register("bool_not", f"""WITH {index_ctes()}, {_term_sc_sql('the', 'A')}
SELECT doc_id, CAST(0 AS DOUBLE) AS score FROM dl WHERE doc_id NOT IN (SELECT doc_id FROM A)""")
def bool_not(spark, sf_dir):
    """JN-3 / SET-3: ``NOT the``: every other document, score 0."""
    idx, t = _algebra(spark, sf_dir, "the")
    return _scored(B.not_postings(t("the"), idx.doc_stats))


@register("bool_and_not", f"""WITH {index_ctes()}, {_term_sc_sql('the', 'A')}, {_term_sc_sql('of', 'Bq')}
SELECT doc_id, round(score, 9) AS score FROM Bq WHERE doc_id NOT IN (SELECT doc_id FROM A)""")
def bool_and_not(spark, sf_dir):
    """JN-4 / SET-4: ``NOT the AND of`` as a difference (Q2 fixed)."""
    _, t = _algebra(spark, sf_dir, "the", "of")
    return _scored(B.not_and_postings(t("the"), t("of")))


@register("bool_or_not", f"""WITH {index_ctes()}, {_term_sc_sql('the', 'A')}, {_term_sc_sql('queen', 'Bq')},
NA AS (SELECT doc_id, 0.0 AS score FROM dl WHERE doc_id NOT IN (SELECT doc_id FROM A))
SELECT coalesce(NA.doc_id, Bq.doc_id) AS doc_id, round(coalesce(NA.score, 0) + coalesce(Bq.score, 0), 9) AS score
FROM NA FULL OUTER JOIN Bq ON NA.doc_id = Bq.doc_id""")
def bool_or_not(spark, sf_dir):
    """JN-5: ``NOT the OR queen``."""
    idx, t = _algebra(spark, sf_dir, "the", "queen")
    return _scored(B.not_or_postings(t("the"), t("queen"), idx.doc_stats))


# --- name index (CMP-6) on part: path = p_brand/p_name.txt -------------------

def _part_docs(spark, sf_dir) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("doc_id"), F.col("p_brand").alias("source"),
                    F.concat("p_brand", F.lit("/"), "p_name", F.lit(".txt")).alias("path"),
                    F.col("p_name").alias("text"))


NAME_QUERY = "small AND ring OR Brand#3"


@register("name_search", f"""WITH
ND AS (SELECT p_partkey AS doc_id, p_brand || ' - ' || split_part(p_name, '.', 1) AS pretty, p_name AS text FROM part),
dl AS (SELECT doc_id, CAST(len({words_sql('text')}) AS BIGINT) AS doc_len FROM ND),
tf AS (SELECT DISTINCT lower(unnest({words_sql('pretty')})) AS term, doc_id, 1 AS tf FROM ND),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT CAST(count(*) AS DOUBLE) AS N FROM ND),
sc AS (SELECT tf.term, tf.doc_id, tf.tf / dl.doc_len * log2(n.N / dfs.df) AS score
       FROM tf JOIN dl USING (doc_id) JOIN dfs USING (term) CROSS JOIN n),
c1 AS (SELECT a.doc_id, a.score + b.score AS s FROM sc a JOIN sc b ON a.doc_id = b.doc_id
       WHERE a.term = 'small' AND b.term = 'ring'),
c2 AS (SELECT doc_id, score AS s FROM sc WHERE term = 'brand#3'),
hits AS (SELECT 0 AS query_id, doc_id, sum(s) AS score FROM (SELECT * FROM c1 UNION ALL SELECT * FROM c2) GROUP BY doc_id)
{ranked_sql('hits', 10)}""")
def name_search(spark, sf_dir):
    """CMP-6 / AGG-7 / PRJ-1: Boolean search over the name index of parts
    (name words kept with punctuation, tf = 1)."""
    docs = _part_docs(spark, sf_dir)
    idx = I.Index(I.build_name_index(docs), I.doc_stats(docs), "lower")
    return B.boolean_search(idx, NAME_QUERY, count=10)


@register("name_search_stored", ORACLE["name_search"])
def name_search_stored(spark, sf_dir):
    """SNK-3 / CMP-6: the same search on the written name index."""
    from tessera.session import scratch_path

    path = scratch_path(spark, "names-index")
    I.write_name_index(_part_docs(spark, sf_dir), path)
    return B.boolean_search(I.read_index(spark, path), NAME_QUERY, count=10)


@register("postings_stemmed", f"WITH {stemmed_index_ctes()} SELECT term, doc_id, tf FROM tf")
def postings_stemmed(spark, sf_dir):
    """STR-3 / CMP-3 with the Porter analyzer (the reference default): stems
    computed once per distinct word form, joined back."""
    return _index(spark, sf_dir, "porter").postings.select("term", "doc_id", "tf")


STEM_QUERY = "licensed OR queens AND NOT the"
_STEM_QUERY_SQL = values_sql([(0, STEM_QUERY)], "query_id, query")


@register("bool_stemmed", f"""WITH {stemmed_index_ctes("(SELECT * FROM " + _STEM_QUERY_SQL + ")")},
{boolean_ctes(_STEM_QUERY_SQL, "(SELECT STEMS.term FROM STEMS WHERE STEMS.token = word)")}
{ranked_sql("H", 10)}""")
def bool_stemmed(spark, sf_dir):
    """CMP-4 with stemming on both sides (``licensed`` finds ``license``)."""
    return B.boolean_search(_index(spark, sf_dir, "porter"), STEM_QUERY, count=10)


# --- scalar text functions -------------------------------------------------

@register("bracket_strip", """SELECT doc_id, regexp_replace(text, '[\\(\\[].*?[\\)\\]]', '', 'g') AS stripped FROM documents""")
def bracket_strip(spark, sf_dir):
    """STR-5: bracketed annotations removed."""
    from tessera.functions.text import strip_brackets

    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", strip_brackets("text").alias("stripped"))


@register("blank_lines", f"""SELECT doc_id,
  array_to_string(list_filter(string_split_regex(text, {q(SPLITLINES_BREAK)}), lambda x: x <> ''), chr(10)) AS cleaned
FROM documents""")
def blank_lines(spark, sf_dir):
    """STR-6: empty lines dropped."""
    from tessera.functions.text import drop_blank_lines

    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", drop_blank_lines("text").alias("cleaned"))


@register("pretty_names", """SELECT doc_id, source || ' - ' || CAST(doc_id AS VARCHAR) AS pretty_name,
  source AS source_of_path, source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path_key, replace(source, '/', '_') AS safe
FROM documents""")
def pretty_names(spark, sf_dir):
    """PRJ-1..PRJ-4 over corpus paths (``/data/<source>/<id>.txt``)."""
    from tessera.functions.text import path_key, pretty_name, safe_title, source_of_path

    docs = read_corpus(spark, sf_dir).withColumn("full", F.concat(F.lit("/data/"), "path"))
    return docs.select("doc_id", pretty_name("full").alias("pretty_name"),
                       source_of_path(path_key("full")).alias("source_of_path"),
                       path_key("full").alias("path_key"), safe_title("source").alias("safe"))


# --- sources and sinks ---------------------------------------------------------

@register("json_flatten", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_flatten(spark, sf_dir):
    """STR-15: nested JSON field access with an explicit schema."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


def _listings(spark, sf_dir) -> DataFrame:
    """Stand-in landed listing pages built from ``part``: 20 songs per page
    (page = p_partkey div 20), requested artist = brand of the page's first
    song.  Only JSON rows; the flattening is the job."""
    p = read_table(spark, sf_dir, "part").select(
        (F.col("p_partkey") / 20).cast("bigint").alias("page"), "p_partkey",
        F.substring_index("p_brand", "#", -1).cast("bigint").alias("aid"), "p_name")
    song = F.struct(F.col("p_partkey"), F.struct(
        F.col("p_name").alias("title"),
        F.concat(F.lit("https://songs.example/"), F.col("p_partkey").cast("string")).alias("url"),
        F.struct(F.col("aid").alias("id")).alias("primary_artist")).alias("s"))
    g = p.groupBy("page").agg(F.sort_array(F.collect_list(song)).alias("l"), F.min_by("aid", "p_partkey").alias("artist_id"))
    js = F.to_json(F.struct(F.struct(F.col("l.s").alias("songs"), (F.col("page") + 1).alias("next_page")).alias("response")))
    return g.select("artist_id", "page", js.alias("json"))


@register("listing_to_corpus", """WITH P AS (SELECT p_partkey // 20 AS page, p_partkey, p_name, CAST(split_part(p_brand, '#', 2) AS BIGINT) AS aid FROM part),
FP AS (SELECT page, arg_min(aid, p_partkey) AS artist_id FROM P GROUP BY page),
S AS (SELECT P.*, row_number() OVER (PARTITION BY page ORDER BY p_partkey) - 1 AS pos FROM P)
SELECT FP.artist_id, S.page, S.pos, S.p_name AS title, 'https://songs.example/' || CAST(S.p_partkey AS VARCHAR) AS url
FROM S JOIN FP USING (page) WHERE S.aid = FP.artist_id""")
def listing_to_corpus(spark, sf_dir):
    """CMP-2 / SRC-6 / FLT-2: flatten paged listings to the requested
    artist's songs."""
    from tessera.operators.ingest import flatten_listing

    return flatten_listing(_listings(spark, sf_dir))


def _seed_hits(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    seeds = (part.select(F.upper("p_name").alias("seed")).distinct()
             .unionByName(part.select(F.concat(F.upper(F.substring_index("p_name", " ", 1)), F.lit(" THING")).alias("seed")))
             .distinct())
    # Stand-in search answers: every part sharing the seed's first word, in
    # key order; the exact name is somewhere in that list (or nowhere).
    cand = part.select(F.lower(F.substring_index("p_name", " ", 1)).alias("w"),
                       F.col("p_partkey").alias("hit_pos"), F.col("p_partkey").alias("artist_id"),
                       F.col("p_name").alias("artist_name"))
    hits = seeds.withColumn("w", F.lower(F.substring_index("seed", " ", 1))).join(cand, "w").drop("w")
    return seeds, hits


_SEED_SQL = """S AS (SELECT DISTINCT upper(p_name) AS seed FROM part
       UNION SELECT DISTINCT upper(split_part(p_name, ' ', 1)) || ' THING' FROM part),
H AS (SELECT S.seed, p.p_partkey AS hit_pos, p.p_partkey AS artist_id, p.p_name AS artist_name
      FROM S JOIN part p ON lower(split_part(S.seed, ' ', 1)) = lower(split_part(p.p_name, ' ', 1))),
R AS (SELECT seed, arg_min(artist_id, hit_pos) AS artist_id, min(hit_pos) AS hit_pos
      FROM H WHERE lower(artist_name) = lower(seed) GROUP BY seed)"""


@register("resolve_entities", f"WITH {_SEED_SQL} SELECT seed, artist_id, hit_pos FROM R")
def resolve_entities_q(spark, sf_dir):
    """JN-13 / WIN-6 / FLT-1: first case-insensitive exact hit per seed."""
    from tessera.operators.ingest import resolve_entities

    seeds, hits = _seed_hits(spark, sf_dir)
    return resolve_entities(seeds, hits)


@register("unresolved_entities", f"WITH {_SEED_SQL} SELECT seed FROM S WHERE seed NOT IN (SELECT seed FROM R)")
def unresolved_entities_q(spark, sf_dir):
    """FLT-4: seeds without an exact hit."""
    from tessera.operators.ingest import resolve_entities, unresolved_entities

    seeds, hits = _seed_hits(spark, sf_dir)
    return unresolved_entities(seeds, resolve_entities(seeds, hits))


def _html_extract_sql() -> str:
    """Regex form for the test pages (first <article>, no script/style/
    comment inside it, entities limited to amp/quot, with or without ';' as
    HTML5 allows for these legacy names) — checked equal at sf0.001-0.1."""
    return f"""WITH A AS (
  SELECT page_id, regexp_extract(html, {q('(?s)<article[^>]*>(.*?)</article>')}, 1) AS body,
         regexp_matches(html, {q('<article[\\s>]')}) AS has
  FROM pages),
R AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(body, '<[^>]*>', '', 'g'),
                                                    '&quot;?', '"', 'g'), '&amp;?', '&', 'g') AS raw
      FROM A WHERE has),
C AS (SELECT page_id, array_to_string(list_filter(string_split_regex(
        regexp_replace(raw, {q(r'[\(\[].*?[\)\]]')}, '', 'g'), {q(SPLITLINES_BREAK)}), lambda x: x <> ''), chr(10)) AS text
      FROM R)
SELECT page_id, text FROM C WHERE text <> ''"""


@register("html_extract", _html_extract_sql())
def html_extract(spark, sf_dir):
    """STR-7 / FLT-3: text of each page's ``<article>`` (scripts, styles,
    comments excluded), brackets and empty lines removed."""
    from tessera.functions.html import extract_element_text
    from tessera.operators.ingest import clean_text

    pages = read_table(spark, sf_dir, "pages")
    t = extract_element_text(pages.select("page_id", "url", "html"), "html", "article", None, "raw")
    return t.select("page_id", clean_text(F.col("raw")).alias("text")).where(F.col("text").isNotNull() & (F.col("text") != ""))


def _pages_corpus_sql() -> str:
    """``_html_extract_sql`` plus artist = URL host and title = URL path with
    '/' made file-safe — checked equal at sf0.001-0.1."""
    body = _html_extract_sql().replace("SELECT page_id, text FROM C WHERE text <> ''", "").rstrip()
    return body + f""",
U AS (SELECT page_id, regexp_extract(url, {q('^[a-z]+://([^/:?#]+)')}, 1) AS artist,
             translate(regexp_extract(url, {q('^[a-z]+://[^/]+/(.*?)(\\?|$)')}, 1), '/', '_') AS title FROM pages)
SELECT U.artist, U.title, C.text FROM C JOIN U USING (page_id) WHERE C.text <> ''"""


@register("pages_to_corpus", _pages_corpus_sql())
def pages_to_corpus(spark, sf_dir):
    """CMP-1 / SRC-5 / PRJ-4: pages -> (artist = site, title = page path,
    text) corpus rows; written and re-read through SNK-7."""
    from tessera.operators.ingest import extract_corpus, write_corpus
    from tessera.session import scratch_path

    pages = read_table(spark, sf_dir, "pages").select(
        F.expr("parse_url(url, 'HOST')").alias("artist"),
        F.regexp_extract("url", r"^[a-z]+://[^/]+/(.*?)(\?|$)", 1).alias("title"), "html")
    corpus = extract_corpus(pages, tag="article", css_class=None)
    out = scratch_path(spark, "pages_corpus")
    write_corpus(corpus, out)
    return spark.read.parquet(out).select("artist", "title", "text")


@register("index_roundtrip", f"""WITH {index_ctes()}
SELECT term, doc_id, tf, doc_len FROM tf JOIN dl USING (doc_id) WHERE term IN ('queen', 'license')""")
def index_roundtrip(spark, sf_dir):
    """SNK-2 / SRC-7 / SRT-2: write the index range-partitioned and sorted by
    term, reopen it, look up two terms (pushed-down filter on the scan)."""
    from tessera.session import scratch_path

    path = scratch_path(spark, "index")
    I.write_index(_index(spark, sf_dir), path)
    idx = I.read_index(spark, path)
    return idx.postings.where(F.col("term").isin("queen", "license")).select("term", "doc_id", "tf", "doc_len")


@register("corpus_roundtrip", """SELECT doc_id, source, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines FROM documents""")
def corpus_roundtrip(spark, sf_dir):
    """SNK-1 / SNK-7 / SRC-2 / PRJ-2: corpus written partitioned by source,
    re-read whole (source recovered from the partition folders), read line by
    line (lines per document)."""
    from tessera.session import scratch_path
    from tessera.sources.corpus import read_lines

    docs = read_corpus(spark, sf_dir)
    out = scratch_path(spark, "corpus")
    docs.repartitionByRange("source", "doc_id").write.mode("overwrite").partitionBy("source").parquet(out)
    back = spark.read.parquet(out)
    lines = read_lines(back).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))
    return back.select("doc_id", "source").join(lines, "doc_id").select("doc_id", "source", F.col("n_lines").cast("bigint"))


@register("vectors_roundtrip", f"""SELECT id AS doc_id, CAST(count(*) AS BIGINT) AS n_buckets, CAST(sum(cnt * cnt) AS BIGINT) AS sq
FROM (SELECT id, bucket, count(*) AS cnt FROM (SELECT doc_id AS id, {_bucket_sql('w')} AS bucket
      FROM (SELECT doc_id, unnest({_embed_words_sql('text', None)}) AS w FROM documents)) GROUP BY ALL) GROUP BY id""")
def vectors_roundtrip(spark, sf_dir):
    """CMP-8 / SNK-4 / SRC-8: corpus embeddings, computed and written by the
    first call, found by the second."""
    from tessera.session import scratch_path
    from tessera.sources.tables import corpus_vectors

    out, docs = scratch_path(spark, "vectors"), read_corpus(spark, sf_dir)
    corpus_vectors(spark, out, docs)
    v = corpus_vectors(spark, out, docs)
    return v.select(F.col("id").alias("doc_id"), F.size("idx").cast("bigint").alias("n_buckets"),
                    F.aggregate("val", F.lit(0.0), lambda a, x: a + x * x).cast("bigint").alias("sq"))


@register("neighbors_roundtrip", f"""WITH {_dup_pairs_sql()}
SELECT doc_id, list(neighbor_id ORDER BY rank) AS neighbors FROM NB GROUP BY doc_id""")
def neighbors_roundtrip(spark, sf_dir):
    """SNK-5 / SRC-9 / AGG-12: the duplicate table, computed and written by
    the first call, found by the second, folded into per-document neighbour
    lists in rank order."""
    from tessera.operators.duplicates import embed_corpus
    from tessera.operators.knn import neighbor_lists
    from tessera.operators.skew import write_vectors
    from tessera.session import scratch_path
    from tessera.sources.tables import duplicate_table

    # written: each call takes their fingerprint, and the first one searches them
    out, vectors = scratch_path(spark, "neighbors"), write_vectors(embed_corpus(read_corpus(spark, sf_dir)), "vectors")
    duplicate_table(spark, out, vectors)
    return neighbor_lists(duplicate_table(spark, out, vectors))


@register("text_tree", """SELECT row_number() OVER (ORDER BY source || '/' || CAST(doc_id AS VARCHAR) || '.txt') - 1 AS doc_id, source,
  source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, md5(text || chr(10)) AS text_md5 FROM documents""")
def text_tree(spark, sf_dir):
    """SRC-1 / WIN-1: the documents written as a tree of text files, a folder
    per source and document, and read back whole (a text file ends with a line
    end); ids are ordinals of the sorted paths."""
    from tessera.session import scratch_path, shuffles_freed
    from tessera.sources.corpus import read_text_tree

    root = scratch_path(spark, "text-tree")
    docs = read_corpus(spark, sf_dir).select(F.col("source").alias("band"), F.substring_index("path", "/", -1).alias("song"), "text")
    # a file a document costs more than its bytes: as many tasks as there are
    # partitions, whatever their size.  Version 2: tasks move their own files at
    # their commit, not the driver all of them at the end
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = docs.repartitionByRange(parts, "band", "song").write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    # on a local path the checksummed file system writes two files a document and
    # starts chmod four times; the plain one writes one and starts it once
    out = out.option("fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem").option("fs.file.impl.disable.cache", "true")
    with shuffles_freed(spark):
        out.partitionBy("band", "song").text(root)
    tree = read_text_tree(spark, root, lambda p: F.regexp_replace(p, "^.*/band=([^/]*)/song=([^/]*)/[^/]*$", "$1/$2"))
    return tree.select("doc_id", "source", "path", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@register("seed_list", "SELECT DISTINCT p_name AS name FROM part")
def seed_list(spark, sf_dir):
    """SRC-4: the distinct part names written one per line and read back."""
    from tessera.session import scratch_path
    from tessera.sources.corpus import read_seeds

    path = scratch_path(spark, "seeds")
    read_table(spark, sf_dir, "part").select("p_name").distinct().write.text(path)
    return read_seeds(spark, path)


@register("search_answers", """SELECT p_brand AS seed, row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_partkey) - 1 AS hit_pos,
  p_partkey AS artist_id, p_name AS artist_name FROM part""")
def search_answers(spark, sf_dir):
    """STR-15 / CMP-2: search answers, landed as JSON (an answer per brand and
    size of ``part``), flattened to their hits."""
    from tessera.operators.ingest import search_hits

    artist = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    hit = F.struct("p_partkey", F.struct(F.struct(artist.alias("primary_artist")).alias("result")).alias("h"))
    answers = read_table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("seed"), "p_size").agg(F.sort_array(F.collect_list(hit)).alias("l"))
    landed = answers.select("seed", F.to_json(F.struct(F.struct(F.col("l.h").alias("hits")).alias("response"))).alias("json"))
    return search_hits(landed)


@register("posting_map_merge", f"WITH {index_ctes()} SELECT term, doc_id, tf FROM tf")
def posting_map_merge(spark, sf_dir):
    """MAP-1 / D5: nested (term, chunk) -> MAP<doc, tf> views of two blocks
    (even and odd lines of every document) merged with ``map_zip_with``, in
    small chunks, flattened back to rows."""
    a, b = (I.posting_maps(I.build_index(d).postings, chunk=100) for d in _cut_documents(read_corpus(spark, sf_dir)))
    m = I.merge_posting_maps(a, b)
    return m.select("term", F.explode("postings").alias("doc_id", "tf")).select(
        "term", "doc_id", F.col("tf").cast("bigint"))


_LETTERS_SQL = "list_transform(range(26), lambda i: CAST(length({0}) - length(replace({0}, chr(CAST(97 + i AS INTEGER)), '')) AS FLOAT))"


def _letter_model():
    """A user's model: how often each letter occurs."""
    import numpy as np

    def model(texts):
        rows = [np.frombuffer(t.lower().encode("utf-32-le"), np.uint32) for t in texts]
        return np.stack([np.bincount(r[(r >= 97) & (r < 123)] - 97, minlength=26) for r in rows])

    return model


@register("embed_with_user_model", f"SELECT doc_id, {_LETTERS_SQL.format('lower(text)')} AS embedding FROM documents")
def embed_with_user_model(spark, sf_dir):
    """VEC-2: a user's model plugged in as an iterator Arrow UDF, applied to
    the reduced texts, whole."""
    from tessera.functions.text import reduced_text
    from tessera.functions.vectors import model_embedder

    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", model_embedder(_letter_model, dim=26)(reduced_text("text")).alias("embedding"))


@register("ml_search_user_model", f"""WITH {index_ctes()},
C AS (SELECT doc_id, round(score, 9) AS tfidf, row_number() OVER (ORDER BY round(score, 9) DESC, doc_id) - 1 AS l0_rank
      FROM sc WHERE term = 'license' QUALIFY l0_rank < 100),
E AS (SELECT doc_id, list_transform({_LETTERS_SQL.format('lower(text)')}, lambda x: CAST(x AS DOUBLE)) AS v FROM documents),
Q AS (SELECT list_transform({_LETTERS_SQL.format("'license'")}, lambda x: CAST(x AS DOUBLE)) AS v),
S AS (SELECT C.*, round(list_dot_product(E.v, Q.v) / (sqrt(list_dot_product(E.v, E.v)) * sqrt(list_dot_product(Q.v, Q.v))), 6) AS cos_sim
      FROM C JOIN E USING (doc_id) CROSS JOIN Q)
SELECT 0::BIGINT AS query_id, row_number() OVER (ORDER BY cos_sim DESC, l0_rank) - 1 AS rank, doc_id, CAST(l0_rank AS BIGINT) AS l0_rank, tfidf, cos_sim
FROM S QUALIFY rank < 20""")
def ml_search_user_model(spark, sf_dir):
    """VEC-2 / CMP-7: search reranked by a user's model on both sides."""
    from tessera.functions.text import reduced_text
    from tessera.functions.vectors import model_embedder
    from tessera.operators.rerank import ml_search

    docs, embed = read_corpus(spark, sf_dir), model_embedder(_letter_model, dim=26)
    queries = _queries_df(spark, [(0, "license")])
    vectors = docs.select(F.col("doc_id").alias("id"), embed(reduced_text("text")).alias("vec"))
    asked = queries.select(F.col("query_id").alias("id"), embed(F.col("query")).alias("vec"))
    return ml_search(I.build_index(docs), docs, queries, doc_vectors=vectors, query_vectors=asked)


# --- streaming ----------------------------------------------------------------

@register("stream_index", f"WITH {index_ctes()} SELECT term, doc_id, tf FROM tf")
def stream_index(spark, sf_dir):
    """Structured Streaming index maintenance: documents landed as several
    files are streamed one file per micro-batch, each batch inverted into a
    block (idempotent ``foreachBatch``), blocks merged and written as the
    range-sorted index, which is read back."""
    from tessera.session import scratch_path, shuffles_freed
    from tessera.streaming.index_stream import compact_index, start_index_stream

    stage = scratch_path(spark, "landed-docs")
    with shuffles_freed(spark):
        read_table(spark, sf_dir, "documents").repartition(4, "source").write.option("compression", "zstd").mode("overwrite").parquet(stage)
    base = scratch_path(spark, "stream-index")
    q_ = start_index_stream(spark, stage, base, f"{base}/_checkpoint", files_per_batch=1)
    q_.awaitTermination()
    compact_index(spark, base, f"{base}/index")
    return I.read_index(spark, f"{base}/index").postings.select("term", "doc_id", "tf")


@register("ml_snippets", f"""WITH {_ml_ctes(ML_QUERIES, "all")},
MPW AS (SELECT query_id, unnest(generate_series(0, len(ws) - 1)) AS word_no, unnest(ws) AS word
        FROM (SELECT query_id, {words_sql('positive')} AS ws FROM MP)),
MPW2 AS (SELECT * FROM MPW WHERE word NOT IN ('AND', 'OR', 'NOT')),
{_snippet_sql("SELECT query_id, rank, doc_id, cos_sim AS score FROM MLR", "MPW2")}""")
def ml_snippets(spark, sf_dir):
    """CMP-7 rendering: snippets of the reranked ML hits for the positive
    query words only (Q21 fixed: negated words are not searched)."""
    from tessera.operators.rerank import ml_search, parse_ml
    from tessera.operators.snippets import query_words, snippets

    docs = read_corpus(spark, sf_dir)
    qdf = _queries_df(spark, ML_QUERIES)
    res = ml_search(I.build_index(docs), docs, qdf, match="all")
    hits = res.select("query_id", "rank", "doc_id", F.col("cos_sim").alias("score"))
    words = query_words(parse_ml(qdf).select("query_id", F.col("positive").alias("query")))
    return snippets(hits, docs, words)


@register("source_boundaries", """WITH O AS (SELECT source, row_number() OVER (ORDER BY source || '/' || CAST(doc_id AS VARCHAR) || '.txt') - 1 AS o
FROM documents),
L AS (SELECT o, source, lag(source) OVER (ORDER BY o) AS prev FROM O)
SELECT source, o AS start, prev AS prev_source FROM L WHERE prev IS NULL OR prev <> source""")
def source_boundaries(spark, sf_dir):
    """WIN-5: where the source changes in path order, with the previous
    source — from the per-source ranges (AGG-10) joined end-to-start, not
    from a window over the whole corpus."""
    from tessera.operators.duplicates import source_ranges
    from tessera.sources.corpus import ordinal

    r = source_ranges(ordinal(read_corpus(spark, sf_dir).select("source", "path"), "path", "doc_ord"))
    prev = r.select(F.col("end").alias("start"), F.col("source").alias("prev_source"))
    return r.select("source", "start").join(prev, "start", "left").select("source", "start", "prev_source")


@register("document_status", f"""WITH {_dup_pairs_sql()},
QP AS (SELECT doc_id AS query_id, path AS req FROM DOCP
       UNION ALL SELECT -1, 'nowhere/none.txt' UNION ALL SELECT -2, 'x/y/src0/999999999.txt'),
HIT AS (SELECT QP.query_id, d.doc_id FROM QP LEFT JOIN DOCP d ON d.path = array_to_string(string_split(QP.req, '/')[-2:], '/'))
SELECT CAST(query_id AS BIGINT) AS query_id,
       CASE WHEN HIT.doc_id IS NULL THEN 'not_found'
            WHEN HIT.doc_id NOT IN (SELECT doc_id FROM NB) THEN 'no_duplicates' ELSE 'ok' END AS status
FROM HIT""")
def document_status_q(spark, sf_dir):
    """FLT-10 for CMP-12: 'not_found' / 'no_duplicates' / 'ok' for every
    document path plus two unknown paths."""
    from tessera.operators.duplicates import document_status

    docs = read_corpus(spark, sf_dir)
    extra = spark.createDataFrame([(-1, "nowhere/none.txt"), (-2, "x/y/src0/999999999.txt")],
                                  "query_id bigint, path string")
    paths = docs.select(F.col("doc_id").alias("query_id"), "path").unionByName(extra)
    return document_status(_doc_neighbors(spark, sf_dir), docs, paths)


@register("conversation_postings", f"""WITH CV AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS doc_id, text FROM conversations),
{index_ctes('CV')}
SELECT term, doc_id, tf FROM tf""")
def conversation_postings(spark, sf_dir):
    """CMP-3 over the second corpus: every conversation turn is a document;
    doc ids are ordinals over (conv_id, turn) (WIN-1, no single-partition
    window)."""
    from tessera.sources.corpus import with_ordinal

    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.struct("conv_id", "turn").alias("key"))
    docs = with_ordinal(conv, "key", "key", "doc_id")
    return I.build_index(docs).postings.select("term", "doc_id", "tf")
