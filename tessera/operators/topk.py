"""SRT-5 / CMP-4: the best k hits of a stored index, without scoring every hit;
conjunctions from their rarest word.

**Blocks.**  A stored index cuts the doc ids into blocks of ``block_docs`` and
keeps, for every frequent term, the largest ``tf / doc_len`` that it has in each
block (``score_blocks``).  Times the term's idf this bounds what the term can
add to a document of the block; a rare term's bounds are read off its few
postings.  A clause can hit in a block only if all its positive literals occur
there, so its bound is the sum over its literals in such blocks and nothing
elsewhere; a query's bound in a block is the sum over its clauses.

**Two passes.**  Every query first scores the ``SEED_BLOCKS`` blocks of its
largest bounds.  If that gives k hits, the k-th score is a threshold: only
blocks whose bound reaches it are scored in the second pass (a bound counts up
to the rounding of scores, so ties are kept).  The terms and doc-id ranges of
the chosen blocks are pushed down to the postings, which lie sorted by (term,
doc_id): skipped blocks are not read.

**Rarest first.**  Within the chosen blocks a clause starts from the postings of
its rarest positive literal.  Its documents are the only candidates: the other
literals' postings are joined with them, and read only around their ids if the
candidates are few.  A stop word beside a rare word gives as many rows as the
rare word.

Queries with a clause of negative literals only range over all documents; they,
and tables of more literals than can be listed, go through ``boolean_search``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import boolean
from tessera.operators.index import Index
from tessera.operators.lookup import MAX_LOCAL_ROWS, MAX_RANGES, key_filter, ranges
from tessera.operators.skew import write_once

SEED_BLOCKS = 4   # blocks that a query scores first
MAX_PAIRS = 5000  # (term, block) pairs that are listed for the scan


def bounds(index: Index, terms: list[str], hot: set[str]) -> DataFrame:
    """(term, block, max_w): stored for ``hot`` terms, else from the postings."""
    block = F.floor(F.col("doc_id") / index.block_docs).cast("bigint")
    rare = index.postings.where(key_filter("term", [t for t in terms if t not in hot]))
    rare = rare.groupBy("term", block.alias("block")).agg(F.max(F.col("tf") / F.col("doc_len")).alias("max_w"))
    return index.score_blocks.where(key_filter("term", sorted(hot))).select("term", "block", "max_w").unionByName(rare)


def block_bounds(bound: DataFrame, lits: DataFrame) -> DataFrame:
    """(query_id, block, bound) of the blocks that a query can hit in."""
    per = bound.join(F.broadcast(lits.where(~F.col("negative"))), "term")
    worth = F.when(F.col("scoring"), F.col("max_w") * F.col("idf")).otherwise(F.lit(0.0))
    clause = (per.groupBy("query_id", "clause_no", "block")
              .agg(F.count(F.lit(1)).alias("n"), F.max("n_pos").alias("n_pos"), F.sum(worth).alias("bound"))
              .where(F.col("n") == F.col("n_pos")))
    return clause.groupBy("query_id", "block").agg(F.sum("bound").alias("bound"))


def _scan_filter(index: Index, pairs: list[tuple[str, int]]):
    """Rows of the postings in one of the (term, block) pairs, as terms with
    doc-id ranges (blocks that lie close together become one range)."""
    blocks: dict[str, set[int]] = {}
    for term, block in pairs:
        blocks.setdefault(term, set()).add(block)
    most = max(1, MAX_RANGES // max(1, len(blocks)))
    out = F.lit(False)
    width = index.block_docs
    for term, held in sorted(blocks.items()):
        firsts = sorted(b for b in held if b - 1 not in held)  # of runs of neighbours
        lasts = sorted(b for b in held if b + 1 not in held)
        runs = list(zip(firsts, lasts, strict=True)) if len(firsts) <= most else ranges(list(held), most)
        near = F.lit(False)
        for a, b in runs:
            near = near | F.col("doc_id").between(F.lit(a * width), F.lit((b + 1) * width - 1))
        out = out | ((F.col("term") == F.lit(term)) & near)
    return out


def block_matches(index: Index, lits: DataFrame, chosen: DataFrame) -> DataFrame:
    """The matches of ``literal_matches`` that lie in the chosen (query_id,
    block) and belong to a candidate of their clause."""
    width = index.block_docs
    pairs = chosen.join(F.broadcast(lits), "query_id").select("term", "block").distinct().limit(MAX_PAIRS + 1).collect()
    postings = index.postings
    if len(pairs) <= MAX_PAIRS:
        postings = postings.where(_scan_filter(index, [(r["term"], r["block"]) for r in pairs]))
    else:
        postings = postings.where(key_filter("term", sorted({r["term"] for r in lits.select("term").collect()})))
    contrib = F.when(F.col("scoring"), F.col("tf") / F.col("doc_len") * F.col("idf")).otherwise(F.lit(0.0))

    def matched(rows: DataFrame, of: DataFrame) -> DataFrame:
        rows = rows.withColumn("block", F.floor(F.col("doc_id") / width).cast("bigint")).join(F.broadcast(of), "term")
        rows = rows.join(chosen.select("query_id", "block"), ["query_id", "block"], "left_semi")
        return rows.select("query_id", "clause_no", "doc_id", "n_pos", F.when(F.col("negative"), 0).otherwise(1).alias("pos_hit"),
                           F.when(F.col("negative"), 1).otherwise(0).alias("neg_hit"), contrib.alias("contrib"))

    first = write_once(matched(postings, lits.where("rarest")), "rarest-matches")
    others = lits.where("not rarest")
    if others.isEmpty():
        return first
    ids = first.select("doc_id").distinct().limit(MAX_LOCAL_ROWS + 1).collect()
    if len(ids) <= MAX_LOCAL_ROWS:
        postings = postings.where(key_filter("doc_id", [r["doc_id"] for r in ids]))
    candidates = first.select("query_id", "clause_no", "doc_id").distinct()
    return first.unionByName(matched(postings, others).join(candidates, ["query_id", "clause_no", "doc_id"], "left_semi"))


def _literals(index: Index, rows: list, df: dict[str, int], n: int) -> DataFrame:
    """The literals as a local table with idf, n_pos and whether a literal is
    its clause's rarest positive one."""
    import math

    clauses: dict[tuple, list] = {}
    for r in rows:
        clauses.setdefault((r["query_id"], r["clause_no"]), []).append(r)
    out = []
    for members in clauses.values():
        positive = [r for r in members if not r["negative"]]
        rarest = min(positive, key=lambda r: (df.get(r["term"], 0), r["lit_no"]))
        for r in members:
            idf = math.log2(n / df[r["term"]]) if df.get(r["term"]) else 0.0
            out.append((r["query_id"], r["clause_no"], r["lit_no"], r["term"], r["negative"], r["scoring"], len(positive), idf, r is rarest))
    return index.postings.sparkSession.createDataFrame(
        out, "query_id bigint, clause_no bigint, lit_no bigint, term string, negative boolean, scoring boolean, n_pos int, idf double, rarest boolean")


def top_hits(index: Index, queries, count: int = 10, normalize_query: bool = False, seen: dict | None = None) -> DataFrame:
    """hits(query_id, rank, doc_id, score), equal to ``boolean_search``, of an
    index that was read from storage.  ``seen`` is told how many (query, block)
    pairs there were and how many were scored."""
    spark = index.postings.sparkSession
    if isinstance(queries, str):
        queries = spark.createDataFrame([(0, queries)], "query_id bigint, query string")
    if index.score_blocks is None:
        return boolean.boolean_search(index, queries, count, normalize_query)
    literals, _ = boolean.parse_boolean(queries, index.analyzer, normalize_query)
    rows = literals.limit(boolean.MAX_PUSHDOWN_TERMS + 1).collect()
    if len(rows) > boolean.MAX_PUSHDOWN_TERMS:
        return boolean.boolean_search(index, queries, count, normalize_query)
    positive = {(r["query_id"], r["clause_no"]) for r in rows if not r["negative"]}
    ranging = {r["query_id"] for r in rows if (r["query_id"], r["clause_no"]) not in positive}
    plain = queries.where(F.col("query_id").isin(sorted(ranging))) if ranging else None
    rows = [r for r in rows if r["query_id"] not in ranging]
    results = [boolean.boolean_search(index, plain, count, normalize_query)] if ranging else []
    if rows:
        terms = sorted({r["term"] for r in rows if r["term"] is not None})
        found = index.term_stats().where(key_filter("term", terms)).collect()  # a row per query term
        df = {r["term"]: r["df"] for r in found}
        hot = {r["term"] for r in found if r["df"] >= index.hot_df}
        lits = _literals(index, rows, df, index.num_docs())
        bound = write_once(block_bounds(bounds(index, terms, hot), lits), "block-bounds")
        order = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
        seeds = write_once(bound.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SEED_BLOCKS).select("query_id", "block"), "seed-blocks")
        first = write_once(boolean.rank_hits(boolean.score_hits(block_matches(index, lits, seeds)), count), "seed-hits")
        kth = first.where(F.col("rank") == count).select("query_id", F.col("score").alias("kth"))
        slack = 10.0**-boolean.SCORE_DIGITS
        rest = bound.join(seeds, ["query_id", "block"], "left_anti").join(F.broadcast(kth), "query_id", "left")  # a row per query
        rest = write_once(rest.where(F.col("kth").isNull() | (F.col("bound") >= F.col("kth") - slack)).select("query_id", "block"), "open-blocks")
        if seen is not None:
            seen |= {"blocks": bound.count(), "scored": seeds.count() + rest.count()}
        hits = first.select("query_id", "doc_id", "score")
        if not rest.isEmpty():
            hits = hits.unionByName(boolean.score_hits(block_matches(index, lits, rest)))
        results.append(boolean.rank_hits(hits, count).select("query_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], T.StructType.fromDDL("query_id bigint, rank bigint, doc_id bigint, score double"))
    return results[0] if len(results) == 1 else results[0].unionByName(results[1])
