"""CMP-3 / CMP-6: inverted index construction and maintenance.

Working format is the *long* form ``postings(term, doc_id, tf, doc_len)``: one
row per (term, document).  A stop word can sit in most documents, so a nested
``term -> list`` row would be one unbounded row per hot term; the long form
keeps every row small and lets partial aggregation and AQE split hot terms.

Build plan (one shuffle): documents dealt by id (``skew.dealt``) -> explode tokens
-> hash aggregates on (term, doc_id) in the task that holds the document.  Texts
are exchanged, not postings, which are several times as large.  ``doc_len`` (the
reference's per-document word count) rides along from the document row, so
scoring never joins the document table back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.porter import porter_stem
from tessera.functions.text import has_token, index_tokens, may_be_term, pretty_name, split_words, strip_punctuation, word_count
from tessera.operators.lookup import PAGE_ROWS
from tessera.operators.skew import MAX_BROADCAST_BYTES, deal_parts, dealt, skew_split_join, write_once, written_bytes


@dataclass
class Index:
    """An inverted index over a document table.

    postings:  term STRING, doc_id BIGINT, tf BIGINT, doc_len BIGINT
    doc_stats: doc_id BIGINT, doc_len BIGINT  (the universe for NOT)
    analyzer:  how both documents and query words are normalised
    """

    postings: DataFrame
    doc_stats: DataFrame
    analyzer: str = "lower"
    stored_term_stats: DataFrame | None = None  # (term, df) written with the index
    stored_num_docs: int | None = None          # N written with the index
    # (term, doc_id, tf, doc_len) of one tokenising pass, with a row of NULL
    # term per document, for writers: postings and doc_stats are its two halves
    staged: DataFrame | None = None
    # the same postings, counted where the documents lie before an exchange: for
    # plans that read the postings of a few terms only
    scanned: DataFrame | None = None
    # terms -> their rows of ``scanned``, other words being dropped unfolded
    scan: Callable[[list[str]], DataFrame] | None = None
    # chunk size -> postings with their chunk, of documents dealt by chunk
    chunked: Callable[[int], DataFrame] | None = None
    dealt_to: int | None = None  # partitions by doc_id that the postings lie in
    # (term, block, max_w) of a stored index: the largest tf / doc_len that a
    # term of at least hot_df documents has in each block of block_docs ids
    score_blocks: DataFrame | None = None
    block_docs: int = 0
    hot_df: int = 0

    def term_stats(self) -> DataFrame:
        """AGG-4: document frequency per term (stored table, else a partial +
        final aggregate over the postings)."""
        if self.stored_term_stats is not None:
            return self.stored_term_stats
        return self.postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))

    def num_docs(self) -> int:
        """AGG-5: corpus size N."""
        if self.stored_num_docs is not None:
            return self.stored_num_docs
        return self.doc_stats.count()

    def of_terms(self, terms: list[str]) -> DataFrame:
        """The postings of a few terms, without counting the other words."""
        if self.scan is not None:
            return self.scan(terms)
        return (self.postings if self.scanned is None else self.scanned).where(F.col("term").isin(terms))

    def materialized(self, terms: list[str] | None = None) -> "Index":
        """The same index with postings and document stats written once (shared
        checkpoint folder): for plans that read an index built from raw text
        several times.  A built index takes one tokenising pass.  ``terms``: all
        that will be looked up; only their postings are counted and written, as
        the filter on them reaches the words of each document."""
        from tessera.session import reliable_checkpoint

        if terms is not None and self.scanned is not None:
            looked_up = write_once(self.of_terms(terms), "term-postings")
            return Index(looked_up, self.doc_stats, self.analyzer, self.stored_term_stats, self.stored_num_docs)
        if self.staged is not None:
            postings, stats = staged_halves(self.staged)
        else:
            postings, stats = reliable_checkpoint(self.postings), reliable_checkpoint(self.doc_stats)
        return Index(postings, stats, self.analyzer, self.stored_term_stats, self.stored_num_docs)


def staged_halves(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(postings, doc_stats) of ``Index.staged``, written once.  Its row of a
    document counts the rows of equal id and length, each of which is one of
    doc_stats."""
    once = write_once(staged, "staged-postings")
    each = F.explode(F.array_repeat(F.lit(True), F.col("tf").cast("int"))).alias("each")
    return once.where("term is not null"), once.where("term is null").select("doc_id", "doc_len", each).drop("each")


def doc_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """AGG-6: (doc_id, doc_len) — a projection, no shuffle."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       word_count(text_col).alias("doc_len"))


def tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """D4: token stream (doc_id, pos, token) of raw (punctuation-free) tokens."""
    # posexplode_outer + null filter: no inferred size filter pushed to the scan
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.posexplode_outer(index_tokens(text_col)).alias("pos", "token"),
    ).where(F.col("token").isNotNull())


def stem_vocabulary(words: DataFrame, col: str = "token") -> DataFrame:
    """Distinct words -> (token, term, n), n the rows that hold the word;
    written once, so that the stemmer runs once per distinct word form and a
    later filter on ``term`` cannot be rewritten into one over every
    occurrence."""
    vocab = words.groupBy(F.col(col).alias("token")).agg(F.count(F.lit(1)).alias("n"))
    return write_once(vocab.select("token", porter_stem("token").alias("term"), "n"), "stems")


def build_index(docs: DataFrame, analyzer: str = "lower", text_col: str = "text") -> Index:
    """CMP-3: documents(doc_id, text) -> Index.

    analyzer: ``lower`` (case folding only) or ``porter`` (case folding +
    Porter stem, the reference default)."""
    # One whitespace split per document gives both the length (raw words,
    # punctuation-only ones included) and the tokens (punctuation deleted per
    # word, empty ones dropped) - the same tokens as deleting punctuation
    # from the whole text first, since deletion never touches whitespace.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    parts = deal_parts(texts)
    length = F.size("w").cast("bigint").alias("doc_len")
    split = split_words("text").alias("w")
    lying, words = texts.select("doc_id", split), dealt(texts, parts=parts).select("doc_id", split)
    stats = lying.select("doc_id", length)

    def stripped(words: DataFrame, keep=has_token("w0"), pieces="w") -> DataFrame:
        # explode_outer: a plain explode makes Spark infer a size filter and push
        # it below the scan's round-robin spread, splitting every text twice, once
        # in the scan task.
        also = [c for c in words.columns if c not in ("doc_id", "w")]
        rows = words.select("doc_id", *also, length, F.explode_outer(pieces).alias("w0")).where(keep)
        return rows.select("doc_id", *also, "doc_len", strip_punctuation("w0").alias("tok"))

    def counted(rows: DataFrame, *also: str) -> DataFrame:
        tf = rows.groupBy(F.lower("tok").alias("term"), "doc_id", "doc_len", *also).agg(F.count(F.lit(1)).alias("tf"))
        return tf.select("term", "doc_id", F.col("tf").cast("bigint").alias("tf"), "doc_len", *also)

    def scan(terms: list[str]) -> DataFrame:
        return counted(stripped(lying, may_be_term("w0", terms))).where(F.col("term").isin(terms))

    def chunked(chunk: int) -> DataFrame:
        by_chunk = dealt(texts.withColumn("chunk", chunk_of(chunk)), "chunk", parts)
        return counted(stripped(by_chunk.select("doc_id", "chunk", split)), "chunk")

    # One element more than words: its row (past the last word) stands for the
    # document itself, so that lengths come out of the same pass.  Only writers
    # read these rows; a search has no use for them.
    staged = stripped(words, F.col("w0").isNull() | has_token("w0"), F.concat("w", F.array(F.lit(None).cast("string"))))
    if analyzer == "lower":
        return Index(counted(stripped(words)), stats, analyzer, staged=counted(staged), scanned=counted(stripped(lying)),
                     scan=scan, chunked=chunked, dealt_to=parts)
    if analyzer == "porter":
        # Count raw word forms per document first (partial aggregation shrinks
        # the stream to postings) and write the counts once: the vocabulary,
        # the hot forms and the stems all read them.  Several forms of one
        # stem in a document add up.
        raw = write_once(staged.withColumnRenamed("tok", "token")
                         .groupBy("token", "doc_id", "doc_len").agg(F.count(F.lit(1)).alias("tf")), "word-forms")
        stats = raw.where("token is null").select("doc_id", "doc_len")
        raw = raw.where("token is not null")
        stems = stem_vocabulary(raw)
        # the forms that differ from their stem are few beside the postings: these
        # stay where they are
        changed = write_once(stems.where("token <> term").select("token", F.col("term").alias("stem")), "changed-forms")
        if written_bytes(changed) <= MAX_BROADCAST_BYTES:
            stemmed = raw.join(F.broadcast(changed), "token", "left").withColumn("term", F.coalesce("stem", "token"))
        else:
            stemmed = skew_split_join(raw, stems, "token", "n")
        # dealt before forms add up: few do, and a scan's task holds too many to count
        stemmed = dealt(stemmed.select("term", "doc_id", "doc_len", "tf"), parts=parts)
        postings = stemmed.groupBy("term", "doc_id", "doc_len").agg(F.sum("tf").alias("tf"))
        postings = postings.select("term", "doc_id", F.col("tf").cast("bigint").alias("tf"), "doc_len")
        return Index(postings, stats, analyzer)
    raise ValueError(f"unknown analyzer {analyzer!r}")


def merge_stats(stats: DataFrame) -> DataFrame:
    """Document lengths of stacked partial indexes: a document that lies in
    several blocks has the sum of its parts."""
    return stats.groupBy("doc_id").agg(F.sum("doc_len").cast("bigint").alias("doc_len"))


def merge_blocks(postings: DataFrame, stats: DataFrame) -> DataFrame:
    """AGG-3 / SET-5: postings of any number of partial indexes (blocks)
    stacked together -> one index; tf of a (term, doc) seen in several blocks
    adds up, and so does the document's length (``stats``: merged doc_id,
    doc_len).  Spark runs it as partial + final hash aggregation (the k-way
    block merge of SPIMI) and one join on the document."""
    tf = postings.groupBy("term", "doc_id").agg(F.sum("tf").cast("bigint").alias("tf"))
    # a row of stats per document: hashed, so that the postings need no sort
    return tf.join(stats.hint("shuffle_hash"), "doc_id").select("term", "doc_id", "tf", "doc_len")


def merge_index(a: Index, b: Index) -> Index:
    """Merge two indexes; their documents may overlap (a document cut into two
    blocks, as a block flushed in its middle leaves it)."""
    if a.analyzer != b.analyzer:
        raise ValueError(f"indexes with different analyzers: {a.analyzer!r}, {b.analyzer!r}")
    cols = ["term", "doc_id", "tf"]
    lengths = a.doc_stats.unionByName(b.doc_stats)
    if a.dealt_to is not None and a.dealt_to == b.dealt_to:  # the lengths go where the postings lie
        lengths = lengths.repartition(a.dealt_to, "doc_id")
    stats = merge_stats(lengths)
    return Index(merge_blocks(a.postings.select(*cols).unionByName(b.postings.select(*cols)), stats), stats, a.analyzer)


# Doc ids per row of the nested export views: a stop word sits in most
# documents, so one row per term would be unbounded; rows are per
# (term, chunk) with chunk = doc_id div POSTING_CHUNK, and concatenating a
# term's chunks in chunk order gives its full list.
POSTING_CHUNK = 1_000_000


# Documents of a chunk up to which chunks are dealt whole to tasks.
DEALT_CHUNK = 4096


def chunk_of(chunk: int) -> Column:
    return F.floor(F.col("doc_id") / chunk).cast("bigint")


def posting_lists(postings: DataFrame | Index, chunk: int = POSTING_CHUNK) -> DataFrame:
    """AGG-2 / SRT-3: nested export view ``(term, chunk) -> [(doc_id, tf)]``
    sorted by doc id, at most ``chunk`` entries per row.  For a built index and
    small chunks the documents of a chunk are dealt to one task, so that no
    posting is exchanged."""
    if isinstance(postings, Index):
        whole = postings.chunked is not None and chunk <= DEALT_CHUNK
        rows = postings.chunked(chunk) if whole else postings.postings.withColumn("chunk", chunk_of(chunk))
    else:
        rows = postings.withColumn("chunk", chunk_of(chunk))
    return (rows.groupBy("term", "chunk")
            .agg(F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")))


def posting_maps(postings: DataFrame, chunk: int = POSTING_CHUNK) -> DataFrame:
    """Nested ``(term, chunk) -> MAP<doc_id, tf>`` view (D5), bounded rows."""
    return (postings.withColumn("chunk", chunk_of(chunk))
            .groupBy("term", "chunk")
            .agg(F.map_from_entries(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")))


def merge_posting_maps(a: DataFrame, b: DataFrame) -> DataFrame:
    """MAP-1: merge two nested views chunk by chunk, summing tf of common docs
    (``map_zip_with``); entries present on one side only pass through."""
    j = a.alias("a").join(b.alias("b"), ["term", "chunk"], "full_outer")
    merged = F.map_zip_with(
        F.coalesce(F.col("a.postings"), F.create_map().cast("map<bigint,bigint>")),
        F.coalesce(F.col("b.postings"), F.create_map().cast("map<bigint,bigint>")),
        lambda k, v1, v2: F.coalesce(v1, F.lit(0)) + F.coalesce(v2, F.lit(0)),
    )
    return j.select("term", "chunk", merged.alias("postings"))


# Doc ids of a block, and documents from which a term's blocks are stored.
BLOCK_DOCS, HOT_DF = 4096, 1024
SMALL_BLOCK = 256  # documents of a block whose rows are not added up before they are exchanged
PAGES = {"parquet.page.row.count.limit": str(PAGE_ROWS)}


def write_index(index: Index, path: str, num_partitions: int | None = None, block_docs: int = BLOCK_DOCS, hot_df: int = HOT_DF) -> None:
    """SNK-2: range-partition by term and sort by (term, doc_id) so Parquet
    row-group min/max statistics on ``term`` let a lookup read only the row
    groups of the query terms (SRC-7).  The tables are one version: readers see
    the old index until all of them are there (``sources.versions``).
    ``score_blocks`` serves ``operators.topk``."""
    from tessera.sources.versions import publish

    p, stats = index.postings, index.doc_stats
    spark = p.sparkSession
    if index.staged is not None:  # one tokenising pass for both
        once = write_once(index.staged, "staged-postings", compression="zstd")
        p, stats = once.where("term is not null"), once.where("term is null").select("doc_id", "doc_len")
    # (term, doc_id) range keys: a hot term is split over several tasks/files
    # while the files stay globally ordered by term.
    p = (p.repartitionByRange(num_partitions, "term", "doc_id") if num_partitions
         else p.repartitionByRange("term", "doc_id"))

    def write(folder: str) -> dict:
        p.sortWithinPartitions("term", "doc_id").write.options(**PAGES, compression="zstd").parquet(f"{folder}/postings")
        postings = spark.read.parquet(f"{folder}/postings")
        # Document frequencies, read back from the written postings (partial +
        # final aggregate), stored sorted by term so a search looks up its terms
        # by row-group pruning instead of aggregating postings at query time.
        (postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
         .repartitionByRange("term").sortWithinPartitions("term")
         .write.options(**PAGES).parquet(f"{folder}/term_stats"))
        # Frequent terms are few: written on their own, their size shows that, and
        # the postings stay where they are.
        hot = write_once(spark.read.parquet(f"{folder}/term_stats").where(F.col("df") >= hot_df).select("term"), "hot-terms")
        hot = F.broadcast(hot) if written_bytes(hot) <= MAX_BROADCAST_BYTES else hot
        block = F.floor(F.col("doc_id") / block_docs).cast("bigint").alias("block")
        weights = postings.join(hot, "term", "left_semi").select("term", block, (F.col("tf") / F.col("doc_len")).alias("max_w"))
        if block_docs <= SMALL_BLOCK:  # few rows add up before an exchange: the one by range is enough
            weights = weights.repartitionByRange("term", "block")
        blocks = weights.groupBy("term", "block").agg(F.max("max_w").alias("max_w"))
        if block_docs > SMALL_BLOCK:
            blocks = blocks.repartitionByRange("term", "block")
        blocks.sortWithinPartitions("term", "block").write.parquet(f"{folder}/score_blocks")
        stats.write.parquet(f"{folder}/doc_stats")
        return {"analyzer": index.analyzer, "num_docs": spark.read.parquet(f"{folder}/doc_stats").count(),
                "block_docs": block_docs, "hot_df": hot_df}

    publish(spark, path, write)


def read_index(spark, path: str) -> Index:
    """SRC-7: open the current version of a written index.  A missing path is
    an error (Q12 fix)."""
    from tessera.sources.versions import current

    at = current(spark, path)
    if at is None:
        raise FileNotFoundError(f"no index at {path}")
    return Index(spark.read.parquet(f"{at.folder}/postings"),
                 spark.read.parquet(f"{at.folder}/doc_stats"), at.info["analyzer"],
                 stored_term_stats=spark.read.parquet(f"{at.folder}/term_stats"),
                 stored_num_docs=int(at.info["num_docs"]),
                 score_blocks=spark.read.parquet(f"{at.folder}/score_blocks"),
                 block_docs=at.info["block_docs"], hot_df=at.info["hot_df"])


def build_name_index(docs: DataFrame, analyzer: str = "lower") -> DataFrame:
    """CMP-6 / AGG-7: index over pretty names (``band - song``).

    Name words are whitespace-split without punctuation stripping (the ``-``
    becomes a term), normalised, and stored with tf = 1 however often they
    occur.  Same schema as the text postings, so Boolean search runs on it
    unchanged; ``doc_len`` is the text word count of the document."""
    names = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        word_count("text").alias("doc_len"),
                        F.explode_outer(split_words(pretty_name("path"))).alias("token")
                        ).where(F.col("token").isNotNull())
    if analyzer == "porter":
        names = skew_split_join(names, stem_vocabulary(names), "token", "n")
    else:
        names = names.withColumn("term", F.lower("token"))
    return (names.select("term", "doc_id", "doc_len").distinct()
            .select("term", "doc_id", F.lit(1).cast("bigint").alias("tf"), "doc_len"))


def write_name_index(docs: DataFrame, path: str, analyzer: str = "lower") -> None:
    """SNK-3: the name index written like a text index (postings, df, N), to
    be opened by :func:`read_index` and searched in its place."""
    write_index(Index(build_name_index(docs, analyzer), doc_stats(docs), analyzer), path)
