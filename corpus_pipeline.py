"""A training-data pipeline over ``documents``: five stages, each an operator of
``tessera.llm``.  A stage takes (spark, docs, sf_dir) and returns a DataFrame;
its result is written as Parquet and read again as the next stage's ``docs``.

Rows: the stages take NULLs in any column, empty and very long texts, repeated
rows, empty tables and further columns; what each makes of them stands in its
operator's docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, line_dedup, mixing, ngram_join, quality_rules
from tessera.llm._common import id_key, written
from tessera.session import scratch_path


#: Share of its lines that makes a document a near copy of an earlier one.
NEAR_COPY = 0.5


def _without_copies(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """``kept`` without exact copies: of the rows of ``docs`` that share a text,
    those of the smallest doc_id (NULL first) stay; texts are told apart by
    their MD5.  NULL texts stay."""
    key = F.md5(F.col("text").cast("binary"))
    ids = docs.where("text is not null").select(key.alias("_key"), id_key().alias("_d"))
    groups = ids.groupBy("_key").agg(F.min("_d").alias("_first"), F.max("_d").alias("_last")).where("_first < _last").select("_key", "_first")
    gone = ids.join(written(groups, "copies"), "_key").where("_d > _first").select("_key", "_d").distinct()
    # by text and id: the copies of one text lie in many partitions
    same = (key == gone["_key"]) & (id_key() == gone["_d"])
    return kept.join(gone, same, "left_anti").select(*(F.col(f"`{c}`") for c in kept.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, one doc_id of each group of
    exact copies (equal texts are judged alike).  The rules' shares are those
    of all documents."""
    return _without_copies(quality_rules.keep_good(docs), docs)


def _freed(docs: DataFrame, spare: float | None = None) -> DataFrame:
    """Texts freed of every run of two lines that an earlier text holds;
    ``n_chars`` follows the text.  A document that this leaves only white
    space of goes."""
    freed = line_dedup.dedup_lines(docs, all_starts=True, spare=spare)
    freed = freed.where(F.col("text").isNull() | (F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"n_chars": F.length("text").cast("bigint")}
    return freed.select(*(new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts freed of repeated runs of lines.  A document that has more than half its lines from one earlier
    document is a near copy and stays whole: the next stage judges it as a
    document, and frees those that it keeps."""
    return _freed(docs, NEAR_COPY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (that of the smallest doc_id, NULL first, then text hash) of
    each group of texts linked by five-word shingles at a similarity of 0.8 or
    more.  Documents are told apart by id and text, so that texts which share
    an id, or have none, are judged one by one; rows that repeat the document
    which stays do so too.  The documents that stay are freed of repeated runs
    of lines: those that the stage before left whole have them still."""
    row = F.xxhash64("doc_id", "text")
    groups = ngram_join.jaccard_components(docs.select(row.alias("doc_id"), "text"), shingle=5, percent=80)
    ids = docs.select(row.alias("doc_id"), id_key().alias("_d")).distinct()
    linked = written(groups.where("n_shingles > 0").select("doc_id", "component_id").distinct().join(ids, "doc_id"), "near-groups")
    stay = linked.groupBy("component_id").agg(F.min(F.struct("_d", "doc_id")).alias("o")).select(F.col("o.doc_id").alias("doc_id"))
    gone = linked.join(stay, "doc_id", "left_anti").select(F.col("doc_id").alias("_gone"))
    # written: the line dedup reads them five times
    return _freed(written(docs.join(gone, row == gone["_gone"], "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns)), "documents-left"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture's schedule: the files of the
    written table hold the slots one after another."""
    return mixing.mix(docs).orderBy("mix_slot", "doc_id").select(*(F.col(f"`{c}`") for c in docs.columns))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256, mix_slot, on_target): ids as
    little-endian 32-bit integers, the digest of the text that they decode to,
    and the document's place in the mixture, in whose order the rows are
    written.  (The stage before returns the columns of documents alone; the same
    documents have the same places.)"""
    import public_tokenizers

    spec = bpe.read_spec(spark, public_tokenizers.path("word_bpe_49k.json"))
    placed = mixing.mix(docs.select("doc_id", "text", "source")).withColumn("on_target", F.col("on_target").cast("bigint"))
    out = bpe.encode(placed.orderBy("mix_slot", "doc_id"), spec, carry=("mix_slot", "on_target"))
    return out.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"), "mix_slot", (F.col("on_target") == 1).alias("on_target"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing", mixture),
    ("BPE encoding", encoding),
]

#: Expectation-maximisation and byte-pair merges have no SQL form; the tests
#: hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
