"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    adaptive_scan,
    bpe,
    fill_middle,
    language_id,
    line_dedup,
    mixing,
    neighbour_votes,
    ngram_join,
    quality_rules,
    substring_dedup,
    token_counts,
    token_links,
    toxicity,
)
from tessera.llm._common import documents


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.dedup_lines(documents(spark, sf_dir)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(documents(spark, sf_dir).select("doc_id", "text", "lang"))


def op4_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return adaptive_scan.search(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(documents(spark, sf_dir), shingle=3, percent=90)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(documents(spark, sf_dir), bpe.read_spec(spark, _tokenizer("word_bpe_49k.json")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir).select("doc_id", "source", "text")).drop("text")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove_repeats(documents(spark, sf_dir)))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    spec = (public_tokenizers.PATTERN, token_counts.read_ranks(spark, _tokenizer("byte_bpe_50k.tiktoken")))
    return token_counts.count(documents(spark, sf_dir), spec, eod=50256)


def op11_neighbour_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_votes.predict(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_links.align_files(documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digest(fill_middle.transform(documents(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_quality_rules, op3_language_id, op4_adaptive_scan, op5_ngram_join,
                            op6_bpe, op7_toxicity, op8_mixing, op9_substring_dedup, op10_token_counts, op11_neighbour_votes, op12_token_links, op13_fill_middle)
}
ORACLE: dict[str, str] = {"op1_line_dedup": line_dedup.ORACLE, "op8_mixing": mixing.oracle(), "op13_fill_middle": fill_middle.ORACLE}
