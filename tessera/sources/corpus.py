"""SRC-1..SRC-6: corpus, seed list, page and landed-JSON sources.

The reference walks a ``root/<band>/<song>.txt`` tree; here a corpus is a
DataFrame ``docs(doc_id BIGINT, source STRING, path STRING, text STRING)``.
It comes either from a table (the test ``documents`` table: ``source`` is the
band, ``path = source/doc_id.txt``) or from a text tree read by Spark itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.text import FILE_LINE_BREAK, path_key, source_of_path
from tessera.operators.skew import write_once
from tessera.session import reliable_checkpoint, settings

#: A tree holds a small file a document.  Spark counts 4 MB for opening one, which
#: makes a task of a few files, and lists up to 10,000 folders by a task each.
TREE_SETTINGS = {"spark.sql.files.openCostInBytes": str(32 << 10), "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64"}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan over the cluster when it has fewer partitions than
    the default parallelism (a table stored as one Parquet row group is read
    by a single task).  A large input already has many more splits than cores
    and is left untouched, so this never adds a shuffle at scale."""
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: leave as is
        return df
    if have < want:
        return df.repartition(want)
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def corpus_from_documents(documents: DataFrame) -> DataFrame:
    """documents(doc_id, text, source, ...) -> docs(doc_id, source, path, text)."""
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source"),
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        F.col("text"),
    )


def read_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_from_documents(read_table(spark, sf_dir, "documents"))


def ordinal(df: DataFrame, order_col, out_col: str = "doc_id") -> DataFrame:
    """WIN-1 / SRT-1: dense 0-based ordinal by ``order_col`` without moving all
    rows into one partition: range-partition + sort, count rows per partition,
    prefix-sum the (few) partition counts, add the offset.

    The sorted data is checkpointed first (reliable checkpoint in the shared
    folder) so that recomputation after an executor loss cannot reorder it.
    All columns of ``df`` travel: give the key columns only and join the rest
    back by key (:func:`with_ordinal`)."""
    cols = order_col if isinstance(order_col, (list, tuple)) else [order_col]
    s = (df.repartitionByRange(*cols).sortWithinPartitions(*cols)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mono", F.monotonically_increasing_id()))
    s = reliable_checkpoint(s)
    s = s.withColumn("_local", F.col("_mono") - F.shiftleft(F.col("_pid").cast("bigint"), 33))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (s.join(F.broadcast(offsets), "_pid")
            .withColumn(out_col, (F.col("_off") + F.col("_local")).cast("bigint"))
            .drop("_pid", "_mono", "_local", "_off"))


def with_ordinal(df: DataFrame, order_col, key: str, out_col: str = "doc_id") -> DataFrame:
    """``df`` with its ordinal by ``order_col``: only the order columns and the
    unique ``key`` are sorted and checkpointed; the other columns (texts) join
    them back by ``key``."""
    cols = order_col if isinstance(order_col, (list, tuple)) else [order_col]
    narrow = ordinal(df.select(*dict.fromkeys([key, *cols])), cols, out_col)
    return df.join(narrow.select(key, out_col), key)


def read_text_tree(spark: SparkSession, root: str, key=path_key) -> DataFrame:
    """SRC-1: one document per file under ``root/<band>/<song>.txt``; ids are
    ordinals of the sorted ``band/song`` paths (WIN-1).  ``key`` makes that
    path from a file's full path (default: its last two parts).  The files are
    opened once: the ordinals (which sample, sort and join the paths) and the
    result read a table that they are written to."""
    with settings(spark, TREE_SETTINGS):
        files = (spark.read.format("text").option("wholetext", True)
                 .option("recursiveFileLookup", True).load(root)
                 .select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text")))
        # _metadata.file_path is a URI: percent-encoded ("Alice%20in%20Chains"),
        # but a "+" in it is a plus, which url_decode would turn into a space
        plain = F.url_decode(F.replace(F.regexp_replace("file_path", "^file:", ""), F.lit("+"), F.lit("%2B")))
        files = files.select(key(plain).alias("path"), "text")
        files = write_once(files.withColumn("source", source_of_path("path")), "text-files")
    return with_ordinal(files, "path", "path").select("doc_id", "source", "path", "text")


def read_lines(docs: DataFrame) -> DataFrame:
    """SRC-2: (doc_id, line_no, line) — documents read line by line (universal
    newlines, as a text file is read)."""
    return (docs.select("doc_id", F.posexplode_outer(F.split("text", FILE_LINE_BREAK, -1)).alias("line_no", "line"))
            .where(F.col("line").isNotNull()))


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4: seed list, one name per line."""
    return spark.read.text(path).select(F.col("value").alias("name"))
