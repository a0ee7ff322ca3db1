"""Lookups of a few terms, and vectors in batches of bounded size."""

from pyspark.sql import functions as F

from tessera.operators import index as I


def test_lookups_write_the_postings_of_their_terms_only(spark):
    index = I.build_index(spark.createDataFrame([(1, "a b B"), (2, "c a")], "doc_id bigint, text string"))
    few = index.materialized(["b", "z"])
    assert sorted(map(tuple, few.postings.collect())) == [("b", 1, 2, 3)] and few.num_docs() == 2


def test_vectors_travel_in_small_batches(spark):
    """A batch of vectors is bounded by bytes; by rows it held a whole group."""
    from tessera.operators import knn

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    vectors = spark.range(1, 9).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vec"))
    knn.knn_cells(vectors, threshold=0.9).collect()
    wide = spark.range(64).select(F.repeat(F.lit("x"), 1 << 19).alias("s")).coalesce(1)
    sizes = [r.n for r in wide.mapInPandas(lambda it: (p.assign(n=[len(p)] * len(p))[["n"]] for p in it), "n bigint").collect()]
    assert max(sizes) <= 1 + knn.ARROW_BYTES // (1 << 19)
