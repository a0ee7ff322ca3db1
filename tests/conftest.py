import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_spark

    s = get_spark(master="local[4]", shuffle_partitions=4, app_name="tessera-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def micro_docs(spark):
    """FIXTURES §3 golden micro-corpus (N = 6)."""
    rows = [
        (0, "rain rain sun"),
        (1, "Sun moon - dog"),
        (2, "rain moon"),
        (3, "dog's dog"),
        (4, "sun, moon; rain"),
        (5, "star"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    from pyspark.sql import functions as F

    return df.withColumn("source", F.lit("band")).withColumn(
        "path", F.concat(F.lit("band/"), F.col("doc_id").cast("string"), F.lit(".txt")))
