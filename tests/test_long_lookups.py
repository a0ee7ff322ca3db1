"""Long scattered key lists on sorted tables: counted rows, not plan text."""

import random

from pyspark.sql import functions as F
from test_plans import rows_read

from tessera.operators import boolean as B
from tessera.operators import index as I
from tessera.operators.lookup import pruned


def test_a_thousand_scattered_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    (spark.range(2_000_000).select(F.col("id").alias("doc_id"), F.format_string("w%07d", "id").alias("term"))
     .repartitionByRange(50, "doc_id").sortWithinPartitions("doc_id").write.option("parquet.page.row.count.limit", "100").parquet(path))
    table = spark.read.parquet(path)
    keys = random.Random(1).sample(range(2_000_000), 1000)
    for column, values in (("doc_id", keys), ("term", [f"w{k:07d}" for k in keys])):
        hit = pruned(table, column, [*values, None, values[0]])
        assert sorted(r.doc_id for r in hit.collect()) == sorted(keys)
        assert rows_read(hit) < 200_000
    assert pruned(table, "doc_id", []).count() == 0
    assert pruned(table, "doc_id", keys, scans=2).count() == 1000


def test_queries_of_many_words(spark, tmp_path):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, " ".join(f"t{rng.randrange(3000)}" for _ in range(30))) for i in range(400)], "doc_id bigint, text string")
    built = I.build_index(docs)
    I.write_index(built, str(tmp_path / "i"))
    queries = spark.createDataFrame([(k, " OR ".join(f"t{rng.randrange(3000)}" for _ in range(10))) for k in range(50)], "query_id bigint, query string")
    rows = lambda idx: sorted(map(tuple, B.boolean_search(idx, queries, count=5).collect()))
    assert rows(I.read_index(spark, str(tmp_path / "i"))) == rows(built)
