"""Nearest names by the segment index, against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import fuzzy


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_force(queries, names):
    out = {}
    for i, q in queries:
        if q is None:
            continue
        d, m = min((distance(q.lower(), n.lower()), n) for n in names if n is not None)
        if d <= len(q) // 2:
            out[i] = (q, m, d)
    return out


def by_id(df):
    return {r.query_id: (r["query"], r["match"], r["distance"]) for r in df.collect()}


def edited(rnd, s, n):
    s = list(s)
    for _ in range(n):
        k = rnd.randrange(3)
        at = rnd.randrange(len(s) + 1)
        if k == 0:
            s.insert(at, rnd.choice("abcdé"))
        elif s:
            at = min(at, len(s) - 1)
            s[at:at + 1] = [] if k == 1 else [rnd.choice("abcd𝄞")]
    return "".join(s)


@pytest.mark.parametrize("edits", [(1, 3), (2,), ()])
def test_equals_all_pairs(spark, edits):
    rnd = random.Random(1)
    names = ["".join(rnd.choice("abcd E") for _ in range(rnd.randrange(1, 14))) for _ in range(300)] + ["", "É", None, "aaaa", "aaaa"]
    queries = [(i, edited(rnd, rnd.choice(names[:300]), rnd.randrange(6))) for i in range(150)] + [(900, ""), (901, None), (902, "zzzzzzzzzz"), (903, "İstanbul")]
    q = spark.createDataFrame(queries, "query_id bigint, name string")
    n = spark.createDataFrame([(x,) for x in names], "name string")
    assert by_id(fuzzy.nearest_names(q, n, edits=edits)) == brute_force(queries, names)


def test_few_names_are_compared(spark):
    """100,000 names of two words: below a tenth are compared."""
    names = spark.range(100_000).select(F.concat_ws(" ", F.substring(F.md5(F.col("id").cast("string")), 1, 7), F.substring(F.md5((F.col("id") * 3).cast("string")), 1, 6)).alias("name"))
    typos = names.limit(40).select(F.monotonically_increasing_id().alias("query_id"), F.concat(F.substring("name", 1, 4), F.lit("x"), F.substring("name", 6, 20)).alias("query"))
    typos = typos.withColumn("slack", F.floor(F.length("query") / 2).cast("int"))
    for edits in fuzzy.EDITS:
        pairs = fuzzy.near_pairs(typos, fuzzy.name_segments(names, "name", edits), edits)
        assert 40 <= pairs.count() < 40 * 100_000 / 10
    found = fuzzy.nearest_names(typos.withColumnRenamed("query", "name"), names)
    assert found.count() == 40 and found.agg(F.max("distance")).first()[0] == 1


def test_stored_segments(spark, tmp_path):
    names = spark.createDataFrame([(x,) for x in ("red stone", "blue river", "green hill")], "name string")
    tables = {}
    for t in fuzzy.EDITS:
        fuzzy.name_segments(names, "name", t).write.parquet(str(tmp_path / str(t)))
        tables[t] = spark.read.parquet(str(tmp_path / str(t)))
    q = spark.createDataFrame([(1, "red stoné"), (2, "bluu rivver"), (3, "grin hal")], "query_id bigint, name string")
    assert by_id(fuzzy.nearest_names(q, names, segments=tables)) == {1: ("red stoné", "red stone", 1), 2: ("bluu rivver", "blue river", 2), 3: ("grin hal", "green hill", 4)}


def test_embedding_of_the_first_words_on_request(spark):
    """VEC-1 with the user's option of 512 words."""
    from tessera.functions.vectors import hash_embed

    words = [f"w{i}" for i in range(700)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:512])), (3, "one")], "doc_id bigint, text string")
    got = {}
    for r in hash_embed(docs, "doc_id", "text", max_words=512).collect():
        got.setdefault(r.id, []).append((r.bucket, r.cnt))
    assert sorted(got[1]) == sorted(got[2]) and sum(n for _, n in got[1]) == 512 and sum(n for _, n in got[3]) == 1
    assert hash_embed(docs, "doc_id", "text").where("id = 1").agg({"cnt": "sum"}).first()[0] == 700
