"""Streaming index blocks (idempotent replay), status outputs, Q22 dedupe."""

from pyspark.sql import functions as F

from tessera.operators import index as I


def test_stream_blocks_and_replay(spark, tmp_path):
    from tessera.streaming.index_stream import compact_index, start_index_stream

    land = tmp_path / "land"
    rows = [(i, f"w{i % 3} common word{i}", "en", f"s{i % 2}", 10) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df.repartition(3, "source").write.parquet(str(land))
    base = str(tmp_path / "idx")
    q = start_index_stream(spark, str(land), base, f"{base}/_ckpt", files_per_batch=1)
    q.awaitTermination()
    # a restart with the same checkpoint finds nothing new: no duplicate blocks
    q = start_index_stream(spark, str(land), base, f"{base}/_ckpt", files_per_batch=1)
    q.awaitTermination()
    idx = compact_index(spark, base, f"{base}/index")
    want = I.build_index(df.select("doc_id", "text"))
    key = lambda d: sorted(tuple(r) for r in d.select("term", "doc_id", "tf", "doc_len").collect())
    assert key(idx.postings) == key(want.postings)
    back = I.read_index(spark, f"{base}/index")
    assert back.num_docs() == 12
    assert {r.term: r.df for r in back.term_stats().collect()}["common"] == 12


def test_source_status(spark):
    from tessera.operators.duplicates import source_status

    docs = spark.createDataFrame([(0, "ABBA"), (1, "Queen")], "doc_id bigint, source string")
    names = spark.createDataFrame([(0, "abba"), (1, "quen"), (2, "zzzzzz")], "query_id bigint, name string")
    got = {r.query_id: (r.status, r.source) for r in source_status(docs, names).collect()}
    assert got == {0: ("ok", "ABBA"), 1: ("ok", "Queen"), 2: ("not_found", None)}


def test_entity_dedupe(spark):
    from tessera.operators.ingest import resolve_entities

    seeds = spark.createDataFrame([("Alice in Chains",), ("Alice In Chains",)], "seed string")
    hits = spark.createDataFrame([("Alice in Chains", 1, 7, "Alice In Chains"),
                                  ("Alice In Chains", 1, 7, "Alice In Chains")],
                                 "seed string, hit_pos bigint, artist_id bigint, artist_name string")
    assert resolve_entities(seeds, hits).count() == 2
    assert [(r.seed, r.artist_id) for r in resolve_entities(seeds, hits, dedupe=True).collect()] == \
        [("Alice In Chains", 7)]


def test_relevance_label_and_report_sink(spark, tmp_path):
    from tessera.functions.text import relevance_label
    from tessera.operators.duplicates import write_report

    r = spark.createDataFrame([(0.5,)], "s double").select(relevance_label("s").alias("l")).first()
    assert r.l == "[relevance = 0.500]"
    rep = spark.createDataFrame([(1, "b/1.txt", 1, 2, "b/2.txt"), (1, "b/1.txt", 2, 5, "b/5.txt")],
                                "doc_id bigint, path string, rank bigint, neighbor_id bigint, neighbor_path string")
    out = str(tmp_path / "report")
    write_report(rep, out)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines == ["b/1.txt", "\tb/2.txt", "\tb/5.txt"]


def test_search_hits_json(spark):
    from tessera.operators.ingest import resolve_entities, search_hits

    js = ('{"response": {"hits": [{"result": {"primary_artist": {"id": 1, "name": "ABBA Tribute"}}},'
          ' {"result": {"primary_artist": {"id": 2, "name": "ABBA"}}}]}}')
    ans = spark.createDataFrame([("abba", js)], "seed string, json string")
    hits = search_hits(ans)
    assert [(r.hit_pos, r.artist_id) for r in hits.collect()] == [(0, 1), (1, 2)]
    seeds = spark.createDataFrame([("abba",)], "seed string")
    assert [r.artist_id for r in resolve_entities(seeds, hits).collect()] == [2]
