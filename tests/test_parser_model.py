"""Random Boolean queries (operators anywhere, repeated NOTs, empty
operands) against an independent recursive model of the semantics: split at
the first OR, else the first AND, else the first NOT (words before it are
ignored), else the literal's first word; an empty operand is an error, which
must come out as status 'invalid' with no hits."""

import math
import random

from tessera.operators import boolean as B
from tessera.operators import index as I

DOCS = ["rain rain sun", "Sun moon - dog", "rain moon", "dog's dog", "sun, moon; rain", "star"]


class Invalid(Exception):
    pass


def model(tokens, scored, n):
    if not tokens:
        raise Invalid
    for op in ("OR", "AND"):
        if op in tokens:
            i = tokens.index(op)
            a, b = model(tokens[:i], scored, n), model(tokens[i + 1:], scored, n)
            if op == "AND":
                return {d: a[d] + b[d] for d in a if d in b}
            out = dict(a)
            for d, v in b.items():
                out[d] = out.get(d, 0.0) + v
            return out
    if "NOT" in tokens:
        i = tokens.index("NOT")
        inner = model(tokens[i + 1:], scored, n)
        return {d: 0.0 for d in range(n) if d not in inner}
    return dict(scored.get(tokens[0].lower(), {}))


def scored_postings():
    lens = [len(t.split()) for t in DOCS]
    tf = {}
    for d, t in enumerate(DOCS):
        for w in t.translate(str.maketrans("", "", "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")).split():
            tf.setdefault(w.lower(), {}).setdefault(d, 0)
            tf[w.lower()][d] += 1
    n = len(DOCS)
    return {w: {d: c / lens[d] * math.log2(n / len(p)) for d, c in p.items()} for w, p in tf.items()}, n


def test_random_queries_match_model(spark):
    rnd = random.Random(2024)
    vocab = ["rain", "sun", "Moon", "dog", "star", "zzz", "AND", "OR", "NOT", "NOT", "AND", "OR"]
    queries = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 7)))) for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(DOCS)), "doc_id bigint, text string")
    idx = I.build_index(docs)
    qdf = spark.createDataFrame(queries, "query_id bigint, query string")
    hits = B.boolean_search(idx, qdf, count=None).collect()
    status = {r.query_id: r.status for r in B.search_status(idx, qdf).collect()}
    got = {}
    for r in hits:
        got.setdefault(r.query_id, {})[r.doc_id] = round(r.score, 6)
    scored, n = scored_postings()
    for qid, text in queries:
        try:
            want = {d: round(v, 6) for d, v in model(text.split(), scored, n).items()}
        except Invalid:
            assert status[qid] == "invalid", text
            assert qid not in got, text
            continue
        assert status[qid] == "ok", text
        assert got.get(qid, {}) == want, text
