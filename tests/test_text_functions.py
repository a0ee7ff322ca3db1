"""FIXTURES §4 micro-inputs for the scalar text functions."""

from pyspark.sql import functions as F

from tessera.functions import text as TX


def one(spark, expr, value):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(expr(F.col("v")).alias("o")).first()["o"]


def test_bracket_strip(spark):
    assert one(spark, TX.strip_brackets, "x (a] y") == "x  y"
    assert one(spark, TX.strip_brackets, "a [chorus]\nb (x2) c") == "a \nb  c"


def test_blank_lines(spark):
    assert one(spark, TX.drop_blank_lines, "a\n\nb\n \nc") == "a\nb\n \nc"


def test_reduced_text(spark):
    assert one(spark, TX.reduced_text, "a  b \n\n c") == "a  b  c"
    assert one(spark, lambda c: TX.reduced_text(c, 2), "a  b \n\n c") == "a b"


def test_pretty_and_safe(spark):
    assert one(spark, TX.pretty_name, "r/Mr. Big/To Be. With You.txt") == "Mr. Big - To Be"
    assert one(spark, TX.safe_title, "a/b") == "a_b"


def test_ml_split(spark):
    rows = [("a b NOT(c d)",), ("a NOT (c d)",), ("a NOTHING",), ("NOT x",)]
    df = spark.createDataFrame(rows, "q string").select(
        "q", TX.ml_positive("q").alias("p"), TX.ml_negative_words("q").alias("n"))
    got = {r.q: (r.p, list(r.n)) for r in df.collect()}
    assert got["a b NOT(c d)"] == ("a b", ["c", "d"])
    assert got["a NOT (c d)"] == ("a", ["c", "d"])
    assert got["a NOTHING"] == ("a NOTHING", [])
    assert got["NOT x"] == ("", ["x"])


def test_tokens_and_word_count(spark):
    df = spark.createDataFrame([("Sun moon - dog's x",)], "t string")
    r = df.select(TX.index_tokens("t").alias("tok"), TX.word_count("t").alias("wc")).first()
    assert list(r.tok) == ["Sun", "moon", "dogs", "x"]
    assert r.wc == 5


def test_snippet(spark):
    from tessera.operators.snippets import snippets

    docs = spark.createDataFrame([(7, "band/7.txt", "the Rain falls\nend"),
                                  (8, "band/8.txt", "x" * 30 + " rainy day")],
                                 "doc_id bigint, path string, text string")
    hits = spark.createDataFrame([(0, 1, 7, 1.0), (0, 2, 8, 0.5)], "query_id bigint, rank bigint, doc_id bigint, score double")
    words = spark.createDataFrame([(0, 0, "rain"), (0, 1, "zzz")], "query_id bigint, word_no bigint, word string")
    out = {(r.doc_id, r.word): r for r in snippets(hits, docs, words).collect()}
    r = out[(7, "rain")]
    assert (r.found, r.truncated, r.before, r.match_text, r.after) == (True, False, "the ", "Rain", " falls")
    r = out[(8, "rain")]
    assert (r.found, r.truncated, r.before, r.match_text, r.after) == (True, True, "x" * 19 + " ", "rainy", " day")
    assert out[(7, "zzz")].found is False


def test_html_element_text(spark):
    from tessera.functions.html import element_text

    cases = [  # page, text of the first article, text of the first div of class lyrics
        ("<html><head><script>var t='</p>';</script></head><body><nav>menu</nav>"
         "<article><h1>T&amp;A</h1><p><b>bold<br>line</p><style>p{}</style><!-- c -->"
         "<div>in</div>[Chorus] end</article><article>second</article></body></html>", "T&Aboldlinein[Chorus] end", None),
        ("<div class='lyrics x'>la</div>", None, "la"),
        ("<p>none</p>", None, None), ("", None, None), (None, None, None),
        ("<p><article class='a'>x<br/>y<article>in</article>z<!-- > c --></article>after", "xyinz", None),
        ("<div class='nolyrics'>B</div><DIV CLASS=lyrics id=2>C < d<style>s</style><div>e</div>f</div>g", None, "C < def"),
        ("<article/>x", "", None), ("<articles>no</articles><article >yes", "yes", None),
        ('<div id="1" class="a lyrics">&lt;&#233;&eacute;</div>', None, "<éé"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, h string")
    out = df.select("i", element_text("h", "article", None).alias("a"), element_text("h").alias("d"))
    assert {r.i: (r.a, r.d) for r in out.collect()} == {i: (a, d) for i, (_, a, d) in enumerate(cases)}
    assert "Python" not in out._jdf.queryExecution().toString()


def test_character_references(spark):
    import html

    from pyspark.sql import functions as F

    from tessera.functions.html import unescape

    texts = ["a&amp;b", "&#65;&#x41;", "&notit; &notin; &lt", "&bogus; &", "&#0;&#xD800;&#1114112;&#99999999999999999999;&#xFFFFFFFFFF;",
             "&#128;&#x9f;&#129;&#1;&#xFFFE;", "x &copy y &copyright; &acE;", "&ampamp;", "plain", "&#x1F600; é &NotEqualTilde;", "&;&#;&#x;", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.u for r in df.select("t", unescape(F.col("t")).alias("u")).collect()} == {t: html.unescape(t) for t in texts}


def test_snippet_with_stemmed_word(spark):
    from tessera.operators.snippets import snippets

    docs = spark.createDataFrame([(1, "b/1.txt", "A license\nlicensed work")], "doc_id bigint, path string, text string")
    hits = spark.createDataFrame([(0, 1, 1, 1.0)], "query_id bigint, rank bigint, doc_id bigint, score double")
    words = spark.createDataFrame([(0, 0, "licensed")], "query_id bigint, word_no bigint, word string")
    lower = snippets(hits, docs, words).first()
    stem = snippets(hits, docs, words, analyzer="porter").first()
    assert (lower.match_text, lower.before) == ("licensed", "A license\n")
    assert (stem.match_text, stem.before, stem.after) == ("license", "A ", "")
