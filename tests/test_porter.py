from pyspark.sql import functions as F

from tessera.functions.porter import porter_stem

# Published examples of the algorithm (paper + reference vocabulary).
CASES = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
    "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "valenci": "valenc", "hesitanci": "hesit", "digitizer": "digit",
    "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous",
    "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electriciti": "electr", "electrical": "electr",
    "hopeful": "hope", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust",
    "defensible": "defens", "irritant": "irrit", "replacement": "replac", "adjustment": "adjust",
    "dependent": "depend", "adoption": "adopt", "homologou": "homolog", "communism": "commun",
    "activate": "activ", "angulariti": "angular", "homologous": "homolog", "effective": "effect",
    "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll", "generalizations": "gener", "oscillators": "oscil",
    "is": "is", "as": "as", "Running": "run", "analogi": "analog",
}


def test_porter_vocabulary(spark):
    df = spark.createDataFrame([(w,) for w in CASES], "token string")
    got = {r.token: r.term for r in df.select("token", porter_stem("token").alias("term")).collect()}
    assert {w: (got[w], s) for w, s in CASES.items() if got[w] != s} == {}


def test_stem_vocabulary_is_native(spark):
    from tessera.operators.index import stem_vocabulary

    df = spark.createDataFrame([(w,) for w in CASES], "token string")
    out = stem_vocabulary(df.unionByName(df.limit(3)))
    assert {r.token: r.term for r in out.collect()} == CASES
    assert out.agg(F.sum("n")).first()[0] == len(CASES) + 3
    assert "Python" not in df.select(porter_stem("token"))._jdf.queryExecution().toString()


def test_column_form_equals_the_sql_form(spark):
    """Random words over the letters that the rules look at, y runs too."""
    import random

    import duckdb

    from tessera.plans.sqltext import porter_ctes

    rng = random.Random(9)
    ends = "s es ies sses ed eed ing at bl iz y al ational ization iveness ement ment ent ion ou ism e ll logi icate ness ful".split()
    words = {"".join(rng.choices("abceilmnostuyvz", k=rng.randrange(1, 7))) + rng.choice(["", *ends]) + rng.choice(["", *ends]) for _ in range(6000)}
    words |= {"yyy", "byying", "sayyed", "yy", "toyyyed", "éclairs", "naïvely", "ies", "eed", "ing", "x9s"}
    df = spark.createDataFrame([(w,) for w in sorted(words)], "token string")
    got = {r.token: r.term for r in df.select("token", porter_stem("token").alias("term")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE w AS SELECT unnest(?) AS token", [sorted(words)])
    want = dict(con.execute(f"WITH {porter_ctes('w')} SELECT token, term FROM STEMS").fetchall())
    assert {w: (got[w], want[w]) for w in words if got[w] != want[w]} == {}
