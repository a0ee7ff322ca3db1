import random

import pytest

WORDS = "the of and to in red blue stone river cloud Garden walks under seven lights café über niño дом".split()


@pytest.fixture(scope="session")
def messy_rows():
    """(doc_id, text, lang, source): prose, copies, near copies, shared
    passages, repeated rows, NULLs, empty, short and very long texts."""
    rng = random.Random(5)

    def prose(n):
        return " ".join(rng.choice(WORDS) + (".\n" if rng.random() < 0.1 else "") for _ in range(n))

    passage = prose(60)
    base = prose(200)
    rows = [(i, prose(rng.randrange(1, 150)), rng.choice(["en", "fr", None]), rng.choice(["src0", "src0", "src1", "x", None])) for i in range(60)]
    rows += [(100 + i, base, "en", "src0") for i in range(25)]
    for i in range(25):
        w = base.split(" ")
        w[rng.randrange(len(w))] = f"edit{i}"
        rows.append((200 + i, " ".join(w), "en", "src0"))
    rows += [(300 + i, f"{prose(40)} {passage} {prose(30)}", "fr", "src2") for i in range(20)]
    rows += [(400, None, "en", "src0"), (401, "", "en", None), (402, " \n\t ", None, "src1"), (403, "one", "fr", "src0"), (404, "two words", "fr", "src0"),
             (405, prose(30_000), "en", "src0"), (406, "a" * 50_000, "en", "src0"), (407, "same " * 300, "en", "src0"), (408, "line one here\nline two here\n" * 40, "en", "src0"),
             (409, "\n\n\n", "en", "src0"), (410, "Straße ÉTÉ\x1c\x85  \x0b!!! ### |", None, "src1")]
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    """The rows with unique ids, and columns whose names the operators use."""
    df = spark.createDataFrame(messy_rows, "doc_id bigint, text string, lang string, source string")
    return df.selectExpr("*", "length(text) n_chars", "1 n_words", "'z' kept", "2 `key`", "3 _row", "4 d", "5 mix_slot", "6 n_lines", "true held_out", "7 _quality_pattern", "8 node", "9 count", "0.5 score").repartition(5).cache()


@pytest.fixture(scope="session")
def empty(messy):
    return messy.where("1 = 0")


@pytest.fixture(scope="session")
def odd_ids(spark, messy_rows):
    """NULL ids, repeated rows and ids that two texts share."""
    rows = [*messy_rows[:30], *messy_rows[:10], (None, messy_rows[62][1], "en", "src0"), (None, messy_rows[62][1], "en", "src0"), (None, None, None, None), (3, messy_rows[62][1], "en", "src1")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
