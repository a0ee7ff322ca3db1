"""STR-3: Porter stemming as column expressions.

The rules are M. F. Porter's, "An algorithm for suffix stripping" (1980), in
the revised form Porter later published with his reference code, which departs
from the paper in three places: words of one or two letters are left alone,
step 2 maps ``-bli`` to ``-ble`` (paper: ``-abli`` to ``-able``) and adds
``-logi`` to ``-log``.  Input is lower-cased first.

A ``y`` after a consonant is a vowel; it is written ``Y`` while the steps run.
Consonants and vowels are then plain character classes, and the conditions of
the rules (the measure of a stem, "contains a vowel", "ends consonant vowel
consonant") are regular expressions on the stem.

Use it on distinct words (``operators.index.stem_vocabulary``): the steps are
many regular expressions per word.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: suffix rules of the published algorithm ------------------
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate",
    "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
    "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
         "ism", "ate", "iti", "ous", "ive", "ize"]
# -----------------------------------------------------------------------------

V, C = "[aeiouY]", "[^aeiouY]"
# last letters of all suffixes that a step cuts or changes
ENDS = sorted({s[-1] for s in [*STEP2, *STEP3, *STEP4, "s", "ed", "ing", "y", "e", "l"]})
ONE = f"^{C}*{V}+{C}"             # measure of at least one
TWO = f"^{C}*{V}+{C}+{V}+{C}"     # measure of at least two
CVC = f"{C}{V}[^aeiouYwxy]$"


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once however often it is read."""
    return F.get(F.transform(F.array(value), body), 0)


def _mark(w: Column) -> Column:
    def add(done: Column, c: Column) -> Column:
        return F.concat(done, F.when((c == "y") & done.rlike(f"{C}$"), "Y").otherwise(c))

    one_by_one = F.aggregate(F.split(w, ""), F.lit(""), add)
    return F.when(w.contains("yy"), one_by_one).otherwise(F.regexp_replace(w, "([^aeiouy])y", "$1Y"))


def _step1a(w: Column) -> Column:
    return F.regexp_replace(w, "(?:(ss|i)es|([^s])s)$", "$1$2")


def _step1b(w: Column) -> Column:
    def mend(stem: Column) -> Column:
        double = stem.rlike(r"([^aeiouY])\1$|Yy$")
        return (F.when(stem.rlike("(at|bl|iz)$") | (~double & stem.rlike(f"^{C}+{V}[^aeiouYwxy]$")), F.concat(stem, F.lit("e")))
                .when(double & ~stem.rlike("[lsz]$"), F.regexp_replace(stem, ".$", "")).otherwise(stem))

    cut = f"^(.*{V}.*)(ed|ing)$"
    return (F.when(w.rlike("eed$"), F.regexp_replace(w, f"({ONE}.*)eed$", "$1ee"))
            .when(w.rlike(cut), _let(F.regexp_extract(w, cut, 1), mend)).otherwise(w))


def _step1c(w: Column) -> Column:
    return F.regexp_replace(w, f"^(.*{V}.*)[yY]$", "$1i")


def _longest(suffixes) -> str:
    """(stem)(suffix): the shortest stem, so the longest suffix."""
    return f"^(.*?)({'|'.join(suffixes)})$"


def _replace(rules: dict[str, str]):
    pattern = _longest(rules)
    table = F.create_map(*(F.lit(x) for kv in rules.items() for x in kv))

    def step(w: Column) -> Column:
        stem, suffix = F.regexp_extract(w, pattern, 1), F.regexp_extract(w, pattern, 2)
        return F.when((suffix != "") & stem.rlike(ONE), F.concat(stem, F.get(F.array(table[suffix]), 0))).otherwise(w)

    return step


def _step4(w: Column) -> Column:
    pattern = _longest(STEP4)

    def strip(stem: Column) -> Column:
        fits = stem.rlike(TWO) & (~w.rlike("ion$") | stem.rlike("[st]$"))
        return F.when(w.rlike(pattern) & fits, stem).otherwise(w)

    return _let(F.regexp_extract(w, pattern, 1), strip)


def _step5a(w: Column) -> Column:
    def strip(stem: Column) -> Column:
        return F.when(w.endswith("e") & (stem.rlike(TWO) | (stem.rlike(ONE) & ~stem.rlike(CVC))), stem).otherwise(w)

    return _let(F.regexp_replace(w, "e$", ""), strip)


def _step5b(w: Column) -> Column:
    return F.when(w.endswith("ll") & w.rlike(TWO), F.regexp_replace(w, "l$", "")).otherwise(w)


def porter_stem(word) -> Column:
    """Stem of a word (lower-cased; words of one or two letters unchanged, as are
    those that end in a letter that no suffix ends in)."""
    steps = [_mark, _step1a, _step1b, _step1c, _replace(STEP2), _replace(STEP3), _step4, _step5a, _step5b]

    def run(w: Column, rest: list) -> Column:
        return F.translate(w, "Y", "y") if not rest else _let(rest[0](w), lambda x: run(x, rest[1:]))

    c = F.col(word) if isinstance(word, str) else word
    return _let(F.lower(c), lambda w: F.when((F.length(w) <= 2) | ~F.substring(w, -1, 1).isin(ENDS), w).otherwise(run(w, steps)))
