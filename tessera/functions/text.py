"""Column expressions for text handling.

Everything here is a native Spark expression (no Python per row), so it stays
inside whole-stage codegen.  Regular expressions use explicit character classes
instead of ``\\s``/``\\w``/``\\b`` because those are ASCII-only in Java unless
``(?U)`` is set, and ASCII-only in DuckDB's RE2: the same class text runs in
both engines, which keeps the SQL oracle exact.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# The 32 ASCII punctuation characters deleted from document text before it is
# split into index tokens (Python's string.punctuation, in its natural order).
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Unicode whitespace as understood by Python's str.split() with no argument.
WHITESPACE = (
    r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)
WS_RUN = WHITESPACE + "+"
# The same for Java, which tests a class member by member: two ranges turn nearly
# every letter away before that.
JAVA_WS_RUN = r"[\x09-\x20\x85-\x{3000}&&" + WHITESPACE + "]+"

# Characters Python's ``re`` treats as word characters (approximation used on
# both engines): letters, digits, underscore.
WORD_CHAR = r"[\p{L}\p{N}_]"
NON_WORD_CHAR = r"[^\p{L}\p{N}_]"

# Line breaks of Python's text-mode file iteration (universal newlines).
FILE_LINE_BREAK = r"\r\n|\r|\n"

# Line boundaries of Python's str.splitlines().
SPLITLINES_BREAK = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\x{2028}\x{2029}]"

# Bracketed annotations such as [Chorus] or (x2): shortest run from an opening
# round/square bracket to the next closing one, within a line.
BRACKETED = r"[\(\[].*?[\)\]]"

# Boolean query operator words.
OP_AND, OP_OR, OP_NOT = "AND", "OR", "NOT"
# -----------------------------------------------------------------------------


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_punctuation(text) -> Column:
    """STR-1: delete the 32 ASCII punctuation characters."""
    return F.translate(col_(text), PUNCTUATION, "")


def has_token(word) -> Column:
    """Whether anything is left of a word without punctuation: the regex stops
    at the first such character, and the stripped word is computed once (a
    filter on it would compute it again)."""
    return col_(word).rlike("[^" + re.escape(PUNCTUATION) + "]")


ALNUM = "abcdefghijklmnopqrstuvwxyz0123456789"


def may_be_term(word, terms: list[str]) -> Column:
    """Whether a raw word may become one of the lower-case ``terms``: of words that
    begin with ASCII letters or digits only those pass whose first two characters
    begin a term, so that few words are stripped and folded.  All others (with
    punctuation or other letters up to there) pass."""
    begin = {t[:2] for t in terms} | {t[:1] for t in terms if len(t) == 1}
    other = [a for a in ALNUM if a not in begin] + [a + b for a in ALNUM for b in ALNUM if a + b not in begin]
    return ~F.lower(F.substring(col_(word), 1, 2)).isin(other) & has_token(word)


def split_words(text) -> Column:
    """STR-2: whitespace split with empty pieces removed (``str.split()``).
    ``array_remove`` keeps this inside whole-stage codegen (a lambda
    ``filter`` would be evaluated interpretively)."""
    return F.array_remove(F.split(col_(text), JAVA_WS_RUN), "")


def index_tokens(text) -> Column:
    """Tokens that go into the inverted index: punctuation deleted, then
    whitespace-split.  Case folding / stemming is the analyzer's job."""
    return split_words(strip_punctuation(text))


def word_count(text) -> Column:
    """AGG-6: document length = whitespace words of the raw text (words made of
    punctuation only still count, although they yield no index token)."""
    return F.size(split_words(text)).cast("bigint")


def strip_brackets(text) -> Column:
    """STR-5: remove ``(...)``/``[...]`` runs (mixed pairs allowed) in a line.

    ``(?d)`` makes ``.`` stop at ``\\n`` only, as in Python."""
    return F.regexp_replace(col_(text), "(?d)" + BRACKETED, "")


def drop_blank_lines(text) -> Column:
    """STR-6: drop empty lines (whitespace-only lines stay), join with ``\\n``."""
    lines = F.split(col_(text), SPLITLINES_BREAK)
    return F.array_join(F.filter(lines, lambda x: x != F.lit("")), "\n")


def reduced_text(text, max_words: int = -1) -> Column:
    """STR-9 / SRC-3: right-strip each line, drop empty lines, join with one
    space; if ``max_words > 0`` keep the first ``max_words`` words joined by
    single spaces."""
    lines = F.split(col_(text), FILE_LINE_BREAK)
    lines = F.transform(lines, lambda x: F.regexp_replace(x, WHITESPACE + "+$", ""))
    joined = F.array_join(F.filter(lines, lambda x: x != F.lit("")), " ")
    if max_words > 0:
        return F.array_join(F.slice(split_words(joined), 1, max_words), " ")
    return joined


def pretty_name(path) -> Column:
    """PRJ-1: ``band/song.txt`` -> ``band - song``; the song part is cut at its
    first dot (``Mr. Big/To Be. With You.txt`` -> ``Mr. Big - To Be``)."""
    parts = F.split(col_(path), "/")
    band = F.element_at(parts, -2)
    name = F.substring_index(F.element_at(parts, -1), ".", 1)
    return F.concat(band, F.lit(" - "), name)


def source_of_path(path) -> Column:
    """PRJ-2: first component of a ``band/song`` path."""
    return F.substring_index(col_(path), "/", 1)


def path_key(path) -> Column:
    """PRJ-3: last two components of a user-supplied path."""
    return F.substring_index(col_(path), "/", -2)


def safe_title(title) -> Column:
    """PRJ-4: make a title usable as a file name (``/`` -> ``_``)."""
    return F.translate(col_(title), "/", "_")


def relevance_label(score) -> Column:
    """PRJ-6: ``[relevance = x.xxx]`` as printed next to each hit."""
    return F.format_string("[relevance = %.3f]", col_(score))


# ML query syntax: ``word word NOT(word word)``.  NOT is recognised as a whole
# token (``NOT``, ``NOT(...``), not as a prefix of a word such as ``NOTHING``.
ML_QUERY_SPLIT = r"(?s)^(.*?)(?:^|" + WHITESPACE + r")NOT(?:\(|" + WHITESPACE + r"|$)(.*)$"


def ml_positive(query) -> Column:
    """STR-11: text before the first NOT token (the whole query if none)."""
    q = col_(query)
    return F.when(q.rlike(ML_QUERY_SPLIT), F.regexp_extract(q, ML_QUERY_SPLIT, 1)).otherwise(q)


def ml_negative_words(query) -> Column:
    """STR-11: words after the first NOT token, all brackets removed."""
    q = col_(query)
    neg = F.regexp_replace(F.regexp_extract(q, ML_QUERY_SPLIT, 2), r"[()]", "")
    return F.when(q.rlike(ML_QUERY_SPLIT), split_words(neg)).otherwise(F.array().cast("array<string>"))


def query_reduce(query) -> Column:
    """STR-13: query text without ``NOT`` and brackets (snippet words)."""
    return F.regexp_replace(F.regexp_replace(col_(query), "NOT", ""), r"[()]", "")


def regex_quote(s) -> Column:
    """Quote a string column for literal use inside a regex (Q10 fix)."""
    return F.concat(F.lit(r"\Q"), F.replace(col_(s), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
