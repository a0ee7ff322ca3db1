"""STR-7: text of the first element with a given tag (and class) in a page, as
column expressions.

The page is cut into tokens by one regular expression: comments, declarations,
the whole of ``script`` / ``style`` / ``template`` elements, tags, and the text
between them.  A fold over the tokens follows the depth of the wanted tag and
notes where its first element begins and ends (two positions, so the state
does not grow with the page); the text tokens in between are unescaped and
joined.  An element that is never closed ends with the page.  NULL when the
page has no such element.

Character references follow HTML: decimal, hexadecimal, and the names of the
standard's table, which Python's ``html.entities`` holds; names that the
standard lets stand without ``;`` may be followed by more letters.
"""

from __future__ import annotations

import re
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements whose content is no text.
SKIP = ("script", "style", "template")
TOKENS = r"(?is)<!--.*?(?:-->|$)|<(" + "|".join(SKIP) + r")\b[^>]*>.*?(?:</\1\s*>|$)|</?[a-z!?][^>]*>|[^<]+|<"
#: References that need no semicolon.
LEGACY = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
#: What a numeric reference to 128..159 stands for (fixed values of HTML).
C1 = dict(zip(range(0x80, 0xA0), bytes(range(0x80, 0xA0)).decode("cp1252", "replace"), strict=True))


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once however often it is read."""
    return F.get(F.transform(F.array(value), body), 0)


def _string_map(d: dict) -> Column:
    return F.create_map(*(F.lit(x) for kv in d.items() for x in kv))


def _char(code: Column) -> Column:
    """The character of a code point; U+FFFD for 0, surrogates and beyond,
    nothing for control characters and noncharacters."""
    bad = code.isNull() | (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    gone = (code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127)
            | code.between(0xFDD0, 0xFDEF) | (code % 65536 >= 65534))
    wide = F.decode(F.unhex(F.lpad(F.hex(F.when(bad, 0xFFFD).otherwise(code)), 8, "0")), "UTF-32")
    c1 = _string_map({k: v for k, v in C1.items() if v != "\ufffd"})
    return F.when(bad, F.lit("\ufffd")).when(gone, F.lit("")).otherwise(F.coalesce(c1[code.cast("int")], wide))


def _reference(r: Column) -> Column:
    """The text that one reference stands for, or itself."""
    # more digits than any code point has are no code point (NULL)
    hexa = F.ltrim(F.regexp_extract(r, "^&#[xX]([0-9a-fA-F]+)", 1), F.lit("0"))
    tens = F.ltrim(F.regexp_extract(r, "^&#([0-9]+)", 1), F.lit("0"))
    number = F.when(r.rlike("^&#[xX]"), F.when(F.length(hexa) <= 6, F.conv(hexa, 16, 10))).otherwise(F.when(F.length(tens) <= 7, tens))
    number = number.try_cast("bigint")
    name = F.substring(r, 2, 40)
    short = F.regexp_extract(name, "^(" + "|".join(map(re.escape, LEGACY)) + ")", 1)
    table = _string_map(html5)
    exact = table[name]
    return (F.when(r.startswith("&#"), _let(number, _char))
            .when(exact.isNotNull(), exact)
            .when(short != "", F.concat(table[short], F.substring(name, F.length(short) + 1, F.lit(40)))).otherwise(r))


def unescape(text: Column) -> Column:
    """Character references replaced by what they stand for."""
    parts = F.regexp_extract_all(text, F.lit(r"(?s)&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[a-zA-Z][a-zA-Z0-9]*;?|[^&]+|&"), F.lit(0))
    return F.when(~text.contains("&"), text).otherwise(
        F.array_join(F.transform(parts, lambda p: F.when(p.startswith("&") & (F.length(p) > 1), _reference(p)).otherwise(p)), ""))


def element_text(html, tag: str = "div", css_class: str | None = "lyrics") -> Column:
    """Text under the first ``<tag class=css_class>`` (NULL if absent)."""
    page = F.col(html) if isinstance(html, str) else html
    name = re.escape(tag)
    wanted = rf"(?is)^<{name}(?=[\s/>])"
    if css_class is not None:
        c = re.escape(css_class)
        wanted += rf"[^>]*\sclass\s*=\s*(?:\"(?:[^\"]*\s)?{c}(?:\s[^\"]*)?\"|'(?:[^']*\s)?{c}(?:\s[^']*)?'|{c}(?=[\s/>]))"
    opens, closes = rf"(?is)^<{name}(?=[\s/>])[^>]*(?<!/)>$", rf"(?is)^</{name}\s*>$"

    def span(tokens: Column) -> Column:
        """(depth, first, last): positions of the element's tags."""
        start = F.struct(F.lit(0).alias("depth"), F.lit(-1).alias("first"), F.lit(-1).alias("last"), F.lit(0).alias("i"))

        def step(s: Column, t: Column) -> Column:
            depth, first, last, i = (s[c] for c in ("depth", "first", "last", "i"))
            begins = (first < 0) & t.rlike(wanted)
            inside = (depth > 0) & (last < 0)
            now = (F.when(begins, F.when(t.endswith("/>"), 0).otherwise(1)).when(inside & t.rlike(opens), depth + 1)
                   .when(inside & t.rlike(closes), depth - 1).otherwise(depth))
            done = F.when((last < 0) & (begins | inside) & (now == 0), i).otherwise(last)
            return F.struct(now.alias("depth"), F.when(begins, i).otherwise(first).alias("first"), done.alias("last"), (i + 1).alias("i"))

        return F.aggregate(tokens, start, step)

    def text(tokens: Column) -> Column:
        def joined(s: Column) -> Column:
            n = F.when(s["last"] < 0, F.size(tokens)).otherwise(s["last"]) - s["first"]
            # a lone "<" is text; a token of two and more characters that begins with it is not
            plain = F.filter(F.slice(tokens, s["first"] + 1, F.greatest(n, F.lit(0))), lambda t: ~t.startswith("<") | (t == "<"))
            return F.when(s["first"] >= 0, F.array_join(F.transform(plain, unescape), ""))

        return _let(span(tokens), joined)

    return _let(F.regexp_extract_all(page, F.lit(TOKENS), F.lit(0)), text)


def extract_element_text(pages: DataFrame, html_col: str = "html", tag: str = "div",
                         css_class: str | None = "lyrics", out_col: str = "text") -> DataFrame:
    """Add ``out_col`` = :func:`element_text` of ``html_col`` to every row."""
    return pages.withColumn(out_col, element_text(html_col, tag, css_class))
