"""DuckDB SQL building blocks for the oracle statements.

These are independent SQL formulations of the same semantics, used only to
check the Spark plans (the driver runs them against the same Parquet tables).
"""

from __future__ import annotations

# Written out here, not imported from the code that the statements check.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WHITESPACE = "[\\x09-\\x0d\\x1c-\\x1f\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
WORD_CHAR, NON_WORD_CHAR = "[\\p{L}\\p{N}_]", "[^\\p{L}\\p{N}_]"
# text before the first NOT that stands as a word or before a bracket, text after it
ML_QUERY_SPLIT = "(?s)^(.*?)(?:^|" + WHITESPACE + ")NOT(?:\\(|" + WHITESPACE + "|$)(.*)$"
SPLITLINES_BREAK = "\\r\\n|[\\n\\x0b\\x0c\\r\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


PUNCT_SQL = q(PUNCTUATION)
WS_SQL = q(WHITESPACE + "+")


def words_sql(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, {WS_SQL}), lambda x: x <> '')"


def tokens_sql(expr: str) -> str:
    return words_sql(f"translate({expr}, {PUNCT_SQL}, '')")


def index_ctes(docs: str = "documents") -> str:
    """CTEs: dl(doc_id, doc_len), tf(term, doc_id, tf), dfs(term, df), n(N),
    sc(term, doc_id, tf, score) — lower-case analyzer."""
    return f"""
dl AS (SELECT doc_id, CAST(len({words_sql('text')}) AS BIGINT) AS doc_len FROM {docs}),
tk AS (SELECT doc_id, lower(unnest({tokens_sql('text')})) AS term FROM {docs}),
tf AS (SELECT term, doc_id, CAST(count(*) AS BIGINT) AS tf FROM tk GROUP BY term, doc_id),
dfs AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM tf GROUP BY term),
n AS (SELECT CAST(count(*) AS DOUBLE) AS N FROM {docs}),
sc AS (SELECT tf.term, tf.doc_id, tf.tf, tf.tf / dl.doc_len * log2(n.N / dfs.df) AS score
       FROM tf JOIN dl USING (doc_id) JOIN dfs USING (term) CROSS JOIN n)"""


def stemmed_index_ctes(queries_sql: str | None = None, docs: str = "documents") -> str:
    """The CTEs of ``index_ctes`` for the Porter analyzer; the stems cover the
    words of ``queries_sql`` too."""
    more = f" UNION ALL SELECT unnest({words_sql('query')}) FROM {queries_sql}" if queries_sql else ""
    return f"""
tk0 AS (SELECT doc_id, unnest({tokens_sql('text')}) AS token FROM {docs}),
tv AS (SELECT token FROM tk0{more}),{porter_ctes('tv')},
""" + index_ctes(docs).lstrip().replace(
        f"tk AS (SELECT doc_id, lower(unnest({tokens_sql('text')})) AS term FROM {docs})",
        "tk AS (SELECT doc_id, term FROM tk0 JOIN STEMS USING (token))")


def values_sql(rows: list[tuple], cols: str) -> str:
    def lit(v):
        if isinstance(v, str):
            return q(v)
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({cols})"


def boolean_ctes(queries_sql: str, term: str = "lower(word)") -> str:
    """Flat-DNF Boolean evaluation over a queries relation (query_id, query).
    Needs ``index_ctes``.  Produces H(query_id, doc_id, score) and
    ST(query_id, status)."""
    return f"""
qw AS (SELECT query_id, {words_sql('query')} AS toks FROM {queries_sql}),
qt AS (SELECT query_id, unnest(toks) AS tok, unnest(generate_series(1, len(toks))) AS pos FROM qw),
qn AS (SELECT *, sum(CASE WHEN tok = 'OR' THEN 1 ELSE 0 END) OVER (PARTITION BY query_id ORDER BY pos) AS clause_no,
              sum(CASE WHEN tok IN ('OR', 'AND') THEN 1 ELSE 0 END) OVER (PARTITION BY query_id ORDER BY pos) AS lit_no
       FROM qt),
lw AS (SELECT query_id, clause_no, lit_no, count(*) FILTER (WHERE tok = 'NOT') AS n_not,
              max(pos) FILTER (WHERE tok = 'NOT') AS last_not
       FROM qn WHERE tok NOT IN ('OR', 'AND') GROUP BY query_id, clause_no, lit_no),
lit AS (SELECT l.query_id, l.clause_no, l.lit_no, l.n_not, arg_min(t.tok, t.pos) AS word
        FROM lw l LEFT JOIN qn t ON t.query_id = l.query_id AND t.lit_no = l.lit_no
             AND t.tok NOT IN ('OR', 'AND') AND t.pos > coalesce(l.last_not, 0)
        GROUP BY l.query_id, l.clause_no, l.lit_no, l.n_not),
slots AS (SELECT query_id, count(*) FILTER (WHERE tok IN ('OR', 'AND')) + 1 AS n_slots FROM qn GROUP BY query_id),
good AS (SELECT s.query_id FROM slots s JOIN (SELECT query_id, count(*) AS n FROM lit WHERE word IS NOT NULL GROUP BY query_id) v
         ON v.query_id = s.query_id WHERE v.n = s.n_slots),
ST AS (SELECT query_id, CASE WHEN query_id IN (SELECT query_id FROM good) THEN 'ok' ELSE 'invalid' END AS status
       FROM {queries_sql}),
L AS (SELECT query_id, clause_no, lit_no, {term} AS term, n_not % 2 = 1 AS neg, n_not = 0 AS scoring
      FROM lit WHERE query_id IN (SELECT query_id FROM good)),
C AS (SELECT query_id, clause_no, count(*) FILTER (WHERE NOT neg) AS n_pos FROM L GROUP BY query_id, clause_no),
PM AS (SELECT L.query_id, L.clause_no, s.doc_id, count(*) AS hits,
              sum(CASE WHEN L.scoring THEN s.score ELSE 0 END) AS cscore
       FROM L JOIN sc s ON s.term = L.term WHERE NOT L.neg GROUP BY L.query_id, L.clause_no, s.doc_id),
CH AS (SELECT PM.query_id, PM.clause_no, PM.doc_id, PM.cscore FROM PM JOIN C
         ON C.query_id = PM.query_id AND C.clause_no = PM.clause_no WHERE PM.hits = C.n_pos
       UNION ALL
       SELECT C.query_id, C.clause_no, dl.doc_id, 0.0 FROM C CROSS JOIN dl WHERE C.n_pos = 0),
OKC AS (SELECT * FROM CH WHERE NOT EXISTS (
          SELECT 1 FROM L JOIN tf ON tf.term = L.term
          WHERE L.neg AND L.query_id = CH.query_id AND L.clause_no = CH.clause_no AND tf.doc_id = CH.doc_id)),
H AS (SELECT query_id, doc_id, sum(cscore) AS score FROM OKC GROUP BY query_id, doc_id)"""


def ranked_sql(source: str, count: int | None, part: str = "query_id") -> str:
    lim = f"QUALIFY rank <= {count}" if count is not None else ""
    return f"""SELECT CAST({part} AS BIGINT) AS {part},
       row_number() OVER (PARTITION BY {part} ORDER BY round(score, 9) DESC, doc_id) AS rank,
       doc_id, round(score, 9) AS score
FROM {source} {lim}"""


__all__ = ["porter_ctes", "stemmed_index_ctes", "q", "PUNCT_SQL", "WS_SQL", "words_sql", "tokens_sql", "index_ctes", "values_sql",
           "boolean_ctes", "ranked_sql", "WORD_CHAR", "NON_WORD_CHAR"]


def porter_ctes(words: str, col: str = "token") -> str:
    """CTE STEMS(token, term): Porter stems of ``words``' distinct ``col``, one
    CTE per step of the published algorithm; Y is a y that counts as a vowel."""
    v, c = "[aeiouY]", "[^aeiouY]"
    one, two = f"^{c}*{v}+{c}", f"^{c}*{v}+{c}+{v}+{c}"

    def rules(table: str, src: str, pairs: str) -> str:
        """The longest suffix of ``pairs`` that fits decides."""
        return f"""{table} AS (SELECT token, CASE WHEN s IS NOT NULL AND regexp_matches(stem, '{one}') THEN stem || r ELSE w END AS w
FROM (SELECT token, w, p.s, p.r, left(w, length(w) - length(p.s)) AS stem FROM {src}
      LEFT JOIN (VALUES {pairs}) AS p(s, r) ON suffix(w, p.s)
      QUALIFY row_number() OVER (PARTITION BY token ORDER BY length(p.s) DESC) = 1))"""

    step2 = ("('ational','ate'),('tional','tion'),('enci','ence'),('anci','ance'),('izer','ize'),('bli','ble'),('alli','al'),"
             "('entli','ent'),('eli','e'),('ousli','ous'),('ization','ize'),('ation','ate'),('ator','ate'),('alism','al'),"
             "('iveness','ive'),('fulness','ful'),('ousness','ous'),('aliti','al'),('iviti','ive'),('biliti','ble'),('logi','log')")
    step3 = "('icate','ic'),('ative',''),('alize','al'),('iciti','ic'),('ical','ic'),('ful',''),('ness','')"
    step4 = ",".join(f"('{s}')" for s in "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split())
    return f"""
P0 AS (SELECT DISTINCT {col} AS token, lower({col}) AS w FROM {words}),
PS AS (SELECT token, list_reduce(string_split(w, ''), lambda a, x: a || CASE WHEN x = 'y' AND regexp_matches(a, '{c}$') THEN 'Y' ELSE x END, '') AS w
       FROM P0 WHERE length(w) > 2),
P1A AS (SELECT token, CASE WHEN suffix(w, 'sses') OR suffix(w, 'ies') THEN left(w, length(w) - 2)
                           WHEN suffix(w, 's') AND NOT suffix(w, 'ss') THEN left(w, length(w) - 1) ELSE w END AS w FROM PS),
P1X AS (SELECT token, w, CASE WHEN suffix(w, 'eed') THEN NULL WHEN suffix(w, 'ed') THEN left(w, length(w) - 2)
                              WHEN suffix(w, 'ing') THEN left(w, length(w) - 3) END AS stem FROM P1A),
P1D AS (SELECT *, regexp_matches(stem, '{c}$') AND length(stem) > 1 AND lower(right(stem, 1)) = lower(left(right(stem, 2), 1)) AS twice FROM P1X),
P1B AS (SELECT token, CASE
          WHEN suffix(w, 'eed') THEN CASE WHEN regexp_matches(left(w, length(w) - 3), '{one}') THEN left(w, length(w) - 1) ELSE w END
          WHEN stem IS NULL OR NOT regexp_matches(stem, '{v}') THEN w
          WHEN suffix(stem, 'at') OR suffix(stem, 'bl') OR suffix(stem, 'iz') THEN stem || 'e'
          WHEN twice THEN CASE WHEN right(stem, 1) IN ('l', 's', 'z') THEN stem ELSE left(stem, length(stem) - 1) END
          WHEN regexp_matches(stem, '^{c}*{v}+{c}+$') AND regexp_matches(stem, '{c}{v}[^aeiouYwxy]$') THEN stem || 'e'
          ELSE stem END AS w FROM P1D),
P1C AS (SELECT token, CASE WHEN lower(right(w, 1)) = 'y' AND regexp_matches(left(w, length(w) - 1), '{v}') THEN left(w, length(w) - 1) || 'i' ELSE w END AS w FROM P1B),
{rules('P2', 'P1C', step2)},
{rules('P3', 'P2', step3)},
P4 AS (SELECT token, CASE WHEN s IS NOT NULL AND regexp_matches(stem, '{two}') AND (s <> 'ion' OR right(stem, 1) IN ('s', 't')) THEN stem ELSE w END AS w
       FROM (SELECT token, w, p.s, left(w, length(w) - length(p.s)) AS stem FROM P3 LEFT JOIN (VALUES {step4}) AS p(s) ON suffix(w, p.s)
             QUALIFY row_number() OVER (PARTITION BY token ORDER BY length(p.s) DESC) = 1)),
P5A AS (SELECT token, CASE WHEN suffix(w, 'e') AND (regexp_matches(left(w, length(w) - 1), '{two}')
                 OR (regexp_matches(left(w, length(w) - 1), '{one}') AND NOT regexp_matches(left(w, length(w) - 1), '{c}{v}[^aeiouYwxy]$')))
               THEN left(w, length(w) - 1) ELSE w END AS w FROM P4),
P5B AS (SELECT token, CASE WHEN suffix(w, 'll') AND regexp_matches(w, '{two}') THEN left(w, length(w) - 1) ELSE w END AS w FROM P5A),
STEMS AS (SELECT token, replace(w, 'Y', 'y') AS term FROM P5B UNION ALL SELECT token, w FROM P0 WHERE length(w) <= 2)"""
