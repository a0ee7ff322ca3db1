"""Line dedup: globally repeated multi-line chunks leave the texts (native).

Chunks are content-defined.  Every line has a 32-bit hash; a rolling hash over
the last three line hashes ends a chunk where it is divisible by ``divisor``,
so the boundaries inside a shared passage depend on the passage alone and
survive shifts.  Chunks of at least ``min_lines`` lines that hold a character
besides white space are counted by hash; the repeated ones are then grouped by
their very bytes.  The first occurrence (smallest doc_id, then row hash, then
line) stays, all others go.

Boundaries near the ends of a passage depend on what surrounds it, so short
shared passages are found in part only (README).  ``all_starts`` judges the
windows of ``min_lines`` lines at every start instead and misses none.

DataFrame functions only.  Counts are partial aggregates; a text is shuffled
once, on its own key, and the exchange serves both joins; bodies travel only
for chunks whose hash repeats, each chunk's rows reduced before the shuffle.

Rows: a NULL text stays NULL with 0 lines; an empty text is one empty line;
NULL doc_ids sort first; rows equal in doc_id and text are one document and
get equal results; rows that share only the doc_id are different documents.
Columns of the input named like a result column are not carried.  An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import id_key, written

DIVISOR, MIN_LINES = 4, 2
#: Weights of the rolling hash over the last three lines, and its modulus.
ROLL, MODULUS = (1, 31, 961), 2147483647


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: Catalyst would otherwise
    copy the expression to each place (and element) that reads it."""
    return F.get(F.transform(F.array(value), body), 0)


def _lines() -> Column:
    return F.split(F.col("text"), "\n", -1)


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("bigint")


def _body(lines: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(lines, start + 1, n), "\n")


def _chunks(lines: Column, divisor: int, min_lines: int, all_starts: bool) -> Column:
    """Chunks (start, n, key) of at least ``min_lines`` lines; with
    ``all_starts`` the windows of ``min_lines`` lines instead."""
    def ends(hashes: Column) -> Column:
        def end(h: Column, i: Column) -> Column:
            before = [F.coalesce(F.get(hashes, i - k), F.lit(0).cast("bigint")) * ROLL[k] for k in (1, 2)]
            rolled = (h * ROLL[0] + before[0] + before[1]) % MODULUS
            return F.when((rolled % divisor == 0) | (i == F.size(hashes) - 1), i)

        return F.filter(F.transform(hashes, end), lambda e: e.isNotNull())

    def spans(cuts: Column) -> Column:
        def span(e: Column, k: Column) -> Column:
            start = F.when(k == 0, F.lit(0)).otherwise(F.get(cuts, k - 1) + 1)
            return F.struct(start.alias("start"), (e - start + 1).alias("n"))

        return F.filter(F.transform(cuts, span), lambda c: c["n"] >= min_lines)

    def keyed(c: Column) -> Column:
        body = _body(lines, c["start"], c["n"])
        return _let(body, lambda x: F.struct(c["start"].alias("start"), c["n"].alias("n"), F.when(x.rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(x)).alias("key")))

    if all_starts:
        last = F.size(lines) - min_lines
        starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: keyed(F.struct(i.alias("start"), F.lit(min_lines).alias("n"))))
    return _let(_let(F.transform(lines, _line_hash), ends), lambda cuts: F.transform(spans(cuts), keyed))


def _copies(cut: DataFrame, keyed: DataFrame, repeated: DataFrame, share: float) -> DataFrame:
    """(_row) of documents that have more than ``share`` of their lines in chunks
    of one and the same earlier document."""
    whole = keyed.select("_row", "_d", F.size(_lines()).alias("size")).distinct()
    spots = cut.join(repeated, "key").select("_row", "key", F.sequence("start", F.col("start") + F.col("n") - 1).alias("lines")).join(whole, "_row")
    first = spots.groupBy("key").agg(F.min(F.struct("_d", "_row")).alias("o")).select("key", F.col("o._row").alias("first"))
    shared = spots.join(first, "key").where("_row <> first").select("_row", "first", "size", F.explode("lines").alias("line")).distinct()
    per = shared.groupBy("_row", "first", "size").agg(F.count(F.lit(1)).alias("n"))
    return per.where(F.col("n") > share * F.col("size")).select("_row").distinct()


def dedup_lines(docs: DataFrame, divisor: int = DIVISOR, min_lines: int = MIN_LINES, all_starts: bool = False, spare: float | None = None) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``text`` freed of repeated chunks, plus
    n_lines and n_removed.  With ``all_starts`` every run of ``min_lines`` lines
    is judged, whatever the boundaries: no repeated run is missed.  With
    ``spare`` a document that has more than this share of its lines from one
    earlier document is left whole: it is a near copy, to be judged as a document, and
    cut to its differences it could no longer be told."""
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    # in a struct no column of the input can clash with one of ours
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("_row"), id_key().alias("_d"), "text", F.struct(*(F.col(f"`{c}`") for c in rest)).alias("_rest"))

    cut = docs.select(F.xxhash64("doc_id", "text").alias("_row"), F.explode(_let(_lines(), lambda lines: _chunks(lines, divisor, min_lines, all_starts))).alias("c"))
    cut = written(cut.select("_row", "c.*").where("key is not null"), "line-chunks")
    repeated = written(cut.groupBy("key").count().where("count > 1").select("key"), "repeated-chunks")
    suspects = cut.join(repeated, "key").groupBy("_row").agg(F.collect_set(F.struct("start", "n")).alias("suspects"))
    if spare is not None:
        suspects = suspects.join(written(_copies(cut, keyed, repeated, spare), "near-copies"), "_row", "left_anti")

    joined = keyed.join(suspects, "_row", "left")
    body = _let(_lines(), lambda lines: F.transform("suspects", lambda c: F.struct(c["start"].alias("start"), _body(lines, c["start"], c["n"]).alias("body"))))
    bodies = joined.where("suspects is not null").select("_row", "_d", F.explode(body).alias("c"))
    owners = (bodies.groupBy("c.body").agg(F.min(F.struct("_d", "_row", "c.start")).alias("o"))
              .groupBy(F.col("o._row").alias("_row")).agg(F.collect_list("o.start").alias("kept")))

    kept = F.coalesce("kept", F.array().cast("array<int>"))
    def gone_of(k: Column) -> Column:
        if all_starts:  # windows overlap; a set operation, as a long text has many
            others = F.array_except(F.transform("suspects", lambda c: c["start"]), k)
            return F.array_distinct(F.flatten(F.transform(others, lambda i: F.sequence(i, i + min_lines - 1))))
        others = F.filter("suspects", lambda c: ~F.array_contains(k, c["start"]))
        return F.flatten(F.transform(others, lambda c: F.sequence(c["start"], c["start"] + c["n"] - 1)))

    gone = _let(kept, gone_of)

    def freed(lines: Column, gone: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        text = F.when(F.size(gone) == 0, F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
        return F.struct(text.alias("text"), F.size(lines).cast("bigint").alias("n_lines"), F.size(gone).cast("bigint").alias("n_removed"))

    result = _let(_lines(), lambda lines: _let(F.coalesce(gone, F.array().cast("array<int>")), lambda g: freed(lines, g)))
    none = F.lit(0).cast("bigint")
    # a struct column, unfolded by a second projection: each field is read from the finished value
    out = joined.join(owners, "_row", "left").select("_rest", F.explode(F.array(result)).alias("_r"))
    return out.select("_rest.*", "_r.text", F.when(F.col("_r.text").isNull(), none).otherwise(F.col("_r.n_lines")).alias("n_lines"),
                      F.coalesce("_r.n_removed", none).alias("n_removed"))


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


#: DuckDB statement of ``digest(dedup_lines(documents))`` for unique doc_ids.
ORACLE = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents WHERE text IS NOT NULL),
hashed AS (SELECT doc_id, i, line, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM lines),
rolled AS (
  SELECT *, (h + 31 * coalesce(lag(h, 1) OVER w, 0) + 961 * coalesce(lag(h, 2) OVER w, 0)) % 2147483647 % 4 = 0 AS cut
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
placed AS (
  SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
  FROM rolled),
chunks AS (SELECT doc_id, c, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body FROM placed GROUP BY doc_id, c),
judged AS (
  SELECT *, n >= 2 AND regexp_matches(body, '[^\x20\x09-\x0D]')
    AND row_number() OVER (PARTITION BY body ORDER BY n >= 2 DESC, doc_id, c) > 1 AS gone
  FROM chunks),
kept AS (
  SELECT doc_id, sum(n) AS n_lines, coalesce(sum(n) FILTER (WHERE gone), 0) AS n_removed,
         coalesce(string_agg(body, chr(10) ORDER BY c) FILTER (WHERE NOT gone), '') AS text
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed, md5(k.text) AS kept_md5
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
