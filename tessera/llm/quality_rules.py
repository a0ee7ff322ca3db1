"""Quality rules by weak supervision.

Every rule votes for good (+1) or junk (-1) or abstains (0).  The votes of a
document form a pattern; with K rules there are at most 3**K patterns, so the
table of pattern counts over *all* documents is small whatever the input.
Expectation-maximisation on these counts estimates the shares of the classes
(good documents, unlike kinds of junk) and, per rule and class, the chance of
each vote (a rule's accuracy, held by a weak prior only), and gives every
pattern its posterior probability of quality.  Documents at or above
``threshold`` are kept; the base rules of the contract (fewer than 10 words, a
fifth of the words in repeated windows) also fail a document by themselves.

The texts are read once, in tasks; what goes on is a short row per document.

Rows: a NULL or empty text has no words and fails the base rules; rows are
judged one by one (repeated rows alike); other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import batch, covered, map_arrow, rolled, word_hashes, written

#: Fixed values of the contract.
SPACES, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
WINDOW = 5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_upper", "n_letters", "n_marks", "n_stutter")


def features(text: str | None) -> tuple[int, ...]:
    """BASE and MORE counts of one text."""
    text = text or ""
    h = word_hashes(text.encode())
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    w = rolled(h, WINDOW)
    repeat = 0
    if len(w) > 1:
        order = np.argsort(w, kind="stable")
        same = w[order[1:]] == w[order[:-1]]
        if same.any():
            starts = np.unique(np.concatenate((order[1:][same], order[:-1][same])))
            repeat = int(covered(starts, WINDOW, len(h)).sum())
    # a letter that has two cases and stands in upper case; letters of any script
    units = np.frombuffer(text.encode("utf-16-le"), np.uint16)
    kind = _kinds()[units]
    return (len(h), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat,
            len(lines), int((kind == 2).sum()), int((kind > 0).sum()), text.count("!") + text.count("?"), int((h[1:] == h[:-1]).sum()))


_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """0 no letter, 1 letter, 2 upper-case letter, by UTF-16 unit."""
    if not _KINDS:
        chars = [chr(i) for i in range(65536)]
        _KINDS.append(np.array([(c.isalpha() or 0xD800 <= ord(c) < 0xE000) + (c.isupper() and c.isalpha()) for c in chars], np.uint8))
    return _KINDS[0]


def rules(prefix: str = "") -> dict[str, Column]:
    """Votes over the counts (shares are cross-multiplied: no division).  Each
    rule vouches for clearly clean documents and abstains in between."""
    def c(name: str) -> Column:
        return F.col(prefix + name)

    words, chars, letters, lines = c("n_words"), c("word_chars"), c("n_letters"), c("n_lines")
    junk = {
        "length": words < 10,
        "repeats": 5 * c("n_repeat_words") > words,
        "symbols": 10 * c("n_symbols") > words,
        "word_length": (chars < 2 * words) | (chars > 15 * words),
        "lines": 2 * c("n_dup_lines") > lines,
        "capitals": 2 * c("n_upper") > letters,
        "letters": 2 * letters < chars,
        "marks": 5 * c("n_marks") > words,
        "stutter": 5 * c("n_stutter") > words,
    }
    good = {
        "length": words >= 40,
        "repeats": 20 * c("n_repeat_words") <= words,
        "symbols": 100 * c("n_symbols") <= words,
        "word_length": (chars >= 3 * words) & (chars <= 8 * words),
        "lines": 10 * c("n_dup_lines") <= lines,
        "capitals": 10 * c("n_upper") <= letters,
        "letters": 10 * letters >= 9 * chars,
        "marks": 20 * c("n_marks") <= words,
        "stutter": 20 * c("n_stutter") <= words,
    }
    return {k: F.when(v, F.lit(-1)).when(good[k] & (words > 0), F.lit(1)).otherwise(F.lit(0)) for k, v in junk.items()}


def measured(docs: DataFrame, carry: list[str], prefix: str = "") -> DataFrame:
    """The columns ``carry``, the counts of ``text`` and the number of the vote
    pattern (counts and pattern under ``prefix``)."""
    counts = pa.schema([(prefix + n, pa.int64()) for n in (*BASE, *MORE)])

    def run(batches):
        for b in batches:
            rows = [features(t.as_py()) for t in b.column(b.num_columns - 1)]
            cols = zip(*rows, strict=True) if rows else ([] for _ in counts)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(c, pa.int64()) for c in cols)], names=[*b.schema.names[:-1], *counts.names])

    rows = docs.select(*carry, F.col("text").alias(prefix + "_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]] + [f"`{n}` bigint" for n in counts.names]
    pattern = sum(((v + 1) * 3**k for k, v in enumerate(rules(prefix).values())), F.lit(0))
    return map_arrow(rows, run, ", ".join(fields)).withColumn(prefix + "pattern", pattern.cast("int"))


#: A class of documents is junk if the rules besides its foremost one turn
#: against it by so much in sum (1: a rule withholds its good vote in every document).
AGREE = 0.5


def _em(onehot: np.ndarray, counts: np.ndarray, post: np.ndarray, rounds: int, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """EM from the class posteriors ``post`` [class, pattern]: (posteriors,
    chance of each vote [class, rule, vote], class shares, log likelihood).
    Nothing holds the chances but ``prior`` pseudo-counts."""
    for _ in range(rounds):
        weight = post * counts
        sums = np.einsum("cp,prv->crv", weight, onehot) + prior
        chance = sums / sums.sum(2, keepdims=True)
        share = (weight.sum(1) + prior) / (counts.sum() + prior * len(post))
        log = np.einsum("prv,crv->cp", onehot, np.log(chance)) + np.log(share)[:, None]
        top = log.max(0)
        whole = top + np.log(np.exp(log - top).sum(0))
        now = np.exp(log - whole)
        done = np.abs(now - post).max(initial=0) < 1e-9
        post = now
        if done:
            break
    return post, chance, share, float(counts @ whole)


def fit(votes: np.ndarray, counts: np.ndarray, rounds: int = 200, prior: float = 1.0) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over patterns: (posterior of good per pattern, chance of each vote
    [class, rule, vote], share of good).  Within a class the rules vote
    independently, and their accuracies are estimated freely.

    One class of junk cannot hold several unlike kinds, so there are as many
    as the counts bear out: starting from one class of all documents, the
    documents that some rule calls junk are split off as a further class as
    long as that lowers the Bayesian information criterion.  A rule that fires
    by itself, however often, bears out no class: independent votes explain
    it.  A class is junk if at least two rules turn against it, compared with
    the classes found good, the most vouched for being the first; so no rule
    condemns documents that all others vouch for."""
    onehot = np.stack([votes == v for v in (-1, 0, 1)], 2).astype(float)  # pattern, rule, vote
    k = votes.shape[1]
    cost = (2 * k + 1) * np.log(max(counts.sum(), 2)) / 2  # of one more class
    best = _em(onehot, counts, np.ones((1, len(counts))), rounds, prior)
    for _ in range(k):
        tried = []
        for r in range(k):
            fires = votes[:, r] < 0
            if fires.any() and not fires.all():
                moved = np.where(fires, 0.95, 0.05)
                tried.append(_em(onehot, counts, np.vstack([best[0] * (1 - moved), moved]), rounds, prior))
        top = max(tried, key=lambda t: t[3], default=best)
        if top[3] - cost <= best[3]:
            break
        best = top
    post, chance, share, _ = best
    good = np.arange(len(share)) == np.argmax((chance[:, :, 2] - chance[:, :, 0]).sum(1))  # most vouched for
    for _ in share:
        clean = np.einsum("c,crv->rv", share * good, chance) / share[good].sum()
        fired = np.clip(chance[:, :, 0] - clean[:, 0], 0, None)  # class, rule: junk votes beyond those of good classes
        turned = fired + np.clip(clean[:, 2] - chance[:, :, 2], 0, None)  # and good votes withheld
        good = good | (turned.sum(1) - turned.max(1) < AGREE) | (fired.sum(1) < AGREE)
    return post[good].sum(0), chance, float(share[good].sum())


def posteriors(rows: DataFrame, prefix: str = "") -> DataFrame:
    """(pattern, posterior), from the pattern counts of all ``rows``."""
    seen = rows.groupBy(prefix + "pattern").count().collect()  # at most 3 ** len(rules) rows
    ids = np.array([r[0] for r in seen], np.int64)
    by_rule = np.stack([ids // 3**k % 3 - 1 for k in range(len(rules()))], 1)
    good = fit(by_rule, np.array([r[1] for r in seen], float))[0] if seen else []
    table = [(int(i), float(g)) for i, g in zip(ids, good, strict=True)]
    return F.broadcast(rows.sparkSession.createDataFrame(table, f"`{prefix}pattern` int, `{prefix}posterior` double"))


def _failed(prefix: str = "") -> Column:
    words, repeat = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < 10) | (100 * repeat > 20 * words)


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, counts, base_failed, posterior, kept) per row of ``docs``."""
    rows = written(measured(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")), ["doc_id"]), "quality-counts")
    out = rows.join(posteriors(rows), "pattern")
    return out.select("doc_id", *BASE, _failed().alias("base_failed"), "posterior", (~_failed() & (F.col("posterior") >= threshold)).alias("kept"))


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns.  The texts are counted
    twice instead of shuffled once."""
    p = "_quality_"
    while any(c.startswith(p) for c in docs.columns):
        p = "_" + p
    table = posteriors(written(measured(docs, [], p).select(p + "pattern"), "quality-patterns"), p)
    rows = measured(docs, docs.columns, p)
    return rows.join(table, p + "pattern").where(~_failed(p) & (F.col(p + "posterior") >= threshold)).select(*docs.columns)
