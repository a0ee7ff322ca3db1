"""Language identification by interpolated Kneser-Ney character models.

Training.  Letters (other characters become one space) give 4-grams of UTF-16
units, each an exact 64-bit number.  Tasks count them over *all* training
texts, Spark adds the counts per language.  The highest order is discounted raw
counts, lower orders are continuation counts, all interpolated down to the
uniform distribution; discounts, continuation counts and context totals are
Spark aggregates over all grams.  A language's model stores all of its grams.  A
caller that needs a model of bounded size gives ``max_grams``: of each order it
then holds the grams whose count reaches the smallest power-of-two step that
leaves at most so many, and all single units; the probability of those left out
goes to the shorter context.  A model is sorted arrays of gram hashes (the packed
units), one language after another, searched by bisection: at most four numbers
for a gram of each order, so it grows with the distinct grams of its languages
and not with their texts.

Prediction.  A text gets the language of lowest cross-entropy per letter, ties
to the smaller name.  A calibration fold (a sixteenth of the training rows,
left out of the counts) says per step of the margin to the second language
how often the choice was right, made monotone: that is the score.  It also
gives, per language, the cross-entropy that its own texts stay under;
``rejected`` marks texts above it (or, with ``min_score``, of too low a score).

Rows: a NULL text or one without letters is ``und`` with score 0, as is any
text if nothing was learned; rows with NULL lang, doc_id or text are not
learned from; repeated rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import as_i64, batch, map_arrow, written

ORDER = 4
MAX_LANGUAGES = 256
#: Steps of the calibration tables, per nat.
STEPS, TOP = 20, 200

_FOLD: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    """UTF-16 unit -> itself if a letter (or part of one), else a space."""
    if not _FOLD:
        _FOLD.append(np.array([i if chr(i).isalpha() or 0xD800 <= i < 0xE000 else 32 for i in range(65536)], np.uint16))
    return _FOLD[0]


def grams(text: str | None) -> np.ndarray:
    """Packed 4-grams of a text, one per letter or gap between words; empty if
    it has no letter."""
    if not text:
        return np.empty(0, np.uint64)
    u = _fold_table()[np.frombuffer(text.lower().encode("utf-16-le"), np.uint16)]
    gap = u == 32
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    u = u[keep]
    if not (u != 32).any() or not any(map(str.isalpha, text)):
        return np.empty(0, np.uint64)
    u = np.concatenate((np.full(ORDER - 1, 32, np.uint16), u[1:] if u[0] == 32 else u)).astype(np.uint64)
    n = len(u) - ORDER + 1
    out = u[:n] << np.uint64(48)
    for k in range(1, ORDER):
        out |= u[k:k + n] << np.uint64(48 - 16 * k)
    return out


def _tally(keys: np.ndarray, n: np.ndarray | None = None):
    """Sorted distinct keys and the sum of n (1 each) per key."""
    if n is None:
        keys = np.sort(keys)
        at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
        return keys[at], np.diff(np.append(at, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[at], np.add.reduceat(n, at) if len(at) else n


def _count(batches):
    """(lang, gram, n), summed over the task."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
    held: dict[str, list] = {}
    size: dict[str, int] = {}

    def merged(lang):
        k, n = _tally(np.concatenate([x[0] for x in held[lang]]), np.concatenate([x[1] for x in held[lang]]))
        held[lang], size[lang] = [(k, n)], 0

    for b in batches:
        texts: dict[str, list] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            texts.setdefault(lang, []).append(grams(text.as_py()))
        for lang, parts in texts.items():
            k, n = _tally(np.concatenate(parts))
            held.setdefault(lang, []).append((k, n))
            size[lang] = size.get(lang, 0) + len(k)
            if size[lang] > 500_000:
                merged(lang)
    for lang in held:
        merged(lang)
        k, n = held[lang][0]
        yield batch(schema, [lang] * len(k), as_i64(k), n)


@dataclass
class Table:
    """Sorted keys with values, one language after another: those of language j
    lie from starts[j] to starts[j + 1]."""

    starts: np.ndarray
    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, per: list[tuple[np.ndarray, np.ndarray]]) -> Table:
        starts = np.concatenate(([0], np.cumsum([len(k) for k, _ in per], dtype=np.int64)))
        return cls(starts, np.concatenate([k for k, _ in per]).astype(np.uint64), np.concatenate([v for _, v in per]).astype(np.float64))

    def look(self, j: int, q: np.ndarray, other: float) -> np.ndarray:
        """Values of language j at q; ``other`` where it has none."""
        keys, values = (x[self.starts[j]:self.starts[j + 1]] for x in (self.keys, self.values))
        if not len(keys):
            return np.full(len(q), other)
        i = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
        return np.where(keys[i] == q, values[i], other)


@dataclass
class Model:
    """Per order a table of discounted probabilities by gram and one of backoff
    weights by context."""

    langs: list[str]
    uniform: float
    probs: list[Table]
    backs: list[Table]
    logs: np.ndarray | None = None

    def arrays(self) -> tuple:
        """What a broadcast carries: plain lists and arrays."""
        parts = lambda tables: [(t.starts, t.keys, t.values) for t in tables]
        return self.langs, self.uniform, parts(self.probs), parts(self.backs)

    @classmethod
    def from_arrays(cls, langs, uniform, probs, backs) -> Model:
        return cls(langs, uniform, [Table(*t) for t in probs], [Table(*t) for t in backs]).finish()

    def log_probs(self, q: np.ndarray) -> np.ndarray:
        """log p(last unit | the units before) per gram and language."""
        return np.stack([self._log_probs(j, q) for j in range(len(self.langs))], 1)

    def _log_probs(self, j: int, q: np.ndarray) -> np.ndarray:
        p = np.full(len(q), self.uniform)
        for k in range(1, ORDER + 1):
            mask = np.uint64(2 ** (16 * k) - 1)
            p = p * self.backs[k - 1].look(j, (q & mask) >> np.uint64(16), 1.0) + self.probs[k - 1].look(j, q & mask, 0.0)
        return np.log(p)

    def finish(self) -> Model:
        """Keep the log probabilities of every language's own grams."""
        top = self.probs[-1]
        self.logs = np.concatenate([self._log_probs(j, top.keys[top.starts[j]:top.starts[j + 1]]) for j in range(len(self.langs))])
        return self

    def cross_entropy(self, g: np.ndarray) -> np.ndarray:
        """Nats per gram, by language."""
        k, n = _tally(g)
        top, out = self.probs[-1], np.empty(len(self.langs))
        for j in range(len(self.langs)):
            lo, hi = top.starts[j], top.starts[j + 1]
            at = np.minimum(np.searchsorted(top.keys[lo:hi], k), max(hi - lo - 1, 0)) + lo
            hit = top.keys[at] == k if hi > lo else np.zeros(len(k), bool)
            total = float(n[hit] @ self.logs[at[hit]])
            if not hit.all():
                total += float(n[~hit] @ self._log_probs(j, k[~hit]))
            out[j] = -total / len(g)
        return out


def discount(n1: int, n2: int) -> float:
    return n1 / (n1 + 2 * n2) if n1 and n2 else 0.75


def assemble(langs: list[str], levels: list[dict[str, tuple[np.ndarray, np.ndarray]]], n_units: int) -> Model:
    """The model from the stored grams and probabilities of each order, from 1 up.
    What a context's stored grams leave of 1 goes to the shorter context."""
    probs, backs = [], []
    for level in levels:
        per, left = [], []
        for g in langs:
            keys, p = level[g]
            order = np.argsort(keys, kind="stable")
            keys, p = keys[order], p[order]
            ctx, at = np.unique(keys >> np.uint64(16), return_inverse=True)
            per.append((keys, p))
            left.append((ctx, np.maximum(1 - np.bincount(at, p, len(ctx)), 1e-12)))
        probs.append(Table.of(per))
        backs.append(Table.of(left))
    return Model(langs, 1.0 / (n_units + 1), probs, backs).finish()


def estimate(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Interpolated Kneser-Ney from {lang: (sorted grams, counts)}, in memory,
    nothing left out; ``train`` does the same in Spark."""
    langs = sorted(counts)
    level, levels = {g: counts[g] for g in langs}, []
    for k in range(ORDER, 0, -1):
        per = {}
        for g in langs:
            keys, n = level[g]
            off = discount(int((n == 1).sum()), int((n == 2).sum()))
            _, at = np.unique(keys >> np.uint64(16), return_inverse=True)
            per[g] = (keys, np.maximum(n - off, 0) / np.bincount(at, n)[at])
        levels.append(per)
        mask = np.uint64(2 ** (16 * (k - 1)) - 1)
        level = {g: _tally(np.sort(level[g][0] & mask)) for g in langs}
    units = np.unique(np.concatenate([levels[-1][g][0] for g in langs]))
    return assemble(langs, levels[::-1], len(units))


def train(rows: DataFrame, max_grams: int | None = None) -> Model | None:
    """Model from all rows (lang, text); None if they hold no letters.  Counts,
    discounts, continuation counts and context totals are those of all grams, and
    all are stored; with ``max_grams`` the rarest are left out at the end."""
    learn = rows.where("lang is not null and text is not null").select("lang", "text")
    level = written(map_arrow(learn, _count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "char-grams")
    langs, levels, units = [], [], 0
    for k in range(ORDER, 0, -1):
        step = F.floor(F.log2("n")).cast("int").alias("step")
        ones, twos = (F.sum((F.col("n") == c).cast("bigint")) for c in (1, 2))
        per: dict[str, dict[int, tuple]] = {}
        for r in level.groupBy("lang", step).agg(F.count(F.lit(1)).alias("kinds"), ones.alias("ones"), twos.alias("twos")).collect():  # languages times at most 63 steps
            per.setdefault(r.lang, {})[r.step] = (r.kinds, r.ones, r.twos)
        if not per:
            return None
        if len(per) > MAX_LANGUAGES:
            raise ValueError(f"{len(per)} languages; the model is bounded at {MAX_LANGUAGES}")
        langs, least, off = sorted(per), {}, {}
        for lang, steps in per.items():
            total = 0
            for s in sorted(steps, reverse=True):
                if (total := total + steps[s][0]) > (math.inf if max_grams is None else max_grams):
                    break
                least[lang] = 2**s
            # not even the largest step fits: none; single units always fit
            least.setdefault(lang, 2 ** (max(steps) + 1))
            least[lang] = 1 if k == 1 else least[lang]
            off[lang] = discount(sum(x[1] for x in steps.values()), sum(x[2] for x in steps.values()))
        of = lambda values: F.create_map(*(F.lit(x) for kv in values.items() for x in kv))[F.col("lang")]
        ctx = F.shiftrightunsigned("gram", 16)
        totals = level.groupBy("lang", ctx.alias("ctx")).agg(F.sum("n").alias("total"))
        kept = level.where(F.col("n") >= of(least)).withColumn("ctx", ctx).join(totals, ["lang", "ctx"])
        table = kept.select("lang", "gram", (F.greatest(F.col("n") - of(off), F.lit(0.0)) / F.col("total")).alias("p")).toArrow()  # distinct grams, of one order at a time
        lang = np.array(table.column("lang").to_pylist(), object)
        gram, p = table.column("gram").to_numpy().view(np.uint64), table.column("p").to_numpy()
        levels.append({g: (gram[lang == g], p[lang == g]) for g in langs})
        if k > 1:
            shorter = F.col("gram").bitwiseAND(F.lit(2 ** (16 * (k - 1)) - 1))
            level = written(level.groupBy("lang", shorter.alias("gram")).agg(F.count(F.lit(1)).alias("n")), "char-grams")
        else:
            units = level.select("gram").distinct().count()
    return assemble(langs, levels[::-1], units)


def _ranked(model: Model, text: str | None):
    g = grams(text)
    if not len(g):
        return None
    ce = model.cross_entropy(g)
    best = int(np.argmin(ce))
    margin = float(np.partition(ce, 1)[1] - ce[best]) if len(ce) > 1 else float(TOP)
    return best, float(ce[best]), margin


def _step(x: float) -> int:
    return int(min(TOP - 1, x * STEPS))


def calibrate(model: Model, rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(chance of being right per step of the margin, ceiling of the
    cross-entropy per language), from labelled rows: counts per step."""
    shared = rows.sparkSession.sparkContext.broadcast(model.arrays())
    schema = pa.schema([("kind", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])

    def run(batches):
        model = Model.from_arrays(*shared.value)
        for b in batches:
            seen: dict[tuple, int] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if found := _ranked(model, text.as_py()):
                    right = model.langs[found[0]] == lang
                    for key in ((0, _step(found[2]), int(right)), *([(1, found[0], _step(found[1]))] if right else [])):
                        seen[key] = seen.get(key, 0) + 1
            if seen:
                yield batch(schema, *zip(*((*k, n) for k, n in seen.items()), strict=True))

    learn = rows.where("lang is not null and text is not null").select("lang", "text")
    sums = map_arrow(learn, run, "kind int, a int, b int, n bigint").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    right, tried, ceiling = np.zeros(TOP), np.zeros(TOP), np.zeros((len(model.langs), TOP))
    for kind, a, b, n in sums.collect():  # at most TOP * (2 + languages) rows
        if kind == 0:
            tried[a] += n
            right[a] += n * b
        else:
            ceiling[a, b] += n
    share = (right + 1) / (tried + 2)
    share = np.maximum.accumulate(np.where(tried > 0, share, 0))
    share[share == 0] = 1 / len(model.langs)
    top = [(np.flatnonzero(c).max() + 2) / STEPS if c.any() else np.inf for c in ceiling]
    return share, np.array(top)


def identify(docs: DataFrame, model: Model | None, share: np.ndarray, ceiling: np.ndarray, min_score: float = 0.0) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast((model and model.arrays(), share, ceiling))
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches):
        parts, share, ceiling = shared.value
        model = Model.from_arrays(*parts) if parts else None
        for b in batches:
            out = []
            for text in b.column("text"):
                found = _ranked(model, text.as_py()) if model else None
                if found is None:
                    out.append(("und", 0.0, True))
                else:
                    score = float(share[_step(found[2])])
                    out.append((model.langs[found[0]], score, bool(found[1] > ceiling[found[0]] or score < min_score)))
            yield batch(schema, b.column("doc_id"), *zip(*out, strict=True)) if out else batch(schema, [], [], [], [])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_arrow(rows, run, "doc_id bigint, lang_pred string, score double, rejected boolean")


def fold():
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def fit(docs: DataFrame, max_grams: int | None = None):
    """(model, share, ceiling) from the training rows of ``docs`` (doc_id, text, lang)."""
    rows = docs.where(fold() % 4 != 2)
    model = train(rows.where(fold() % 16 != 1), max_grams)
    if model is None:
        return None, np.zeros(TOP), np.zeros(0)
    return model, *calibrate(model, rows.where(fold() % 16 == 1))


def predict(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row, learned
    from the rows that are not held out."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    out = identify(docs, *fit(docs))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
