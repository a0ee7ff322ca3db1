"""Quality classifier: labelled neighbours in a latent-semantic space vote.

Terms.  A text is a bag of hashed terms: its words (lower case, punctuation at
the ends left off), and the *forms* of its words (runs of capitals, small
letters and digits as one sign each, other characters as they are), so that
invented or rare words still say how they are written.  Three more terms count
lines, lines that repeat, and words equal to the word before.  A term weighs
log(1 + count) * log((1 + N) / (1 + documents with it)); words count
``WORD_WEIGHT`` times as much as forms; a document's vector has length 1.

Space.  The leading ``AXES`` right singular vectors of the labelled documents'
matrix (from the eigenvectors of its term-by-term products) are the
latent-semantic axes; documents are projected on them and scaled to length 1.

Vote.  The labelled vectors and the axes are broadcast.  Every document's
cosines with *all* labelled vectors are computed in blocks (one matrix product
per batch and block); the ``NEIGHBOURS`` largest positive ones weight their
labels.  The score is the weighted share of label 1.

Bounds.  The classifier is fitted on about ``max_rows`` labelled rows in the
order of a hash, in one task (a matrix of max_rows by ``TERMS``), and the model
has max_rows + TERMS vectors of AXES numbers.  Scoring covers every row.

Rows: NULL and empty texts, and others without terms or without any similar
labelled row, score the labelled rows' share of label 1; without labels every
score is 0.5; labels that are NULL, not 0 or 1, or belong to NULL ids are not
learned from; the smallest label of a doc_id counts, and of rows that share a
doc_id one text (the one of smallest hash); equal similarities go to the row
that comes first in the sample; repeated rows score alike; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import batch, list_slices, map_arrow, written

#: Buckets of word terms and of all terms; axes; weight of words.
WORDS, TERMS, AXES, WORD_WEIGHT = 1536, 2048, 64, 0.25
#: Labelled rows to learn from (below 2**PLACE_BITS), neighbours, threshold.
MAX_ROWS, NEIGHBOURS, THRESHOLD = 12_000, 25, 0.7
#: Labelled vectors of a block; bits of a place in the sample within a key.
BLOCK, PLACE_BITS = 4096, 14
#: Words whose terms a task remembers before it starts afresh.
MEMORY = 300_000

_ENDS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def form(word: str) -> str:
    """``Abc!!`` -> ``Aa!!``: kinds of characters, runs of one kind once."""
    out = []
    for c in word[:24]:
        kind = ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
        if not (out and kind.isalnum() and out[-1] == kind):
            out.append(kind)
    return "".join(out[:8])


def _form_bucket(name: str) -> int:
    return WORDS + xxhash.xxh3_64_intdigest(name.encode()) % (TERMS - WORDS)


class Terms:
    """Terms of texts; remembers words."""

    def __init__(self):
        self.known: dict[str, tuple[int, int]] = {}
        # names with a space are no forms
        self.lines, self.repeated_lines, self.repeated_words = (_form_bucket(n) for n in ("line ", "line again", "word again"))

    def buckets(self, word: str) -> tuple[int, int]:
        out = self.known.get(word)
        if out is None:
            if len(self.known) >= MEMORY:
                self.known.clear()
            bare = word.lower().strip(_ENDS)
            out = self.known[word] = xxhash.xxh3_64_intdigest(bare.encode()) % WORDS, _form_bucket(form(word))
        return out

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(terms, log(1 + count)); empty without words."""
        words = (text or "").split()
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        at: Counter = Counter()
        for word, n in Counter(words).items():
            a, b = self.buckets(word)
            at[a] += n
            at[b] += n
        lines = [x for x in text.split("\n") if x.strip()]
        at[self.lines] += len(lines)
        at[self.repeated_lines] += len(lines) - len(set(lines))
        at[self.repeated_words] += sum(map(str.__eq__, words, words[1:]))
        at = {k: n for k, n in at.items() if n}
        return np.fromiter(at, np.int32, len(at)), np.log1p(np.fromiter(at.values(), np.float32, len(at)))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; zero rows stay."""
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(norm > 1e-12, norm, 1)).astype(np.float32)


def matrix(rows: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray) -> np.ndarray:
    """Weighted term vectors of length 1, a row each."""
    x = np.zeros((len(rows), TERMS), np.float32)
    for i, (at, n) in enumerate(rows):
        x[i, at] = n * weight[at]
    return unit(x)


def term_weights(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    df = np.bincount(np.concatenate([at for at, _ in rows]) if rows else [], minlength=TERMS)
    weight = np.log((1 + len(rows)) / (1 + df))
    weight[:WORDS] *= WORD_WEIGHT
    return weight.astype(np.float32)


def axes(x: np.ndarray, k: int = AXES) -> np.ndarray:
    """Leading right singular vectors of x, as columns, with a fixed sign."""
    values, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    top = vectors[:, ::-1][:, :k][:, values[::-1][:k] > 1e-6 * max(values[-1], 1e-30)]
    return (top * np.sign(top[np.abs(top).argmax(0), np.arange(top.shape[1])])).astype(np.float32)


def vote(q: np.ndarray, labelled: np.ndarray, label: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Weighted share of label 1 among the k most similar labelled vectors."""
    base = float(label.mean())
    best = np.empty((len(q), 0), np.int32)
    for lo in range(0, len(labelled), BLOCK):
        cosine = q @ labelled[lo:lo + BLOCK].T
        place = 2**PLACE_BITS - 1 - np.arange(lo, lo + cosine.shape[1], dtype=np.int32)
        # similarity in steps of 2**-16, then the place in the sample
        key = (np.clip(cosine, 0, 1) * 2**16).astype(np.int32) << PLACE_BITS | place
        best = np.concatenate((best, np.partition(key, max(0, key.shape[1] - k), 1)[:, -k:]), 1)
    best = np.sort(best, 1)[:, -k:]
    at = 2**PLACE_BITS - 1 - (best & (2**PLACE_BITS - 1))
    similar = (best >> PLACE_BITS) / 2**16
    total = similar.sum(1)
    return np.where(total > 0, (similar * label[at]).sum(1) / np.where(total > 0, total, 1), base)


def _sample_terms(batches):
    schema = pa.schema([("order", pa.int64()), ("label", pa.int32()), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.float32()))])
    terms = Terms()
    for b in batches:
        found = [terms.of(t.as_py()) for t in b.column("text")]
        yield batch(schema, b.column("order"), b.column("label"), [x for x, _ in found], [n for _, n in found])


def _fit(table: pa.Table) -> pa.Table:
    """Labelled vectors (label, vector) and, without a label, per term its
    weight and its place on the axes."""
    table = table.sort_by([("order", "ascending")]).slice(0, 2**PLACE_BITS).combine_chunks()
    at, lo, hi = list_slices(table.column("at").chunk(0))
    n, *_ = list_slices(table.column("n").chunk(0))
    rows = [(at[i:j], n[i:j]) for i, j in zip(lo, hi, strict=True)]
    weight = term_weights(rows)
    x = matrix(rows, weight)
    v = axes(x)
    vectors = np.concatenate((unit(x @ v), v * weight[:, None]))
    label = table.column("label").to_pylist() + [None] * TERMS
    place = list(range(table.num_rows)) + list(range(TERMS))
    return pa.table({"label": pa.array(label, pa.int32()), "place": pa.array(place, pa.int32()), "vector": pa.array(list(vectors), pa.list_(pa.float32()))})


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(labelled vectors, their labels, weighted axes) from ``labels`` (doc_id,
    quality); None without labelled documents."""
    if max_rows > 2**PLACE_BITS:
        raise ValueError(f"max_rows is bounded by {2**PLACE_BITS}")
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    known = known.withColumn("order", F.xxhash64("doc_id"))
    share = min(1.0, max_rows / max(1, known.count()))
    chosen = known.where(F.pmod("order", F.lit(2**30)) < int(share * 2**30))
    # about max_rows short rows, a bound
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = written(rows.groupBy("doc_id", "label", "order").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "quality-sample")
    terms = map_arrow(rows.select("order", "label", "text"), _sample_terms, "order bigint, label int, at array<int>, n array<float>")
    fitted = terms.groupBy().applyInArrow(_fit, "label int, place int, vector array<float>").orderBy("place").toArrow()
    if not fitted.num_rows:
        return None
    v = np.array(fitted.column("vector").combine_chunks().flatten()).reshape(fitted.num_rows, -1)
    label = fitted.column("label").to_numpy()
    is_term = np.isnan(label)
    return v[~is_term], label[~is_term], v[is_term]


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> DataFrame:
    """(doc_id, score) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        terms, model = Terms(), shared.value
        for b in batches:
            if model is None:
                yield batch(schema, b.column("doc_id"), [0.5] * b.num_rows)
                continue
            labelled, label, axis = model
            q = np.zeros((b.num_rows, axis.shape[1]), np.float32)
            for i, t in enumerate(b.column("text")):
                at, n = terms.of(t.as_py())
                q[i] = n @ axis[at]
            yield batch(schema, b.column("doc_id"), vote(unit(q), labelled, label))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id bigint, score double")


def held_out():
    """Rows that nothing is learned from: crc32(doc_id) mod 4 is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    model = train(docs, labels.where(~held_out()).select("doc_id", "quality"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def brute_force(labelled: list[tuple[str | None, int]], texts: list[str | None], k: int = NEIGHBOURS) -> list[float]:
    """The definition by a full singular value decomposition and plain sorted
    cosines, in memory, for tests; ``labelled`` in the order of the sample."""
    terms = Terms()
    rows = [terms.of(t) for t, _ in labelled]
    weight = term_weights(rows)
    x = matrix(rows, weight).astype(np.float64)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    v = vt[:AXES][s[:AXES] ** 2 > 1e-6 * s[0] ** 2].T
    p = x @ v
    p = [r / (np.linalg.norm(r) or 1) for r in p]
    label = [y for _, y in labelled]
    out = []
    for t in texts:
        q = matrix([terms.of(t)], weight)[0] @ v
        q = q / (np.linalg.norm(q) or 1)
        near = sorted(((min(1.0, float(q @ r)), -i) for i, r in enumerate(p)), reverse=True)[:k]
        near = [(c, -i) for c, i in near if c > 0]
        total = sum(c for c, _ in near)
        out.append(sum(c * label[i] for c, i in near) / total if total > 0 else float(np.mean(label)))
    return out
