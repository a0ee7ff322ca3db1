"""Substring dedup: repeated windows of words, merged into maximal removal intervals.

Method.  Every window of ``width`` consecutive words has a Rabin-Karp hash.
Counting all of them would shuffle the whole corpus as 64-bit numbers, so the
count runs in two steps that lose no window:

1. Each window names the smallest hash among its ``width - gram + 1``
   ``gram``-word pieces.  Equal windows name equal pieces, so a window whose
   named piece is named once in the whole corpus occurs once and needs no
   count.  The (far fewer) named pieces are counted in Spark.
2. The windows that name a repeated piece are counted by their own hash; the
   smallest doc_id that holds a hash owns it.  A document keeps, of each hash
   it owns, the first window, and removes every other repeated window;
   overlapping windows merge into maximal intervals.

No group is gathered: both counts are partial aggregates, a document receives
only hashes of its own windows, and the join with repeated pieces lets AQE
split a hot piece.  Equality is that of 64-bit hashes.

Rows: NULL and empty texts have no words; NULL doc_ids are one id that sorts
first; rows that share a doc_id do not remove from each other; other columns
are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import NULL_ID, as_i64, batch, covered, id_key, list_slices, map_arrow, rolled, sliding_min, word_hashes, written

WIDTH, GRAM = 20, 6


def _named(h: np.ndarray, width: int, gram: int) -> np.ndarray:
    return sliding_min(rolled(h, gram), width - gram + 1)


def _pieces(width: int, gram: int):
    """(piece, n, row): the pieces that a document's windows name; n is 2 where
    a window that names the piece repeats within the document."""
    schema = pa.schema([("piece", pa.int64()), ("n", pa.int32()), ("row", pa.int64())])

    def run(batches):
        for b in batches:
            out, times, ids = [], [], []
            for row, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                h = word_hashes(text.as_py())
                if len(h) < width:
                    continue
                name, w = _named(h, width, gram), rolled(h, width)
                pieces = np.unique(name)
                n = np.ones(len(pieces), np.int32)
                order = np.argsort(w, kind="stable")
                again = order[1:][w[order[1:]] == w[order[:-1]]]
                if len(again):
                    n[np.searchsorted(pieces, name[again])] = 2
                out.append(pieces)
                times.append(n)
                ids.append(np.full(len(pieces), row, np.int64))
            if out:
                yield batch(schema, as_i64(np.concatenate(out)), np.concatenate(times), np.concatenate(ids))

    return run


def _windows(width: int, gram: int):
    """(hash, d, row): distinct windows of a document that name a repeated piece."""
    schema = pa.schema([("hash", pa.int64()), ("d", pa.int64()), ("row", pa.int64())])

    def run(batches):
        for b in batches:
            values, lo, hi = list_slices(b.column("pieces"))
            ids = b.column("doc_id").fill_null(NULL_ID).to_pylist()
            for i, (d, row, text) in enumerate(zip(ids, b.column("row").to_pylist(), b.column("words"), strict=True)):
                h = word_hashes(text.as_py())
                if len(h) < width or lo[i] == hi[i]:
                    continue
                hit = np.isin(as_i64(_named(h, width, gram)), values[lo[i]:hi[i]])
                w = np.unique(rolled(h, width)[hit])
                yield batch(schema, as_i64(w), np.full(len(w), d, np.int64), np.full(len(w), row, np.int64))

    return run


def _keep(width: int, gram: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])

    def run(batches):
        for b in batches:
            pieces, plo, phi = list_slices(b.column("pieces"))
            owned, olo, ohi = list_slices(b.column("owned"))
            n_words, n_removed, kept = [], [], []
            for i, text in enumerate(b.column("words")):
                text = text.as_py() or b""
                words = text.split()
                gone = 0
                if len(words) >= width and plo[i] < phi[i]:
                    h = word_hashes(text)
                    w = as_i64(rolled(h, width))
                    hit = np.flatnonzero(np.isin(as_i64(_named(h, width, gram)), pieces[plo[i]:phi[i]]))
                    value, at = np.unique(w[hit], return_index=True)
                    first = hit[at[np.isin(value, owned[olo[i]:ohi[i]])]]
                    mask = covered(np.setdiff1d(hit, first, assume_unique=True), width, len(words))
                    gone = int(mask.sum())
                    if gone:
                        words = [x for x, m in zip(words, mask.tolist(), strict=True) if not m]
                n_words.append(len(words) + gone)
                n_removed.append(gone)
                kept.append(b" ".join(words))
            yield batch(schema, b.column("doc_id"), n_words, n_removed, kept)

    return run


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` is the UTF-8 text of the
    words that no repeated window covers, joined by one space."""
    if not 1 <= gram <= width:
        raise ValueError("gram must lie between 1 and width")
    text = F.col("text").cast("binary")
    # Where every row has an id of its own, the id is the key of a document: it
    # compresses well, and the smallest one is a plain aggregate.
    unique = docs.groupBy(id_key().alias("d")).count().where("count > 1").isEmpty()
    row = id_key() if unique else F.xxhash64("doc_id", text)
    # the same columns for both joins below: one exchange of the texts serves both
    src = docs.select(row.alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("words"))
    pieces = map_arrow(src.select("row", "words"), _pieces(width, gram), "piece bigint, n int, row bigint")
    repeated = written(pieces.groupBy("piece").agg(F.sum("n").alias("n")).where("n > 1").select("piece"), "repeated-pieces")
    gather = F.collect_list if unique else F.collect_set  # equal rows name equal pieces
    by_doc = pieces.join(repeated, "piece").groupBy("row").agg(gather("piece").alias("pieces"))
    hits = src.join(by_doc, "row", "left")
    windows = map_arrow(hits.where("pieces is not null"), _windows(width, gram), "hash bigint, d bigint, row bigint")
    first = F.min("d") if unique else F.min(F.struct("d", "row"))["row"]
    owners = windows.groupBy("hash").agg(first.alias("row"))
    owned = owners.groupBy("row").agg(F.collect_list("hash").alias("owned"))
    empty = F.array().cast("array<bigint>")
    judged = hits.join(owned, "row", "left").select("doc_id", "words", F.coalesce("pieces", empty).alias("pieces"), F.coalesce("owned", empty).alias("owned"))
    return map_arrow(judged, _keep(width, gram), "doc_id bigint, n_words bigint, n_removed bigint, kept binary")


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int | None, str | None]], width: int = WIDTH) -> dict[int, tuple[int, int, str]]:
    """The definition, in memory, for tests: rows in the order of documents
    that share an id, if any."""
    import re

    seen: set[tuple] = set()
    out = {}
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone: set[int] = set()
        for i in range(len(words) - width + 1):
            w = tuple(words[i:i + width])
            if w in seen:
                gone.update(range(i, i + width))
            seen.add(w)
        kept = " ".join(x for i, x in enumerate(words) if i not in gone)
        out[d] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out
