"""Fill-in-middle transformation: texts cut in three and put in another order.

A text is a run of units: white space with the word after it, or white space
alone at the end.  Two cuts, drawn from a hash of doc_id, part it into prefix,
middle and suffix, which are written in the order of the form: ``psm``
(prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain`` (the
text as it is).

The cuts are found without a list of units.  The UTF-8 bytes of many texts are
viewed as 64-bit words of eight bytes.  Additions that cannot carry from byte
to byte mark the white bytes of a word, and a shift marks the bytes that end a
unit: a byte that is not white before a white one, and a last white byte.
``bitwise_count`` per word and a running sum number the units; the word that
holds the k-th end comes from a binary search of the running sum, and the byte
inside the word from the eight running counts that one multiplication gives.
Characters are counted alike, by marking the bytes that continue one.

Texts are taken in slices of ``SLICE`` bytes (or one text, if longer), so
memory is bounded by that and by the longest text.  ``restore`` rebuilds the
texts from output and form with SQL functions.

Rows: a NULL or empty text is ``plain`` with 0 units and an empty output; a
text that holds one of the marks is ``plain``; a NULL doc_id is hashed as no
digits; every row stands for itself, so repeated rows give equal results; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import batch, map_arrow

#: Fixed values of the contract: marks, seed of the hash, shares of 100.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM_RATE = 42, 50, 80

#: Bytes of text that a task works on at once.
SLICE = 8 << 20


def _each(byte: int) -> np.uint64:
    """The byte in all eight places of a word."""
    return np.uint64(byte * 0x0101010101010101)


ONE, HIGH, LOW7 = _each(0x01), _each(0x80), _each(0x7F)
#: What lifts a byte of at least 0x09, or of at least 0x0E, to its high bit.
FROM_TAB, FROM_SO, BLANK = _each(0x80 - 0x09), _each(0x80 - 0x0E), _each(0x20)


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(words, first): all texts as 64-bit words, each from a word of its own
    and followed by at least one blank; ``first`` has the word where each
    begins, and the end."""
    first = np.concatenate(([0], np.cumsum([len(t) // 8 + 1 for t in texts], dtype=np.int64)))
    raw = b"".join([t.ljust((len(t) // 8 + 1) * 8) for t in texts])
    return np.frombuffer(raw, "<u8"), first


def white_bytes(x: np.ndarray) -> np.ndarray:
    """High bit of every byte that is 0x20 or 0x09 to 0x0D."""
    low = x & LOW7
    blank = ~((low ^ BLANK) + LOW7)
    control = (low + FROM_TAB) & ~(low + FROM_SO)
    return (blank | control) & ~x & HIGH


def unit_ends(texts: list[bytes], x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """High bit of the last byte of every unit."""
    white = white_bytes(x)
    follows = (white >> np.uint64(8)) | np.append(white[1:] << np.uint64(56), np.uint64(0))
    ends = ~white & follows & HIGH
    for i, t in enumerate(texts):
        if t and t[-1] in b" \t\n\x0b\x0c\r":
            word, byte = divmod(len(t) - 1, 8)
            ends[first[i] + word] |= np.uint64(0x80 << 8 * byte)
    return ends


def select(ends: np.ndarray, upto: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, byte) of the k-th mark (from 1) of all words; ``upto`` is the
    running sum of the words' counts."""
    word = np.searchsorted(upto, k)
    rest = (k - (upto[word] - np.bitwise_count(ends[word]))).astype(np.uint64)
    running = (ends[word] >> np.uint64(7)) * ONE  # byte j: marks in bytes 0 to j
    below = (((rest - np.uint64(1)) * ONE) | HIGH) - running
    return word, np.bitwise_count(below & HIGH).astype(np.int64)


def _starts_before(leads: np.ndarray, upto: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Characters that begin before byte ``at`` of all words."""
    word, byte = at // 8, (at % 8).astype(np.uint64)
    inside = leads[word] & ((np.uint64(1) << (byte * np.uint64(8))) - np.uint64(1))
    return upto[word] - np.bitwise_count(leads[word]) + np.bitwise_count(inside)


def draws(doc_id: int | None) -> list[int]:
    """The first four 8-digit groups of the digest, as unsigned integers."""
    digest = hashlib.sha256(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12)]


def transform_slice(ids: list[int | None], texts: list[bytes]) -> tuple[list, ...]:
    """(n, form, prefix_chars, middle_chars, output) of every text."""
    x, first = words_of(texts)
    ends = unit_ends(texts, x, first)
    upto = np.cumsum(np.bitwise_count(ends), dtype=np.int64)
    before = np.concatenate(([0], upto))[first]
    units = np.diff(before)
    h = np.array([draws(d) for d in ids], np.int64).reshape(-1, 4)
    cuts = np.sort(h[:, :2] % (units + 1)[:, None], 1)
    at = np.tile(first[:-1, None] * 8, (1, 2))  # byte after which a part ends, of all words
    inner = cuts > 0
    word, byte = select(ends, upto, (before[:-1, None] + cuts)[inner])
    at[inner] = word * 8 + byte + 1

    leads = ~(x & ~(x << np.uint64(1))) & HIGH  # all bytes but 10xxxxxx
    chars = np.cumsum(np.bitwise_count(leads), dtype=np.int64)
    start = _starts_before(leads, chars, first[:-1] * 8)
    left, right = (_starts_before(leads, chars, at[:, k]) for k in (0, 1))

    form, output, prefix_chars, middle_chars = [], [], [], []
    p, s, m = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))
    for i, t in enumerate(texts):
        if not t or h[i, 2] % 100 >= RATE or p in t or s in t or m in t:
            form.append("plain")
            output.append(t)
            prefix_chars.append(None)
            middle_chars.append(None)
            continue
        a, b = (at[i] - first[i] * 8).tolist()
        prefix, middle, suffix = t[:a], t[a:b], t[b:]
        spm = h[i, 3] % 100 < SPM_RATE
        form.append("spm" if spm else "psm")
        output.append(b"".join((s, suffix, p, prefix, m, middle) if spm else (p, prefix, s, suffix, m, middle)))
        prefix_chars.append(int(left[i] - start[i]))
        middle_chars.append(int(right[i] - left[i]))
    return units.tolist(), form, prefix_chars, middle_chars, output


def _slices(ids: list, texts: list[bytes]):
    """Runs of rows of at most SLICE bytes, or one row."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SLICE:
            yield ids[lo:i], texts[lo:i]
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield ids[lo:], texts[lo:]


def transform(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def run(batches):
        for b in batches:
            for ids, texts in _slices(b.column("doc_id").to_pylist(), [t.as_py() or b"" for t in b.column("text")]):
                n, form, prefix, middle, output = transform_slice(ids, texts)
                yield batch(schema, ids, n, form, prefix, middle, pa.array(output, pa.binary()).cast(pa.string()))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return map_arrow(rows, run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of; parts of a marked output hold no marks."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    out = output
    for name, places in order.items():
        out = F.when(form == name, F.concat(*(F.get(parts, k) for k in places))).otherwise(out)
    return out


def digest(result: DataFrame) -> DataFrame:
    """``transform``'s rows with digests of the output and of the rebuilt text."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return result.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                         sha(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


#: DuckDB statement of ``digest(transform(documents))``.
ORACLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
drawn AS (
  SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS c2,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
parts AS (
  SELECT *, array_to_string(u[1:least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(u[greatest(c1, c2) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts
"""


def brute_force(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """The definition, in memory, for tests: digest's rows in the order given."""
    import re

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for d, text in rows:
        text = text or ""
        u = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        h1, h2, h3, h4 = draws(d)
        a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
        p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
        if not text or any(k in text for k in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= RATE:
            out.append((d, len(u), "plain", None, None, sha(text), sha(text)))
        elif h4 % 100 < SPM_RATE:
            out.append((d, len(u), "spm", len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}"), sha(text)))
        else:
            out.append((d, len(u), "psm", len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}"), sha(text)))
    return out
