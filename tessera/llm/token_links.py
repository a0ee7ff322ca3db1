"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Every text is encoded by two tokenizers, A (byte-level BPE) and B (pieces with
byte fallback).  Byte offsets where a token of A and one of B both end cut both
sequences into groups; every A token of a group is linked to every B token of
it.  How many documents hold an id pair linked is counted over all documents,
and a document's links are weighed by these counts.

Lockstep.  The texts of a block are walked at once: one NumPy state vector
holds, per document, the next A token and the next B token.  A step compares
the two ends of all documents, moves whichever side is behind (both where the
ends are equal), and emits the cuts of the step, from which the links of the
groups that they close follow; documents that have come to their end leave the
state vector.

Blocks.  A task takes its texts in blocks of about ``BLOCK_BYTES``.  A block
has a dictionary of its own distinct id pairs with the number of its documents
that hold each, and a document's links are places in that dictionary with
multiplicities.  Blocks are written once.  Only the dictionaries are counted
over the corpus (one row per block and pair, whatever the number of links),
joined with the counts, and handed back, one dictionary to one block: nothing
is broadcast but the two vocabulary files, and no text is encoded twice.  A
group of very many tokens is linked by its distinct ids, with multiplicities.

Rows: a text that is NULL or empty, or whose A or B tokens do not spell a space
and the text (B's file normalises some texts, and spells U+2581 as a space),
has no tokens, zeros and an empty digest; every row is a document, also if rows
share a doc_id or have none; repeated rows count each; other columns are
ignored; an empty table gives no rows.  A text must fit a task, as must the
distinct pairs of one block.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._common import list_slices, map_arrow, written
from tessera.llm.bpe import byte_alphabet, read_spec

#: Bytes of text of a block, and of a call of a tokenizer.
BLOCK_BYTES, CALL_BYTES = 3 << 20, 256 << 10
#: Characters of chunks that are encoded as one text.
JOINED = 16 << 10
#: Chunks that a task remembers (the first ones: frequent ones come early), and their length.
MEMORY, LONG = 150_000, 100
#: Token pairs up to which a group's links are written out one by one.
WIDE = 64
#: Cuts that are turned into links at once.
RUN = 1 << 16
#: Bits of an id of B in an id pair, and of the pair in a link; ids of A have
#: 17 bits, numbers of a block's documents the rest of 63.
PAIR_BITS, DOC_SHIFT = 20, 37

#: White space that a cut at every single space would not leave whole.
ODD_SPACE = re.compile(r"^\s|\s\s|\s$")


@dataclass
class Sides:
    """The two tokenizers, and the bytes of every id."""

    encode_a: object
    encode_b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]

    @classmethod
    def load(cls, spec_a: str, model_b: bytes) -> Sides:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        a = Tokenizer.from_str(spec_a)
        a.encode_special_tokens = True  # their strings in a text are ordinary text
        a.no_truncation()
        a.no_padding()
        byte = {c: i for i, c in enumerate(byte_alphabet())}
        vocab = json.loads(spec_a)["model"]["vocab"]
        bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in byte for c in token):
                bytes_a[i] = bytes(byte[c] for c in token)
        b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        bytes_b = []
        for i in range(b.get_piece_size()):
            piece = b.id_to_piece(i)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())

        def encode_a(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in a.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]

        def encode_b(texts: list[str]) -> list[list[int]]:
            return b.encode(texts, num_threads=1)

        return cls(encode_a, encode_b, bytes_a, bytes_b)


def read_model(spark, path: str) -> bytes:
    """A binary vocabulary file, through Spark's reader; path is a parameter."""
    where = path if ":/" in path else f"file://{path}"
    return bytes(spark.read.format("binaryFile").load(where).select("content").first()[0])


@dataclass
class Tokens:
    """The tokens of one side of a block: ids, the byte each ends at in its
    document, and where each document's tokens begin (and the last ones end)."""

    ids: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray], width: np.ndarray) -> Tokens:
        first = np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int64)))
        ids = np.concatenate(rows) if rows else np.empty(0, np.int32)
        upto = np.cumsum(width[ids], dtype=np.int64)
        base = np.concatenate(([0], upto))[first[:-1]]
        return cls(ids, upto - np.repeat(base, np.diff(first)), first)


def chunks(text: str) -> list[str]:
    """``text`` cut before every single space that stands between two
    characters that are not white; these spaces are left out."""
    if not ODD_SPACE.search(text):
        return text.split(" ")
    out: list[str] = []
    for part in text.split(" "):
        if out and (not part or not out[-1] or part[0].isspace() or out[-1][-1].isspace()):
            out[-1] += " " + part
        else:
            out.append(part)
    return out


class Encoder:
    """Ids of texts by both tokenizers.  A's pattern ends a piece before a single
    space, and B merges nothing across one if none of its pieces holds a space
    behind another character; so the ids of a text are those of its chunks, and
    chunks are remembered.  Otherwise texts are encoded whole."""

    def __init__(self, sides: Sides, width_a: np.ndarray, width_b: np.ndarray):
        self.sides, self.widths = sides, (width_a, width_b)
        self.cut = not any(b" " in piece.lstrip(b" ") for piece in sides.bytes_b)
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def whole(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Both sides' ids; None where a side does not spell a space and the text."""
        out, sides = [], self.sides
        for lo, hi in runs(list(map(len, texts)), CALL_BYTES):
            part = texts[lo:hi]
            for t, x, y in zip(part, sides.encode_a(part), sides.encode_b(part), strict=True):
                want = b" " + t.encode()
                same = b"".join([sides.bytes_a[k] for k in x]) == want == b"".join([sides.bytes_b[k] for k in y])
                out.append((np.array(x, np.int32), np.array(y, np.int32)) if same else None)
        return out

    def learn(self, new: list[str]) -> None:
        """Ids of chunks, as bytes.  Those without white space at their ends are
        encoded many at once, as the text that they make with spaces between."""
        plain, odd = [], []
        for c in new:
            (plain if c and " " not in c and c == c.strip() else odd).append(c)
        rows = [plain[lo:hi] for lo, hi in runs(list(map(len, plain)), JOINED)]
        for row, found in zip(rows, self.whole([" ".join(row) for row in rows]), strict=True):
            if found is None:
                odd += row
                continue
            ends = np.cumsum(list(map(len, " ".join(row).encode().split(b" ")))) + np.arange(1, len(row) + 1)
            cut = [np.searchsorted(np.cumsum(w[ids]), ends, "right").tolist() for w, ids in zip(self.widths, found, strict=True)]
            x, y = (ids.tobytes() for ids in found)
            i = j = 0
            for c, i1, j1 in zip(row, *cut, strict=True):
                self.known[c] = x[4 * i:4 * i1], y[4 * j:4 * j1]
                i, j = i1, j1
        for c, found in zip(odd, self.whole(odd), strict=True):
            self.known[c] = found and tuple(ids.tobytes() for ids in found)

    def of(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of every text; none for texts that either side does not spell."""
        none = np.empty(0, np.int32)
        a, b = [none] * len(texts), [none] * len(texts)
        rows = {i: chunks(t) if self.cut else [t] for i, t in enumerate(texts) if t}
        new = list({c for row in rows.values() for c in row}.difference(self.known))
        self.learn(new)
        known, left = self.known, []
        for i, row in rows.items():
            found = [known[c] for c in row]
            if None in found:  # a chunk is not spelled: the text as a whole decides
                left.append(i)
                continue
            x, y = zip(*found, strict=True)
            a[i], b[i] = np.frombuffer(b"".join(x), np.int32), np.frombuffer(b"".join(y), np.int32)
        for i, found in zip(left, self.whole([texts[i] for i in left]), strict=True):
            if found:
                a[i], b[i] = found
        room = MEMORY - (len(known) - len(new))
        for k, c in enumerate(new):
            if k >= room or len(c) > LONG:
                del known[c]
        return a, b


def runs(sizes: list[int], most: int):
    """(start, end) of successive runs of about ``most``."""
    lo = size = 0
    for i, n in enumerate(sizes, 1):
        size += n
        if size >= most or i == len(sizes):
            yield lo, i
            lo, size = i, 0


def walk(a: Tokens, b: Tokens):
    """Cuts of every step: (doc, first A, A after the last, first B, B after the
    last) of the groups that the step closes."""
    doc = np.flatnonzero(np.diff(a.first) > 0)
    i, j = a.first[doc], b.first[doc]
    i0, j0, stop = i.copy(), j.copy(), a.first[doc + 1]
    while len(doc):
        x, y = a.end[i], b.end[j]
        i = i + (x <= y)
        j = j + (y <= x)
        cut = x == y
        if cut.any():
            yield doc[cut], i0[cut], i[cut], j0[cut], j[cut]
            i0, j0 = np.where(cut, i, i0), np.where(cut, j, j0)
            going = i < stop  # both sides end at the same byte, the text's last
            if not going.all():
                doc, i, j, i0, j0, stop = (v[going] for v in (doc, i, j, i0, j0, stop))


def gathered(steps, least: int):
    """The cuts of successive steps, in runs of at least ``least``, so that a
    step of few documents costs no more than its own comparisons."""
    held, size = [], 0
    for cuts in steps:
        held.append(cuts)
        size += len(cuts[0])
        if size >= least:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _spread(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[k], lo[k] + 1, ... for n[k] numbers, one after another."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def group_links(a: Tokens, b: Tokens, cuts: tuple[np.ndarray, ...]):
    """(link, times) of the groups that steps have closed: a link is document,
    A id and B id as one number; times is None where every link stands once."""
    doc, i0, i1, j0, j1 = cuts
    na, nb = i1 - i0, j1 - j0
    single = (na == 1) & (nb == 1)
    yield _link(doc[single], a.ids[i0[single]], b.ids[j0[single]]), None
    some = ~single & (na * nb <= WIDE)
    if some.any():
        # every A token of a group, and then every B token of the group for it
        at_a = _spread(i0[some], na[some])
        width = np.repeat(nb[some], na[some])
        at_b = _spread(np.repeat(j0[some], na[some]), width)
        yield _link(np.repeat(doc[some], na[some] * nb[some]), np.repeat(a.ids[at_a], width), b.ids[at_b]), None
    for k in np.flatnonzero(~single & (na * nb > WIDE)):
        ids_a, times_a = np.unique(a.ids[i0[k]:i1[k]], return_counts=True)
        ids_b, times_b = np.unique(b.ids[j0[k]:j1[k]], return_counts=True)
        yield _link(doc[k], np.repeat(ids_a, len(ids_b)), np.tile(ids_b, len(ids_a))), np.outer(times_a, times_b).ravel()


def _link(doc, ids_a: np.ndarray, ids_b: np.ndarray) -> np.ndarray:
    return np.int64(doc) << DOC_SHIFT | ids_a.astype(np.int64) << PAIR_BITS | ids_b


class Names:
    """Digests of groups: ids in decimal, each with the sign that follows it."""

    def __init__(self, size_a: int, size_b: int):
        self.parts = [b"%d%c" % (i, c) for n, signs in ((size_a, b",|"), (size_b, b",;")) for c in signs for i in range(n)]
        self.starts = 0, size_a, 2 * size_a, 2 * size_a + size_b

    def digests(self, a: Tokens, b: Tokens, last_a: np.ndarray, last_b: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of every document, hashed; '' without tokens.
        last_a, last_b: whether a token is the last one of its group."""
        n_a, n_b = len(a.ids), len(b.ids)
        group_a = np.cumsum(last_a) - last_a  # groups that end before the token
        group_b = np.cumsum(last_b) - last_b
        after_a = np.flatnonzero(last_a) + 1  # A tokens up to each group's end
        before_b = np.concatenate(([0], np.flatnonzero(last_b) + 1))
        order = np.empty(n_a + n_b, np.int64)
        order[np.arange(n_a) + before_b[group_a]] = a.ids + np.where(last_a, self.starts[1], self.starts[0])
        order[np.arange(n_b) + after_a[group_b]] = b.ids + np.where(last_b, self.starts[3], self.starts[2])
        parts, out = self.parts, []
        for lo, hi in zip(a.first + b.first, (a.first + b.first)[1:], strict=False):
            out.append(hashlib.sha256(b"".join([parts[k] for k in order[lo:hi].tolist()])[:-1]).hexdigest() if hi > lo else "")
        return out


def align(encoder: Encoder, names: Names, width_a: np.ndarray, width_b: np.ndarray, texts: list[str | None]) -> dict:
    """A block: per document n_a, n_b, n_groups, n_links, groups_sha256, links
    (places in the dictionary, with offsets) and times; the dictionary's pairs
    and in how many documents of the block each is linked."""
    rows_a, rows_b = encoder.of(texts)
    a, b = Tokens.of(rows_a, width_a), Tokens.of(rows_b, width_b)
    n = len(texts)
    last_a, last_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
    plain, wide, wide_times = [np.empty(0, np.int64)], [], []
    for cuts in gathered(walk(a, b), RUN):
        last_a[cuts[2] - 1], last_b[cuts[4] - 1] = True, True
        for link, times in group_links(a, b, cuts):
            if times is None:
                plain.append(link)
            else:
                wide.append(link)
                wide_times.append(times)
    # links of a document with the same pair become one, with its multiplicity
    link, times = np.unique(np.concatenate(plain), return_counts=True)
    if wide:
        link, where = np.unique(np.concatenate((link, *wide)), return_inverse=True)
        times = np.bincount(where, np.concatenate((times, *wide_times)), len(link)).astype(np.int64)
    doc, pair = link >> DOC_SHIFT, link & (1 << DOC_SHIFT) - 1
    known = np.unique(pair)
    place = np.searchsorted(known, pair)
    return {
        "n_a": np.diff(a.first), "n_b": np.diff(b.first),
        "n_groups": np.diff(np.concatenate(([0], np.cumsum(last_a)))[a.first]),
        "n_links": np.bincount(doc, times, n).astype(np.int64),
        "groups_sha256": names.digests(a, b, last_a, last_b),
        "links": place.astype(np.int32), "times": times, "first": np.searchsorted(doc, np.arange(n + 1)),
        "pairs": known, "held": np.bincount(place, minlength=len(known)),
    }


#: Rows of a block: documents, and the dictionary in parts of ``PART`` pairs.
_DOC = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
        ("groups_sha256", pa.string()), ("links", pa.list_(pa.int32())), ("times", pa.list_(pa.int64()))]
_PART = [("base", pa.int32()), ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int32()))]
_BLOCK = pa.schema([("block", pa.string()), *_DOC, *_PART])
PART = 8192


def _block_rows(block: str, ids: list, out: dict):
    """Batches of the document rows and the dictionary rows of a block."""
    n, size = len(ids), len(out["pairs"])
    links = {f: pa.ListArray.from_arrays(pa.array(out["first"], pa.int32()), pa.array(out[f], kind.value_type)) for f, kind in _DOC[-2:]}
    cols = {"block": pa.array([block] * n), "doc_id": pa.array(ids, pa.int64())} | links
    yield pa.RecordBatch.from_arrays([cols[f.name] if f.name in cols else pa.nulls(n, f.type) if f.name not in out or f.name in ("pairs", "held") else pa.array(out[f.name], f.type) for f in _BLOCK], schema=_BLOCK)
    base = list(range(0, size, PART))
    offsets = pa.array([*base, size], pa.int32())
    cols = {"block": pa.array([block] * len(base), pa.string()), "base": pa.array(base, pa.int32())}
    cols |= {f: pa.ListArray.from_arrays(offsets, pa.array(out[f], kind.value_type)) for f, kind in _PART[1:]}
    yield pa.RecordBatch.from_arrays([cols.get(f.name, pa.nulls(len(base), f.type)) for f in _BLOCK], schema=_BLOCK)


def _blocks(spec, model, block_bytes: int):
    def run(batches):
        import uuid

        sides = Sides.load(spec.value, model.value)
        width_a, width_b = (np.array(list(map(len, t)), np.int64) for t in (sides.bytes_a, sides.bytes_b))
        if len(width_a) > 1 << DOC_SHIFT - PAIR_BITS or len(width_b) > 1 << PAIR_BITS:
            raise ValueError("the vocabularies have more ids than a link has room for")
        encoder, names = Encoder(sides, width_a, width_b), Names(len(sides.bytes_a), len(sides.bytes_b))
        ids, texts, size = [], [], 0
        for b in batches:
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids.append(d)
                texts.append(t.as_py())
                size += len(texts[-1] or "") + 1
                if size >= block_bytes:
                    yield from _block_rows(uuid.uuid4().hex, ids, align(encoder, names, width_a, width_b, texts))
                    ids, texts, size = [], [], 0
        if ids:
            yield from _block_rows(uuid.uuid4().hex, ids, align(encoder, names, width_a, width_b, texts))

    return run


_RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _weigh(key, docs: pa.Table, judged: pa.Table) -> pa.Table:
    """A block's documents, with its dictionary's counts."""
    docs, judged = docs.combine_chunks(), judged.combine_chunks()
    place = judged.column("place").to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place], best[place] = judged.column("count").to_numpy(), judged.column("best").to_numpy()
    weighed = {"n_best": [0] * docs.num_rows, "count_sum": [0] * docs.num_rows}
    if docs.num_rows:
        links, lo, hi = list_slices(docs.column("links").chunk(0))
        times, *_ = list_slices(docs.column("times").chunk(0))
        for f, weight in (("n_best", best), ("count_sum", count)):
            upto = np.concatenate(([0], np.cumsum(weight[links] * times)))
            weighed[f] = upto[hi] - upto[lo]
    names = [c.split()[0] for c in _RESULT.split(", ")]
    return pa.table({f: pa.array(weighed[f], pa.int64()) if f in weighed else docs.column(f) for f in names})


def align_documents(docs: DataFrame, spec_a: str, model_b: bytes, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    of every row: tokens of both sides, groups, links; links whose pair is held
    by as many documents as any pair of its A id; and the links' counts added up."""
    context = docs.sparkSession.sparkContext
    spec, model = context.broadcast(spec_a), context.broadcast(model_b)  # two vocabulary files
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = "block string, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links array<int>, times array<bigint>, base int, pairs array<bigint>, held array<int>"
    blocks = written(map_arrow(rows, _blocks(spec, model, block_bytes), kinds), "token-links")

    parts = blocks.where("base is not null").select("block", "base", F.posexplode(F.arrays_zip("pairs", "held")).alias("k", "e"))
    entries = parts.select("block", (F.col("base") + F.col("k")).alias("place"), F.col("e.pairs").alias("pair"), F.col("e.held").alias("held"))
    counts = entries.groupBy("pair").agg(F.sum("held").alias("count"))
    # at most one row per id of B in a window
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", PAIR_BITS)))
    counts = written(counts.select("pair", "count", (F.col("count") == most).cast("int").alias("best")), "pair-counts")
    judged = entries.join(counts, "pair").select(F.col("block").alias("of"), "place", "count", "best")
    linked = blocks.where("n_a is not null").select("block", *(f for f, _ in _DOC))
    return linked.groupBy("block").cogroup(judged.groupBy("of")).applyInArrow(_weigh, _RESULT)


def align_files(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``align_documents`` with the vocabularies of two files."""
    spark = docs.sparkSession
    return align_documents(docs, read_spec(spark, path_a), read_model(spark, path_b))


def brute_force(rows: list[tuple[int | None, str | None]], path_a: str, path_b: str) -> list[tuple]:
    """The definition with the libraries, in memory, for tests."""
    from collections import Counter

    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    char = {c: i for i, c in enumerate(byte_alphabet())}
    linked: list[tuple] = []
    counts: Counter = Counter()
    for d, text in rows:
        text = text or ""
        ta = a.encode(" " + text, add_special_tokens=False).ids if text else []
        tb = b.encode(text) if text else []
        sa = [bytes(char[c] for c in a.id_to_token(i)) for i in ta]
        sb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in tb]
        if not text or b"".join(sa) != (" " + text).encode() or b"".join(sb) != (" " + text).encode():
            linked.append((d, [], [], [], []))
            continue
        ends = [{sum(map(len, s[:k + 1])) for k in range(len(s))} if len(s) < 300 else set(np.cumsum([len(x) for x in s]).tolist()) for s in (sa, sb)]
        both = sorted(ends[0] & ends[1])
        groups = [([], []) for _ in both]
        for side, ids, parts in ((0, ta, sa), (1, tb, sb)):
            end = g = 0
            for i, x in zip(ids, parts, strict=True):
                end += len(x)
                groups[g][side].append(i)
                if end == both[g]:
                    g += 1
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        counts.update(set(links))
        linked.append((d, ta, tb, groups, links))
    most: dict[int, int] = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for d, ta, tb, groups, links in linked:
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((d, len(ta), len(tb), len(groups), len(links), sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out
