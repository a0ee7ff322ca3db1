"""BPE encoding and decoding with forced boundaries.

A pair of bytes that stands side by side in no token of the vocabulary can
never be merged across, so a cut between such bytes is certain.  Every text is
split at white space and by the tokenizer's own pattern, every piece at its
forced cuts; the fragments are merged independently of one another (lowest
rank first, leftmost first, by a heap over a linked list, so a run of a million
letters stays log-linear) and their ids concatenated.  Fragments and pieces
are remembered per task, within a bound.

``Codec`` reads a ``tokenizers`` JSON file of the kind "BPE with word ends":
normaliser NFC, white space, lower case; pattern split; byte-level alphabet;
no decoder.  Encoding equals the library's ``encode(add_special_tokens=False)``
(special tokens written in a text become their ids), decoding its
``decode(skip_special_tokens=False)``: the tokens joined by spaces.

Rows: a NULL text encodes like an empty one (no ids, empty decoded text); rows
are independent of one another, so repeated rows give equal results; an empty
table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import batch, map_arrow

#: Entries that a task remembers before it starts afresh.
MEMORY = 300_000
#: Ids up to which a plain search for the lowest rank beats a heap.
SHORT = 40
#: Rank of a pair that is no merge.
NONE = (2**31, 0)
WHITE = r"\p{White_Space}+"
END = "</w>"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 bytes stand for themselves, the others
    follow from U+0100 on."""
    out, spare = [], 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class Codec:
    def __init__(self, spec: str):
        import regex
        from tokenizers import Regex, normalizers, pre_tokenizers

        d = json.loads(spec)
        model = d["model"]
        kinds = [n["type"] for n in d["normalizer"]["normalizers"]]
        split, level = d["pre_tokenizer"]["pretokenizers"]
        if (model["type"], model["end_of_word_suffix"], kinds, level["type"], d["decoder"]) != ("BPE", END, ["NFC", "Replace", "Lowercase"], "ByteLevel", None):
            raise ValueError("not a lower-case BPE file with word ends")
        vocab = model["vocab"]
        self.token = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in d["added_tokens"]}
        special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.white, self.piece = regex.compile(WHITE), regex.compile(split["pattern"]["Regex"])
        # Characters beyond ASCII are composed, lowered and told apart by the
        # library's own tables: Python's are of another version of Unicode.
        self.normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.split = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), "removed", invert=True)
        alphabet = byte_alphabet()
        self.first = [vocab[c] for c in alphabet]
        self.last = [vocab[c + END] for c in alphabet]
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(merges)}
        byte = {c: b for b, c in enumerate(alphabet)}
        self.joined = bytearray(65536)  # 1 where two bytes stand side by side in a token
        for t in vocab:
            raw = [byte[c] for c in t.removesuffix(END)]
            for a, b in zip(raw, raw[1:], strict=False):
                self.joined[a << 8 | b] = 1
        self.fragments: dict = {}
        self.words: dict[str, bytes] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Merge neighbours, lowest rank and then leftmost first."""
        return self.merge_short(ids) if len(ids) <= SHORT else self.merge_long(ids)

    def merge_short(self, ids: list[int]) -> list[int]:
        get = self.rank.get
        ranks = [get(p, NONE) for p in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks))[0] != NONE[0]:
            i = ranks.index(best)
            ids[i:i + 2] = [best[1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], best[1]), NONE)
            if i < len(ranks):
                ranks[i] = get((best[1], ids[i + 1]), NONE)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """By a heap over a linked list: log-linear in the ids."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def meet(i: int, j: int) -> None:
            if i >= 0 and j < n and (found := self.rank.get((ids[i], ids[j]))):
                heapq.heappush(heap, (found[0], i, found[1], ids[i], ids[j]))

        for i in range(n - 1):
            meet(i, i + 1)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # a neighbour has been merged meanwhile
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            meet(before[i], i)
            meet(i, k)
        return [t for t in ids if t >= 0]

    def cuts(self, raw: bytes) -> list[int]:
        """Ends of the fragments of a piece: its forced boundaries and its end."""
        joined = self.joined
        return [*[i for i, (a, b) in enumerate(zip(raw, raw[1:], strict=False), 1) if not joined[a << 8 | b]], len(raw)]

    def encode_piece(self, piece: str) -> list[int]:
        raw, out, start = piece.encode(), [], 0
        for end in self.cuts(raw):
            key = (raw[start:end], end == len(raw))
            if (ids := self.fragments.get(key)) is None:
                if len(self.fragments) >= MEMORY:
                    self.fragments.clear()
                ids = [self.first[c] for c in key[0]]
                if key[1]:
                    ids[-1] = self.last[key[0][-1]]
                ids = self.merge(ids)
                if len(raw) < 256:
                    self.fragments[key] = ids
            out += ids
            start = end
        return out

    def encode_word(self, word: str) -> bytes:
        """Ids of the text between two white spaces, as little-endian 32 bits."""
        if word.isascii():
            norm = word.lower()
            # ASCII letters alone are one piece of the pattern
            pieces = [norm] if norm.isalpha() else self.piece.findall(norm)
        else:
            norm = self.normal.normalize_str(word)
            # letters of a range that every version of Unicode knows
            pieces = [norm] if max(norm) < "\u0250" and norm.isalpha() else [p for p, _ in self.split.pre_tokenize_str(norm)]
        ids = [i for p in pieces for i in self.encode_piece(p)]
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) < 256:
            if len(self.words) >= MEMORY:
                self.words.clear()
            self.words[word] = out
        return out

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.at_special and "<|" in text and len(parts := self.at_special.split(text)) > 1:
            return b"".join(self.special[p] if k % 2 else self.encode(p) for k, p in enumerate(parts))
        # U+001C to U+001F part words for str.split, but are no white space
        words = text.split() if not any(c in text for c in "\x1c\x1d\x1e\x1f") else [w for w in self.white.split(text) if w]
        known = self.words.get
        return b"".join([known(w) or self.encode_word(w) for w in words])

    def decode(self, ids: bytes) -> str:
        token = self.token
        return " ".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


def read_spec(spark, path: str) -> str:
    """The tokenizer file, through Spark's reader; path is a parameter."""
    where = path if ":/" in path else f"file://{path}"
    return spark.read.text(where, wholetext=True).first()[0]


def encode(docs: DataFrame, spec: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as little-endian 32-bit integers;
    and the bigint columns ``carry`` as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # one vocabulary file
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary()), *((c, pa.int64()) for c in carry)])

    def run(batches):
        codec = Codec(shared.value)
        for b in batches:
            ids = [codec.encode(t.as_py()) for t in b.column("text")]
            yield batch(schema, b.column("doc_id"), [len(x) // 4 for x in ids], ids, [codec.decode(x).encode() for x in ids], *(b.column(c) for c in carry))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *carry)
    return map_arrow(rows, run, ", ".join(["doc_id bigint, n_tokens bigint, ids binary, decoded binary", *(f"{c} bigint" for c in carry)]))


def digest(docs: DataFrame, spec: str) -> DataFrame:
    """The digests of ``encode``, taken in the tasks that encode."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        codec = Codec(shared.value)
        for b in batches:
            ids = [codec.encode(t.as_py()) for t in b.column("text")]
            yield batch(schema, b.column("doc_id"), [len(x) // 4 for x in ids], [hashlib.sha256(x).hexdigest() for x in ids],
                        [hashlib.sha256(codec.decode(x).encode()).hexdigest() for x in ids])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_arrow(rows, run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
