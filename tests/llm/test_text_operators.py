"""Each operator against its definition in plain Python, on messy rows."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, line_dedup, mixing, ngram_join, quality_rules, substring_dedup, token_counts

SPACES = r"[^\x20\x09-\x0D]+"


def by_id(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


# --- 1 line dedup -----------------------------------------------------------

def chunks_of(text, divisor=line_dedup.DIVISOR):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    out, start = [], 0
    for i in range(len(lines)):
        rolled = h[i] + (31 * h[i - 1] if i > 0 else 0) + (961 * h[i - 2] if i > 1 else 0)
        if rolled % line_dedup.MODULUS % divisor == 0 or i == len(lines) - 1:
            out.append(lines[start:i + 1])
            start = i + 1
    return out


def test_line_dedup(messy, messy_rows):
    seen, want = set(), {}
    for d, text, *_ in sorted(messy_rows, key=lambda r: r[0]):
        if text is None:
            want[d] = (None, 0, 0)
            continue
        kept, gone = [], 0
        for c in chunks_of(text):
            body = "\n".join(c)
            if len(c) > 1 and re.search(SPACES, body) and body in seen:
                gone += len(c)
            else:
                kept += c
            if len(c) > 1:
                seen.add(body)
        want[d] = ("\n".join(kept), text.count("\n") + 1, gone)
    got = line_dedup.dedup_lines(messy)
    assert set(messy.columns) | {"n_removed"} == set(got.columns)
    assert by_id(got.select("doc_id", "text", "n_lines", "n_removed")) == want
    assert sum(w[2] for w in want.values()) > 100


def test_line_dedup_odd_rows(odd_ids, empty):
    assert line_dedup.dedup_lines(empty).count() == 0
    got = line_dedup.dedup_lines(odd_ids)
    assert got.count() == odd_ids.count()
    # repeated rows are one document: equal results
    assert got.where("doc_id = 0").select("text", "n_removed").distinct().count() == 1


def test_line_dedup_is_native(messy):
    plan = line_dedup.dedup_lines(messy)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- 2 quality --------------------------------------------------------------

def base_of(text):
    words = re.findall(SPACES, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(SPACES, x)]
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if grams[tuple(words[i:i + 5])] > 1:
            hit.update(range(i, i + 5))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit),
            len(words) < 10 or 100 * len(hit) > 20 * len(words))


def test_quality_counts(messy, messy_rows, empty, odd_ids):
    got = quality_rules.judge(messy)
    assert by_id(got.select("doc_id", *quality_rules.BASE, "base_failed")) == {r[0]: base_of(r[1]) for r in messy_rows}
    assert got.where("base_failed and kept").count() == 0
    assert quality_rules.judge(empty).count() == 0
    assert quality_rules.judge(odd_ids).count() == odd_ids.count()


def test_keep_good_keeps_columns(messy, empty):
    kept = quality_rules.keep_good(messy)
    assert kept.dtypes == messy.dtypes
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in quality_rules.judge(messy).where("kept").select("doc_id").collect())
    assert quality_rules.keep_good(empty).count() == 0


def test_em_finds_the_junk():
    import numpy as np

    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.85
    votes = np.zeros((20_000, 4), int)
    for k, (hit, false) in enumerate(((0.5, 0.002), (0.3, 0.0), (0.2, 0.001))):
        votes[:, k] = -(rng.random(20_000) < np.where(truth, false, hit)).astype(int)
    votes[:, 3] = np.where(rng.random(20_000) < np.where(truth, 0.95, 0.6), 1, 0)
    patterns, at, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    good = quality_rules.fit(patterns, n.astype(float))[0][at.ravel()] >= 0.5
    assert good[truth].mean() > 0.99
    assert (~good[~truth]).mean() > 0.65  # 72 % of the junk has a junk vote


# --- 5 n-gram join ----------------------------------------------------------

@pytest.mark.parametrize("shingle, percent", [(3, 90), (5, 80), (1, 60)])
def test_ngram_join(messy, messy_rows, shingle, percent):
    got = by_id(ngram_join.jaccard_components(messy, shingle, percent))
    want = ngram_join.brute_force([(r[0], r[1]) for r in messy_rows], shingle, percent)
    assert got == want
    assert len({c for _, c in want.values()}) < len(want) - 20


def test_ngram_join_blocks_equal_tiles(spark, messy, messy_rows, monkeypatch):
    want = by_id(ngram_join.jaccard_components(messy, 3, 85))
    monkeypatch.setattr(ngram_join, "BLOCK", 2)
    assert by_id(ngram_join.jaccard_components(messy, 3, 85)) == want


def test_ngram_join_odd_rows(odd_ids, empty):
    assert ngram_join.jaccard_components(empty).count() == 0
    assert ngram_join.jaccard_components(odd_ids).count() == odd_ids.count()


def test_every_linked_pair_shares_a_tile():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate((a[rng.random(len(a)) > 0.07], rng.integers(0, 2**63, int(rng.integers(0, n // 12 + 1))).astype(np.uint64))))
        if len(b) and ngram_join.links(a, b, 80):
            keys = {v: [ngram_join.tile_keys(s, v, 80) for s in (a, b)] for v in set(ngram_join.levels_of(len(a), 80)) & set(ngram_join.levels_of(len(b), 80))}
            # whichever tiles count as the most popular: more are shared than may be left out
            assert any(len(np.intersect1d(x[0], y[0])) > max(x[1], y[1]) for x, y in keys.values())
            top = max(ngram_join.levels_of(len(a), 80)[0], ngram_join.levels_of(len(b), 80)[0])
            differ = int(np.bitwise_count(ngram_join.signature(a, top) ^ ngram_join.signature(b, top)).sum())
            assert ngram_join.may_link(np.int64(len(a)), len(b), differ, 80)


# --- 6 BPE ------------------------------------------------------------------

def test_bpe_equals_the_library(spark, messy, messy_rows, empty, odd_ids):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    spec, lib = bpe.read_spec(spark, path), Tokenizer.from_file(path)
    rows = [(r[0], r[1]) for r in messy_rows] + [(500 + i, t) for i, t in enumerate(
        ["<|endoftext|>a<|startoftext|> <|endoftext|", "I'm you'Re 3.14 ²½Ⅳ", "ΑΣΣΑ ΣΑΣ İ é ẛ̣", "日本語 👍🏽​﻿ x", "ab" * 4000 + "!?" * 900])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = by_id(bpe.digest(docs, spec))
    full = by_id(bpe.encode(docs, spec).select("doc_id", "n_tokens", F.sha2("ids", 256), F.sha2("decoded", 256)))
    for d, text in rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert got[d] == full[d] == want, (d, text)
    assert bpe.digest(empty, spec).count() == 0
    assert bpe.digest(odd_ids, spec).count() == odd_ids.count()


def test_forced_cuts_are_never_merged_across():
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        codec = bpe.Codec(f.read())
    raw = "strengthqxzjv".encode()
    assert codec.cuts(raw)[-1] == len(raw)
    whole = codec.merge([codec.first[c] for c in raw[:-1]] + [codec.last[raw[-1]]])
    assert whole == codec.encode_piece(raw.decode())


# --- 8 mixing ---------------------------------------------------------------

def test_mixing_stays_within_a_block(spark, messy, empty, odd_ids):
    weights = [5, 3, 2, 7, 1]
    rows = sorted((r.at, r.mix_group) for r in mixing.period(spark, weights).collect())
    assert [a for a, _ in rows] == list(range(sum(weights)))
    done = Counter()
    for t, g in rows:
        done[g] += 1
        for i, w in enumerate(weights):
            assert abs(done[i] - (t + 1) * w / sum(weights)) < 1
    got = mixing.mix(messy, block_rows=4)
    assert got.count() == messy.count()
    assert set(got.columns) == set(messy.columns) | set(mixing.PLACE)
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(odd_ids).count() == odd_ids.count()
    with pytest.raises(ValueError):
        mixing.period(spark, [1, 0])


def test_mixing_order_and_blocks(messy, messy_rows):
    groups = {}
    for d, _, _, source in sorted(messy_rows, key=lambda r: r[0]):
        g = [*mixing.TARGETS, source].index(source)
        groups.setdefault(g, []).append(d)
    want = {d: (g, k // 4) for g, ids in groups.items() for k, d in enumerate(ids)}
    got = mixing.mix(messy, block_rows=4)
    assert by_id(got.select("doc_id", "mix_group", "mix_block")) == want
    slots = got.select("mix_group", "mix_block", "mix_slot").distinct().collect()
    assert len({r.mix_slot for r in slots}) == len(slots)
    assert not re.search("Python|Arrow|Pandas", got._jdf.queryExecution().toString())


# --- 9 substring dedup ------------------------------------------------------

def test_substring_dedup(messy, messy_rows, empty, odd_ids):
    got = by_id(substring_dedup.digest(substring_dedup.remove_repeats(messy)))
    want = substring_dedup.brute_force([(r[0], r[1]) for r in messy_rows])
    assert got == want
    assert sum(w[1] for w in want.values()) > 5000
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert substring_dedup.remove_repeats(odd_ids).count() == odd_ids.count()


@pytest.mark.parametrize("width, gram", [(1, 1), (4, 2), (7, 7)])
def test_substring_dedup_widths(messy, messy_rows, width, gram):
    got = by_id(substring_dedup.digest(substring_dedup.remove_repeats(messy, width, gram)))
    assert got == substring_dedup.brute_force([(r[0], r[1]) for r in messy_rows], width)


# --- 10 token counts --------------------------------------------------------

def test_token_counts(spark, messy, messy_rows, empty, odd_ids):
    import public_tokenizers
    import tiktoken

    ranks = token_counts.read_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    spec = (public_tokenizers.PATTERN, ranks)
    codec = tiktoken.Encoding("own", pat_str=spec[0], mergeable_ranks=ranks, special_tokens={})
    want = {r[0]: (len(codec.encode_ordinary(r[1] or "")),) for r in messy_rows}
    assert by_id(token_counts.count(messy, spec, 50256)) == want
    assert token_counts.count(empty, spec, 50256).count() == 0
    assert token_counts.count(odd_ids, spec, 50256).count() == odd_ids.count()


@pytest.mark.parametrize("segment", [1, 2, 1024])
def test_separator_scan_stitches_blocks(spark, monkeypatch, segment):
    import random

    import numpy as np

    monkeypatch.setattr(token_counts, "SEGMENT", segment)
    rng = random.Random(segment)
    rows, want = [], set()
    for file in range(5):
        lengths = [rng.choice([0, 0, 1, 2, 9, 30]) for _ in range(rng.randrange(0, 12))]
        ids = [x for n in lengths for x in [*([7] * n), 0]] + [7] * (file % 3)
        want |= {(file, k, n) for k, n in enumerate([*lengths, *([file % 3] if file % 3 else [])])}
        at = block = 0
        while at < len(ids):
            n = rng.randrange(0, 6)
            rows.append((file, block, bytearray(np.array(ids[at:at + n], "<u2").tobytes())))
            at, block = at + n, block + 1
    blocks = spark.createDataFrame(rows, "file bigint, block bigint, data binary")
    assert {tuple(r) for r in token_counts.scan(blocks, 0).collect()} == want


def test_flat_files_are_read_in_blocks(spark, tmp_path):
    import numpy as np

    (tmp_path / "a.bin").write_bytes(np.array([5, 5, 0, 5, 0, 0, 5, 5, 5], "<u2").tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    blocks = token_counts.read_files(spark, str(tmp_path), block_bytes=4)
    assert sorted(tuple(r)[1:] for r in token_counts.scan(blocks, 0).collect()) == [(0, 2), (1, 1), (2, 0), (3, 3)]
