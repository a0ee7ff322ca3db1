"""N-gram Jaccard join: documents linked by the similarity of their shingle sets.

A set holds the 64-bit hashes of a document's distinct ``shingle``-word
sequences (ASCII lower case).  Equal sets are one *node* (its hash), so copies
are never compared with one another.

Candidates (lossless).  Sizes fall into bands that grow by half; a node works
on the level of its own band and, if it can link to a larger set, on the next
one.  Two sets that link on a level whose sizes stay below ``hi`` differ in at
most ``d = floor((1 - t) / (1 + t) * 2 * (hi - 1))`` shingles.  The hash range
is cut into ``parts > d`` parts, so the sets hold the same shingles in at least
``parts - d`` of them.  The hash of (level, part, shingles in it) is the key of
a *tile*.  A node with E empty parts shares at least ``parts - d - E`` tiles of
shingles with a partner, so it may leave out the ``parts - d - E - 1`` most
popular ones (in one order for all nodes: the least popular tile that two sets
share is never left out by either).  Passages that many documents share make
popular tiles, which go; a node that meets others in too few tiles goes
altogether.  A node with too many empty parts names those too.

Links.  Tiles are counted in Spark; only keys that two texts share go on.

1. Every node is compared with the most central node (shares most keys) that
   it meets, which joins whole families without listing their pairs.
2. Tiles that still hold two or more components are cut into blocks; pairs of
   blocks compare all nodes of different components.

In both steps a hashed bitmap signature (parity of the shingles per bit) comes
first: the bits that differ bound the overlap from above.  Only for pairs that
pass are the sorted arrays made and shuffled, and intersected exactly.  Texts
are never shuffled: the documents whose arrays are wanted are picked in the
scan by a Bloom filter of their ids (at most 2**28 bits, 32 MB; where that
fills up, more arrays are made than needed, and dropped by the join that
follows).  Components of the links follow by alternating stars.

Rows: NULL and empty texts (or texts without words) have the empty set, link
with nothing and are their own component; rows that share a doc_id are taken
together only if their sets link; NULL doc_ids sort first (component_id is
NULL then).  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._common import POLY, as_i64, batch, from_key, id_key, map_arrow, mix, word_hashes, written
from tessera.llm._graph import components

SHINGLE, PERCENT = 5, 80
#: Parts beyond the d + 1 that a level needs: so many, and a share of d.
SPARE, SHARE = 3, 4
#: Nodes of one block of a tile.
BLOCK = 256
#: Bound of the Bloom filter of wanted documents, as a power of two of bits.
MOST_BITS = 28


def band_starts(top: int = 2**40) -> list[int]:
    lo = [1]
    while lo[-1] < top:
        lo.append(max(lo[-1] + 1, lo[-1] * 3 // 2))
    return lo


_LO = np.array(band_starts(), np.int64)


def shingle_set(text: bytes | None, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the word sequences of ``text``."""
    h = word_hashes((text or b"").lower())
    if not len(h):
        return h
    width = min(shingle, len(h))
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out *= np.uint64(POLY)
        out += h[k:k + n]
    return np.unique(mix(out))


def node_hash(s: np.ndarray) -> int:
    return int(mix(np.array([mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(s))]))[0].view(np.int64))


def levels_of(n: int, percent: int) -> list[int]:
    """Band of a set of ``n`` shingles, and the next if a link can reach it."""
    own = int(np.searchsorted(_LO, n, "right")) - 1
    return [own, own + 1] if 100 * n >= percent * int(_LO[own + 1]) else [own]


def tile_keys(s: np.ndarray, level: int, percent: int) -> tuple[np.ndarray, int]:
    """(keys of a set's tiles on one level, how many of the most popular may be
    left out); the lowest six bits of a key are the level."""
    d = (100 - percent) * 2 * (int(_LO[level + 1]) - 1) // (100 + percent)
    parts = d + 1 + SPARE + d // SHARE
    at = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(s ^ np.uint64(level + 1)), dtype=np.uint64)))
    p = np.arange(parts, dtype=np.uint64)
    lo, hi = np.searchsorted(at, p, "left"), np.searchsorted(at, p, "right")
    keys = mix(total[hi] - total[lo] + p * np.uint64(POLY) + (hi - lo).astype(np.uint64))
    full = hi > lo
    spare = int(full.sum()) - d - 1
    if spare >= 0:
        keys = keys[full]
    return (keys & ~np.uint64(63)) | np.uint64(level), max(0, spare)


def signature(s: np.ndarray, level: int) -> np.ndarray:
    """Bit i: parity of the number of shingles with hash i, by level 64 to 8192 bits."""
    bits = 1 << min(13, max(6, int(_LO[level + 1] - 1).bit_length()))
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def may_link(n: np.ndarray, m: np.ndarray, differ: np.ndarray, percent: int) -> np.ndarray:
    """The overlap is at most (n + m - differing bits) / 2."""
    most = (n + m - differ) // 2
    return 100 * most >= percent * (n + m - most)


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sets(shingle: int, percent: int):
    """(d, n_shingles, node, level, sig, sig_next): sizes and signatures."""
    schema = pa.schema([("d", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("level", pa.int32()), ("sig", pa.binary()), ("sig_next", pa.binary())])

    def run(batches):
        for b in batches:
            out = []
            for t in b.column("words"):
                s = shingle_set(t.as_py(), shingle)
                if len(s):
                    v = levels_of(len(s), percent)[0]
                    out.append((len(s), node_hash(s), v, signature(s, v).tobytes(), signature(s, v + 1).tobytes()))
                else:
                    out.append((0, None, None, None, None))
            yield batch(schema, b.column("d"), *zip(*out, strict=True)) if out else batch(schema, *([] for _ in schema))

    return run


def _keys(shingle: int, percent: int):
    """(key, node, spare); a task names the keys of a repeated node once (it
    forgets nodes when it has met many: a key row more does no harm)."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("spare", pa.int32())])

    def run(batches):
        met: set[int] = set()
        for b in batches:
            keys, nodes, spares = [], [], []
            for t in b.column("words"):
                s = shingle_set(t.as_py(), shingle)
                if not len(s) or (node := node_hash(s)) in met:
                    continue
                if len(met) > 200_000:
                    met.clear()
                met.add(node)
                for v in levels_of(len(s), percent):
                    k, spare = tile_keys(s, v, percent)
                    keys.append(k)
                    nodes.append(np.full(len(k), node, np.int64))
                    spares.append(np.full(len(k), spare, np.int32))
            if keys:
                yield batch(schema, as_i64(np.concatenate(keys)), np.concatenate(nodes), np.concatenate(spares))

    return run


def _differ(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1).astype(np.int64)


def _bounded(percent: int):
    """The pairs whose signatures, on the level of the larger set, allow a link."""
    schema = pa.schema([("node", pa.int64()), ("node2", pa.int64())])

    def run(batches):
        for t in batches:
            out = []
            for r in t.to_pylist():
                if abs(r["level"] - r["level2"]) > 1:
                    continue
                top = max(r["level"], r["level2"])
                x = np.frombuffer(r["sig"] if r["level"] == top else r["sig_next"], np.uint64)
                y = np.frombuffer(r["sig2"] if r["level2"] == top else r["sig_next2"], np.uint64)
                if may_link(np.int64(r["size"]), r["size2"], _differ(x, y), percent):
                    out.append((r["node"], r["node2"]))
            if out:
                yield batch(schema, *zip(*out, strict=True))

    return run


def _exact(percent: int):
    """The pairs whose sorted arrays link."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for t in batches:
            out = []
            for a, b, x, y in zip(t.column("node").to_pylist(), t.column("node2").to_pylist(), t.column("words"), t.column("words2"), strict=True):
                if links(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent):
                    out.append((a, b))
            if out:
                yield batch(schema, *zip(*out, strict=True))

    return run


def _arrays(src: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, words): sorted arrays of the nodes of ``wanted(node, d)``, made
    from the text of document d.  A Bloom filter of the ids picks the documents
    in the scan; the join drops what it let through."""
    bits = 1 << min(MOST_BITS, max(16, int(16 * wanted.count()).bit_length()))
    slot = F.pmod(F.xxhash64("d"), F.lit(bits))
    t = (wanted.select(slot.alias("slot")).groupBy(F.floor(F.col("slot") / 64).alias("at"))
         .agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("mask"))).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[t.column("at").to_numpy()] = t.column("mask").to_numpy()
    held = src.sparkSession.sparkContext.broadcast(table)
    schema = pa.schema([("node", pa.int64()), ("words", pa.binary())])

    def run(batches):
        mask = held.value.view(np.uint64)
        for b in batches:
            at = b.column("slot").to_numpy()
            hit = np.flatnonzero((mask[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1))
            texts = b.column("words")
            sets = [shingle_set(texts[int(i)].as_py(), shingle) for i in hit]
            sets = [s for s in sets if len(s)]
            if sets:
                yield batch(schema, [node_hash(s) for s in sets], [s.tobytes() for s in sets])

    made = map_arrow(src.select(slot.alias("slot"), "words"), run, "node bigint, words binary")
    return written(made.join(wanted.select("node"), "node", "left_semi"), "shingle-arrays")


def _tile_pairs(percent: int):
    """Pairs of nodes of different components in a tile (rows of a tile
    follow one another) whose signatures allow a link."""
    schema = pa.schema([("node", pa.int64()), ("node2", pa.int64())])

    def pairs(t: pa.RecordBatch):
        """All pairs within the tiles of ``t``: rows k apart, for every k that
        some tile spans."""
        tile, node, root, block, size = (t.column(c).to_numpy() for c in ("tile", "node", "root", "block", "size"))
        col = t.column("sig")
        ends = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
        width, data = np.diff(ends), np.frombuffer(col.buffers()[2], np.uint8)
        starts = np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1])))
        one = np.repeat(np.minimum.reduceat(block, starts) == np.maximum.reduceat(block, starts), np.diff(np.append(starts, len(tile))))
        sigs = {int(w): data[ends[:-1][width == w][:, None] + np.arange(w)].view(np.uint64) for w in np.unique(width)}
        place = np.zeros(len(tile), np.int64)
        for w in sigs:
            place[width == w] = np.arange((width == w).sum())
        for k in range(1, len(tile)):
            i = np.flatnonzero(tile[k:] == tile[:-k])
            if not len(i):
                break
            j = i + k
            low, high = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
            ok = (root[i] != root[j]) & (one[i] | (block[i] != block[j])) & (100 * low >= percent * high) & (width[i] == width[j])
            i, j = i[ok], j[ok]
            for w, sig in sigs.items():
                at = width[i] == w
                x, y = i[at], j[at]
                fit = may_link(size[x], size[y], _differ(sig[place[x]], sig[place[y]]), percent)
                x, y = node[x[fit]], node[y[fit]]
                yield from zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist(), strict=True)

    def run(batches):
        held = None  # the rows of the last tile, which may go on in the next batch
        for t in batches:
            t = t if held is None else pa.concat_batches([held, t])
            tile = t.column("tile").to_numpy()
            cut = int(np.flatnonzero(tile == tile[-1])[0]) if len(tile) else 0
            held = t.slice(cut)
            if cut and (out := set(pairs(t.slice(0, cut)))):
                yield batch(schema, *zip(*out, strict=True))
        if held is not None and held.num_rows and (out := set(pairs(held))):
            yield batch(schema, *zip(*out, strict=True))

    return run


def _open_tiles(rows: DataFrame, members: DataFrame, roots: DataFrame) -> DataFrame:
    """(tile, node, root, block, size, sig): block pairs of the tiles that
    hold several components, both sides of a pair under one ``tile``."""
    rooted = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = (rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n"))
               .where("lo <> hi").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    inside = rooted.join(written(several, "open-tiles"), "key").join(members.select("node", "level", "sig", "sig_next", "size"), "node")
    own = F.col("level") == F.col("key").bitwiseAND(F.lit(63))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = inside.select("key", "node", "root", "size", "blocks", F.when(own, F.col("sig")).otherwise(F.col("sig_next")).alias("sig"), block.alias("block")).withColumn("other", other)
    tile = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    return (paired.select(tile.alias("tile"), "node", "root", "block", "size", "sig")
            .repartition("tile").sortWithinPartitions("tile"))


def _several(rows: DataFrame) -> DataFrame:
    """(key, n) of the keys that several nodes have; ``rows`` are distinct."""
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def link_table(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(nodes, links): nodes(d, n_shingles, node) per row of ``docs``; links
    (a, b) between nodes, enough of them to join each component."""
    src = docs.select(id_key().alias("d"), F.col("text").cast("binary").alias("words"))
    nodes = written(map_arrow(src, _sets(shingle, percent), "d bigint, n_shingles bigint, node bigint, level int, sig binary, sig_next binary"), "shingle-nodes")
    keys = map_arrow(src.select("words"), _keys(shingle, percent), "key bigint, node bigint, spare int")
    shared = written(keys.groupBy("key").count().where("count > 1").select("key"), "shared-keys")
    met = written(keys.join(shared, "key").distinct(), "met-keys")
    several = written(_several(met), "popular-keys")
    popular = Window.partitionBy("node", F.col("key").bitwiseAND(F.lit(63))).orderBy(F.desc("n"), "key")  # a node's keys
    left = met.join(several, "key").withColumn("place", F.row_number().over(popular)).where("place > spare").select("key", "node")
    left = written(left, "left-keys")
    rows = written(left.join(written(_several(left), "tile-sizes"), "key"), "tiles")

    central = rows.groupBy("node").agg(F.sum("n").alias("weight"))
    weighted = rows.select("key", "node").join(central, "node")
    heads = weighted.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("head"))
    leaders = (rows.select("key", "node").join(written(heads, "tile-heads"), "key")
               .groupBy("node").agg(F.max("head").alias("head")).select("node", F.col("head.node").alias("leader")))
    first = nodes.where("node is not null").groupBy("node").agg(
        F.min(F.struct("d", F.col("n_shingles").alias("size"), "level", "sig", "sig_next")).alias("f"))
    members = written(first.join(leaders, "node").select("node", "leader", "f.*"), "members")

    def verified(pairs: DataFrame) -> DataFrame:
        ends = pairs.select("node").unionByName(pairs.select(F.col("node2").alias("node"))).distinct()
        arrays = _arrays(src, written(members.select("node", "d").join(ends, "node"), "wanted-arrays"), shingle)
        other = arrays.select(F.col("node").alias("node2"), F.col("words").alias("words2"))
        return map_arrow(arrays.join(pairs, "node").join(other, "node2"), _exact(percent), "a bigint, b bigint")

    heads = members.select(*(F.col(c).alias(f"{c}2") for c in ("node", "size", "level", "sig", "sig_next")))
    chosen = members.where("node <> leader").withColumn("node2", F.col("leader")).join(heads, "node2")
    close = written(map_arrow(chosen, _bounded(percent), "node bigint, node2 bigint"), "pairs-1")
    edges = written(verified(close), "links-1")
    opened = _open_tiles(rows.drop("n"), members, components(edges))
    rest = written(map_arrow(opened, _tile_pairs(percent), "node bigint, node2 bigint").distinct(), "pairs-2")
    return nodes.select("d", "n_shingles", "node"), edges.unionByName(written(verified(rest), "links-2"))


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``; two sets link
    when 100 * intersection >= percent * union."""
    nodes, edges = link_table(docs, shingle, percent)
    full = nodes.where("node is not null")
    roots = components(edges)
    first = full.groupBy("node").agg(F.min("d").alias("d")).join(roots, "node", "left")
    # both written, so that AQE can split the join of a large component
    first = written(first.select("node", "d", F.coalesce("root", "node").alias("root")), "component-nodes")
    least = written(first.groupBy("root").agg(F.min("d").alias("c")), "component-ids")
    named = written(first.join(least, "root").select("node", "c"), "component-names")
    out = nodes.join(named, "node", "left").withColumn("c", F.coalesce("c", "d"))
    return out.select(from_key("d").alias("doc_id"), "n_shingles", from_key("c").alias("component_id"))


def brute_force(rows: list[tuple[int, str | None]], shingle: int = SHINGLE, percent: int = PERCENT) -> dict[int, tuple[int, int]]:
    """The definition, in memory, for tests: an inverted index over true
    shingles counts every overlap."""
    import re
    from collections import Counter, defaultdict

    sets, index = {}, defaultdict(list)
    for d, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        k = min(shingle, len(w))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
        for g in sets[d]:
            index[g].append(d)
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for d, s in sets.items():
        for o, both in Counter(o for g in s for o in index[g] if o < d).items():
            if 100 * both >= percent * (len(s) + len(sets[o]) - both):
                x, y = find(d), find(o)
                up[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}
