"""Token counts by separator scan over flat, unindexed token files.

A flat file is a run of little-endian token ids; ``eod`` ends each document.
There is no index: a file comes as blocks (file, block, data) of any sizes that
are whole ids.  A task finds the separators of a block with one vectorised
comparison and emits what the block knows by itself: the lengths of the
documents that begin and end inside, the tokens before its first and after its
last separator (``head``, ``tail``) and how many separators it has.  A prefix
scan over these small rows, per file, stitches the boundaries: the document
that ends at a block's first separator has the tails of the blocks since the
previous separator plus the head, and the running separator count is the
document's number.  A document without a final separator at the end of a file
counts too if it has tokens.

``read_files`` makes blocks of flat files of any size: only lengths are read on
the way to the tasks, which read ranges.  A prefix scan within a file runs in two levels, segments of ``SEGMENT`` blocks
first, so that a file of any number of blocks is no single window.

``pack`` makes such blocks from texts for the query: every task writes one
flat file of its documents.

Rows: a NULL text is an empty document with 0 tokens; an empty table gives no
rows; repeated rows are documents of their own; other columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._common import batch, map_arrow, written

#: Ids of a block that ``pack`` writes.
BLOCK_TOKENS = 1 << 19
SEGMENT = 1024


def _scan(eod: int, dtype: str):
    schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("n_sep", pa.int64()), ("head", pa.int64()), ("tail", pa.int64()), ("inner", pa.list_(pa.int64()))])

    def run(batches):
        for b in batches:
            rows = []
            for file, block, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                ids = np.frombuffer(data.as_py() or b"", dtype)
                at = np.flatnonzero(ids == eod)
                if len(at):
                    rows.append((file, block, len(at), int(at[0]), len(ids) - int(at[-1]) - 1, np.diff(at) - 1))
                else:
                    rows.append((file, block, 0, 0, len(ids), np.empty(0, np.int64)))
            if rows:
                yield batch(schema, *zip(*rows, strict=True))

    return run


def scan(blocks: DataFrame, eod: int, dtype: str = "<u2") -> DataFrame:
    """(file, doc, n_tokens): length of the doc-th document (from 0) of every
    file of ``blocks(file, block, data)``."""
    found = map_arrow(blocks.select(F.col("file").cast("bigint"), F.col("block").cast("bigint"), "data"), _scan(eod, dtype),
                      "file bigint, block bigint, n_sep bigint, head bigint, tail bigint, inner array<bigint>")
    found = written(found.withColumn("segment", F.floor(F.col("block") / SEGMENT)), "separators")
    small = found.drop("inner")

    def before(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
        """Exclusive prefix scan: separators so far, tokens since the last one."""
        w = Window.partitionBy(*keys).orderBy(order)
        past = w.rowsBetween(Window.unboundedPreceding, -1)
        run = F.sum((F.col("n_sep") > 0).cast("int")).over(past)
        rows = rows.withColumn("seps", F.coalesce(F.sum("n_sep").over(past), F.lit(0))).withColumn("run", F.coalesce(run, F.lit(0)))
        rows = rows.withColumn("total", F.coalesce(F.sum("tail").over(past), F.lit(0)))
        # tails ahead of the last block with a separator; those from it on are open
        mark = F.max(F.when(F.col("n_sep") > 0, F.col("total"))).over(past)
        return rows.withColumn("open", F.col("total") - F.coalesce(mark, F.lit(0)))

    inside = before(small, ["file", "segment"], "block").select("file", "segment", "block", "seps", "open", "run")
    # what a segment is to the ones after it
    last = Window.partitionBy("file", "segment").orderBy(F.desc("block"))
    ends = before(small, ["file", "segment"], "block").withColumn("r", F.row_number().over(last)).where("r = 1")
    ends = ends.select("file", "segment", (F.col("seps") + F.col("n_sep")).alias("n_sep"),
                       F.when(F.col("n_sep") > 0, F.col("tail")).otherwise(F.col("open") + F.col("tail")).alias("tail"))
    outer = before(ends, ["file"], "segment").select("file", "segment", F.col("seps").alias("seps0"), F.col("open").alias("open0"))
    place = inside.join(outer, ["file", "segment"]).select("file", "block", (F.col("seps0") + F.col("seps")).alias("first"),
                                                          (F.col("open") + F.when(F.col("run") == 0, F.col("open0")).otherwise(0)).alias("open"))
    stitched = found.join(written(place, "block-places"), ["file", "block"])
    lengths = F.concat(F.array(F.col("head") + F.col("open")), F.col("inner"))
    closed = stitched.where("n_sep > 0").select("file", "first", F.posexplode(lengths).alias("k", "n_tokens")).select("file", (F.col("first") + F.col("k")).alias("doc"), "n_tokens")
    rest = (ends.groupBy("file").agg(F.sum("n_sep").alias("doc"), F.max("segment").alias("segment"))
            .join(ends.select("file", "segment", "tail"), ["file", "segment"]).join(outer, ["file", "segment"]))
    own = ends.select("file", "segment", (F.col("n_sep") > 0).alias("cut"))
    rest = rest.join(own, ["file", "segment"]).select("file", "doc", (F.col("tail") + F.when(F.col("cut"), 0).otherwise(F.col("open0"))).alias("n_tokens"))
    return closed.unionByName(rest.where("n_tokens > 0"))


def _ranges(batches):
    """Bytes of (path, start, length) ranges, read from the shared store."""
    from pyarrow import fs

    schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("data", pa.binary())])
    for b in batches:
        for file, path, block, start, length in zip(*(b.column(c).to_pylist() for c in ("file", "path", "block", "start", "length")), strict=True):
            store, name = fs.FileSystem.from_uri(path)
            with store.open_input_file(name) as f:
                yield batch(schema, [file], [block], [f.read_at(length, start)])


def read_files(spark, path: str, block_bytes: int = 1 << 20, dtype: str = "<u2") -> DataFrame:
    """Blocks (file, block, data) of the flat files below ``path``, in a store
    that tasks can open.  Spark lists the files and their lengths; a file of any
    size is dealt out as ranges of whole ids, each read by itself in some task.
    An incomplete id at the end of a file is left out."""
    width = np.dtype(dtype).itemsize
    block_bytes = block_bytes // width * width
    if not block_bytes:
        raise ValueError("a block holds at least one id")
    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("path").alias("file"), "path", (F.floor(F.col("length") / width) * width).alias("size"))
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), F.col("size") - 1), F.lit(block_bytes).cast("bigint"))
    cut = files.select("file", "path", "size", F.posexplode(starts).alias("block", "start"))
    cut = cut.select("file", "path", F.col("block").cast("bigint").alias("block"), "start", F.least(F.lit(block_bytes), F.col("size") - F.col("start")).cast("bigint").alias("length"))
    return cut.repartition("path", "start").mapInArrow(_ranges, "file bigint, block bigint, data binary")


def read_ranks(spark, path: str) -> dict[bytes, int]:
    """A rank file (base64 token, rank per line) through Spark's reader."""
    where = path if ":/" in path else f"file://{path}"
    lines = spark.read.text(where, wholetext=True).first()[0].split("\n")
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}


def _pack(spec, eod: int, dtype: str, block_tokens: int):
    schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("data", pa.binary()), ("doc", pa.int64()), ("doc_id", pa.int64())])

    def run(batches):
        import tiktoken
        from pyspark import TaskContext

        pattern, ranks = spec.value
        codec = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        file, block, doc = TaskContext.get().partitionId(), 0, 0
        held = np.empty(0, dtype)
        for b in batches:
            ids, parts = b.column("doc_id").to_pylist(), [held]
            for t in b.column("text"):
                text = t.as_py()
                parts.append(np.array([*(codec.encode_ordinary(text) if text else ()), eod], dtype))
            held = np.concatenate(parts)
            full = len(held) // block_tokens
            data = [held[k * block_tokens:(k + 1) * block_tokens].tobytes() for k in range(full)]
            held = held[full * block_tokens:]
            none = [None] * len(ids)
            yield batch(schema, [file] * (full + len(ids)), [*range(block, block + full), *none], [*data, *none],
                        [*([None] * full), *range(doc, doc + len(ids))], [*([None] * full), *ids])
            block, doc = block + full, doc + len(ids)
        if len(held):
            yield batch(schema, [file], [block], [held.tobytes()], [None], [None])

    return run


def pack(docs: DataFrame, spec: tuple[str, dict[bytes, int]], eod: int, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(blocks(file, block, data), order(file, doc, doc_id)): the texts as flat
    token files, and which document was written where; one written table, so
    both stay consistent when a task is run again."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # one vocabulary file
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = written(map_arrow(rows, _pack(shared, eod, dtype, block_tokens), "file bigint, block bigint, data binary, doc bigint, doc_id bigint"), "flat-tokens")
    return out.where("block is not null").select("file", "block", "data"), out.where("doc is not null").select("file", "doc", "doc_id")


def count(docs: DataFrame, spec: tuple[str, dict[bytes, int]], eod: int) -> DataFrame:
    """(doc_id, n_tokens) of every row, counted from its flat token file."""
    blocks, order = pack(docs, spec, eod)
    return order.join(scan(blocks, eod), ["file", "doc"]).select("doc_id", "n_tokens")
