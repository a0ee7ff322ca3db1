"""Flat files by ranges."""

import numpy as np
import pytest

from tessera.llm import token_counts


@pytest.mark.parametrize("block_bytes", [2, 7, 1001, 1 << 20])
def test_files_are_read_by_ranges(spark, tmp_path, block_bytes):
    rng = np.random.default_rng(2)
    lengths = {name: rng.integers(0, 400, 60).tolist() for name in ("a", "b")}
    if block_bytes < 1000:
        lengths = {name: x[:4] for name, x in lengths.items()}
    for name, docs in lengths.items():
        ids = np.concatenate([np.append(rng.integers(1, 60_000, n), 0) for n in docs]).astype("<u2")
        (tmp_path / f"{name}.bin").write_bytes(ids.tobytes() + b"\x07")  # and half an id
    blocks = token_counts.read_files(spark, str(tmp_path), block_bytes)
    sizes = [len(r.data) for r in blocks.collect()]
    assert max(sizes) <= block_bytes and all(s % 2 == 0 for s in sizes)
    got = {}
    for r in token_counts.scan(blocks, 0).collect():
        got.setdefault(r.file, {})[r.doc] = r.n_tokens
    assert sorted([d[k] for k in sorted(d)] for d in got.values()) == sorted(lengths.values())


def test_content_is_not_read_on_the_way(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(bytes(100))
    plan = token_counts.read_files(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan
    with pytest.raises(ValueError):
        token_counts.read_files(spark, str(tmp_path), 1)
