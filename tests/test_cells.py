"""Cells of many rows: only the tokens of signatures move, and a crowd is opened tile by tile where it lies."""

import numpy as np

from roadloom.operators import minhash_lsh as lsh, similarity_join as sj
from test_edges_by_shingle import SCHEMA, _every_pair, _rows


def test_tokens_hold_the_whole_signature(spark):
    rows = [(i, [f"t{(i * k) % 11}" for k in range(1, 2 + i % 6)]) for i in range(60)]
    forms = lsh.with_signature(spark.createDataFrame(rows, "form bigint, shingles array<string>"), 16).cache()
    packed = lsh._packed_signatures(forms, 8, 2).toArrow()
    size = {r.form: len(set(r.shingles)) for r in forms.collect()}
    assert all(len(x) <= 4 * size[f] for f, x in zip(packed["form"].to_pylist(), packed["sig"].to_pylist()))
    inverse, shift = lsh._solving(16)
    sig = {r.form: (np.array(r.sig) - shift) * inverse % lsh.hashing.MODULUS for r in forms.collect()}
    held = lsh._held_tokens(packed["sig"], 16)
    assert all((held[k] == sig[f]).all() for k, f in enumerate(packed["form"].to_pylist()))
    forms.unpersist()


def test_tiles_and_blocks_find_the_same_edges(monkeypatch, spark):
    rows = _rows()
    forms = spark.createDataFrame(rows, SCHEMA)
    for block, tile in ((1 << 15, 9), (40, 9), (11, 2_000)):
        monkeypatch.setattr(sj, "CELL_BLOCK", block)
        monkeypatch.setattr(sj, "BLOCK_ROWS", tile)
        found = sorted((r["a"], r["b"], round(r["d"], 9)) for r in sj.fused_edges(forms, 0.5, []).collect())
        assert found == _every_pair(rows, 0.5)
