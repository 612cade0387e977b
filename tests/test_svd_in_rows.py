"""The SVD with its block sent to the rows gives what the joins give, and holds no table of scores."""

from __future__ import annotations

import random

from roadloom import session
from roadloom.operators import vectors as vx


def _vectors(spark):
    rng = random.Random(3)
    rows = [(i, {f"k{rng.randrange(30)}": float(rng.randrange(0, 9)) for _ in range(6)}) for i in range(200)]
    rows += [rows[5], (6, {"k1": 2.5}), (1000, {}), (1001, {"k2": 0.0})]  # repeated numbers count as one row
    return session.stored(spark.createDataFrame(rows, "rid long, vec map<string,double>"))


def _values(df):
    return {(r.rid, r.component): r.value for r in df.collect()}


def test_block_in_rows_is_the_joined_one(spark, monkeypatch):
    vectors = _vectors(spark)
    here = _values(vx.truncated_svd(vectors, 4))
    joined = _values(vx._joined_svd(vectors, 4, 10, 5))
    assert here.keys() == joined.keys() and len(here) == 800
    assert all(abs(here[k] - joined[k]) < 1e-6 for k in here)
    monkeypatch.setattr(vx, "SVD_BROADCAST_ROWS", 3)
    assert _values(vx.truncated_svd(vectors, 4)).keys() == here.keys()


def test_scores_are_not_kept(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a table of scores was written")

    monkeypatch.setattr(vx.Scratch, "__call__", refuse)
    assert len(_values(vx.truncated_svd(_vectors(spark), 2))) == 400
