"""Groups that fit a task are added up in arrays: as by brute force, whatever the chunks, with repeated and unnamed rows."""

import random

import pytest

from roadloom.operators import group_sums
from roadloom.session import stored


def _rows():
    rng = random.Random(4)
    rows = []
    for i in range(60):
        merch = {f"m{rng.randrange(5)}": rng.randrange(1, 9) for _ in range(rng.randrange(0, 4))}
        sig = [] if i % 13 == 0 else [rng.randrange(3) for _ in range(6)]
        rows.append((i, f"g{i * i % 7}", sig, merch, sum(v * v for v in merch.values())))
    return rows + [rows[8], (None, "g1", [0] * 6, {"m1": 2}, 4), (70, None, [1] * 6, {}, 0)]


def _sims(x, y):
    route = sum(a == b for a, b in zip(x[2], y[2])) / 6
    dot = sum(x[3][k] * y[3][k] for k in x[3] if k in y[3])
    return route, dot / (x[4] * y[4]) ** 0.5 if dot else 0.0


@pytest.mark.parametrize("fusion", ["mean", "product"])
def test_sums_are_those_of_every_pair(monkeypatch, spark, fusion):
    rows = _rows()
    features = stored(spark.createDataFrame(rows, "rid bigint, g string, sig array<bigint>, merch map<string,bigint>, q bigint"))
    want = {}
    for x in rows:
        if x[1] is None:
            continue
        pairs = [_sims(x, y) for y in rows if y[1] == x[1]]
        n, route, cos, both = want.get((x[1], x[0]), (len(pairs), 0.0, 0.0, 0.0))
        want[x[1], x[0]] = (n, route + sum(r for r, _ in pairs), cos + sum(c for _, c in pairs), both + sum(r * c for r, c in pairs))
    for chunk, dense in ((4096, 1 << 23), (3, 2)):
        monkeypatch.setattr(group_sums, "CHUNK_ROWS", chunk)
        monkeypatch.setattr(group_sums, "DENSE_CELLS", dense)
        sums = group_sums.fused_distance_sums(features, features, "g", "cosine", 0.5, fusion)
        assert "Window" not in sums._jdf.queryExecution().executedPlan().toString()
        got = {(r.g, r.rid): (r.members, r.sum_d) for r in sums.collect()}
        assert got.keys() == want.keys()
        for k, (n, route, cos, both) in want.items():
            d = (n - route) / 2 + (n - (cos + n) / 2) / 2 if fusion == "mean" else (n - route - cos + both) / 2
            assert got[k][0] == n and got[k][1] == pytest.approx(d, abs=1e-9)
