"""Edges over all routes: met by shingle or by equal load, the same as by measuring every pair, and without a join on items."""

from __future__ import annotations

import random

from roadloom.operators import similarity_join as sj

SCHEMA = "form long, weight long, shingles array<string>, n int, merch map<string,bigint>, w bigint, q bigint"


def _row(form, shingles, merch):
    amounts = list(merch.values())
    whole = None not in amounts
    return (form, 1, shingles, len(shingles), merch, sum(amounts) if whole else None, sum(x * x for x in amounts) if whole else None)


def _rows():
    draw = random.Random(3)
    rows = [
        _row(form, draw.sample("pqrstu", draw.randint(0, 4)), {i: draw.randint(0, 3) for i in draw.sample("ijk", draw.randint(0, 3))})
        for form in range(120)
    ]
    rows += [_row(200, ["p"], {"i": None}), _row(201, ["p"], {"i": 2}), _row(202, ["x"], {"i": 2, "j": 0}), _row(None, ["p"], {"i": 2})]
    return rows + [_row(5, ["q"], {"i": 1}), _row(203, [], {}), _row(204, [], {})]  # form 5 is there twice


def _every_pair(rows, reach):
    out = []
    for k, x in enumerate(rows):
        for y in rows[k + 1 :]:
            if x[0] is None or y[0] is None or x[0] == y[0]:
                continue
            inter = len(set(x[2]) & set(y[2]))
            union = x[3] + y[3] - inter
            ruzicka = 0.0
            if x[5] is not None and y[5] is not None:
                smin = sum(min(x[4][i], y[4][i]) for i in x[4] if i in y[4])
                ruzicka = smin / (x[5] + y[5] - smin) if x[5] + y[5] - smin else 0.0
            d = 0.5 * (1 - (inter / union if union else 0.0)) + 0.5 * (1 - ruzicka)
            if d <= reach + sj.EPS:
                out.append((min(x[0], y[0]), max(x[0], y[0]), round(d, 9)))
    return sorted(out)


def test_edges_are_those_of_every_pair(monkeypatch, spark):
    rows = _rows()
    forms = spark.createDataFrame(rows, SCHEMA)
    for reach, block in ((0.5, 2_000), (0.5, 7), (0.4, 7)):
        monkeypatch.setattr(sj, "BLOCK_ROWS", block)
        found = sorted((r["a"], r["b"], round(r["d"], 9)) for r in sj.fused_edges(forms, reach, []).collect())
        assert found == _every_pair(rows, reach) and len(found) > 20


def test_no_join_on_items(monkeypatch, spark):
    def refused(*_):
        raise AssertionError("a join on items: there are few, so almost all pairs of routes meet")

    monkeypatch.setattr(sj, "ruzicka_pairs", refused)
    sj.fused_edges(spark.createDataFrame(_rows(), SCHEMA), 0.5, [])
