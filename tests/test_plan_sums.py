"""Sums of routes with plans: made in the route's row, the same as by a join, without a table of pairs."""

from __future__ import annotations

import pytest

from roadloom.operators import standards as st
from roadloom.settings import Settings

SCHEMA = "rid long, driver string, sroute string, shingles array<string>, n int, merch map<string,bigint>, w bigint, q bigint"


def _routes(spark):
    rows = [
        (1, "a", "x", ["p", "q"], 2, {"i": 3, "j": 1}, 4, 10),
        (2, "a", "x", ["q", "r"], 2, {"i": 5}, 5, 25),
        (2, "a", "x", ["q", "r"], 2, {"i": 5}, 5, 25),  # there twice
        (2, "b", None, ["p"], 1, {"j": 2}, 2, 4),  # the same number, another driver
        (None, "c", "y", ["r", "s"], 2, {}, 0, 0),
        (4, None, "y", [], 0, {"k": 2, "i": None}, None, None),
        (5, "d", "z", ["none"], 1, {"none": 1}, 1, 1),
    ]
    rows += [(10 + i, f"d{i % 7}", "z", ["p", "s"][: 1 + i % 2], 1 + i % 2, {"ijk"[i % 3]: i}, i, i * i) for i in range(40)]
    return spark.createDataFrame(rows, SCHEMA)


def _plans(spark):
    rows = [
        (1, ["p", "q", "r"], 3, {"i": 4, "j": 2}, 6, 20),
        (3, ["s"], 1, {"k": 1, "i": None}, None, None),
        (7, ["p"], 1, {"k": 9}, 9, 81),
        (7, ["p"], 1, {"k": 9}, 9, 81),
    ]
    return spark.createDataFrame(rows, "std_no long, shingles array<string>, n int, merch map<string,bigint>, w bigint, q bigint")


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_sums_in_rows_are_those_of_the_join(monkeypatch, spark):
    routes, plans = _routes(spark), _plans(spark)
    monkeypatch.setattr(st, "BATCH_MATCHES", 5)
    here = st.standard_pair_sums(routes, plans)
    joined = st._joined_pair_sums(routes, plans)
    assert here.columns == joined.columns and here.dtypes == joined.dtypes
    assert _sorted(here) == _sorted(joined) and here.count() > 40
    monkeypatch.setattr(st, "PLAN_TOKENS", 3)
    assert _sorted(st.standard_pair_sums(routes, plans)) == _sorted(joined)


@pytest.mark.parametrize("settings", [Settings(), Settings(metric="cosine"), Settings(k=2, fusion="product")])
def test_the_best_of_a_row_is_the_best_of_its_pairs(spark, settings):
    routes, plans = _routes(spark), _plans(spark)
    one = st.best_standard(st.standard_similarity(routes, plans, settings, best_only=True))
    every = st.best_standard(st.standard_similarity(routes, plans, settings))
    assert _sorted(one) == _sorted(every) and every.count() > 20


def test_no_table_of_pairs_is_held(spark):
    sums = st.standard_pair_sums(_routes(spark), _plans(spark))
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "std_no" not in "".join(line.split("functions=")[0] for line in plan.splitlines() if "Aggregate(" in line)
