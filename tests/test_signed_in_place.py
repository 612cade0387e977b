"""Signatures of loads are made in the route's row, the same as by moving loads; repeated routes have those of all their rows."""

import random

import pytest
from pyspark.sql import functions as F

from roadloom.operators import minhash_lsh as lsh
from roadloom.session import stored


def _features(spark):
    rng = random.Random(11)
    rows = [(i, "s", {f"m{rng.randrange(6)}": rng.randrange(0, 40) for _ in range(rng.randrange(0, 5))}) for i in range(120)]
    rows += [(7, "t", {"m9": 3}), (None, "u", {"m1": 5}), (500, "v", None), (501, "w", {"m1": None, "é": 2})]
    return stored(spark.createDataFrame(rows, "rid bigint, sroute string, merch map<string,bigint>"))


@pytest.mark.parametrize("sign", [lsh.with_merch_signature, lsh.with_weighted_signature])
def test_same_signatures_without_moving_routes(monkeypatch, spark, sign):
    features = _features(spark)

    def rows(df):
        return sorted((r.rid is None, r.rid, r.sroute, r.msig) for r in df.collect())

    here = sign(features, 12)
    found = rows(here)
    once = sign(features.filter("rid <> 7 AND rid IS NOT NULL"), 12)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and ("merch#" in line or "min(" in line)]
    monkeypatch.setattr(lsh, "MERCH_KINDS", 0)
    moved = sign(features, 12)
    assert moved.columns == here.columns and rows(moved) == found and len(found) == 124
    assert [r[3] for r in found if r[1] in (None, 500)] == [[], []]


def test_lines_wait_for_no_shuffle_with_suppliers(spark, tmp_path):
    from roadloom.sources import star

    tables = {
        "nation": ("n_nationkey long, n_name string", [(0, "A"), (1, "B")]),
        "supplier": ("s_suppkey long, s_nationkey long", [(1, 0), (2, 1)]),
        "customer": ("c_custkey long, c_nationkey long", [(5, 1)]),
        "orders": ("o_orderkey long, o_custkey long", [(9, 5)]),
        "lineitem": (
            "l_orderkey long, l_linenumber int, l_shipdate date, l_partkey long, l_suppkey long, l_extendedprice double",
            [(9, 2, None, 3, 2, 1.0), (9, 1, None, 3, 1, 1.0), (9, 3, None, 3, 7, 1.0)],
        ),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the sizes are overestimated
    try:
        routes = star.actual_routes(spark, str(tmp_path), False)
        plan = routes._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(l_suppkey" in line]
        assert [tuple(r) for r in routes.select("rid", "driver", "sroute", F.transform("route", lambda t: F.concat(t["from"], t["to"]))).collect()] == [(9, 5, "B", ["AB", "BB"])]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dominant_plans_are_made_once(spark):
    from roadloom.plans import ideal

    rows = [(i, f"d{i % 2}", f"s{i % 3}", {f"p:{i % 4}": 1.0, "i:m": 0.5}, 1.25) for i in range(12)]
    vecs = stored(spark.createDataFrame(rows, "rid bigint, driver string, sroute string, vec map<string,double>, q double"))
    best = ideal.ideal_by_pairs(vecs)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Generate explode(vec" in line]
    assert sorted(r.driver for r in best.collect()) == ["d0", "d1"]
