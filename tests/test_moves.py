"""Rows move whole: sums and pairs of small groups, and the same results when groups count as large."""

import random

import pytest
from pyspark.sql import functions as F

from roadloom.operators import group_sums, minhash_lsh as lsh, similarity_join as sj, standards as st
from roadloom.session import stored


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(5)
    rows = []
    for i in range(80):
        sh = sorted({f"t{rng.randrange(8)}" for _ in range(rng.randrange(0, 5))})
        merch = {f"m{rng.randrange(5)}": rng.randrange(1, 9) for _ in range(rng.randrange(0, 4))}
        driver = None if i % 20 == 0 else "big" if i % 2 else f"d{i % 9}"
        rows.append((i, i, driver, 1, sh, len(sh), merch, sum(merch.values()), sum(v * v for v in merch.values())))
    return stored(lsh.with_signature(spark.createDataFrame(
        rows, "rid bigint, form bigint, driver string, weight bigint, shingles array<string>, n int, "
        "merch map<string,bigint>, w bigint, q bigint"), 16))


@pytest.mark.parametrize("fusion", ["mean", "product"])
def test_large_and_small_groups_have_the_same_sums(monkeypatch, features, fusion):
    found = []
    for largest in (1000, 20, 0):  # all small, some, none
        monkeypatch.setattr(group_sums, "GROUP_ROWS", largest)
        sums = group_sums.fused_distance_sums(features, features, "driver", "cosine", 0.5, fusion)
        found.append(sorted((r.driver, r.rid, r.members, round(r.sum_d, 9)) for r in sums.collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) == 76


def test_small_groups_move_rows_once(features):
    sums = group_sums.fused_distance_sums(features, features, "driver")
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and not any("part#" in line or " v#" in line for line in moved)


def test_pairs_in_groups_of_any_size(monkeypatch, features):
    found = []
    for largest in (1000, 20, 0):
        monkeypatch.setattr(sj, "GROUP_FORMS", largest)
        pairs = sj.fused_edges(features, 0.8, ["driver"])
        found.append(sorted((r.driver, r.a, r.b, round(r.d, 9)) for r in pairs.collect()))
    assert found[0] and found[0] == found[1] == found[2]


def test_pairs_with_plans_are_dealt_by_their_number(monkeypatch, features):
    monkeypatch.setattr(st, "TASK_PAIRS", 50)
    plans = features.limit(5).select(F.col("rid").alias("std_no"), "shingles", "n", "merch", "w", "q")
    assert st.by_route(features, plans).rdd.getNumPartitions() == 9


def test_stored_tables_can_be_read_by_many_tasks(spark):
    kept = stored(spark.range(0, 50_000, 1, 1))
    assert len(kept.inputFiles()) == 3 and kept.count() == 50_000


def test_candidates_move_signatures_only(features):
    found = []
    for block in (1000, 7):  # no crowd, crowds in blocks
        ids = lsh.candidate_ids(features, 8, 2, block)
        plan = ids._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in plan.splitlines() if "Exchange" in line or "FileScan" in line]
        assert moved and not any("shingles#" in line or "merch#" in line or "bands#" in line for line in moved)
        found.append(sorted((r.a, r.b, r.share) for r in ids.collect()))
    sig = {r.form: r.sig for r in features.collect() if r.sig}
    want = []
    for a in sig:
        for b in sig:
            share = sum(sig[a][i:i + 2] == sig[b][i:i + 2] for i in range(0, 16, 2)) / 8
            if a < b and share >= (1 / 8) ** (1 / 2):
                want.append((a, b, share))
    assert want and found[0] == found[1] == sorted(want)


def test_routes_stay_in_place_unless_repeated(features):
    plans = features.limit(5).select(F.col("rid").alias("std_no"), "shingles", "n", "merch", "w", "q")
    routes = features.withColumn("sroute", F.lit("s"))
    once = st.standard_pair_sums(routes, plans)
    assert not [x for x in once._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x and "tokens#" in x]
    names = ["rid", "std_no", *st.SUMS]
    single = {tuple(r) for r in once.select(*names).collect()}
    again = stored(routes.unionByName(routes.filter("rid = 7")))
    doubled = {tuple(r) for r in st.standard_pair_sums(again, plans).select(*names).collect()}
    joined = {tuple(r) for r in st._joined_pair_sums(again, plans).select(*names).collect()}
    assert single and doubled == joined and len(doubled) == len(single)
    assert {r for r in doubled if r[0] != 7} == {r for r in single if r[0] != 7} and doubled != single
