"""The K-means answer to its file, largest distances, clashes, weighted signatures and id lists, against brute force."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadloom import catalog
from roadloom.operators import diameter, minhash_lsh as lsh, reports, similarity_join as sj, vectors as vx
from roadloom.plans import recommend
from roadloom.session import Scratch, cut_lineage

FOLDER = "/root/testdata/sf0.001"


def _sparse(spark, dense, groups):
    rows = [
        (g, i, {int(s): int(v) for s, v in enumerate(row) if v}, int((row * row).sum()))
        for i, (g, row) in enumerate(zip(groups, dense))
    ]
    return spark.createDataFrame(rows, "g string, rid long, vec map<int,bigint>, q long")


@pytest.mark.parametrize("slots, levels, probes", [(4, 12, 3), (1, 2, 1), (2, 30, 1)])
def test_largest_distance_is_that_of_all_pairs(spark, slots, levels, probes):
    rng = np.random.default_rng(5)
    dense = rng.integers(0, 6, (120, 9)) * (rng.random((120, 9)) < 0.5)
    dense[:, 0] = rng.integers(1, 4, 120)
    dense[10] = dense[11] = dense[12] * 2
    dense[13] = 0
    groups = ["a" if i < 90 else "b" if i < 119 else "alone" for i in range(120)]
    got = {r.g: r.max_dist for r in diameter.largest_distance(_sparse(spark, dense, groups), "g", slots, levels, probes).collect()}
    want = {}
    for g in set(groups):
        rows = np.array([d for d, h in zip(dense, groups) if h == g and d.any()], float)
        unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
        want[g] = 1 - (unit @ unit.T).min()
    assert got.keys() == want.keys() and got["alone"] == pytest.approx(0, abs=1e-9)
    assert all(got[g] == pytest.approx(want[g], abs=1e-9) for g in want)
    none = diameter.largest_distance(_sparse(spark, dense, groups).limit(0), "g")
    assert none.columns == ["g", "max_dist"] and none.count() == 0


def test_weighted_signatures_estimate_the_weighted_jaccard(spark):
    """Within four standard errors for every pair, small and huge quantities alike; none for an empty load."""
    rng = np.random.default_rng(8)
    rows = [(i, {f"i{j}": int(rng.integers(1, 10 ** (1 + 3 * (i % 4)))) for j in range(6) if rng.random() < 0.8}) for i in range(24)]
    rows += [(24, rows[0][1]), (25, {}), (26, {"i0": 0})]
    loads = spark.createDataFrame(rows, "rid long, merch map<string,bigint>")
    size = 256
    got = {r.rid: r.msig for r in lsh.with_weighted_signature(loads, size).collect()}
    assert got[24] == got[0] and got[25] == [] and got[26] == []
    errors = []
    for i, a in rows[:24]:
        for j, b in rows[:24]:
            if i < j and a and b:
                keys = a.keys() | b.keys()
                exact = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
                seen = np.mean([x == y for x, y in zip(got[i], got[j])])
                errors.append(abs(seen - exact) / max(np.sqrt(exact * (1 - exact) / size), 1 / size))
    assert max(errors) < 4.5 and np.mean(errors) < 1.2


@pytest.mark.parametrize("labels, stopped, placed", [
    ([3, 1, 2, 1, 3], 3, [True, True, True, False, False]),
    ([4, 3, 2, 1, 0], None, [True] * 5),
    ([2, 2, 2, 2, 2], 1, [True, False, False, False, False]),
])
def test_walk_stops_at_the_first_label_seen_before(spark, labels, stopped, placed):
    rows = spark.createDataFrame([(i, l, 0.5) for i, l in enumerate(labels)], "std_no long, label int, dist double")
    out = recommend.first_clash(rows).orderBy("std_no").collect()
    assert [r.placed for r in out] == placed
    assert {r.stopped_at for r in out} == {stopped} and {r.valid for r in out} == {stopped is None}


@pytest.mark.parametrize("name, reach", [("WORSE_PART", 0.9), ("BETTER_PART", 0.6)])
def test_own_metric_finds_every_pair_within_reach(spark, name, reach):
    """Loads and routes at random, some empty; all pairs of a driver by plain Python."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(90):
        route = [f"s{j}" for j in rng.choice(8, rng.integers(0, 5), replace=False)]
        merch = {f"i{j}": int(rng.integers(1, 6)) for j in rng.choice(7, rng.integers(0, 4), replace=False)}
        rows.append((i, int(i % 3 > 0), 1, route, len(route), merch, sum(merch.values()), sum(v * v for v in merch.values())))
    forms = spark.createDataFrame(rows, "form long, driver int, weight long, shingles array<string>, n int, merch map<string,bigint>, w long, q long")
    got = {(r.a, r.b): r.d for r in sj.metric_edges(forms, getattr(catalog, name), reach, ["driver"]).collect()}
    want = {}
    for r in rows:
        for s in rows:
            if r[0] < s[0] and r[1] == s[1]:
                union, keys = set(r[3]) | set(s[3]), r[5].keys() | s[5].keys()
                jac = len(set(r[3]) & set(s[3])) / len(union) if union else 0
                ruz = sum(min(r[5].get(k, 0), s[5].get(k, 0)) for k in keys) / sum(max(r[5].get(k, 0), s[5].get(k, 0)) for k in keys) if keys else 0
                d = (max if name == "WORSE_PART" else min)(1 - jac, 1 - ruz)
                if d <= reach + 1e-9:
                    want[r[0], s[0]] = d
    assert got.keys() == want.keys() and len(want) > 20
    assert all(got[p] == pytest.approx(want[p]) for p in want)


def test_metric_without_a_bound_is_refused(spark):
    forms = spark.createDataFrame([], "form long, shingles array<string>, n int, merch map<string,bigint>, w long, q long")
    with pytest.raises(ValueError, match="needs a bound"):
        sj.metric_edges(forms, sj.Metric(lambda s: s["inter"]), 0.5, [])
    with pytest.raises(ValueError, match="says nothing"):
        sj.metric_edges(forms, sj.Metric(lambda s: s["inter"], lambda reach: 0.0), 0.5, [])


def test_walk_over_no_plans(spark):
    rows = spark.createDataFrame([], "std_no long, label int, dist double")
    assert recommend.first_clash(rows).count() == 0


def test_id_lists_hold_every_id_once_in_order(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(95, -1, -1)] + [("b", 7), ("c", 1), ("c", 0)], "driver string, rid long")
    out = reports.id_lists(rows, "driver", "rid", 10).orderBy("driver", "chunk").collect()
    hot = [r.ids for r in out if r.driver == "hot"]
    assert sum(hot, []) == list(range(96)) and [len(h) for h in hot] == [10] * 9 + [6]
    assert [(r.driver, r.chunk, r.ids) for r in out if r.driver != "hot"] == [("b", 0, [7]), ("c", 0, [0, 1])]


def test_sparse_ml_vectors_are_those_of_the_maps(spark):
    rows = spark.createDataFrame([(1, {7: 2, 0: 5}), (2, {}), (3, {3: 0, 9: 1})], "rid long, vec map<int,bigint>")
    with Scratch(spark) as kept:
        got = {r.rid: r.features for r in vx.ml_vectors(rows, 10, kept).collect()}
    assert {k: (v.size, dict(zip(v.indices.tolist(), v.values.tolist()))) for k, v in got.items()} == {
        1: (10, {0: 5.0, 7: 2.0}), 2: (10, {}), 3: (10, {9: 1.0})}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")
def test_kmeans_answer_is_the_same_for_any_partitioning_and_decodes_to_the_routes(spark):
    actual, standard, cities, items = catalog._coded(spark, FOLDER)
    labelled, clustroids = recommend.kmeans_recommended(actual, standard, 6)
    again, _ = recommend.kmeans_recommended(actual.repartition(13).orderBy(F.desc("rid")), standard, 6)
    label = {r.rid: r.label for r in labelled.collect()}
    assert label == {r.rid: r.label for r in again.collect()} and len(set(label.values())) == 6
    planned = vx.positional_vectors(standard, cities, items, "std_no")
    matches = cut_lineage(recommend.clustroid_matches(labelled, clustroids, planned))
    chosen = recommend.numbered(matches)
    rows = chosen.collect()
    vecs = {r.rid: r for r in labelled.collect()}
    plans = sorted(planned.collect(), key=lambda r: r.std_no)
    for r in rows:
        a = vecs[r.rid]
        sims = [sum(v * p.vec.get(k, 0) for k, v in a.vec.items()) / np.sqrt(float(a.q)) / np.sqrt(float(p.q)) for p in plans]
        assert r.std_no == plans[int(np.argmax(np.round(sims, 9)))].std_no and r.sim == pytest.approx(max(sims), abs=1e-9)
    own = len({r.std_no for r in rows}) == len(rows)
    assert {r.by_plan for r in rows} == {own}
    assert [r.new_no for r in sorted(rows, key=lambda r: r.std_no if own else r.label)] == list(range(6))
    decoded = {r.rid: r.route for r in recommend.decoded_clustroids(chosen, labelled, cities, items).collect()}
    wanted = {r.rid: r.route for r in actual.filter(F.col("rid").isin(list(decoded))).collect()}
    assert len(decoded) == 6
    for rid, route in decoded.items():
        assert [(t["from"], t["to"], t["merchandise"]) for t in route] == [(t["from"], t["to"], t["merchandise"]) for t in wanted[rid]]


def test_numbering_follows_plans_that_pair_off(spark):
    rows = spark.createDataFrame([(0, 9), (1, 4), (2, 6)], "label int, std_no long")
    assert {(r.label, r.new_no) for r in recommend.numbered(rows).collect()} == {(1, 0), (2, 1), (0, 2)}
    twice = spark.createDataFrame([(0, 9), (1, 4), (2, 4)], "label int, std_no long")
    assert {(r.label, r.new_no) for r in recommend.numbered(twice).collect()} == {(0, 0), (1, 1), (2, 2)}
