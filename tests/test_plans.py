"""Clustering as the plans run it, on the smallest tables."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadloom import catalog
from roadloom.operators import features as ft, minhash_lsh as lsh, similarity_join as sj
from roadloom.plans import recommend
from roadloom.session import cut_lineage
from test_hierarchy import brute

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


def test_recommended_clusters_follow_the_candidates(spark):
    actual = cut_lineage(ft.with_features(catalog._actual(spark, FOLDER), 2))
    sizing = recommend.Sizing(2, 64, 0.1, 2, 9)
    got = {r.rid: r.label for r in recommend.cluster_routes(actual, sizing, catalog.CANONICAL, 0.85).collect()}
    forms = cut_lineage(sj.collapse(actual, []))
    edges = {(r.a, r.b): r.d for r in recommend.candidate_edges(forms, 64, 0.1, catalog.CANONICAL).collect() if r.d <= 0.85}
    want = brute({r.form: r.weight for r in forms.collect()}, edges, 2, 9, 2)
    assert {f: got[f] for f in want} == want
    assert len(got) == actual.count() and len(set(want.values())) > 2


def test_kmeans_labels_are_those_of_the_nearest_centres(spark):
    actual, standard, _, _ = catalog._coded(spark, FOLDER)
    labelled, medoids = recommend.kmeans_recommended(actual, standard, 5)
    rows = labelled.collect()
    slots = sorted({s for r in rows for s in r.vec})
    dense = np.array([[r.vec.get(s, 0) for s in slots] for r in rows], float)
    label = np.array([r.label for r in rows])
    centres = np.array([dense[label == k].mean(axis=0) for k in sorted(set(label))])
    far = ((dense[:, None, :] - centres[None]) ** 2).sum(axis=2)
    own = far[np.arange(len(rows)), np.searchsorted(sorted(set(label)), label)]
    assert (own <= far.min(axis=1) * 1.02 + 1e-6).all()
    unit = dense / np.linalg.norm(dense, axis=1, keepdims=True)
    for m in medoids.collect():
        inside = unit[label == m.label]
        sums = len(inside) - inside @ inside.sum(axis=0)
        assert m.sum_d == pytest.approx(sums.min(), abs=1e-6) and m.members == len(inside)


def test_loads_apart_by_at_most_a_length(spark):
    """Every pair within the distance, with and without common items, and no other."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(80):
        merch = {f"i{j}": int(rng.integers(1, 9)) for j in rng.choice(12, rng.integers(0, 4), replace=False)}
        rows.append((i, int(i % 2), 1, [], 0, merch, sum(merch.values()), sum(v * v for v in merch.values())))
    forms = spark.createDataFrame(rows, "form long, driver int, weight long, shingles array<string>, n int, merch map<string,bigint>, w long, q long")
    got = {(r.a, r.b) for r in sj.l2_pairs(forms, 6.0, ["driver"]).select(F.col("pa.form").alias("a"), F.col("pb.form").alias("b")).collect()}
    want = set()
    for r in rows:
        for s in rows:
            if r[0] < s[0] and r[1] == s[1] and sum((r[5].get(k, 0) - s[5].get(k, 0)) ** 2 for k in r[5].keys() | s[5].keys()) <= 36:
                want.add((r[0], s[0]))
    assert got == want and len(want) > 50


def test_signatures_of_nothing_stay_empty(spark):
    empty = spark.createDataFrame([(1, [])], "rid long, shingles array<string>")
    assert lsh.with_signature(empty, 8).first().sig == []
