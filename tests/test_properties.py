"""Brute force against the plans that avoid pairs, and invariants."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadloom.operators import components as cc, density, group_sums, minhash_lsh as lsh
from roadloom.operators import similarity_join as sj, vectors as vx
from roadloom.operators.ordering import dense_index


def _forms(spark, n=120, seed=3, hot=False):
    """Random shingle sets and loads; ``hot`` gives every row one common, popular token."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        sh = sorted({f"t{rng.randrange(25)}" for _ in range(rng.randrange(0, 7))})
        if hot:
            sh = ["all"] + sh[:1]
        merch = {f"m{rng.randrange(6)}": rng.randrange(1, 20) for _ in range(rng.randrange(0, 4))}
        rows.append((i, "D" if i % 3 else "E", 1, sh, len(sh), merch, sum(merch.values()),
                     sum(v * v for v in merch.values())))
    return rows, spark.createDataFrame(
        rows,
        "form bigint, driver string, weight bigint, shingles array<string>, n int, "
        "merch map<string,bigint>, w bigint, q bigint",
    )


def _jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 0.0


def _ruzicka(a, b):
    low = sum(min(a[k], b[k]) for k in a.keys() & b.keys())
    high = sum(a.values()) + sum(b.values()) - low
    return low / high if high else 0.0


def _cosine(r, s):
    dot = sum(r[5][k] * s[5][k] for k in r[5].keys() & s[5].keys())
    return dot / (r[7] * s[7]) ** 0.5 if dot else 0.0


@pytest.mark.parametrize("threshold", [0.15, 0.5, 1.0])
def test_jaccard_pairs_complete(spark, threshold):
    rows, df = _forms(spark)
    got = {(r.a, r.b) for r in sj.jaccard_pairs(df, threshold, ["driver"]).select(
        F.col("pa.form").alias("a"), F.col("pb.form").alias("b")).collect()}
    want = {(r[0], s[0]) for r, s in itertools.combinations(rows, 2)
            if r[1] == s[1] and _jaccard(r[3], s[3]) >= threshold - 1e-9}
    assert got == want


def test_weighted_and_cosine_pairs_complete(spark):
    rows, df = _forms(spark)
    key = [F.col("pa.form").alias("a"), F.col("pb.form").alias("b")]
    got = {(r.a, r.b) for r in sj.ruzicka_pairs(df, 0.3, []).select(*key).collect()}
    assert got == {(r[0], s[0]) for r, s in itertools.combinations(rows, 2) if _ruzicka(r[5], s[5]) >= 0.3 - 1e-9}
    got = {(r.a, r.b) for r in sj.cosine_pairs(df, 0.7, []).select(*key).collect()}
    assert got == {(r[0], s[0]) for r, s in itertools.combinations(rows, 2) if _cosine(r, s) >= 0.7 - 1e-9}


def test_popular_tokens_are_cut_into_blocks(spark):
    rows, df = _forms(spark, hot=True)
    pairs = sj.similar_pairs(
        df, sj.set_entries("shingles"), F.lit(0.3) * F.col("n"), [], ["shingles"], unit=True, block_rows=7
    ).select(F.col("pa.form").alias("a"), F.col("pb.form").alias("b")).collect()
    got = [(r.a, r.b) for r in pairs]
    assert len(got) == len(set(got))  # every pair meets in exactly one cell
    want = {(r[0], s[0]) for r, s in itertools.combinations(rows, 2) if _jaccard(r[3], s[3]) >= 0.3}
    assert want <= set(got)


def test_group_sums_match_pairs(spark):
    rows, df = _forms(spark)
    signed = lsh.with_merch_signature(lsh.with_signature(df.withColumnRenamed("form", "rid"), 16), 16)
    local = {r.rid: r for r in signed.collect()}
    for metric in ("cosine", "raw cosine", "jaccard"):
        sums = {r.rid: r.sum_d for r in
                group_sums.fused_distance_sums(signed, signed, "driver", metric, 0.3).collect()}

        def share(x, y):
            return sum(u == v for u, v in zip(x, y)) / 16

        for r in rows:
            total = 0.0
            for s in (s for s in rows if s[1] == r[1]):
                a, b = local[r[0]], local[s[0]]
                cos = _cosine(r, s)
                merch = {"cosine": (cos + 1) / 2, "raw cosine": cos, "jaccard": share(a.msig, b.msig)}[metric]
                total += 0.3 * (1 - share(a.sig, b.sig)) + 0.7 * (1 - merch)
            assert sums[r[0]] == pytest.approx(total)
    product = {r.rid: r.sum_d for r in group_sums.fused_distance_sums(
        signed, signed, "driver", "cosine", fusion="product").collect()}
    for r in rows:
        total = sum(
            (1 - sum(u == v for u, v in zip(local[r[0]].sig, local[s[0]].sig)) / 16) * (1 - _cosine(r, s)) / 2
            for s in rows if s[1] == r[1]
        )
        assert product[r[0]] == pytest.approx(total)


def test_unit_signature_equals_direct_hashing(spark):
    from roadloom.functions import hashing, shape

    _, df = _forms(spark, n=20)
    quick = lsh.with_merch_signature(df.withColumnRenamed("form", "rid"), 8)
    slow = shape.once(quick, "units", hashing.unit_tokens("merch"))
    slow = slow.withColumn("direct", hashing.signature("units", 8, 29))
    assert slow.filter("direct <> msig").count() == 0


def test_signature_estimates_jaccard(spark):
    rows = [(0, [f"x{i}" for i in range(60)]), (1, [f"x{i}" for i in range(30, 90)])]
    df = spark.createDataFrame(rows, "rid bigint, shingles array<string>")
    a, b = [r.sig for r in lsh.with_signature(df, 400).orderBy("rid").collect()]
    estimate = sum(x == y for x, y in zip(a, b)) / 400
    assert abs(estimate - 1 / 3) < 3 * (1 / 3 * 2 / 3 / 400) ** 0.5


def test_lsh_candidates_match_band_counting(spark):
    rows, df = _forms(spark)
    signed = lsh.with_signature(df, 16)
    sig = {r.form: r.sig for r in signed.collect()}
    got = {(r.a, r.b): r.share for r in lsh.candidate_pairs(signed, 8, 2).select(
        F.col("pa.form").alias("a"), F.col("pb.form").alias("b"), "share").collect()}
    want = {}
    for a, b in itertools.combinations(sorted(sig), 2):
        if sig[a] and sig[b]:
            share = sum(sig[a][i:i + 2] == sig[b][i:i + 2] for i in range(0, 16, 2)) / 8
            if share >= (1 / 8) ** (1 / 2):
                want[a, b] = share
    assert got == want


def _union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(100, 160)]
    nodes = list(range(80)) + list(range(100, 161))
    got = cc.connected_components(
        spark.createDataFrame(edges, "a bigint, b bigint"),
        spark.createDataFrame([(n,) for n in nodes], "node bigint"),
    )
    assert {r.node: r.component for r in got.collect()} == _union_find(nodes, edges)


def test_dbscan_against_brute_force(spark):
    rng = random.Random(9)
    xs = {i: rng.uniform(0, 30) for i in range(60)}
    weight = {i: 3 if i == 7 else 1 for i in xs}
    near = {(a, b) for a, b in itertools.combinations(xs, 2) if abs(xs[a] - xs[b]) <= 0.6}
    reach = {i: weight[i] + sum(weight[b if a == i else a] for a, b in near if i in (a, b)) for i in xs}
    cores = {i for i in xs if reach[i] >= 4}
    labels = _union_find(cores, [(a, b) for a, b in near if a in cores and b in cores])
    want = dict(labels)
    for i in xs:
        if i not in cores:
            around = [labels[b if a == i else a] for a, b in near if i in (a, b) and (b if a == i else a) in cores]
            want[i] = min(around, default=-1)
    got = density.dbscan(
        spark.createDataFrame([(i, weight[i]) for i in xs], "node bigint, weight bigint"),
        spark.createDataFrame(sorted(near), "a bigint, b bigint"),
        4,
    )
    assert {r.node: r.label for r in got.collect()} == want


def test_hierarchy_finds_planted_clusters(spark):
    rng = random.Random(1)
    xs = [(i, rng.gauss(c * 10, 0.3)) for i, c in enumerate([0] * 20 + [1] * 20 + [2] * 5 + [5])]
    edges = [(a, b, abs(x - y)) for (a, x), (b, y) in itertools.combinations(xs, 2) if abs(x - y) <= 4]
    nodes = spark.createDataFrame([(i, 1) for i, _ in xs], "node bigint, weight bigint")
    df = spark.createDataFrame(edges, "a bigint, b bigint, d double")
    got = {r.node: r.label for r in density.hierarchical_density(nodes, df, 4.0, 6, 4).collect()}
    assert [got[i] for i, _ in xs] == [0] * 20 + [20] * 20 + [40] * 5 + [-1]
    small = density.hierarchical_density(nodes, df.repartition(7), 4.0, 6, 4, max_size=6)
    labels = {r.node: r.label for r in small.collect()}
    sizes = [sum(1 for v in labels.values() if v == label) for label in set(labels.values()) - {-1}]
    assert labels[40] == 40 and max(sizes) <= 6


def test_dense_index(spark):
    df = spark.createDataFrame([(f"k{i:03d}",) for i in range(200)], "k string").repartition(6)
    rows = dense_index(df, "k", "no").collect()
    assert sorted((r.k, r.no) for r in rows) == [(f"k{i:03d}", i) for i in range(200)]


def test_svd_keeps_the_gram_matrix(spark):
    rows = [(0, {"a": 1.0, "b": 1.0}), (1, {"b": 1.0}), (2, {"a": 0.5, "c": 2.0})]
    df = spark.createDataFrame(rows, "rid bigint, vec map<string,double>")
    got = {}
    for r in vx.truncated_svd(df, 3).collect():
        got.setdefault(r.rid, {})[r.component] = r.value
    for a, va in rows:
        for b, vb in rows:
            full = sum(va[k] * vb[k] for k in va.keys() & vb.keys())
            kept = sum(got[a].get(c, 0) * got[b].get(c, 0) for c in range(3))
            assert kept == pytest.approx(full, abs=1e-9)


def test_svd_of_more_features_than_a_driver_would_hold(spark):
    rng = np.random.default_rng(4)
    n, f, rank = 30, 4500, 4
    plain = rng.normal(size=(n, rank)) * [9, 6, 4, 3] @ rng.normal(size=(rank, f)) / f**0.5 + 0.01 * rng.normal(size=(n, f)) / f**0.5
    df = spark.createDataFrame([(i, {f"f{j}": float(plain[i, j]) for j in range(f)}) for i in range(n)], "rid bigint, vec map<string,double>")
    got = np.zeros((n, rank))
    for r in vx.truncated_svd(df, rank, rounds=3).collect():
        got[r.rid, r.component] = r.value
    left, values, _ = np.linalg.svd(plain, full_matrices=False)
    want = left[:, :rank] * values[:rank]
    assert np.linalg.norm(got, axis=0) == pytest.approx(values[:rank], rel=1e-6)
    assert np.abs(np.abs(got) - np.abs(want)).max() < 1e-4
    residue = np.linalg.norm(got @ np.linalg.lstsq(got, plain, rcond=None)[0] - plain)
    assert residue == pytest.approx(np.linalg.norm(values[rank:]), rel=1e-4)


def test_svd_of_nothing(spark):
    assert vx.truncated_svd(spark.createDataFrame([], "rid bigint, vec map<string,double>"), 3).collect() == []


def test_vector_pairs_complete(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        vec = {s: rng.randrange(1, 9) for s in sorted(rng.sample(range(12), 4))}
        rows.append((i, vec, sum(v * v for v in vec.values())))
    df = spark.createDataFrame(rows, "form bigint, vec map<int,bigint>, q bigint")
    got = {(r.a, r.b) for r in vx.vector_cosine_pairs(df, 0.8, [], []).select(
        F.col("pa.form").alias("a"), F.col("pb.form").alias("b")).collect()}
    want = set()
    for r, s in itertools.combinations(rows, 2):
        dot = sum(r[1][k] * s[1][k] for k in r[1].keys() & s[1].keys())
        if dot / (r[2] * s[2]) ** 0.5 >= 0.8 - 1e-9:
            want.add((r[0], s[0]))
    assert got == want
