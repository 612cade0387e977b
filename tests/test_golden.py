"""Hand-worked answers on small routes."""

import json

import pytest
from pyspark.sql import functions as F

from roadloom.functions import shape, tuning
from roadloom.operators import driver_scores as ds, features as ft, reports, standards as st
from roadloom.operators import similarity_join as sj, vectors as vx
from roadloom.plans import driver_top, ideal
from roadloom.settings import Settings
from roadloom.sources import route_files as rf


def test_nodes_and_shingles(golden):
    actual, _ = golden
    rows = {r.rid: r for r in ft.with_features(actual, 2).collect()}
    assert rows[0].shingles == ["Rome,Milan", "Milan,Bergamo"]
    assert rows[4].shingles == [] and rows[4].n == 0
    assert rows[5].shingles == ["Rome,Milan", "Milan,Rome"]  # the repeat collapses
    assert rows[0].merch == {"milk": 9, "pens": 4} and rows[0].w == 13 and rows[0].q == 97
    assert rows[5].merch == {} and rows[5].w == 0
    assert ft.with_features(actual, 3).filter("rid = 3").first().shingles == []


def test_profile(golden):
    row = ft.profile(*golden).first()
    assert (row.n_actual, row.n_standard, row.longest, row.shortest) == (6, 3, 3, 0)
    assert (row.max_qty, row.n_drivers, row.n_cities, row.n_items) == (9, 3, 4, 3)


def test_similarity_and_votes(golden):
    actual, standard = golden
    settings = Settings(k=2)
    sims = st.standard_similarity(ft.with_features(actual, 2), ft.with_features(standard, 2), settings)
    found = {(r.rid, r.std_no): r.sim for r in sims.collect()}
    assert found[0, 0] == pytest.approx(1.0)
    # Shingles: 1 of 3 shared; quantities: minima 9 + 4 over maxima 9 + 4.
    assert found[2, 0] == pytest.approx(0.5 / 3 + 0.5)
    # One of two shingles; tea 2 of (2 + 1).
    assert found[3, 10] == pytest.approx(0.5 / 2 + 0.5 * 2 / 3)
    assert not any(rid == 4 for rid, _ in found)
    best = st.best_standard(sims)
    assert {r.rid: r.std_no for r in best.collect()}[3] == 10
    top = driver_top.top_from_similarity(sims, standard, actual)
    lists = {}
    for r in top.orderBy("driver", "rank").collect():
        lists.setdefault(r.driver, []).append(r.std_no)
    assert lists["A"] == [0, 1, 10] and lists["B"] == [10, 0, 1]
    voted = driver_top.top_from_similarity(sims).filter("driver = 'A'").collect()
    assert [r.std_no for r in voted] == [0]


def test_padding_needs_only_five(spark):
    scored = spark.createDataFrame([("A", 7, 2.0), ("A", 2, 1.0)], "driver string, std_no bigint, score double")
    standard = spark.range(12).withColumnRenamed("id", "std_no")
    drivers = spark.createDataFrame([("A",), ("B",)], "driver string")
    rows = ds.top_standards(scored, standard, drivers).orderBy("driver", "rank").collect()
    assert [r.std_no for r in rows if r.driver == "A"] == [7, 2, 0, 1, 3]
    assert [r.std_no for r in rows if r.driver == "B"] == [0, 1, 2, 3, 4]


def test_own_standard(golden):
    actual, standard = golden
    sims = st.standard_similarity(ft.with_features(actual, 2), ft.with_features(standard, 2), Settings())
    costs = reports.standard_distances(st.own_standard(sims, standard), standard)
    means = {r.std_no: r.mean_dist for r in costs.collect()}
    assert means[0] == pytest.approx(0.0)
    assert means[1] == pytest.approx(1 - 0.5 * 1 / 2)


def test_collapse_counts_copies(golden):
    actual, _ = golden
    forms = {r.form: r.weight for r in sj.collapse(ft.with_features(actual, 2), ["driver"]).collect()}
    assert forms == {0: 2, 2: 1, 3: 1, 4: 1, 5: 1}
    features = ft.with_features(actual, 2)
    members = sj.members_of(features, sj.collapse(features, ["driver"]), ["driver"])
    assert {r.rid: r.form for r in members.collect()}[1] == 0


def test_positional_round_trip(golden):
    actual, standard = golden
    cities, items = vx.code_tables(actual, standard)
    rows = vx.positional_rows(actual, cities, items)
    assert rows.filter("rid = 4").count() == 0
    back = {r.rid: r.route for r in vx.decode_positional(rows, cities, items).collect()}
    assert [(t["from"], t["to"], t["merchandise"]) for t in back[0]] == [
        ("Rome", "Milan", {"milk": 4, "pens": 4}),
        ("Milan", "Bergamo", {"milk": 5}),
    ]
    dense = vx.ml_vectors(vx.positional_vectors(actual, cities, items), 15)
    vec = dense.filter("rid = 3").first().features.toArray().tolist()
    # Cities Bergamo 1, Milan 2, Rome 3, Turin 4; items milk, pens, tea.
    assert vec == [4.0, 2.0, 0.0, 0.0, 2.0] + [0.0] * 10


def test_pair_plan(golden):
    actual, _ = golden
    vecs = ideal.pair_features(actual)
    dominant = {r.driver: (r.sroute, r.mass) for r in ideal.dominant_standard(vecs).collect()}
    assert dominant["A"] == ("s0", pytest.approx(1.0))  # two equal routes: (4 - 2) / 2
    assert {r.driver: r.rid for r in ideal.ideal_by_pairs(vecs).collect()}["A"] == 1
    assert {r.driver: r.rid for r in ideal.ideal_by_pairs(vecs, "medoid").collect()}["A"] == 0


def test_divergence(golden):
    actual, standard = golden
    rows = {r.rid: r for r in reports.divergence(actual, standard).collect()}
    assert rows[0].cities_removed == 0 and rows[0].items_changed == 0
    assert rows[3].items_removed == pytest.approx(1 / 2) and rows[3].items_added == 0


def test_settings_checks():
    for bad in ({"k": 1}, {"alpha": 1.5}, {"metric": "x"}, {"fusion": "y"}):
        with pytest.raises(ValueError):
            Settings(**bad)


def test_tuning_rules():
    assert tuning.lsh_threshold(10_000, 10_000) == 0.0
    assert tuning.lsh_threshold(20_000, 10_000) == 0.1
    assert tuning.lsh_threshold(10**6, 10**6) == 0.9
    assert tuning.signature_size(5_000) == 300 and tuning.signature_size(10**6) == 510
    assert tuning.most_divisible_near(50) == 60
    for size in (60, 64, 300, 420):
        for t in (0.0, 0.1, 0.2, 0.4, 0.9):
            bands, rows = tuning.bands_and_rows(size, t)
            assert bands * rows == size
    assert tuning.bands_and_rows(64, 0.0) == (64, 1)
    assert tuning.usable_k(3, 1, 10, 10) == 2 and tuning.usable_k(3, 2, 10, 10) == 3
    assert tuning.cluster_bounds(5) == (2, 5)


def test_json_round_trip(spark, golden, tmp_path):
    source = tmp_path / "actual_x.json"
    source.write_text(
        json.dumps(
            [{"id": "a12", "driver": "A", "sroute": "s10",
              "route": [{"from": "Forlì", "to": "Rome", "merchandise": {"milk": 3, "tea": 1}}]}],
            ensure_ascii=False,
        ),
        encoding="utf-8",
    )
    row = rf.read_actual(spark, str(source)).first()
    assert (row.rid, row.sroute, row.route[0]["from"]) == (12, "s10", "Forlì")
    assert row.route[0]["merchandise"] == {"milk": 3, "tea": 1}
    assert rf.file_suffix(str(source), "actual") == "_x"
    with pytest.raises(ValueError):
        rf.read_standard(spark, str(source))

    actual, standard = golden
    chosen = actual.filter("rid in (0, 3)").withColumn("new_no", F.col("rid"))
    rf.write_standard(chosen, str(tmp_path / "standard_new"))
    again = rf.read_standard(spark, str(tmp_path / "standard_new"), multiline=False)
    assert {r.sroute for r in again.collect()} == {"s0", "s3"}
    rf.write_perfect(chosen, str(tmp_path / "perfect"))
    perfect = rf.read_perfect(spark, str(tmp_path / "perfect"))
    assert vx.pair_vectors(perfect, "driver").count() == 2
    sims = st.standard_similarity(ft.with_features(actual, 2), ft.with_features(standard, 2), Settings())
    rf.write_driver_top(driver_top.top_from_similarity(sims, standard, actual), str(tmp_path / "driver"))
    lists = {r.driver: r.routes for r in spark.read.json(str(tmp_path / "driver")).collect()}
    assert lists["A"] == ["s0", "s1", "s10"]


def test_city_order_kept(golden):
    actual, _ = golden
    row = actual.filter("rid = 5").select(F.array_distinct(shape.nodes()).alias("c")).first()
    assert row.c == ["Rome", "Milan"]


def test_unit_length(golden):
    actual, standard = golden
    cities, items = vx.code_tables(actual, standard)
    dense = vx.ml_vectors(vx.positional_vectors(actual, cities, items), 15)
    for row in vx.normalized(dense).collect():
        assert row.unit.norm(2) == pytest.approx(1.0)
