"""A spread of queries against their SQL on the smallest tables; the rest runs in compare.py."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "route_profile", "route_shingles_k3", "driver_pairs_jaccard", "driver_pairs_ruzicka",
    "std_similarity", "driver_top5", "driver_score_ratio", "divergence_summary", "lsh_candidates",
    "lsh_refined_top5", "driver_ideal_pairvec", "driver_mean_distance_jaccard", "components", "dbscan_routes",
    "decoded_routes", "standard_spread", "tuning", "driver_edges", "driver_top5_maxsim", "cluster_scores_by_trips",
    "ideal_by_trips", "recommended_by_plan", "improvement_by_plan", "cluster_sizes_by_plan", "medoids_in_plan_order",
    "written_plans", "written_top5", "written_ideal", "density_labels_driver", "ideal_route", "driver_pairs_l2",
    "driver_pairs_fused_product", "driver_pairs_fused_mean_cosine", "positional_dbscan",
]
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@needs_tables
@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) == ""


@needs_tables
def test_clustering_queries_work_on_real_edges(spark):
    assert entry.queries()["driver_edges"](spark, "/root/testdata/sf0.01").count() > 1000


@needs_tables
def test_entry(spark):
    top = entry.entry(spark)
    assert top.columns == ["driver", "rank", "std_no", "score"] and top.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_tables
@pytest.mark.parametrize("name", ["driver_top5", "driver_pairs_jaccard", "lsh_candidates", "medoid_by_sroute"])
def test_no_cross_join_in_plan(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@needs_tables
def test_mean_cosine_lists_every_jaccard_pair(spark):
    pairs = entry.queries()["driver_pairs_jaccard"](spark, FOLDER).select("driver", "a", "b")
    fused = entry.queries()["driver_pairs_fused_mean_cosine"](spark, FOLDER).select("driver", "a", "b")
    assert pairs.count() > 0 and pairs.exceptAll(fused).count() == 0 and fused.exceptAll(pairs).count() == 0
