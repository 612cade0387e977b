"""Every query by name, as ``(spark, folder) -> DataFrame`` over the star tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.functions import hashing, measures, shape, tuning
from roadloom.operators import components as cc
from roadloom.operators import density, diameter, driver_scores as ds, features as ft, group_sums as gs, hierarchy
from roadloom.operators import minhash_lsh as lsh, reports, similarity_join as sj
from roadloom.operators import standards as st, vectors as vx
from roadloom.operators.ordering import best_per
from roadloom.plans import driver_top, ideal, recommend
from roadloom.session import checkpoint_folder, stored
from roadloom.settings import Settings
from roadloom.sources import route_files, star

K = 3
DRIVER_K = 2  # in-driver comparisons: pairs of cities
SIGNATURE = 64
MERCH_SIGNATURE = 32
LSH_THRESHOLD = 0.1  # driven with driven; the same for any number of routes
STANDARD_LSH_THRESHOLD = 0.0  # driven with planned: any equal position
JACCARD_MIN, RUZICKA_MIN, COSINE_MIN = 0.1, 0.2, 0.6
L2_MAX = 0.1  # of the largest load a route could have
#: pairs are listed up to these fused distances
FUSED_MAX = {("mean", "jaccard"): 0.8, ("product", "jaccard"): 0.5, ("weighted product", "jaccard"): 0.7}
METRIC_MAX = {"worse": 0.85, "better": 0.5}
REACH = 0.85  # clustering sees fused distances up to here
DBSCAN_EPS, DBSCAN_MIN = 0.5, 4
POSITIONAL_EPS, POSITIONAL_LEAST = 0.32, 10
MIN_CLUSTER = 3  # the tables hold no planted clusters: small ones count
KMEANS_ROUNDS = 300  # K-means ends when it converges, at the latest here
ID_CHUNK = 10  # ids per list; small, so that the tables' drivers have several
CANONICAL = Settings()
DRIVER = ["driver"]


def _actual(spark: SparkSession, folder: str, merchandise: bool = True) -> DataFrame:
    return star.actual_routes(spark, folder, merchandise)


def _routes(spark: SparkSession, folder: str, merchandise: bool = True) -> DataFrame:
    """The same, written once: for queries that read the routes several times.

    Rebuilding them means shuffling the line items again for every use.
    """
    return stored(_actual(spark, folder, merchandise))


def _standard(actual: DataFrame) -> DataFrame:
    """One planned route per ``sroute``: small, used several times, so computed once."""
    return stored(star.standard_routes(actual))


def _tables(spark: SparkSession, folder: str, k: int = K):
    actual = _routes(spark, folder)
    standard = _standard(actual)
    return actual, standard, ft.with_features(actual, k), ft.with_features(standard, k)


def _r(column, name: str, digits: int = 10):
    # Ten digits: shares of 64 or 128 parts end exactly on a half at six.
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, digits).alias(name)


# --- profile and features -------------------------------------------------


def route_profile(spark, folder):
    actual = _routes(spark, folder)
    return ft.profile(actual, _standard(actual))


def _shingle_query(k: int):
    def query(spark, folder):
        return ft.shingle_rows(ft.with_features(_actual(spark, folder, False), k, False), "rid")

    return query


def shingle_vocab_size(spark, folder):
    actual = _routes(spark, folder, False)
    own = ft.vocabulary(ft.with_features(actual, K, False))
    planned = ft.vocabulary(ft.with_features(_standard(actual), K, False))
    both = own.union(planned).distinct().agg(F.count("*")).scalar()
    return own.agg(F.count("*").alias("n_actual")).withColumn("n_both", both)


def route_merch(spark, folder):
    return ft.merch_rows(ft.with_features(_actual(spark, folder), K), "rid")


def _scaled_query(norm: str):
    def query(spark, folder):
        actual = _routes(spark, folder)
        return ft.scaled_merch(actual, _standard(actual), norm)

    return query


def _cities(spark, folder) -> DataFrame:
    actual = _actual(spark, folder, False)
    return stored(ft.dictionary(actual.select(F.explode(shape.nodes()).alias("city")), "city"))


def city_codes(spark, folder):
    return _cities(spark, folder)


def item_codes(spark, folder):
    items = _actual(spark, folder).select(F.explode(shape.items()).alias("item"))
    return ft.dictionary(items, "item")


def city_pairs(spark, folder):
    return ft.ordered_groups(_cities(spark, folder), 2)


def city_triples(spark, folder):
    return ft.ordered_groups(_cities(spark, folder), 3)


def city_permutations(spark, folder):
    n = F.col("n")
    counted = _cities(spark, folder).agg(F.count("*").alias("n"))
    return counted.select(
        "n",
        ft.permutations_of(n, 2).alias("p2"),
        ft.permutations_of(n, 3).alias("p3"),
        F.expr("p2 div 2").alias("c2"),
        F.expr("p3 div 6").alias("c3"),
    )


def stacked_routes(spark, folder):
    actual = _routes(spark, folder, False)
    both = ft.stacked(actual, _standard(actual))
    return both.select(
        "rid", "type", F.size("route").alias("trips"), F.array_join(shape.nodes(), ">").alias("path")
    )


def driver_codes(spark, folder):
    return ft.first_appearance_codes(_actual(spark, folder, False), "driver", "rid")


def route_city_order(spark, folder):
    return _actual(spark, folder, False).select(
        "rid", F.array_join(F.array_distinct(shape.nodes()), ">").alias("cities")
    )


# --- pairs inside a driver ------------------------------------------------


def _driver_forms(spark, folder) -> DataFrame:
    return stored(sj.collapse(ft.with_features(_actual(spark, folder), DRIVER_K), DRIVER))


def driver_forms(spark, folder):
    return _driver_forms(spark, folder).select("driver", "form", "weight", "n", "w", "q")


def driver_pairs_jaccard(spark, folder):
    pairs = sj.jaccard_pairs(_driver_forms(spark, folder), JACCARD_MIN, DRIVER)
    inter = F.size(F.array_intersect("pa.shingles", "pb.shingles"))
    return pairs.select(
        "driver", F.col("pa.form").alias("a"), F.col("pb.form").alias("b"),
        inter.alias("inter"), (F.col("pa.n") + F.col("pb.n") - inter).alias("union_n"), "jaccard",
    )


def driver_pairs_ruzicka(spark, folder):
    pairs = sj.ruzicka_pairs(_driver_forms(spark, folder), RUZICKA_MIN, DRIVER)
    return pairs.select(
        "driver", F.col("pa.form").alias("a"), F.col("pb.form").alias("b"),
        measures.pair_sums("pa", "pb")["smin"].alias("smin"), _r("ruzicka", "ruzicka"),
    )


def driver_pairs_cosine(spark, folder):
    pairs = sj.cosine_pairs(_driver_forms(spark, folder), COSINE_MIN, DRIVER)
    return pairs.select(
        "driver", F.col("pa.form").alias("a"), F.col("pb.form").alias("b"),
        _r("cosine", "cosine"), _r(measures.half_cosine(F.col("cosine")), "half_cosine"),
    )


def driver_pairs_l2(spark, folder):
    actual = _routes(spark, folder)
    scale = ft.quantity_scale(actual, _standard(actual)).first()[0]
    forms = stored(sj.collapse(ft.with_features(actual, DRIVER_K), DRIVER))
    pairs = sj.l2_pairs(forms, L2_MAX * scale, DRIVER)
    d = F.col("l2") / F.lit(scale)
    return pairs.select(
        "driver", F.col("pa.form").alias("a"), F.col("pb.form").alias("b"),
        _r(d, "l2", 6), _r(measures.l2_similarity(d), "l2_sim", 6),
    )


def _fused_query(fusion: str, metric: str):
    def query(spark, folder):
        edges = sj.fused_edges(
            _driver_forms(spark, folder), FUSED_MAX[fusion, metric], DRIVER, metric, CANONICAL.alpha, fusion
        )
        return edges.select("driver", "a", "b", _r("d", "d"))

    return query


def driver_pairs_fused_mean_cosine(spark, folder):
    """Every pair of ``driver_pairs_jaccard`` with its fused distance, however far its loads are apart."""
    pairs = sj.jaccard_pairs(_driver_forms(spark, folder), JACCARD_MIN, DRIVER)
    merch = measures.merch_distance("cosine", measures.pair_sums("pa", "pb"))
    d = measures.fuse(1 - F.col("jaccard"), merch, "mean", CANONICAL.alpha)
    return pairs.select("driver", F.col("pa.form").alias("a"), F.col("pb.form").alias("b"), _r(d, "d"))


#: Both parts must be near: the larger of the two distances counts, so the routes alone bound it.
WORSE_PART = sj.Metric(
    lambda s: F.greatest(1 - measures.jaccard(s["inter"], s["na"], s["nb"]), 1 - measures.ruzicka(s["smin"], s["wa"], s["wb"])),
    least_jaccard=lambda reach: 1 - reach,
)
#: One near part is enough: the smaller distance counts, and either join may find the pair.
BETTER_PART = sj.Metric(
    lambda s: F.least(1 - measures.jaccard(s["inter"], s["na"], s["nb"]), 1 - measures.ruzicka(s["smin"], s["wa"], s["wb"])),
    least_jaccard=lambda reach: 1 - reach,
    least_ruzicka=lambda reach: 1 - reach,
)


def _metric_query(metric: sj.Metric, reach: float):
    def query(spark, folder):
        return sj.metric_edges(_driver_forms(spark, folder), metric, reach, DRIVER).select("driver", "a", "b", _r("d", "d"))

    return query


def candidate_distances(spark, folder):
    forms = stored(sj.collapse(ft.with_features(_actual(spark, folder), DRIVER_K), []))
    edges = recommend.candidate_edges(forms, SIGNATURE, LSH_THRESHOLD, CANONICAL)
    return edges.select("a", "b", "share", _r("d", "d"))


def driver_edges(spark, folder):
    edges = sj.fused_edges(_driver_forms(spark, folder), REACH, DRIVER)
    return edges.select("driver", "a", "b", _r("d", "d"))


def nan_scan(spark, folder):
    edges = sj.fused_edges(_driver_forms(spark, folder), REACH, DRIVER)
    return reports.invalid_distances(edges)


# --- driven against planned routes ----------------------------------------


def std_similarity(spark, folder):
    _, _, fa, fs = _tables(spark, folder)
    sums = st.standard_pair_sums(fa, fs)
    c = {name: F.col(name) for name in st.SUM_NAMES}
    cos = measures.cosine(c["dot"], c["qa"], c["qb"])
    d = measures.l2(c["dot"], c["qa"], c["qb"])
    return sums.select(
        "rid", "std_no", "inter", "smin", "dot",
        _r(measures.jaccard(c["inter"], c["na"], c["nb"]), "jaccard"),
        _r(measures.ruzicka(c["smin"], c["wa"], c["wb"]), "ruzicka"),
        _r(cos, "cosine"), _r(d, "l2", 6),
        _r(st.fused_similarity(CANONICAL), "sim"),
    )


def std_std_distance(spark, folder):
    _, standard, _, fs = _tables(spark, folder)
    left = fs.select(F.col("std_no").alias("rid"), F.lit(None).alias("driver"), "sroute", "shingles", "n", "merch", "w", "q")
    sims = st.standard_similarity(left, fs, CANONICAL)
    return sims.filter(F.col("rid") < F.col("std_no")).select(
        F.col("rid").alias("a"), F.col("std_no").alias("b"), _r(1 - F.col("sim"), "d")
    )


def _sims(spark, folder, settings: Settings = CANONICAL, k: int = K, best_only: bool = False):
    actual, standard, fa, fs = _tables(spark, folder, k)
    return actual, standard, st.standard_similarity(fa, fs, settings, best_only=best_only)


def best_standard(spark, folder):
    _, _, sims = _sims(spark, folder, best_only=True)
    return st.best_standard(sims).select("rid", "std_no", _r("sim", "sim"))


def driver_top5(spark, folder):
    actual, standard, sims = _sims(spark, folder, best_only=True)
    top = driver_top.top_from_similarity(sims, standard, actual)
    return top.select("driver", "rank", "std_no", _r("score", "score"))


def driver_top5_voted(spark, folder):
    _, _, sims = _sims(spark, folder, best_only=True)
    return driver_top.top_from_similarity(sims).select("driver", "rank", "std_no", _r("score", "score"))


def driver_top5_cosine(spark, folder):
    _, _, sims = _sims(spark, folder, Settings(metric="cosine"), best_only=True)
    return driver_top.top_from_similarity(sims).select("driver", "rank", "std_no", _r("score", "score"))


def driver_top5_product(spark, folder):
    _, _, sims = _sims(spark, folder, Settings(k=2, fusion="product"), 2, True)
    return driver_top.top_from_similarity(sims).select("driver", "rank", "std_no", _r("score", "score"))


def driver_top5_maxsim(spark, folder):
    actual = _routes(spark, folder)
    sims = driver_top.positional_similarity(actual, _standard(actual))
    return driver_top.top_by_best_similarity(sims).select(
        "driver", "rank", "std_no", _r("score", "score")
    )


def driver_score_ratio(spark, folder):
    actual, standard, fa, fs = _tables(spark, folder)
    # Pairs are made twice rather than kept: there are many times more of them than routes.
    sims = st.standard_similarity(fa, fs, CANONICAL)
    drivers = actual.select("driver")
    voted = stored(ds.votes(st.best_standard(st.standard_similarity(fa, fs, CANONICAL, best_only=True))))
    means = ds.driver_mean_score(sims, voted, drivers, standard)
    ratios = ds.score_ratios(means, ds.top_standards(voted, standard, drivers))
    return ratios.select("rank", _r("mean_ratio", "mean_ratio", 6), _r("improvement", "improvement", 4))


def own_standard_distance(spark, folder):
    _, standard, sims = _sims(spark, folder)
    return st.own_standard(sims, standard).select("rid", "std_no", _r("dist", "dist"))


def standard_distance_report(spark, folder):
    _, standard, sims = _sims(spark, folder)
    costs = reports.standard_distances(st.own_standard(sims, standard), standard)
    return reports.spread(costs, "mean_dist").select(*[_r(c, c, 6) for c in ("mean", "std", "cv")])


def driver_load(spark, folder):
    load = reports.driver_load(star.actual_routes(spark, folder, False))
    return load.select(*[_r(c, c, 9) for c in load.columns])


def driver_routes(spark, folder):
    rows = ft.driver_standard_table(_actual(spark, folder, False))
    return rows.groupBy("driver").agg(
        F.count("*").alias("routes"),
        F.count_distinct("sroute").alias("standards"),
        F.min("rid").alias("first_route"),
        F.max("rid").alias("last_route"),
    )


def driver_route_lists(spark, folder):
    rows = ft.driver_standard_table(_actual(spark, folder, False))
    return reports.id_lists(rows, "driver", "rid", ID_CHUNK).select(
        "driver", "chunk", F.size("ids").alias("n"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("rids")
    )


def driver_standard_table(spark, folder):
    return ft.driver_standard_table(_actual(spark, folder, False))


def route_preview(spark, folder):
    head = _actual(spark, folder, False).orderBy("rid").limit(5)
    return head.select("rid", "driver", "sroute", F.size("route").alias("trips"))


def divergence_audit(spark, folder):
    actual = _routes(spark, folder)
    rows = reports.divergence(actual, _standard(actual))
    return rows.select("rid", "driver", "sroute", *[_r(c, c) for c in reports.SHARES])


def divergence_summary(spark, folder):
    actual = _routes(spark, folder)
    rows = reports.divergence_summary(reports.divergence(actual, _standard(actual)))
    return rows.select("driver", "sroute", "routes", *[_r(c, c) for c in reports.SHARES])


# --- MinHash and LSH ------------------------------------------------------


def _set_forms(spark, folder) -> DataFrame:
    features = ft.with_features(_actual(spark, folder, False), DRIVER_K, False)
    return stored(sj.collapse(features, [], False))


def minhash_signatures(spark, folder):
    signed = lsh.with_signature(ft.with_features(_actual(spark, folder, False), K, False), SIGNATURE)
    return signed.filter("n > 0").select("rid", F.array_join("sig", ",").alias("signature"))


def merch_signatures(spark, folder):
    signed = lsh.with_merch_signature(ft.with_features(_actual(spark, folder), K), MERCH_SIGNATURE)
    return signed.select("rid", F.array_join("msig", ",").alias("signature"))


def merch_weighted_signatures(spark, folder):
    signed = lsh.with_weighted_signature(ft.with_features(_routes(spark, folder), K), MERCH_SIGNATURE)
    return signed.select("rid", F.array_join("msig", ",").alias("signature"))


def _signed_forms(spark, folder) -> DataFrame:
    return stored(lsh.with_signature(_set_forms(spark, folder), SIGNATURE))


def lsh_candidates(spark, folder):
    return lsh.candidate_ids(_signed_forms(spark, folder), *tuning.bands_and_rows(SIGNATURE, LSH_THRESHOLD))


def signature_similarity(spark, folder):
    pairs = lsh.candidate_pairs(_signed_forms(spark, folder), *tuning.bands_and_rows(SIGNATURE, LSH_THRESHOLD))
    return pairs.select(
        F.col("pa.form").alias("a"), F.col("pb.form").alias("b"),
        hashing.matching_share("pa.sig", "pb.sig", SIGNATURE).alias("estimate"),
        _r(hashing.signature_ruzicka("pa.sig", "pb.sig"), "sig_ruzicka", 6),
    )


def lsh_isolated(spark, folder):
    forms = _signed_forms(spark, folder)
    pairs = lsh.candidate_ids(forms, *tuning.bands_and_rows(SIGNATURE, LSH_THRESHOLD))
    return forms.join(lsh.linked_ids(pairs), "form", "left_anti").select("form", "weight", "n")


def lsh_report(spark, folder):
    forms = _signed_forms(spark, folder)
    pairs = stored(lsh.candidate_ids(forms, *tuning.bands_and_rows(SIGNATURE, LSH_THRESHOLD)))
    n = F.col("forms")
    linked = lsh.linked_ids(pairs).agg(F.count("*")).scalar()
    kept = pairs.agg(F.count("*")).scalar()
    counted = forms.agg(F.count("*").alias("forms"))
    return (
        counted.withColumn("linked", linked)
        .withColumn("kept", kept)
        .withColumn("total", F.expr("forms * (forms - 1) div 2"))
        .withColumn("saved", F.round((1 - F.col("kept") / F.col("total")) * 100, 6))
    )


def lsh_std_candidates(spark, folder):
    actual = _routes(spark, folder, False)
    left = lsh.with_signature(ft.with_features(actual, DRIVER_K, False), SIGNATURE)
    right = lsh.with_signature(ft.with_features(_standard(actual), DRIVER_K, False), SIGNATURE)
    return lsh.standard_candidates(left, right, *tuning.bands_and_rows(SIGNATURE, STANDARD_LSH_THRESHOLD))


def lsh_refined_top5(spark, folder):
    actual, standard, fa, fs = _tables(spark, folder, DRIVER_K)
    sims = driver_top.lsh_similarity(fa, fs, SIGNATURE, STANDARD_LSH_THRESHOLD, CANONICAL)
    top = driver_top.top_from_similarity(sims, standard, actual)
    return top.select("driver", "rank", "std_no", _r("score", "score"))


def tuning_choices(spark, folder):
    actual = _routes(spark, folder, False)
    sizing = recommend.size_up(actual, _standard(actual), K)
    counts = actual.agg(F.count("*").alias("routes"))
    return counts.select(
        "routes",
        F.lit(sizing.k).alias("k"),
        F.lit(sizing.signature).alias("signature"),
        F.lit(sizing.threshold).alias("threshold"),
        F.lit(sizing.min_size).alias("min_size"),
        F.lit(sizing.max_size).alias("max_size"),
    )


# --- ideal routes ---------------------------------------------------------


def pair_vectors(spark, folder):
    vecs = ideal.pair_features(_actual(spark, folder))
    return vecs.select("rid", F.explode("vec").alias("feature", "value")).select(
        "rid", "feature", _r("value", "value", 9)
    )


def driver_dominant_standard(spark, folder):
    vecs = stored(ideal.pair_features(_actual(spark, folder)))
    return ideal.dominant_standard(vecs).select("driver", "sroute", _r("mass", "mass", 6))


def _pair_ideal(pick: str):
    def query(spark, folder):
        vecs = stored(ideal.pair_features(_actual(spark, folder)))
        best = ideal.ideal_by_pairs(vecs, pick)
        return best.select("driver", "rid", "sroute", _r("sum_d", "sum_d", 6))

    return query


def _signed(actual: DataFrame, merch: bool) -> DataFrame:
    features = ft.with_features(actual, DRIVER_K)
    # Loads first: their signatures read the table a few times.
    return lsh.with_signature(lsh.with_merch_signature(features, MERCH_SIGNATURE) if merch else features, SIGNATURE)


def _mean_distance_query(metric: str, fusion: str = "mean"):
    def query(spark, folder):
        loads = metric == "jaccard"  # their signatures read the routes several times
        signed = stored(_signed(_routes(spark, folder) if loads else _actual(spark, folder), loads))
        means = ideal.mean_distances(signed, metric, CANONICAL.alpha, fusion)
        return means.select("driver", "rid", _r("mean_d", "mean_d"))

    return query


def driver_mean_distance_weighted(spark, folder):
    loads = lsh.with_weighted_signature(ft.with_features(_routes(spark, folder), DRIVER_K), MERCH_SIGNATURE)
    means = ideal.mean_distances(stored(lsh.with_signature(loads, SIGNATURE)), "jaccard", CANONICAL.alpha)
    return means.select("driver", "rid", _r("mean_d", "mean_d"))


def _labels(features: DataFrame, largest: int) -> DataFrame:
    return ideal.driver_labels(features, "jaccard", CANONICAL.alpha, REACH, 2, largest)


def _largest(actual: DataFrame) -> int:
    """Most routes in a cluster: driven routes per planned one."""
    return tuning.forward_expansion(actual.count(), _standard(actual).count())


def density_labels_driver(spark, folder):
    actual = _routes(spark, folder)
    return _labels(stored(ft.with_features(actual, DRIVER_K)), _largest(actual))


def ideal_route(spark, folder):
    actual = _routes(spark, folder)
    signed = stored(_signed(actual, True))
    means = stored(ideal.mean_distances(signed, "jaccard", CANONICAL.alpha))
    best = ideal.ideal_routes(stored(_labels(signed.drop("sig", "msig"), _largest(actual))), means)
    return ideal.fetch_routes(best, actual).select(
        "driver", "rid", "label", _r("best", "best"), _r("mean", "mean"),
        F.array_join(shape.nodes(), ">").alias("path"),
    )


def running_divergence(spark, folder):
    signed = stored(_signed(_actual(spark, folder), False))
    means = ideal.mean_distances(signed, "cosine", CANONICAL.alpha)
    costs = means.groupBy("driver").agg(F.min("mean_d").alias("best"), F.avg("mean_d").alias("mean"))
    out = reports.running_ratio(costs)
    return out.select(*[_r(c, c, 6) for c in out.columns])


# --- clustering and recommendation ----------------------------------------


def route_components(spark, folder):
    forms = _driver_forms(spark, folder)
    edges = sj.fused_edges(forms, REACH, DRIVER)
    return cc.connected_components(edges, forms, "form")


def _eps_edges(spark, folder):
    forms = stored(sj.collapse(ft.with_features(_actual(spark, folder), DRIVER_K), []))
    return forms, stored(sj.fused_edges(forms, DBSCAN_EPS, []))


def dbscan_routes(spark, folder):
    forms, edges = _eps_edges(spark, folder)
    return density.dbscan(forms.select(F.col("form").alias("node"), "weight"), edges, DBSCAN_MIN)


def dbscan_cluster_sizes(spark, folder):
    """Forms per cluster; noise is left out."""
    return reports.cluster_sizes(dbscan_routes(spark, folder))


def medoid_by_sroute(spark, folder):
    signed = stored(_signed(_actual(spark, folder), False))
    sums = gs.fused_distance_sums(signed, signed, "sroute", "cosine", CANONICAL.alpha)
    best = gs.medoids(sums, "sroute")
    return best.select("sroute", "rid", "members", _r("sum_d", "sum_d", 4))


def _recommended(spark, folder):
    actual = _routes(spark, folder)
    standard = _standard(actual)
    signed = stored(_signed(actual, False))
    _, largest = tuning.cluster_bounds(tuning.forward_expansion(actual.count(), standard.count()))
    sizing = recommend.Sizing(DRIVER_K, SIGNATURE, LSH_THRESHOLD, MIN_CLUSTER, largest)
    labels = recommend.cluster_routes(signed.drop("sig"), sizing, CANONICAL, REACH)
    labelled = stored(signed.join(labels, "rid"))
    return actual, standard, labelled, recommend.recommended(labelled, actual, "cosine", CANONICAL.alpha)


def recommended_routes(spark, folder):
    _, _, _, found = _recommended(spark, folder)
    return found.select(
        "new_no", "rid", "label", _r("mean_d", "mean_d"), F.array_join(shape.nodes(), ">").alias("path")
    )


def recommendation_report(spark, folder):
    _, standard, labelled, found = _recommended(spark, folder)
    sims = st.standard_similarity(labelled, ft.with_features(standard, DRIVER_K), CANONICAL)
    costs = reports.standard_distances(st.own_standard(sims, standard), standard)
    rows = recommend.recommendation_report(found, costs)
    return rows.select("measure", *[_r(c, c) for c in ("clusters", "standards", "change")])


def medoid_standard_match(spark, folder):
    actual, standard, fa, fs = _tables(spark, folder)
    sims = st.standard_similarity(fa, fs, CANONICAL, best_only=True)
    signed = stored(_signed(actual, False))
    sums = gs.fused_distance_sums(signed, signed, "sroute", "cosine", CANONICAL.alpha)
    matches = recommend.medoid_matches(gs.medoids(sums, "sroute"), sims)
    return recommend.one_to_one(matches)


# --- the steps after clustering, on labels that SQL knows too ---------------


def _scored_by_trips(spark, folder):
    """Routes of a driver with equally many trips as clusters, with their mean distances."""
    actual = _routes(spark, folder)
    signed = stored(_signed(actual, False))
    means = stored(ideal.mean_distances(signed, "cosine", CANONICAL.alpha))
    labels = actual.select("rid", "driver", F.size("route").alias("label"))
    return actual, labels, means


def cluster_scores_by_trips(spark, folder):
    _, labels, means = _scored_by_trips(spark, folder)
    return ideal.cluster_scores(labels, means).select("driver", "label", "size", _r("score", "score", 6))


def _ideal_by_trips(spark, folder):
    actual, labels, means = _scored_by_trips(spark, folder)
    return ideal.fetch_routes(ideal.ideal_routes(labels, means), actual)


def ideal_by_trips(spark, folder):
    return _ideal_by_trips(spark, folder).select(
        "driver", "rid", "label", _r("best", "best", 6), _r("mean", "mean", 6), F.array_join(shape.nodes(), ">").alias("path")
    )


def running_divergence_by_trips(spark, folder):
    """As ``running_divergence``, but over each driver's chosen cluster only."""
    _, labels, means = _scored_by_trips(spark, folder)
    out = reports.running_ratio(ideal.ideal_routes(labels, means).select("driver", "best", "mean"))
    return out.select(*[_r(c, c, 6) for c in out.columns])


def _labelled_by_plan(spark, folder):
    """Routes of one plan as clusters, named by the plan's number."""
    actual = _routes(spark, folder)
    standard = _standard(actual)
    signed = _signed(actual, False).join(standard.select("sroute", F.col("std_no").alias("label")), "sroute")
    return actual, standard, stored(signed)


def recommended_by_plan(spark, folder):
    actual, _, labelled = _labelled_by_plan(spark, folder)
    found = recommend.recommended(labelled, actual, "cosine", CANONICAL.alpha)
    return found.select("new_no", "rid", "label", _r("mean_d", "mean_d", 6), F.array_join(shape.nodes(), ">").alias("path"))


def improvement_by_plan(spark, folder):
    actual, standard, labelled = _labelled_by_plan(spark, folder)
    found = recommend.recommended(labelled, actual, "cosine", CANONICAL.alpha)
    sims = st.standard_similarity(ft.with_features(actual, K), ft.with_features(standard, K), CANONICAL)
    costs = reports.standard_distances(st.own_standard(sims, standard), standard)
    rows = recommend.recommendation_report(found, costs)
    return rows.select("measure", *[_r(c, c, 6) for c in ("clusters", "standards", "change")])


def cluster_sizes_by_plan(spark, folder):
    _, _, labelled = _labelled_by_plan(spark, folder)
    return reports.cluster_sizes(labelled)


def medoids_in_plan_order(spark, folder):
    actual, standard, labelled = _labelled_by_plan(spark, folder)
    sums = gs.fused_distance_sums(labelled, labelled, "label", "cosine", CANONICAL.alpha)
    medoids = stored(gs.medoids(sums, "label"))
    sims = st.standard_similarity(ft.with_features(actual, K), ft.with_features(standard, K), CANONICAL, best_only=True)
    ordered = recommend.order_by_plan(medoids, recommend.medoid_matches(medoids, sims))
    return ordered.select("new_no", "std_no", "rid", "label")


# --- files written and read back --------------------------------------------


def _file(spark, name: str) -> str:
    return f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}/{name}.json"


def written_plans(spark, folder):
    path = _file(spark, "standard")
    planned = _standard(_actual(spark, folder))
    route_files.write_standard(planned.withColumnRenamed("std_no", "new_no"), path)
    again = route_files.read_standard(spark, path, multiline=False)
    return again.select("std_no", "sroute", F.size("route").alias("trips"), F.array_join(shape.nodes(), ">").alias("path"))


def written_routes(spark, folder):
    path = _file(spark, "actual")
    driven = _actual(spark, folder)
    route_files.write_actual(driven.withColumn("driver", F.col("driver").cast("string")), path)
    again = route_files.read_actual(spark, path, multiline=False)
    load = F.aggregate(shape.trip_loads(), F.lit(0).cast("bigint"), lambda acc, e: acc + e["value"])
    return again.select("rid", "driver", "sroute", F.array_join(shape.nodes(), ">").alias("path"), load.alias("units"))


def written_top5(spark, folder):
    path = _file(spark, "driver")
    actual, standard, sims = _sims(spark, folder, best_only=True)
    route_files.write_driver_top(driver_top.top_from_similarity(sims, standard, actual), path)
    again = spark.read.schema("driver long, routes array<string>").json(path)
    ranked = again.select("driver", F.posexplode("routes").alias("place", "plan"))
    return ranked.select("driver", (F.col("place") + 1).alias("rank"), route_files.number_of("plan").alias("std_no"))


def written_ideal(spark, folder):
    path = _file(spark, "perfectRoute")
    found = _ideal_by_trips(spark, folder)
    route_files.write_perfect(found.withColumn("driver", F.col("driver").cast("string")), path)
    again = route_files.read_perfect(spark, path)
    return again.select("driver", F.size("route").alias("trips"), F.array_join(shape.nodes(), ">").alias("path"))


# --- positional vectors ---------------------------------------------------


def _coded(spark, folder):
    actual = _routes(spark, folder)
    standard = _standard(actual)
    return actual, standard, *vx.code_tables(actual, standard)


def positional_vectors(spark, folder):
    actual, _, cities, items = _coded(spark, folder)
    return vx.positional_rows(actual, cities, items)


def decoded_routes(spark, folder):
    actual, _, cities, items = _coded(spark, folder)
    routes = vx.decode_positional(vx.positional_rows(actual, cities, items), cities, items)
    legs = routes.select("rid", F.posexplode("route").alias("pos", "t"))
    return legs.select(
        "rid", "pos", F.col("t.from").alias("origin"), F.col("t.to").alias("dest"),
        F.array_join(
            F.transform(
                F.array_sort(F.map_entries("t.merchandise")),
                lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")),
            ),
            ",",
        ).alias("load"),
    )


def _positional_by_sroute(spark, folder):
    actual, standard, cities, items = _coded(spark, folder)
    vecs = vx.positional_vectors(actual, cities, items).join(actual.select("rid", "driver", "sroute"), "rid")
    planned = vx.positional_vectors(standard, cities, items, "std_no").join(
        standard.select("std_no", "sroute"), "std_no"
    )
    return stored(vecs), stored(planned)


def standard_spread(spark, folder):
    vecs, planned = _positional_by_sroute(spark, folder)
    clustroids = gs.medoids(recommend.cosine_distance_sums(vecs, "sroute"), "sroute")
    to_plan = recommend.spread_to(
        vecs, planned.select("sroute", F.col("std_no").alias("rid"), "vec", "q"), "sroute"
    )
    return clustroids.join(to_plan.withColumnRenamed("sum_d", "plan_d"), "sroute").select(
        "sroute", "rid", _r("sum_d", "clustroid_d", 4), _r("plan_d", "plan_d", 4)
    )


def standard_pair_spread(spark, folder):
    vecs, _ = _positional_by_sroute(spark, folder)
    spread = reports.mean_pair_distance(vecs, "sroute")
    return spread.select("sroute", "n", _r("mean_dist", "mean_dist", 6))


def standard_pair_extremes(spark, folder):
    vecs, _ = _positional_by_sroute(spark, folder)
    mean = reports.mean_pair_distance(vecs, "sroute")
    return mean.join(diameter.largest_distance(vecs, "sroute"), "sroute").select(
        "sroute", "n", _r("mean_dist", "mean_dist", 6), _r("max_dist", "max_dist", 6)
    )


def standard_pair_report(spark, folder):
    rows = standard_pair_extremes(spark, folder)
    return rows.agg(_r(F.avg("max_dist"), "mean_max", 5), _r(F.avg("mean_dist"), "mean_mean", 5))


def standard_spread_report(spark, folder):
    out = reports.spread_improvement(standard_spread(spark, folder), "clustroid_d", "plan_d")
    return out.select("clusters", *[_r(c, c, 3) for c in out.columns[1:]])


def nearest_center_by_sroute(spark, folder):
    vecs, planned = _positional_by_sroute(spark, folder)
    labelled = vecs.withColumnRenamed("sroute", "label")
    found = recommend.nearest_clusters(labelled.select("label", "vec", "q"), planned)
    return found.select("std_no", "label", _r("dist", "dist", 6))


def nearest_center_walk(spark, folder):
    vecs, planned = _positional_by_sroute(spark, folder)
    labelled = vecs.withColumnRenamed("sroute", "label")
    found = stored(recommend.nearest_clusters(labelled.select("label", "vec", "q"), planned))
    return recommend.first_clash(found).select("std_no", "label", "placed", "stopped_at", "valid")


def cluster_purity(spark, folder):
    rows = _actual(spark, folder, False).select("sroute", F.size("route").alias("label"))
    return reports.cluster_purity(rows).select("sroute", _r("purity", "purity"))


def _kmeans(spark, folder):
    actual = _routes(spark, folder)
    standard = _standard(actual)
    return recommend.kmeans_recommended(actual, standard, standard.count(), max_iter=KMEANS_ROUNDS)


def kmeans_labels(spark, folder):
    labelled, _ = _kmeans(spark, folder)
    return labelled.select("rid", "label")


def kmeans_clustroids(spark, folder):
    _, clustroids = _kmeans(spark, folder)
    return clustroids.select("label", "rid", "members", _r("sum_d", "sum_d", 6))


def written_kmeans(spark, folder):
    """The K-means answer through its file: each cluster's clustroid, decoded from its vector."""
    actual, standard, cities, items = _coded(spark, folder)
    labelled, clustroids = recommend.kmeans_recommended(actual, standard, standard.count(), max_iter=KMEANS_ROUNDS)
    planned = vx.positional_vectors(standard, cities, items, "std_no")
    chosen = recommend.numbered(stored(recommend.clustroid_matches(labelled, clustroids, planned)))
    path = _file(spark, "standardKMeans")
    route_files.write_standard(recommend.decoded_clustroids(chosen, labelled, cities, items), path)
    again = route_files.read_standard(spark, path, multiline=False)
    return again.select(F.col("std_no").alias("new_no"), F.size("route").alias("trips"), F.array_join(shape.nodes(), ">").alias("path"))


def route_svd(spark, folder):
    actual = _routes(spark, folder)
    vecs = stored(vx.pair_vectors(actual, "rid"))
    return vx.truncated_svd(vecs, _standard(actual).count()).select("rid", "component", _r("value", "value", 6))


def _positional_graph(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Routes with their form, forms as nodes, edges of near forms, and driven routes per planned one.

    Routes with the same positional vector are one form, named by the lowest number.
    """
    actual, standard, cities, items = _coded(spark, folder)
    vecs = stored(vx.positional_vectors(actual, cities, items))
    forms = stored(
        vecs.groupBy(F.array_sort(F.map_entries("vec")).alias("content"))
        .agg(F.min("rid").alias("form"), F.count("*").alias("weight"), F.first("vec").alias("vec"), F.first("q").alias("q"))
    )
    members = vecs.withColumn("content", F.array_sort(F.map_entries("vec"))).join(forms.select("content", "form"), "content").drop("content")
    pairs = vx.vector_cosine_pairs(forms, 1 - POSITIONAL_EPS, [], [])
    edges = pairs.select(F.col("pa.form").alias("a"), F.col("pb.form").alias("b"), (1 - F.col("cosine")).alias("d"))
    nodes = forms.select(F.col("form").alias("node"), "weight", F.lit("").alias("scope"))
    return members, nodes, stored(edges), tuning.forward_expansion(actual.count(), standard.count())


def positional_dbscan(spark, folder):
    _, nodes, edges, fan = _positional_graph(spark, folder)
    return density.dbscan(nodes, edges, fan // 2)


def _positional_clusters(spark, folder, least: int | None = None) -> DataFrame:
    members, nodes, edges, fan = _positional_graph(spark, folder)
    labels = hierarchy.hierarchical_clusters(nodes, edges, least or fan // 2, fan, min_samples=1)
    return stored(members.join(labels.withColumnRenamed("node", "form"), "form"))


def positional_density(spark, folder):
    return _positional_clusters(spark, folder).select("rid", "label")


def positional_centers(spark, folder):
    """The medoid of each cluster, small ones too, and how long its centroid is."""
    inside = _positional_clusters(spark, folder, POSITIONAL_LEAST).filter("label >= 0")
    medoids = gs.medoids(recommend.cosine_distance_sums(inside, "label"), "label")
    centers = vx.cluster_centers(inside)
    return medoids.join(centers.select("label", "q"), "label").select(
        "label", "rid", "members", _r("sum_d", "sum_d", 6), _r(F.sqrt("q"), "length", 6)
    )


QUERIES = {
    "route_profile": route_profile,
    "route_shingles_k2": _shingle_query(2),
    "route_shingles_k3": _shingle_query(3),
    "shingle_vocab_size": shingle_vocab_size,
    "route_merch": route_merch,
    "route_merch_scaled": _scaled_query("longest"),
    "route_merch_own_length": _scaled_query("own_length"),
    "city_codes": city_codes,
    "item_codes": item_codes,
    "city_pairs": city_pairs,
    "city_triples": city_triples,
    "city_permutations": city_permutations,
    "stacked_routes": stacked_routes,
    "driver_codes": driver_codes,
    "route_city_order": route_city_order,
    "driver_forms": driver_forms,
    "driver_pairs_jaccard": driver_pairs_jaccard,
    "driver_pairs_ruzicka": driver_pairs_ruzicka,
    "driver_pairs_cosine": driver_pairs_cosine,
    "driver_pairs_l2": driver_pairs_l2,
    "driver_pairs_fused_mean": _fused_query("mean", "jaccard"),
    "driver_pairs_fused_mean_cosine": driver_pairs_fused_mean_cosine,
    "driver_pairs_fused_product": _fused_query("product", "jaccard"),
    "driver_pairs_fused_wproduct": _fused_query("weighted product", "jaccard"),
    "driver_edges": driver_edges,
    "nan_scan": nan_scan,
    "std_similarity": std_similarity,
    "std_std_distance": std_std_distance,
    "best_standard": best_standard,
    "driver_top5": driver_top5,
    "driver_top5_voted": driver_top5_voted,
    "driver_top5_cosine": driver_top5_cosine,
    "driver_top5_product": driver_top5_product,
    "driver_top5_maxsim": driver_top5_maxsim,
    "driver_score_ratio": driver_score_ratio,
    "own_standard_distance": own_standard_distance,
    "standard_distance_report": standard_distance_report,
    "driver_load": driver_load,
    "driver_routes": driver_routes,
    "driver_standard_table": driver_standard_table,
    "route_preview": route_preview,
    "divergence_audit": divergence_audit,
    "divergence_summary": divergence_summary,
    "minhash_signatures": minhash_signatures,
    "merch_signatures": merch_signatures,
    "lsh_candidates": lsh_candidates,
    "signature_similarity": signature_similarity,
    "lsh_isolated": lsh_isolated,
    "lsh_report": lsh_report,
    "lsh_std_candidates": lsh_std_candidates,
    "lsh_refined_top5": lsh_refined_top5,
    "tuning": tuning_choices,
    "pair_vectors": pair_vectors,
    "driver_dominant_standard": driver_dominant_standard,
    "driver_ideal_pairvec": _pair_ideal("reference"),
    "driver_ideal_pairvec_medoid": _pair_ideal("medoid"),
    "driver_mean_distance_cosine": _mean_distance_query("cosine"),
    "driver_mean_distance_product": _mean_distance_query("cosine", "product"),
    "driver_mean_distance_jaccard": _mean_distance_query("jaccard"),
    "density_labels_driver": density_labels_driver,
    "ideal_route": ideal_route,
    "running_divergence": running_divergence,
    "components": route_components,
    "dbscan_routes": dbscan_routes,
    "medoid_by_sroute": medoid_by_sroute,
    "recommended_routes": recommended_routes,
    "recommendation_report": recommendation_report,
    "medoid_standard_match": medoid_standard_match,
    "cluster_scores_by_trips": cluster_scores_by_trips,
    "ideal_by_trips": ideal_by_trips,
    "recommended_by_plan": recommended_by_plan,
    "improvement_by_plan": improvement_by_plan,
    "cluster_sizes_by_plan": cluster_sizes_by_plan,
    "medoids_in_plan_order": medoids_in_plan_order,
    "written_plans": written_plans,
    "written_top5": written_top5,
    "written_ideal": written_ideal,
    "positional_vectors": positional_vectors,
    "decoded_routes": decoded_routes,
    "standard_spread": standard_spread,
    "standard_pair_spread": standard_pair_spread,
    "nearest_center_by_sroute": nearest_center_by_sroute,
    "cluster_purity": cluster_purity,
    "kmeans_labels": kmeans_labels,
    "kmeans_clustroids": kmeans_clustroids,
    "route_svd": route_svd,
    "positional_dbscan": positional_dbscan,
    "positional_density": positional_density,
    "positional_centers": positional_centers,
    "standard_pair_extremes": standard_pair_extremes,
    "standard_pair_report": standard_pair_report,
    "standard_spread_report": standard_spread_report,
    "nearest_center_walk": nearest_center_walk,
    "written_kmeans": written_kmeans,
    "driver_route_lists": driver_route_lists,
    "merch_weighted_signatures": merch_weighted_signatures,
    "driver_mean_distance_weighted": driver_mean_distance_weighted,
    "running_divergence_by_trips": running_divergence_by_trips,
    "driver_pairs_worse_part": _metric_query(WORSE_PART, METRIC_MAX["worse"]),
    "driver_pairs_better_part": _metric_query(BETTER_PART, METRIC_MAX["better"]),
    "candidate_distances": candidate_distances,
    "dbscan_cluster_sizes": dbscan_cluster_sizes,
    "written_routes": written_routes,
}
