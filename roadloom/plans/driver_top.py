"""Which planned routes fit each driver best?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.functions import hashing, measures, tuning
from roadloom.operators import driver_scores as ds, minhash_lsh, standards as st, vectors
from roadloom.operators.ordering import best_per
from roadloom.session import broadcast_if_small, stored
from roadloom.settings import Settings

PLANS_IN_MEMORY = 20_000  # planned routes with signatures, a few kilobytes each


def exact_similarity(actual: DataFrame, standard: DataFrame, settings: Settings) -> DataFrame:
    """All related pairs from feature tables, exact measures."""
    return st.standard_similarity(actual, standard, settings)


def lsh_similarity(
    actual: DataFrame,
    standard: DataFrame,
    signature: int,
    threshold: float,
    settings: Settings,
    route_measure: str = "estimate",
) -> DataFrame:
    """``rid, driver, sroute, std_no, sim`` on LSH candidates.

    route_measure: ``estimate`` (share of equal signature positions) or
    ``signature ruzicka`` (minima over maxima of the signature values).
    """
    bands, rows = tuning.bands_and_rows(signature, threshold)
    left = stored(minhash_lsh.with_signature(actual, signature))
    right = stored(minhash_lsh.with_signature(standard, signature))
    found = minhash_lsh.standard_candidates(left, right, bands, rows)
    columns = ["sig", "shingles", "n", "merch", "w", "q"]
    pairs = found.join(left.select("rid", "driver", "sroute", F.struct(*columns).alias("pa")), "rid").join(
        broadcast_if_small(right.select("std_no", F.struct(*columns).alias("pb")), PLANS_IN_MEMORY), "std_no"
    )
    if route_measure == "estimate":
        route = hashing.matching_share("pa.sig", "pb.sig", signature)
    elif route_measure == "signature ruzicka":
        route = hashing.signature_ruzicka("pa.sig", "pb.sig")
    else:
        raise ValueError("route_measure must be 'estimate' or 'signature ruzicka'")
    merch = measures.merch_similarity(settings.metric, measures.pair_sums("pa", "pb"))
    return pairs.select(
        "rid", "driver", "sroute", "std_no",
        measures.fuse(route, merch, settings.fusion, settings.alpha).alias("sim"),
    )


def top_from_similarity(
    sims: DataFrame, standard: DataFrame | None = None, drivers: DataFrame | None = None
) -> DataFrame:
    """``driver, rank, std_no, score``; padded when both tables are given."""
    return ds.top_standards(ds.votes(st.best_standard(sims)), standard, drivers)


def positional_similarity(actual: DataFrame, standard: DataFrame) -> DataFrame:
    """``rid, driver, std_no, sim`` of positional vectors built over both tables.

    The driver travels with its route: nothing is joined to the pairs afterwards.
    """
    cities, items = vectors.code_tables(actual, standard)
    a = stored(vectors.positional_vectors(actual, cities, items, keep=("driver",)))
    s = stored(vectors.positional_vectors(standard, cities, items, "std_no"))
    return vectors.standard_cosine(a, s, ("driver",))


def top_by_best_similarity(sims: DataFrame) -> DataFrame:
    """Per route the nearest plan; per driver plans ranked by their single best similarity."""
    best = best_per(
        sims, ["rid"], -F.round("sim", 9), F.col("std_no"), keep=["driver", "std_no", "sim"]
    )
    scored = best.groupBy("driver", "std_no").agg(F.max("sim").alias("score"))
    return ds.top_standards(scored)
