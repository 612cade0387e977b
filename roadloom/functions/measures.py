"""Similarities and distances, from pair sums or from two rows side by side.

The sum form takes ``inter`` (shared set members), ``smin`` (sum of minima),
``dot`` and the per-side totals, so a join only ever has to visit shared keys:
the sum of maxima is ``wa + wb - smin`` and the squared L2 distance is
``qa + qb - 2 dot``. An empty side gives similarity 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ratio(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def jaccard(inter: Column, na: Column, nb: Column) -> Column:
    return _ratio(inter, na + nb - inter)


def ruzicka(smin: Column, wa: Column, wb: Column) -> Column:
    return _ratio(smin, wa + wb - smin)


def cosine(dot: Column, qa: Column, qb: Column) -> Column:
    return _ratio(dot, F.sqrt(qa.cast("double")) * F.sqrt(qb.cast("double")))


def half_cosine(cos: Column) -> Column:
    """Cosine moved to [0, 1]."""
    return (cos + F.lit(1.0)) / F.lit(2.0)


def l2(dot: Column, qa: Column, qb: Column, scale: Column | float = 1.0) -> Column:
    """Distance of the vectors divided by ``scale``; the identity may dip below 0 by rounding."""
    scale = scale if isinstance(scale, Column) else F.lit(scale)
    squared = (qa + qb - F.lit(2) * dot).cast("double")
    return F.sqrt(F.greatest(squared, F.lit(0.0))) / scale


def l2_similarity(distance: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + distance)


def fuse(route: Column, merch: Column, fusion: str = "mean", alpha: float = 0.5) -> Column:
    """Mix the route and the merchandise value; works on similarities and on distances."""
    if fusion == "mean":
        return F.lit(alpha) * route + F.lit(1 - alpha) * merch
    if fusion == "product":
        return route * merch
    if fusion == "weighted product":
        return F.pow(route, F.lit(alpha)) * F.pow(merch, F.lit(1 - alpha))
    raise ValueError(f"unknown fusion {fusion!r}")


def merch_similarity(metric: str, sums: dict[str, Column], scale: Column | float = 1.0) -> Column:
    """Merchandise similarity in [0, 1] from pair sums."""
    if metric == "jaccard":
        return ruzicka(sums["smin"], sums["wa"], sums["wb"])
    cos = cosine(sums["dot"], sums["qa"], sums["qb"])
    if metric == "cosine":
        return half_cosine(cos)
    if metric == "raw cosine":
        return cos
    if metric == "L2":
        return l2_similarity(l2(sums["dot"], sums["qa"], sums["qb"], scale))
    raise ValueError(f"unknown metric {metric!r}")


def merch_distance(metric: str, sums: dict[str, Column], scale: Column | float = 1.0) -> Column:
    """Merchandise distance; L2 is unbounded, so it is not 1 - similarity."""
    if metric == "L2":
        return l2(sums["dot"], sums["qa"], sums["qb"], scale)
    return F.lit(1.0) - merch_similarity(metric, sums, scale)


def pair_sums(a: str, b: str) -> dict[str, Column]:
    """The same sums for two feature rows side by side (columns ``<side>.shingles``, ``.merch``...)."""
    ma, mb = F.col(f"{a}.merch"), F.col(f"{b}.merch")
    shared = F.array_intersect(F.map_keys(ma), F.map_keys(mb))
    zero = F.lit(0).cast("bigint")
    return {
        "inter": F.size(F.array_intersect(F.col(f"{a}.shingles"), F.col(f"{b}.shingles"))),
        "smin": F.aggregate(shared, zero, lambda acc, k: acc + F.least(ma[k], mb[k])),
        "dot": F.aggregate(shared, zero, lambda acc, k: acc + ma[k] * mb[k]),
        **{
            out: F.col(f"{side}.{name}")
            for side, tag in ((a, "a"), (b, "b"))
            for out, name in ((f"n{tag}", "n"), (f"w{tag}", "w"), (f"q{tag}", "q"))
        },
    }
