"""Votes of a driver's routes for planned routes, and how much better the best ones are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.operators.ordering import top_per

TOP = 5


def votes(best: DataFrame) -> DataFrame:
    """``driver, std_no, votes, score`` where score is the sum of the best similarities."""
    return best.groupBy("driver", "std_no").agg(
        F.count("*").alias("votes"), F.sum("sim").alias("score")
    )


def _lowest_standards(standard: DataFrame):
    """The TOP lowest planned numbers as one array: enough to pad any driver."""
    lowest = standard.select("std_no").orderBy("std_no").limit(TOP)
    return lowest.agg(F.array_sort(F.collect_list("std_no"))).scalar()


def top_standards(
    scored: DataFrame, standard: DataFrame | None = None, drivers: DataFrame | None = None
) -> DataFrame:
    """``driver, rank, std_no, score``, at most five per driver.

    With ``standard`` and ``drivers`` the list is padded by the lowest-numbered
    plans nobody voted for. A driver with v < 5 votes finds the missing 5 - v
    among the five lowest plans, so five candidates per driver are enough.
    """
    rows = scored.select("driver", "std_no", "score")
    if standard is not None and drivers is not None:
        padding = drivers.select("driver").distinct().select(
            "driver",
            F.explode(_lowest_standards(standard)).alias("std_no"),
            F.lit(0.0).alias("score"),
        )
        rows = rows.unionByName(padding).groupBy("driver", "std_no").agg(
            F.max("score").alias("score")
        )
    order = [F.round("score", 9).desc(), F.col("std_no").asc()]
    return top_per(rows, "driver", order, TOP).select("driver", "rank", "std_no", "score")


def mean_similarity(sims: DataFrame, actual: DataFrame) -> DataFrame:
    """``driver, std_no, mean_sim`` over all of the driver's routes, unrelated ones included."""
    sizes = actual.groupBy("driver").agg(F.count("*").alias("n_routes"))
    sums = sims.groupBy("driver", "std_no").agg(F.sum("sim").alias("total"))
    return sums.join(sizes, "driver").select(
        "driver", "std_no", (F.col("total") / F.col("n_routes")).alias("mean_sim")
    )


def driver_mean_score(sims: DataFrame, voted: DataFrame, actual: DataFrame, standard: DataFrame):
    """``driver, mean_score``: mean over all plans of mean similarity times votes."""
    n_standards = standard.agg(F.count("*")).scalar()
    means = mean_similarity(sims, actual)
    drivers = actual.select("driver").distinct()
    scored = means.join(voted, ["driver", "std_no"]).groupBy("driver").agg(
        F.sum(F.col("mean_sim") * F.col("votes")).alias("total")
    )
    return drivers.join(scored, "driver", "left").select(
        "driver", (F.coalesce("total", F.lit(0.0)) / n_standards).alias("mean_score")
    )


def score_ratios(mean_scores: DataFrame, top: DataFrame) -> DataFrame:
    """Per rank: mean over drivers of (mean score / score at that rank), and the improvement in %."""
    ratio = F.when(
        F.col("score") == 0, F.lit(0.0)
    ).otherwise(F.try_divide(F.col("mean_score"), F.col("score")))
    return (
        top.join(mean_scores, "driver")
        .groupBy("rank")
        .agg(F.avg(ratio).alias("mean_ratio"))
        .select("rank", "mean_ratio", ((1 - F.col("mean_ratio")) * 100).alias("improvement"))
    )
