"""Numbers that back the answers; every report is a DataFrame of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadloom.functions import shape
from roadloom.operators.group_sums import unit_vector_sums
from roadloom.operators.ordering import dense_index
from roadloom.session import broadcast_if_small, cut_lineage


def spread(costs: DataFrame, column: str) -> DataFrame:
    """``mean, std, cv`` of a column (population deviation)."""
    return costs.agg(
        F.avg(column).alias("mean"), F.stddev_pop(column).alias("std")
    ).withColumn("cv", F.try_divide("std", "mean"))


def standard_distances(own: DataFrame, standard: DataFrame) -> DataFrame:
    """``std_no, mean_dist`` of the routes driven for each plan; 1 where nothing is comparable."""
    means = own.groupBy("std_no").agg(F.avg("dist").alias("mean_dist"))
    return standard.select("std_no").join(means, "std_no", "left").select(
        "std_no", F.coalesce("mean_dist", F.lit(1.0)).alias("mean_dist")
    )


def improvement(clusters: DataFrame, standards: DataFrame) -> DataFrame:
    """``measure, clusters, standards, change``: mean, std and cv side by side, change in %."""
    def tall(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.inline(
                F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias(name)) for m in ("mean", "std", "cv")])
            )
        )

    both = tall(clusters, "clusters").join(tall(standards, "standards"), "measure")
    ratio = F.try_divide("clusters", "standards")
    return both.withColumn("change", ratio * 100 - 100)


def cluster_sizes(labels: DataFrame) -> DataFrame:
    """``label, size`` without noise."""
    return labels.filter(F.col("label") >= 0).groupBy("label").agg(F.count("*").alias("size"))


def cluster_purity(labelled: DataFrame) -> DataFrame:
    """``sroute, purity``: routes in labels that occur twice or more, over the largest label."""
    counts = labelled.groupBy("sroute", "label").agg(F.count("*").alias("n"))
    return counts.groupBy("sroute").agg(
        (
            F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(F.lit(0))).cast("double")
            / F.max("n")
        ).alias("purity")
    )


def mean_pair_distance(vectors: DataFrame, group: str) -> DataFrame:
    """``group, n, mean_dist``: mean cosine distance over all pairs of a group, from its vector sum."""
    totals = unit_vector_sums(vectors, group, "vec", "q").groupBy(group).agg(
        F.sum(F.col("total") * F.col("total")).alias("mass")
    )
    sizes = vectors.groupBy(group).agg(F.count("*").alias("n"))
    n = F.col("n").cast("double")
    return totals.join(sizes, group).select(
        group, "n", (1 - F.try_divide(F.col("mass") - n, n * (n - 1))).alias("mean_dist")
    )


def driver_load(actual: DataFrame) -> DataFrame:
    """One row: mean, deviation, minimum and maximum share of routes per driver."""
    counts = actual.groupBy("driver").agg(F.count("*").alias("n"))
    return counts.agg(
        F.sum("n").alias("total"),
        F.avg("n").alias("m"),
        F.stddev_pop("n").alias("s"),
        F.min("n").alias("lo"),
        F.max("n").alias("hi"),
    ).select(*[(F.col(c) / F.col("total")).alias(f"{name}_share") for c, name in
               (("m", "mean"), ("s", "std"), ("lo", "min"), ("hi", "max"))])


def divergence(actual: DataFrame, standard: DataFrame) -> DataFrame:
    """``rid, driver, sroute`` and how the driven route departs from its plan.

    Cities and (from, to, item) quantities removed, added and changed, as
    shares of the plan. Both routes sit in one row after the join on
    ``sroute``, so nothing is exploded.
    """
    def legs(route: str):
        """(from,to,item -> quantity) entries, trip by trip."""
        return F.flatten(
            F.transform(
                route,
                lambda t: F.transform(
                    F.map_entries(t["merchandise"]),
                    lambda e: F.struct(
                        F.concat_ws(",", t["from"], t["to"], e["key"]).alias("key"),
                        e["value"].alias("value"),
                    ),
                ),
            )
        )

    def loaded(routes: DataFrame, name: str) -> DataFrame:
        return shape.once(shape.once(routes, "_legs", legs("route")), name, shape.totals("_legs"))

    driven = loaded(actual, "al").select("rid", "driver", "sroute", shape.nodes().alias("an"), "al")
    planned = loaded(standard, "sl").select("sroute", shape.nodes().alias("sn"), "sl")
    joined = driven.join(planned, "sroute")
    ak, sk = F.map_keys("al"), F.map_keys("sl")
    changed = F.filter(F.array_intersect(ak, sk), lambda k: F.col("al")[k] != F.col("sl")[k])
    n_cities = F.size(F.array_distinct("sn")).cast("double")
    n_items = F.size(sk).cast("double")
    return joined.select(
        "rid",
        "driver",
        "sroute",
        F.try_divide(F.size(F.array_except("sn", "an")), n_cities).alias("cities_removed"),
        F.try_divide(F.size(F.array_except("an", "sn")), n_cities).alias("cities_added"),
        F.try_divide(F.size(F.array_except(sk, ak)), n_items).alias("items_removed"),
        F.try_divide(F.size(F.array_except(ak, sk)), n_items).alias("items_added"),
        F.try_divide(F.size(changed), n_items).alias("items_changed"),
    )


SHARES = ("cities_removed", "cities_added", "items_removed", "items_added", "items_changed")


def divergence_summary(rows: DataFrame) -> DataFrame:
    """Averages per driver, per plan and overall in one pass with grouping sets."""
    return rows.groupingSets([[F.col("driver")], [F.col("sroute")], []], "driver", "sroute").agg(
        F.count("*").alias("routes"), *[F.avg(c).alias(c) for c in SHARES]
    )


def running_ratio(costs: DataFrame) -> DataFrame:
    """One row from ``driver, best, mean``: averages, cumulative ratio and plain per-driver ratio.

    The cumulative sums run over drivers in sorted order. They are carried over
    range partitions by their totals, so no single task sorts all drivers.
    """
    placed = cut_lineage(costs.repartitionByRange("driver").withColumn("_part", F.spark_partition_id()))
    totals = placed.groupBy("_part").agg(F.sum("best").alias("tb"), F.sum("mean").alias("tm"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        "_part",
        F.coalesce(F.sum("tb").over(before), F.lit(0.0)).alias("cb"),
        F.coalesce(F.sum("tm").over(before), F.lit(0.0)).alias("cm"),
    )
    run = Window.partitionBy("_part").orderBy("driver").rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.join(carried, "_part").select(
        "best",
        "mean",
        (F.col("cb") + F.sum("best").over(run)).alias("rb"),
        (F.col("cm") + F.sum("mean").over(run)).alias("rm"),
    )
    return rows.agg(
        F.avg("best").alias("mean_best"),
        F.avg("mean").alias("mean_mean"),
        F.avg(F.coalesce(F.try_divide("rb", "rm"), F.lit(0.0))).alias("running_ratio"),
        F.avg(F.coalesce(F.try_divide(F.round("best", 9), F.round("mean", 9)), F.lit(0.0))).alias("driver_ratio"),
    ).withColumn("change", (1 - F.col("running_ratio")) * 100)


def invalid_distances(edges: DataFrame, column: str = "d") -> DataFrame:
    """One row: number of edges, and of those with a null or NaN distance."""
    bad = F.col(column).isNull() | F.isnan(column)
    return edges.agg(
        F.count("*").alias("pairs"), F.count(F.when(bad, 1)).alias("invalid")
    )


def spread_improvement(spreads: DataFrame, chosen: str, given: str) -> DataFrame:
    """One row: mean and deviation of two columns, and by what share the first mean is lower."""
    return spreads.agg(
        F.count("*").alias("clusters"),
        *[f(c).alias(f"{name}_{c}") for c in (chosen, given) for f, name in ((F.avg, "mean"), (F.stddev_pop, "std"))],
    ).withColumn("improvement", 1 - F.try_divide(f"mean_{chosen}", f"mean_{given}"))


def id_lists(rows: DataFrame, group: str, key: str, length: int) -> DataFrame:
    """``group, chunk, ids``: each group's keys in order, in lists of at most ``length``.

    Rows are numbered over all groups at once, and a group's chunks count from its
    first number, so a group with a third of all rows is spread over many tasks.
    """
    placed = cut_lineage(dense_index(rows.select(group, key), group, "_at", tie=key))
    first = placed.groupBy(group).agg(F.min("_at").alias("_first"))
    chunk = F.expr(f"(_at - _first) div {length}").alias("chunk")
    return (
        placed.join(broadcast_if_small(first), group)
        .groupBy(group, chunk)
        .agg(F.array_sort(F.collect_list(key)).alias("ids"))
    )
