"""Per-route features and dataset-wide counts.

Feature rows are narrow projections of the nested route: no explode, no
shuffle. Long tables are exploded from them only where a join needs a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.functions import shape
from roadloom.operators.ordering import dense_index


def with_features(routes: DataFrame, k: int = 3, merchandise: bool = True) -> DataFrame:
    """Replace ``route`` by ``shingles, n`` and, if carried, ``merch, w, q``.

    n: number of shingles; w, q: sum and sum of squares of the quantities.
    """
    zero = F.lit(0).cast("bigint")
    out = shape.once(routes, "cities", shape.nodes())
    out = shape.once(out, "shingles", shape.shingles("cities", k)).withColumn(
        "n", F.size("shingles")
    )
    if merchandise:
        amounts = F.map_values("merch")
        out = (
            with_merch(out)
            .withColumn("w", F.aggregate(amounts, zero, lambda acc, x: acc + x))
            .withColumn("q", F.aggregate(amounts, zero, lambda acc, x: acc + x * x))
        )
    return out.drop("route", "cities")


def with_merch(routes: DataFrame) -> DataFrame:
    """Add ``merch``: item -> quantity over the whole route, without leaving the row."""
    loads = shape.once(routes, "_loads", shape.trip_loads())
    return shape.once(loads, "merch", shape.totals("_loads")).drop("_loads")


def shingle_rows(features: DataFrame, *keep: str) -> DataFrame:
    """Long form ``(*keep, shingle)``: the incidence matrix without its zeros."""
    return features.select(*keep, F.explode("shingles").alias("shingle"))


def merch_rows(features: DataFrame, *keep: str) -> DataFrame:
    """Long form ``(*keep, item, qty)``."""
    return features.select(*keep, F.explode("merch").alias("item", "qty"))


def tokens_of() -> Column:
    """Shingles and items as one array of ``is_item, token, x``."""
    return F.concat(
        F.transform(
            "shingles",
            lambda s: F.struct(
                F.lit(False).alias("is_item"), s.alias("token"), F.lit(1).cast("bigint").alias("x")
            ),
        ),
        F.transform(
            F.map_entries("merch"),
            lambda e: F.struct(
                F.lit(True).alias("is_item"), e["key"].alias("token"), e["value"].alias("x")
            ),
        ),
    )


def token_rows(features: DataFrame, *keep: str) -> DataFrame:
    """Shingles and items as one long table, so that one join serves both parts."""
    return features.select(*keep, F.inline(tokens_of()))


def quantity_scale(actual: DataFrame, standard: DataFrame) -> DataFrame:
    """One row ``scale``: largest trip quantity times the longest route, over both tables."""
    both = actual.select("route").unionByName(standard.select("route"))
    per_route = both.select(
        F.size("route").alias("trips"),
        F.array_max(
            F.transform("route", lambda t: F.array_max(F.map_values(t["merchandise"])))
        ).alias("top"),
    )
    return per_route.agg((F.max("top") * F.max("trips")).alias("scale"))


def scaled_merch(
    actual: DataFrame, standard: DataFrame, norm: str = "longest", decimals: int = 9
) -> DataFrame:
    """``rid, item, share``: quantities over (largest quantity x longest or own length)."""
    if norm not in ("longest", "own_length"):
        raise ValueError("norm must be 'longest' or 'own_length'")
    scale = quantity_scale(actual, standard)
    if norm == "own_length":
        both = actual.select("route").unionByName(standard.select("route"))
        top = both.select(
            F.array_max(
                F.transform("route", lambda t: F.array_max(F.map_values(t["merchandise"])))
            ).alias("top")
        ).agg(F.max("top").alias("top"))
        divisor = top.scalar() * F.col("trips")
    else:
        divisor = scale.scalar()
    rows = with_merch(actual).select(
        "rid", F.size("route").alias("trips"), F.explode("merch").alias("item", "qty")
    )
    return rows.select(
        "rid",
        "item",
        F.round(F.try_divide(F.col("qty").cast("double"), divisor.cast("double")), decimals).alias(
            "share"
        ),
    )


def profile(actual: DataFrame, standard: DataFrame) -> DataFrame:
    """Counts and extremes over both tables in one row."""
    columns = ["route", F.lit(None).cast("string").alias("driver")]
    both = standard.select(*columns, F.lit(1).alias("is_std")).unionByName(
        actual.select("route", F.col("driver").cast("string").alias("driver"), F.lit(0).alias("is_std"))
    )
    scalars = both.agg(
        F.sum(1 - F.col("is_std")).alias("n_actual"),
        F.sum("is_std").cast("bigint").alias("n_standard"),
        F.max(F.size("route")).alias("longest"),
        F.min(F.size("route")).alias("shortest"),
        F.max(
            F.array_max(
                F.transform("route", lambda t: F.array_max(F.map_values(t["merchandise"])))
            )
        ).alias("max_qty"),
        F.count_distinct("driver").alias("n_drivers"),
    )
    cities = both.select(F.explode(shape.nodes()).alias("v")).agg(F.count_distinct("v"))
    items = both.select(F.explode(shape.items()).alias("v")).agg(F.count_distinct("v"))
    return scalars.withColumn("n_cities", cities.scalar()).withColumn("n_items", items.scalar())


def vocabulary(features: DataFrame) -> DataFrame:
    """Distinct shingles; map-side distinct keeps popular shingles from piling up."""
    return features.select(F.explode("shingles").alias("shingle")).distinct()


def dictionary(values: DataFrame, column: str, first_code: int = 1) -> DataFrame:
    """``(value, code)`` for the distinct values of a column, coded in sorted order."""
    distinct = values.select(F.col(column).alias("value")).filter("value is not null").distinct()
    return dense_index(distinct, "value", "code", first_code)


def first_appearance_codes(rows: DataFrame, value: str, order_key: str) -> DataFrame:
    """``(value, code)`` numbered by the smallest ``order_key`` of each value, from 0."""
    firsts = rows.groupBy(F.col(value).alias("value")).agg(F.min(order_key).alias("first_key"))
    return dense_index(firsts, "first_key", "code", 0, "value").drop("first_key")


def stacked(actual: DataFrame, standard: DataFrame) -> DataFrame:
    """Both tables with ``type`` 0 (standard) and 1 (actual)."""
    return standard.select(
        F.col("std_no").alias("rid"), "route", F.lit(0).alias("type")
    ).unionByName(actual.select("rid", "route", F.lit(1).alias("type")))


def driver_standard_table(actual: DataFrame) -> DataFrame:
    """``rid, driver, sroute`` projection; nested columns are never decoded."""
    return actual.select("rid", "driver", "sroute")


def ordered_groups(dictionary_rows: DataFrame, size: int) -> DataFrame:
    """Ordered tuples of ``size`` (2 or 3) different dictionary entries.

    The dictionary is paired through its codes by generating, per entry, the
    codes of the others; the joins back are equi-joins on the code.
    """
    if size not in (2, 3):
        raise ValueError("size must be 2 or 3")
    last = dictionary_rows.agg(F.max("code")).scalar()
    first = dictionary_rows.agg(F.min("code")).scalar()

    def extend(rows: DataFrame, used: list[str], new: str) -> DataFrame:
        codes = F.explode(F.sequence(first, last)).alias(f"{new}_code")
        out = rows.select("*", codes)
        for name in used:
            out = out.filter(F.col(f"{new}_code") != F.col(f"{name}_code"))
        named = dictionary_rows.select(F.col("value").alias(new), F.col("code").alias(f"{new}_code"))
        return out.join(named, f"{new}_code")

    rows = dictionary_rows.select(F.col("value").alias("c1"), F.col("code").alias("c1_code"))
    rows = extend(rows, ["c1"], "c2")
    if size == 3:
        rows = extend(rows, ["c1", "c2"], "c3")
    return rows.drop("c1_code", "c2_code", "c3_code")


def permutations_of(n: Column, k: int) -> Column:
    """n! / (n-k)! as a bigint expression."""
    return F.aggregate(
        F.sequence(n - F.lit(k - 1), n),
        F.lit(1).cast("bigint"),
        lambda acc, x: acc * x,
    )
