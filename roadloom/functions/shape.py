"""Expressions over one nested route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    Stacked projections are merged, so an expression used inside a lambda would
    be evaluated for every element; the one-row generator keeps it apart.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def nodes(route: str = "route") -> Column:
    """Cities in visiting order: every trip's start, then the last trip's end."""
    last = F.try_element_at(F.col(route), F.lit(-1))["to"]
    return F.when(
        F.size(route) > 0,
        F.concat(F.transform(route, lambda t: t["from"]), F.array(last)),
    ).otherwise(F.array().cast("array<string>"))


def shingles(cities: str, k: int) -> Column:
    """Distinct runs of ``k`` consecutive cities, in order of first appearance."""
    runs = F.transform(
        F.sequence(F.lit(1), F.size(cities) - (k - 1)),
        lambda i: F.concat_ws(",", F.slice(F.col(cities), i, F.lit(k))),
    )
    return F.when(F.size(cities) >= k, F.array_distinct(runs)).otherwise(
        F.array().cast("array<string>")
    )


def city_pairs(route: str = "route") -> Column:
    """Distinct ``from,to`` pairs of a route."""
    return F.array_distinct(
        F.transform(route, lambda t: F.concat_ws(",", t["from"], t["to"]))
    )


def trip_loads(route: str = "route") -> Column:
    """All (item, quantity) entries of a route, trip by trip."""
    return F.flatten(
        F.transform(
            route, lambda t: F.coalesce(F.map_entries(t["merchandise"]), _no_entries())
        )
    )


def items(route: str = "route") -> Column:
    """Distinct items of a route."""
    return F.array_distinct(F.transform(trip_loads(route), lambda e: e["key"]))


def totals(entries: str) -> Column:
    """Map of key -> summed value over an array of (key, value) entries."""
    summed = F.transform(
        F.array_distinct(F.transform(entries, lambda e: e["key"])),
        lambda item: F.struct(
            item.alias("key"),
            F.aggregate(
                F.filter(entries, lambda e: e["key"] == item),
                F.lit(0).cast("bigint"),
                lambda acc, e: acc + e["value"],
            ).alias("value"),
        ),
    )
    return F.map_from_entries(summed)


def _no_entries() -> Column:
    return F.array().cast("array<struct<key:string,value:bigint>>")


def stable_hash(text: Column) -> Column:
    """First 60 bits of the md5 as a non-negative bigint; equal in every process and engine."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
