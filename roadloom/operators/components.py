"""Connected components by hooking, shortcutting and contracting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.session import Scratch, cut_lineage

MAX_ROUNDS = 60


def _ranked(column: str, turn: int) -> Column:
    """A vertex under a random order that changes every round."""
    return F.struct(F.xxhash64(column, F.lit(turn)).alias("order"), F.col(column).alias("id"))


def _parents(edges: DataFrame, scope: list[str], turn: int) -> DataFrame:
    """Each vertex hooks to the smallest of itself and its neighbours; then two shortcuts."""
    both = edges.select(*scope, F.col("a").alias("v"), F.col("b").alias("u")).unionByName(
        edges.select(*scope, F.col("b").alias("v"), F.col("a").alias("u"))
    )
    nearest = both.groupBy(*scope, "v").agg(F.min(_ranked("u", turn)).alias("best"))
    parent = nearest.select(*scope, "v", F.least("best", _ranked("v", turn))["id"].alias("p"))
    return _shortcut(_shortcut(parent, scope), scope)


def _shortcut(parent: DataFrame, scope: list[str]) -> DataFrame:
    up = parent.select(*scope, F.col("v").alias("p"), F.col("p").alias("pp"))
    return parent.join(up, [*scope, "p"]).select(*scope, "v", F.col("pp").alias("p"))


def connected_components(
    edges: DataFrame, nodes: DataFrame, node: str = "node", scope: list[str] | None = None
) -> DataFrame:
    """``*scope, node, component``: the smallest node of each component is its label.

    edges: ``*scope, a, b``. Under a random order the hooking chains are short,
    so each round shrinks the graph by a constant factor whatever its diameter
    or numbering. Only a minimum per vertex is aggregated: a hub is never
    gathered anywhere.
    """
    scope = scope or []
    with Scratch(edges.sparkSession) as kept:
        work = kept(
            edges.select(*scope, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        labels = nodes.select(*scope, F.col(node).alias("node"), F.col(node).alias("component"))
        for turn in range(MAX_ROUNDS):
            if work.isEmpty():
                return _smallest_name(cut_lineage(labels), scope).withColumnRenamed("node", node)
            parent = kept(_parents(work, scope, turn))
            step = parent.select(*scope, F.col("v").alias("component"), "p")
            labels = kept(
                labels.join(step, [*scope, "component"], "left").select(
                    *scope, "node", F.coalesce("p", "component").alias("component")
                )
            )
            pa = parent.select(*scope, F.col("v").alias("a"), F.col("p").alias("pa"))
            pb = parent.select(*scope, F.col("v").alias("b"), F.col("p").alias("pb"))
            work = kept(
                work.join(pa, [*scope, "a"])
                .join(pb, [*scope, "b"])
                .select(*scope, F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
                .filter("a <> b")
                .distinct()
            )
    raise RuntimeError(f"components did not converge in {MAX_ROUNDS} rounds")


def _smallest_name(labels: DataFrame, scope: list[str]) -> DataFrame:
    """Rename each component to its smallest node."""
    names = labels.groupBy(*scope, "component").agg(F.min("node").alias("name"))
    return labels.join(names, [*scope, "component"]).select(
        *scope, "node", F.col("name").alias("component")
    )
