"""Driven routes against planned routes.

The planned routes are the small side. They are counted, and up to
``PLAN_TOKENS`` shingles and items go to every task as postings: a route's sums
with all plans are then made from its own row, and no table of (route, plan)
pairs is held, sorted or spilled. Beyond that bound the same sums come from a
shuffle join on shared shingles and items whose popular tokens adaptive
execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom.functions import measures
from roadloom.operators.features import token_rows, tokens_of
from roadloom.operators.ordering import best_per
from roadloom.session import broadcast_if_small, stored
from roadloom.settings import Settings


TASK_PAIRS = 1_000_000
PLAN_TOKENS = 500_000  # shingles and items of planned routes that a task holds
BATCH_MATCHES = 1 << 20
SIDES = ("driver", "sroute", "na", "nb", "wa", "wb", "qa", "qb")
SUMS = ("inter", "smin", "dot")


def by_route(actual: DataFrame, standard: DataFrame) -> DataFrame:
    """Routes dealt by ``rid`` to as many tasks as keep the sums of all (route, plan) pairs of one in its memory.

    Both should be materialised: their rows are counted.
    """
    tasks = 1 + actual.count() * standard.count() // TASK_PAIRS
    return actual.repartition(max(actual.sparkSession.sparkContext.defaultParallelism, tasks), "rid")


def _plan_rows(standard: DataFrame) -> DataFrame:
    return token_rows(standard, "std_no", F.col("n").alias("nb"), F.col("w").alias("wb"), F.col("q").alias("qb")).withColumnRenamed("x", "y")


class _Postings:
    """The planned routes by token: ``vocabulary`` of shingles and of items, and per token the plans that have it."""

    def __init__(self, rows: pa.Table) -> None:
        rows = rows.combine_chunks()
        is_item = rows.column("is_item").to_numpy()
        token = rows.column("token").combine_chunks()
        self.vocabulary = [pc.unique(token.filter(pa.array(is_item == kind)).drop_null()) for kind in (False, True)]
        code = self.codes(is_item, token)
        order = np.argsort(code, kind="stable")
        order = order[code[order] >= 0]
        size = sum(len(v) for v in self.vocabulary)
        self.length = np.bincount(code[order], minlength=size)
        self.first = np.cumsum(self.length) - self.length
        sides = rows.select(["std_no", "nb", "wb", "qb"]).to_struct_array().combine_chunks()
        # A plan is what the sums are grouped by: equal rows of the table are one plan.
        _, at, plan = np.unique(np.array([repr(x) for x in sides.to_pylist()], object), return_index=True, return_inverse=True)
        self.plans = sides.take(pa.array(at))
        y = rows.column("y").combine_chunks()
        self.plan, self.y = plan[order], y.fill_null(0).to_numpy()[order]
        self.y_null = y.is_null().to_numpy(zero_copy_only=False)[order]

    def codes(self, is_item: np.ndarray, token: pa.Array) -> np.ndarray:
        """A number per shingle or item, -1 for those that no plan has."""
        shingle, item = (pc.index_in(token, value_set=v, skip_nulls=True).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) for v in self.vocabulary)
        return np.where(is_item, np.where(item < 0, -1, item + len(self.vocabulary[0])), shingle)

    def sums(self, row: np.ndarray, code: np.ndarray, is_item: np.ndarray, x: np.ndarray, x_null: np.ndarray) -> tuple[np.ndarray, ...]:
        """``row, plan`` pairs in the order of rows, their sums, and where ``smin`` and ``dot`` have no known part."""
        n = self.length[code]
        at = np.arange(int(n.sum())) + np.repeat(self.first[code] - (np.cumsum(n) - n), n)
        row, item, x, x_null = (np.repeat(c, n) for c in (row, is_item, x, x_null))
        plan, y, y_null = self.plan[at], self.y[at], self.y_null[at]
        if len(x) and float(np.abs(x).max()) * float(np.abs(y).max()) * len(x) >= 2.0**63:
            raise OverflowError("quantities are too large for sums of 64 bits")
        # As in SQL: the lesser of a known and an unknown quantity is the known one, a product with one is unknown.
        least = np.where(x_null, y, np.where(y_null, x, np.minimum(x, y)))
        known_least, known_dot = ~(item & x_null & y_null), ~(item & (x_null | y_null))
        order = np.lexsort((plan, row))
        row, plan = row[order], plan[order]
        begin = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (plan[1:] != plan[:-1])])) if len(row) else np.zeros(0, np.int64)
        parts = [~item, np.where(item & known_least, least, 0), np.where(item & known_dot, x * y, 0), known_least, known_dot]
        added = [np.add.reduceat(p[order].astype(np.int64), begin) if len(begin) else np.zeros(0, np.int64) for p in parts]
        return row[begin], plan[begin], *added[:3], added[3] == 0, added[4] == 0


def _in_memory(standard: DataFrame) -> _Postings | None:
    """The plans for every task, or None if they are too many."""
    rows = _plan_rows(standard)
    if dict(rows.dtypes)["y"] != "bigint" or rows.limit(PLAN_TOKENS + 1).count() > PLAN_TOKENS:
        return None
    return _Postings(rows.toArrow())


def _sums_by_route(actual: DataFrame, standard: DataFrame, postings: _Postings) -> DataFrame:
    """``rid, driver, sroute, na, wa, qa`` and ``plans``, an array of the planned routes that share something, with the sums."""
    keys = ["rid", "driver", "sroute", "n", "w", "q"]
    rows = actual.select(*keys, tokens_of().alias("tokens"))
    # Only a route that is there several times moves: it has the sums of all its rows.
    several = stored(actual.groupBy("rid").agg(F.count("*").alias("rows")).filter("rows > 1 OR rid IS NULL").select("rid"))
    whole = rows
    if not several.isEmpty():
        several = broadcast_if_small(several)
        again = F.col("rid").eqNullSafe(F.col("again"))
        repeated = rows.join(several.withColumnRenamed("rid", "again"), again, "left_semi")
        summed = repeated.groupBy(*keys).agg(F.flatten(F.collect_list("tokens")).alias("tokens"))
        whole = rows.join(several.withColumnRenamed("rid", "again"), again, "left_anti").unionByName(summed)
    whole = whole.select("rid", "driver", "sroute", F.col("n").alias("na"), F.col("w").alias("wa"), F.col("q").alias("qa"), "tokens")
    plan_fields = [T.StructField(f.name, f.dataType) for f in _plan_rows(standard).schema.fields if f.name in ("std_no", "nb", "wb", "qb")]
    plan = T.StructType([*plan_fields, *(T.StructField(name, T.LongType()) for name in SUMS)])
    schema = T.StructType([*whole.schema.fields[:-1], T.StructField("plans", T.ArrayType(plan))])
    sent = actual.sparkSession.sparkContext.broadcast(postings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in batches:
            lists = batch.column("tokens")
            count = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            is_item, token, x = lists.flatten().flatten()
            is_item = is_item.to_numpy(zero_copy_only=False)
            code = held.codes(is_item, token)
            row = np.repeat(np.arange(len(count)), count)
            met = np.flatnonzero(code >= 0)
            work = np.bincount(row[met], held.length[code[met]], len(count)).astype(np.int64)
            x_null, x = x.is_null().to_numpy(zero_copy_only=False), x.fill_null(0).to_numpy()
            total, lo = np.cumsum(work), 0
            while lo < len(count):
                before = int(total[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(total, before + BATCH_MATCHES, side="right")))
                some = met[(row[met] >= lo) & (row[met] < hi)]
                at, plan_at, inter, smin, dot, no_smin, no_dot = held.sums(row[some] - lo, code[some], is_item[some], x[some], x_null[some])
                offsets = np.searchsorted(at, np.arange(hi - lo + 1)).astype(np.int32)
                sides = held.plans.take(pa.array(plan_at)).flatten()
                sums = [pa.array(inter), pa.array(smin, mask=no_smin), pa.array(dot, mask=no_dot)]
                plans = pa.StructArray.from_arrays([*sides, *sums], plan.names)
                kept = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), plans)], schema.names
                )
                lo = hi

    return whole.mapInArrow(run, schema)


def standard_pair_sums(actual: DataFrame, standard: DataFrame) -> DataFrame:
    """Pairs sharing a shingle or an item: ``rid, std_no, driver, sroute`` and their sums."""
    postings = _in_memory(standard) if dict(actual.dtypes)["merch"] == "map<string,bigint>" else None
    if postings is None:
        return _joined_pair_sums(actual, standard)
    one = _sums_by_route(actual, standard, postings)
    return one.select(*[c for c in one.columns if c != "plans"], F.inline("plans")).select("rid", "std_no", *SIDES, *SUMS)


def _joined_pair_sums(actual: DataFrame, standard: DataFrame) -> DataFrame:
    """The same by a join on tokens, for any number of plans."""
    # One shuffle of whole routes here saves shuffling a row per (route, plan) twice later.
    left = token_rows(by_route(actual, standard), "rid", "driver", "sroute", "n", "w", "q")
    right = broadcast_if_small(_plan_rows(standard))
    item = F.col("is_item")
    # The per-side columns are grouping keys: they depend on rid and std_no, and
    # as aggregates they would turn the hash aggregation into a sort.
    sides = ["driver", "sroute", F.col("n").alias("na"), "nb", F.col("w").alias("wa"), "wb", F.col("q").alias("qa"), "qb"]
    return (
        left.join(right, ["is_item", "token"])
        .groupBy("rid", "std_no", *sides)
        .agg(
            F.sum(F.when(item, F.lit(0)).otherwise(F.lit(1))).alias("inter"),
            F.sum(F.when(item, F.least("x", "y")).otherwise(F.lit(0))).alias("smin"),
            F.sum(F.when(item, F.col("x") * F.col("y")).otherwise(F.lit(0))).alias("dot"),
        )
    )


SUM_NAMES = ("inter", "smin", "dot", "na", "nb", "wa", "wb", "qa", "qb")


def fused_similarity(settings: Settings, scale: Column | float = 1.0, sums: Mapping[str, Column] | None = None) -> Column:
    """Similarity of a row of :func:`standard_pair_sums`, or of the sums given."""
    sums = sums or {name: F.col(name) for name in SUM_NAMES}
    return measures.fuse(
        measures.jaccard(sums["inter"], sums["na"], sums["nb"]),
        measures.merch_similarity(settings.metric, sums, scale),
        settings.fusion,
        settings.alpha,
    )


def standard_similarity(
    actual: DataFrame, standard: DataFrame, settings: Settings, scale: Column | float = 1.0, best_only: bool = False
) -> DataFrame:
    """``rid, driver, sroute, std_no, sim``; absent pairs share nothing and count as 0.

    best_only: of each route only what :func:`best_standard` would choose of its
    pairs, chosen in the route's row, so that its pairs need no sort.
    """
    columns = ["rid", "driver", "sroute", "std_no"]
    postings = _in_memory(standard) if best_only and dict(actual.dtypes)["merch"] == "map<string,bigint>" else None
    if postings is None:
        return standard_pair_sums(actual, standard).select(*columns, fused_similarity(settings, scale).alias("sim"))

    def scored(p: Column) -> Column:
        sums = {name: p[name] if name[-1] != "a" else F.col(name) for name in SUM_NAMES}
        sim = fused_similarity(settings, scale, sums)
        return F.struct((-F.round(sim, 9)).alias("order"), p["std_no"].alias("std_no"), sim.alias("sim"))

    found = F.filter(F.transform("plans", scored), lambda s: s["sim"] > 0)
    best = _sums_by_route(actual, standard, postings).select("rid", "driver", "sroute", F.array_min(found).alias("best"))
    return best.filter("best IS NOT NULL").select("rid", "driver", "sroute", "best.std_no", "best.sim")


def best_standard(sims: DataFrame) -> DataFrame:
    """Best planned route per driven route; a route without any similarity has no row."""
    return best_per(
        sims.filter(F.col("sim") > 0),
        ["rid"],
        -F.round("sim", 9),
        F.col("std_no"),
        keep=["driver", "sroute", "std_no", "sim"],
    )


def own_standard(sims: DataFrame, standard: DataFrame) -> DataFrame:
    """``rid, driver, sroute, std_no, dist`` to the route's own plan; unrelated pairs drop out."""
    keys = standard.select("std_no", "sroute")
    return (
        sims.join(keys, ["std_no", "sroute"])
        .filter(F.col("sim") > 0)
        .select("rid", "driver", "sroute", "std_no", (1 - F.col("sim")).alias("dist"))
    )
