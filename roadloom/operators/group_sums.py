"""Summed distances from each row to all members of its group, without pairs.

Both parts of the distance decompose. The number of members that agree with a
row at a signature position is the count of that (group, position, value), and
the summed cosine is the product of the row's unit vector with the sum of the
members' unit vectors. So the cost is linear in the rows, whatever the group
size. Rows travel whole: to their group's task, or, for large groups, not at all,
since the totals of a group combine map-side and are looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom.session import broadcast_if_small, stored

METRICS = ("jaccard", "cosine", "raw cosine")
GROUP_ROWS = 20_000  # a group of more rows is not added up in one task
TASK_ENTRIES = 4_000_000  # entries of whole rows, and so of whole groups, that a task opens
TOTALS_IN_MEMORY = 1_000_000
CHUNK_ROWS = 4_096  # rows whose groups are added up at once
DENSE_CELLS = 1 << 23


def _signed(sig: str) -> Column:
    """Entries of a signature: its positions with their values. A value lies below ``hashing.MODULUS``."""
    share = 1 / F.size(sig)
    return F.transform(sig, lambda v, i: F.struct(i.alias("i"), v.cast("int").alias("v"), F.lit(1.0).alias("given"), share.alias("own")))


def _carried(entries: str, norm: str) -> Column:
    """Entries of a unit vector; ``norm`` is the squared length."""
    unit = F.sqrt(F.col(norm).cast("double"))
    return F.transform(
        F.map_entries(entries),
        lambda e: F.struct(e["key"].alias("key"), (e["value"] / unit).alias("given"), (e["value"] / unit).alias("own")),
    )


def _crossed(sig: str, entries: str, norm: str) -> Column:
    """Every signature position with every entry of the unit vector."""
    unit, size = F.sqrt(F.col(norm).cast("double")), F.size(sig)
    return F.flatten(
        F.transform(
            sig,
            lambda v, i: F.transform(
                F.map_entries(entries),
                lambda e: F.struct(
                    i.alias("i"), v.cast("int").alias("v"), e["key"].alias("key"),
                    (e["value"] / unit).alias("given"), (e["value"] / unit / size).alias("own"),
                ),
            ),
        )
    )


def unit_vector_sums(members: DataFrame, group: str, entries: str = "merch", norm: str = "q"):
    """``group, key, total``: sum of the members' unit vectors; ``norm`` is the squared length."""
    return (
        members.select(group, norm, F.explode(entries).alias("key", "x"))
        .groupBy(group, "key")
        .agg(F.sum(F.col("x") / F.sqrt(F.col(norm).cast("double"))).alias("total"))
    )


def _looked_up(members: DataFrame, probes: DataFrame, group: str, part: str) -> DataFrame:
    """``group, rid, <part>``: one row per probe's entry, from the totals of its group.

    Totals combine map-side. They are broadcast if few, and then the probes do not move.
    """
    long = members.select(group, F.inline(part))
    names = [c for c in long.columns if c not in (group, "given", "own")]
    totals = stored(long.groupBy(group, *names).agg(F.sum("given").alias("total")))
    entries = probes.select(group, "rid", F.inline(part)).drop("given")
    return entries.join(broadcast_if_small(totals, TOTALS_IN_MEMORY), [group, *names]).select(
        group, "rid", (F.col("own") * F.col("total")).alias(part)
    )


def _add_up(probes: DataFrame, group: str, parts: dict[str, DataFrame]) -> DataFrame:
    """Left-outer sum of the parts per row in one shuffle instead of a join per part."""
    names = list(parts)

    def padded(df: DataFrame, own: str | None) -> DataFrame:
        return df.select(
            group, "rid", *[(F.col(n) if n == own else F.lit(0.0)).alias(n) for n in names]
        )

    rows = padded(probes, None)
    for name, part in parts.items():
        rows = rows.unionByName(padded(part, name))
    return rows.groupBy(group, "rid").agg(*[F.sum(n).alias(n) for n in names])


class _Entries:
    """Of some rows the entries of one part: row, cell (what is added up together), given and own."""

    def __init__(self, column: pa.ChunkedArray, group: np.ndarray, signature: bool) -> None:
        lists = column.combine_chunks()
        self.count = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.first = np.cumsum(self.count) - self.count
        self.row = np.repeat(np.arange(len(self.count)), self.count)
        flat = lists.flatten()
        if signature:  # position and value
            at, width = np.arange(len(self.row)) - np.repeat(self.first, self.count), int(self.count.max(initial=1))
            cell = ((group[self.row] * width + at) << 31) + flat.to_numpy(zero_copy_only=False)
            self.cell = np.unique(cell, return_inverse=True)[1]
            self.given, self.own = np.ones(len(cell)), np.repeat(1 / np.maximum(self.count, 1), self.count)
            return
        key, given, own = flat.flatten()
        self.key = key.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.keys = int(self.key.max(initial=0)) + 1
        self.cell = group[self.row] * self.keys + self.key
        self.given, self.own = (x.fill_null(0).to_numpy(zero_copy_only=False) for x in (given, own))


def _weighed(cell: np.ndarray, given: np.ndarray, own: np.ndarray, row: np.ndarray, rows: int, dense: int) -> np.ndarray:
    """Per row the sum, over its entries, of own share times the total given in the entry's cell."""
    if int(cell.max(initial=0)) >= dense:
        cell = np.unique(cell, return_inverse=True)[1]
    return np.bincount(row, own * np.bincount(cell, given)[cell], rows) if len(cell) else np.zeros(rows)


def _sums_of(table: pa.Table, group: str, names: list[str], signatures: set[str], crossed: str | None, dense: int) -> pa.Table:
    """``group, rid, members, *names`` and ``crossed`` of whole groups."""
    code = table.column(group).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    parts = [_Entries(table.column(n), code, n in signatures) for n in names]
    found = {n: _weighed(p.cell, p.given, p.own, p.row, len(code), dense) for n, p in zip(names, parts)}
    if crossed:
        # Every position of a row's signature with every entry of its vector.
        one, two = parts
        times = two.count[one.row]
        row = np.repeat(one.row, times)
        other = np.arange(len(row)) + np.repeat(two.first[one.row] - (np.cumsum(times) - times), times)
        own = two.own[other] * np.repeat(one.own, times)
        found[crossed] = _weighed(np.repeat(one.cell, times) * two.keys + two.key[other], two.given[other], own, row, len(code), dense)
    sums = pa.table(
        [table.column(group), table.column("rid"), pa.array(np.bincount(code)[code]), *(pa.array(x) for x in found.values())],
        [group, "rid", "members", *found],
    )
    added = sums.group_by([group, "rid", "members"]).aggregate([(n, "sum") for n in found])  # rows of one id are one probe
    return added.select([group, "rid", "members", *(f"{n}_sum" for n in found)]).rename_columns(sums.column_names)


def _whole_groups(batches: Iterator[pa.RecordBatch], group: str, most: int) -> Iterator[pa.Table]:
    """Tables of whole groups, of about ``most`` rows or one group, from batches sorted by group."""
    held = None
    for batch in batches:
        one = pa.Table.from_batches([batch])
        held = one if held is None else pa.concat_tables([held, one])
        if held.num_rows < most:
            continue
        code = held.column(group).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts, lo = np.flatnonzero(np.diff(code, prepend=-1)), 0
        for upto in starts[1:].tolist():  # the last group may go on
            if upto - lo >= most or upto == starts[-1]:
                yield held.slice(lo, upto - lo)
                lo = upto
        held = held.slice(lo)
    if held is not None and held.num_rows:
        yield held


def _inside(rows: DataFrame, group: str, parts: dict[str, Column], signatures: dict[str, str], entries: int) -> DataFrame:
    """``group, rid, members, *parts`` for groups that fit a task: whole rows move once, by group, and are added up where they arrive."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, 1 + entries // TASK_ENTRIES)
    crossed = "both_sim" if "both_sim" in parts else None
    names = [n for n in parts if n != crossed]
    opened = [(F.col(signatures[n]) if n in signatures else parts[n]).alias(n) for n in names]
    placed = rows.repartition(tasks, group).sortWithinPartitions(group).select(group, "rid", *opened)

    most, dense = CHUNK_ROWS, DENSE_CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, group, most):
            yield from _sums_of(table, group, names, set(signatures), crossed, dense).combine_chunks().to_batches()

    fields = [*(placed.schema[c] for c in (group, "rid")), T.StructField("members", T.LongType())]
    return placed.mapInArrow(run, T.StructType([*fields, *(T.StructField(n, T.DoubleType()) for n in parts)]))


def _group_totals(rows: DataFrame, group: str, parts: dict[str, Column], width: Column, signatures: dict[str, str] | None = None) -> DataFrame:
    """``group, rid, members, *parts``: per row and part the sum, over its entries, of own share times its group's total.

    A group of up to ``GROUP_ROWS`` rows is added up in one task; larger ones, of which
    there are few, by totals that all tasks look up. ``width`` counts a row's entries, ``signatures``
    names the columns of parts that are signatures. A group that is null is left out.
    """
    names = list(parts)
    known = rows.filter(F.col(group).isNotNull())
    sizes = stored(known.groupBy(group).agg(F.count("*").alias("members"), F.sum(F.coalesce(width, F.lit(0)).cast("bigint")).alias("entries")))
    large = F.col("members") > GROUP_ROWS
    counted = sizes.agg(
        F.count_if(large).alias("large"), F.count_if(~large).alias("small"), F.sum(F.when(~large, F.col("entries"))).alias("entries")
    ).first()
    keys = F.broadcast(sizes.filter(large).select(group))  # at most one group per GROUP_ROWS rows
    found = []
    if counted["small"] or not counted["large"]:
        small = known.join(keys, group, "left_anti") if counted["large"] else known
        found.append(_inside(small, group, parts, signatures or {}, counted["entries"] or 0))
    if counted["large"]:
        big = known.join(keys, group, "left_semi") if counted["small"] else known
        big = big.select(group, "rid", *[c.alias(n) for n, c in parts.items()])
        sums = _add_up(big, group, {n: _looked_up(big, big, group, n) for n in names})
        found.append(sums.join(sizes.drop("entries"), group).select(group, "rid", "members", *names))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def cosine_sums(
    members: DataFrame, probes: DataFrame, group: str, entries: str = "merch", norm: str = "q"
) -> DataFrame:
    """``group, rid, cos``: summed cosine to all members of the group, itself included."""
    cos = _carried(entries, norm).alias("cos")
    if members is probes:
        return _group_totals(members, group, {"cos": cos}, F.size(entries)).drop("members")
    members, probes = members.select(group, cos), probes.select(group, "rid", cos)
    return _add_up(probes, group, {"cos": _looked_up(members, probes, group, "cos")})


def fused_distance_sums(
    members: DataFrame,
    probes: DataFrame,
    group: str,
    metric: str = "cosine",
    alpha: float = 0.5,
    fusion: str = "mean",
) -> DataFrame:
    """``group, rid, members, sum_d``: fused distance of each probe to every member.

    Both should be materialised, they are scanned a few times. Route part: MinHash
    estimate from ``sig``. Merchandise part: the exact
    cosine, or for ``jaccard`` the MinHash estimate of the weighted Jaccard from
    ``msig``. The product needs a cosine metric. Weighted products and L2 do
    not decompose and are refused.
    """
    if metric not in METRICS:
        raise ValueError(f"group sums support {METRICS}")
    if fusion not in ("mean", "product") or (fusion == "product" and metric == "jaccard"):
        raise ValueError("group sums support the mean, and the product with a cosine metric")
    # Values of signatures take half the room where rows move.
    narrow = {c: F.col(c).cast("array<int>") for c in ("sig", "msig") if c in members.columns and c in probes.columns}
    same = members is probes
    members = members.withColumns(narrow)
    probes = members if same else probes.withColumns(narrow)
    parts = {
        "route_sim": _signed("sig"),
        "merch_sim": _signed("msig") if metric == "jaccard" else _carried("merch", "q"),
    }
    if fusion == "product":
        parts["both_sim"] = _crossed("sig", "merch", "q")
    if members is probes:
        route, load = F.size("sig"), F.size("msig" if metric == "jaccard" else "merch")
        signatures = {"route_sim": "sig"} | ({"merch_sim": "msig"} if metric == "jaccard" else {})
        sums = _group_totals(members, group, parts, route + load + (route * load if fusion == "product" else F.lit(0)), signatures)
    else:
        given = members.select(group, *[c.alias(name) for name, c in parts.items()])
        asked = probes.select(group, "rid", *[c.alias(name) for name, c in parts.items()])
        sizes = members.groupBy(group).agg(F.count("*").alias("members"))
        sums = _add_up(asked, group, {name: _looked_up(given, asked, group, name) for name in parts}).join(sizes, group)
    n = F.col("members")
    merch_total: Column = F.col("merch_sim")
    if metric == "cosine":
        merch_total = (merch_total + n) / 2
    distance = F.lit(alpha) * (n - F.col("route_sim")) + F.lit(1 - alpha) * (n - merch_total)
    if fusion == "product":
        # (1 - r)(1 - m) summed; the moved cosine halves the merchandise distance.
        distance = n - F.col("route_sim") - F.col("merch_sim") + F.col("both_sim")
        distance = distance / 2 if metric == "cosine" else distance
    return sums.select(group, "rid", "members", distance.alias("sum_d"))


def medoids(sums: DataFrame, group: str, farthest: bool = False) -> DataFrame:
    """Per group the row with the smallest summed distance (lowest rid on ties).

    ``farthest`` picks the largest sum instead, highest rid on ties.
    """
    key = F.struct(F.round("sum_d", 9), F.col("rid"))
    pick = F.max_by if farthest else F.min_by
    best = F.struct("rid", "sum_d", "members")
    return (
        sums.groupBy(group)
        .agg(pick(best, key).alias("best"))
        .select(
            group,
            F.col("best.rid").alias("rid"),
            F.col("best.sum_d").alias("sum_d"),
            F.col("best.members").alias("members"),
        )
    )
