"""Exact similarity self-joins that never pair up a whole group.

A pair can only reach the wanted overlap if both rows share one of their
*leading* tokens, where tokens are ordered from rare to popular and the leading
ones are those before the remaining weight gets too small. Joining on leading
tokens alone keeps every qualifying pair and skips the popular tokens. Three
things bound the work of one task:

* equal rows are collapsed first into one form with a weight, so a group of
  copies costs one row;
* a token that is still popular is cut into blocks, and its rows meet block by
  block in separate cells of the join key;
* the pair is kept only at the smallest leading token both sides share and is
  measured right there, so no pair is shuffled twice.

Over all routes the items are too few to tell loads apart by their leading ones. A reach
that no pair without a common shingle can keep, unless its loads are equal, goes another
way: rows meet by shingle and all pairs of a block are measured at once, in arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.functions import measures
from roadloom.session import broadcast_if_small, stored

BLOCK_ROWS = 2_000
CELL_BLOCK = 1 << 15  # rows of a block where its pairs are measured in arrays, tile by tile: each block of a crowd is copied once per block
GROUP_FORMS = 64  # all pairs of a group of up to so many rows are looked at in one row
EPS = 1e-9
LARGEST_LOAD = 100_000_000  # up to here loads with a weighted Jaccard of 1, within EPS, are equal


def content_key(features: DataFrame, with_merch: bool = True) -> Column:
    """Fingerprint of what the measures look at."""
    parts = [F.array_join(F.array_sort("shingles"), ";")]
    if with_merch:
        entries = F.transform(
            F.array_sort(F.map_entries("merch")),
            lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")),
        )
        parts.append(F.array_join(entries, ";"))
    return F.md5(F.concat_ws("|", *parts))


def collapse(features: DataFrame, group: list[str], with_merch: bool = True) -> DataFrame:
    """One row per distinct content within a group: ``form`` (lowest rid) and ``weight``."""
    payload = [c for c in ("shingles", "n", "merch", "w", "q") if c in features.columns]
    if not with_merch:
        payload = [c for c in payload if c in ("shingles", "n")]
    return (
        features.withColumn("content", content_key(features, with_merch))
        .groupBy(*group, "content")
        .agg(
            F.min("rid").alias("form"),
            F.count("*").alias("weight"),
            F.first(F.struct(*payload)).alias("payload"),
        )
        .select(*group, "content", "form", "weight", "payload.*")
    )


def members_of(features: DataFrame, forms: DataFrame, group: list[str], with_merch: bool = True):
    """``rid -> form``; forms are unique per content, so only the member side can be skewed."""
    keyed = features.select("rid", *group, content_key(features, with_merch).alias("content"))
    return keyed.join(forms.select(*group, "content", "form"), [*group, "content"]).select(
        "rid", *group, "form"
    )


def _leading(
    rows: DataFrame, group: list[str], tokens: Column, need: Column, unit: bool
) -> DataFrame:
    """``form, *group, lead``: hashed tokens, rare first, until ``need`` gets out of reach.

    Equal hashes of different tokens only add a candidate that the measure rejects.
    """
    long = rows.select(
        "form", *group, need.alias("need"), F.inline(tokens).alias("token", "x")
    ).withColumn("token", F.xxhash64("token"))
    frequency = long.groupBy("token").agg(F.count("*").alias("freq"))
    ordered = (
        long.join(frequency, "token")
        .groupBy("form", *group, "need")
        .agg(F.array_sort(F.collect_list(F.struct("freq", "token", "x"))).alias("ordered"))
    )

    def remaining(i: Column) -> Column:
        if unit:
            return F.size("ordered") - i
        tail = F.slice(F.col("ordered"), i + 1, F.size("ordered"))
        return F.aggregate(tail, F.lit(0.0), lambda acc, t: acc + t["x"])

    kept = F.filter("ordered", lambda t, i: remaining(i) >= F.col("need") - F.lit(EPS))
    return ordered.select(
        "form", *group, F.transform(kept, lambda t: t["token"]).alias("lead")
    )


def _in_small_groups(rows: DataFrame, group: list[str], tokens: Column, payload: list[str]) -> DataFrame:
    """Pairs ``(*group, pa, pb)`` that share a token, for groups of at most ``GROUP_FORMS`` rows: each is opened in one row."""
    names = F.transform(tokens, lambda t: t["token"])
    member = F.struct(F.struct("form", *payload).alias("row"), names.alias("tokens"))
    packed = rows.groupBy(*group).agg(F.collect_list(member).alias("all"))
    each = packed.select(*group, "all", F.explode("all").alias("x"))
    later = F.filter(
        "all", lambda y: (F.col("x.row.form") < y["row"]["form"]) & F.arrays_overlap(F.col("x.tokens"), y["tokens"])
    )
    return each.select(*group, F.col("x.row").alias("pa"), F.explode(later).alias("y")).select(*group, "pa", F.col("y.row").alias("pb"))


def similar_pairs(
    rows: DataFrame,
    tokens: Column,
    need: Column,
    group: list[str],
    payload: list[str],
    unit: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs ``(*group, pa, pb)``, pa.form < pb.form, that share a token.

    ``rows`` should be materialised, it is scanned a few times. ``tokens`` is an
    array of (token, weight) structs; ``need`` the least overlap weight with
    which this row can take part in a qualifying pair. Every pair at or above it
    is returned, some below it too: filter on the measure. Rows without tokens
    pair with nothing. ``unit`` says that all weights are 1.

    Groups of up to ``GROUP_FORMS`` rows move once, whole. In larger ones, and
    without groups, a pair must share a leading token. A group that is null has no pairs.
    """
    if not group:
        return _by_leading_tokens(rows, tokens, need, group, payload, unit, block_rows)
    rows = rows.dropna(subset=group)
    large = rows.groupBy(*group).agg(F.count("*").alias("forms")).filter(F.col("forms") > GROUP_FORMS).select(*group)
    large = stored(large)
    if large.isEmpty():
        return _in_small_groups(rows, group, tokens, payload)
    keys = broadcast_if_small(large)
    small = _in_small_groups(rows.join(keys, group, "left_anti"), group, tokens, payload)
    crowded = stored(rows.join(keys, group, "left_semi"))
    return small.unionByName(_by_leading_tokens(crowded, tokens, need, group, payload, unit, block_rows))


def _by_leading_tokens(
    rows: DataFrame, tokens: Column, need: Column, group: list[str], payload: list[str], unit: bool, block_rows: int
) -> DataFrame:
    """Pairs ``(*group, pa, pb)``, pa.form < pb.form, that share a leading token."""
    leads = stored(_leading(rows, group, tokens, need, unit))
    popular = (
        leads.select(*group, F.explode("lead").alias("key"))
        .groupBy(*group, "key")
        .agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
        .filter(F.col("blocks") > 1)
    )
    led = rows.select("form", F.struct("form", *payload).alias("row")).join(leads, "form")
    blocked = (
        led.select(*group, "row", "lead", F.explode("lead").alias("key"))
        .join(popular, [*group, "key"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("row.form"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
        .drop("blocks", "other")
    )
    # Both sides are the same plan, so Spark shuffles it once and reads it twice.
    left, right = blocked.alias("l"), blocked.alias("r")
    same = F.lit(True)
    for name in [*group, "key", "lo", "hi"]:
        same = same & (F.col(f"l.{name}") == F.col(f"r.{name}"))
    met_here = (F.least("l.block", "r.block") == F.col("l.lo")) & (
        F.greatest("l.block", "r.block") == F.col("l.hi")
    )
    first_shared = F.array_min(F.array_intersect("l.lead", "r.lead")) == F.col("l.key")
    ordered_pair = F.col("l.row.form") < F.col("r.row.form")
    return left.join(right, same & ordered_pair & met_here & first_shared).select(
        *[F.col(f"l.{g}").alias(g) for g in group],
        F.col("l.row").alias("pa"),
        F.col("r.row").alias("pb"),
    )


PAYLOAD = ["weight", "shingles", "n", "merch", "w", "q"]


def _entries(weight) -> Column:
    return F.transform(
        F.map_entries("merch"),
        lambda e: F.struct(e["key"].alias("token"), weight(e["value"]).cast("double").alias("x")),
    )


def set_entries(column: str) -> Column:
    return F.transform(column, lambda s: F.struct(s.alias("token"), F.lit(1.0).alias("x")))


def jaccard_pairs(forms: DataFrame, threshold: float, group: list[str]) -> DataFrame:
    """Form pairs with shingle Jaccard >= threshold (> 0), with all pair sums available."""
    payload = [c for c in PAYLOAD if c in forms.columns]
    pairs = similar_pairs(
        forms, set_entries("shingles"), F.lit(threshold) * F.col("n"), group, payload, unit=True
    )
    inter = F.size(F.array_intersect("pa.shingles", "pb.shingles"))
    value = measures.jaccard(inter, F.col("pa.n"), F.col("pb.n"))
    return pairs.withColumn("jaccard", value).filter(F.col("jaccard") >= threshold - EPS)


def ruzicka_pairs(forms: DataFrame, threshold: float, group: list[str]) -> DataFrame:
    """Form pairs with weighted Jaccard of the merchandise >= threshold (> 0)."""
    pairs = similar_pairs(
        forms, _entries(lambda x: x), F.lit(threshold) * F.col("w"), group, PAYLOAD
    )
    sums = measures.pair_sums("pa", "pb")
    value = measures.ruzicka(sums["smin"], sums["wa"], sums["wb"])
    return pairs.withColumn("ruzicka", value).filter(F.col("ruzicka") >= threshold - EPS)


def cosine_pairs(forms: DataFrame, threshold: float, group: list[str]) -> DataFrame:
    """Form pairs with raw cosine of the merchandise >= threshold (> 0)."""
    pairs = similar_pairs(
        forms,
        _entries(lambda x: x * x),
        F.lit(threshold * threshold) * F.col("q"),
        group,
        PAYLOAD,
    )
    sums = measures.pair_sums("pa", "pb")
    value = measures.cosine(sums["dot"], sums["qa"], sums["qb"])
    return pairs.withColumn("cosine", value).filter(F.col("cosine") >= threshold - EPS)


L2_BANDS = 8


def l2_pairs(forms: DataFrame, most: float, group: list[str]) -> DataFrame:
    """Form pairs ``(*group, pa, pb, l2)`` whose loads are at most ``most`` apart (> 0).

    What one load has and the other has not counts in full, so two loads that share none
    of an item set with squared length above ``most`` squared are too far apart:
    an item join on each load's leading items, up to that length, loses nothing.
    Loads without a common item qualify only if their squared lengths add up to
    ``most`` squared or less; these all belong in the result and meet by bands
    of squared length.
    """
    limit = float(most) ** 2
    shared = similar_pairs(forms, _entries(lambda x: x * x), F.col("q") - F.lit(limit), group, PAYLOAD)
    width = limit / L2_BANDS
    band = F.least(F.floor(F.col("q") / F.lit(width)), F.lit(L2_BANDS)).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.lit(L2_BANDS) - band),
        lambda j: F.struct(F.concat_ws(",", F.least(band, j).cast("string"), F.greatest(band, j).cast("string")).alias("token"), F.lit(1.0).alias("x")),
    )
    light = forms.filter(F.col("q") <= limit)
    apart = similar_pairs(light, cells, F.lit(1.0), group, PAYLOAD, unit=True).filter(
        ~F.arrays_overlap(F.map_keys("pa.merch"), F.map_keys("pb.merch"))
    )
    sums = measures.pair_sums("pa", "pb")
    value = measures.l2(sums["dot"], sums["qa"], sums["qb"])
    found = shared.unionByName(apart).withColumn("l2", value)
    return found.filter(F.col("l2") <= F.lit(float(most)) + F.lit(EPS))


def _least_similarity(reach: float, metric: str, alpha: float, fusion: str) -> tuple[float, float | None]:
    """Least Jaccard, and least merchandise similarity, one of which a pair within reach must have.

    A weighted mean is at least its smaller part, and so is a weighted product; a
    plain product of two factors above the root of the reach is above the reach.
    """
    if fusion == "mean" and (metric == "cosine" or alpha == 1):
        return 1 - reach / alpha, None  # half cosine is never far: the routes alone must be alike
    part = reach**0.5 if fusion == "product" else reach
    return 1 - part, 1 - part if metric == "jaccard" else 1 - 2 * part


def _plain_loads(forms: DataFrame) -> bool:
    """Whether no quantity is negative and no load so large that different ones could count as equal."""
    seen = forms.agg(F.min(F.array_min(F.map_values("merch"))).alias("least"), F.max("w").alias("most")).first()
    return (seen["least"] or 0) >= 0 and (seen["most"] or 0) <= LARGEST_LOAD


def _counted_where_shared(rows: np.ndarray, codes: np.ndarray, column: np.ndarray, height: int, amounts: np.ndarray | None = None):
    """Rows against rows: per pair the sum of minima (without ``amounts``: the number) of shared codes, and the smallest shared code.

    The first ``height`` rows are one side; ``column`` holds each row's place on the other, -1 if it has none.
    """
    width = int(column.max(initial=-1)) + 1
    total = np.zeros((height, width))
    first = np.full((height, width), -1, np.int64)
    order = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
    for lo, hi in zip(starts[::-1], np.append(starts, len(order))[1:][::-1], strict=True):
        held = order[lo:hi]
        left, right = held[rows[held] < height], held[column[rows[held]] >= 0]
        at = np.ix_(rows[left], column[rows[right]])
        total[at] += 1 if amounts is None else np.minimum.outer(amounts[left], amounts[right])
        first[at] = codes[held[0]]
    return total, first


def _edges_by_shingle(forms: DataFrame, reach: float, alpha: float) -> DataFrame:
    """``a, b, d`` of the pairs that share a shingle: forms meet by shingle, and by blocks where it is popular.

    A task holds the forms of two blocks of one shingle, at most about twice ``CELL_BLOCK``, and the sums of the pairs of
    ``BLOCK_ROWS`` by ``BLOCK_ROWS`` of them. A pair is kept at the smallest shingle it shares.
    """
    rows = forms.select(
        "form", "n", F.col("w").cast("double").alias("w"), "shingles", F.map_keys("merch").alias("items"),
        F.transform(F.map_values("merch"), lambda x: F.coalesce(x, F.lit(0)).cast("double")).alias("amounts"),
    ).filter("form IS NOT NULL")
    each = rows.select("*", F.explode("shingles").alias("key"))
    popular = (
        each.groupBy("key").agg(F.ceil(F.count("*") / CELL_BLOCK).cast("int").alias("blocks")).filter(F.col("blocks") > 1)
    )
    met = (
        each.join(broadcast_if_small(stored(popular)), "key", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("form"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
        .drop("blocks", "other")
    )

    def measured(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        key, lo, hi = (table.column(c)[0].as_py() for c in ("key", "lo", "hi"))
        # Rows of block ``lo`` first, each block by form; the others are the columns, or all rows if there is but one block.
        table = table.take(pa.array(np.lexsort((table.column("form").to_numpy(), table.column("block").to_numpy()))))
        block = table.column("block").to_numpy()
        height, size = int((block == lo).sum()), len(block)
        form, n, w = (table.column(c).to_numpy() for c in ("form", "n", "w"))

        def opened(name: str) -> tuple[np.ndarray, pa.Array]:
            lists = table.column(name).combine_chunks()
            count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            return np.concatenate([[0], np.cumsum(count)]).astype(np.int64), lists.flatten()

        at, shingles = opened("shingles")
        encoded = shingles.dictionary_encode()
        known = encoded.dictionary.to_pylist()
        rank = np.empty(len(known), np.int64)
        rank[sorted(range(len(known)), key=known.__getitem__)] = np.arange(len(known))
        shingle, here = rank[encoded.indices.to_numpy()], rank[known.index(key)]
        load_at, items = opened("items")
        amounts = opened("amounts")[1].to_numpy(zero_copy_only=False)
        item = items.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)

        def entries(rows: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Of some rows the number among them and the place of each of their entries."""
            count = bounds[rows + 1] - bounds[rows]
            skipped = bounds[rows] - (np.cumsum(count) - count)
            return np.repeat(np.arange(len(rows)), count), np.arange(int(count.sum())) + np.repeat(skipped, count)

        def share(part: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            whole = left[:, None] + right[None, :] - part
            return np.nan_to_num(np.divide(part, whole, out=np.zeros_like(part), where=whole != 0))

        def tile(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            one = left is right
            rows = left if one else np.concatenate([left, right])
            column = np.arange(len(rows)) if one else np.maximum(np.arange(len(rows)) - len(left), -1)
            row, place = entries(rows, at)
            inter, first = _counted_where_shared(row, shingle[place], column, len(left))
            row, place = entries(rows, load_at)
            smin, _ = _counted_where_shared(row, item[place], column, len(left), amounts[place])
            d = alpha * (1 - share(inter, n[left].astype(float), n[right].astype(float))) + (1 - alpha) * (1 - share(smin, w[left], w[right]))
            near = (d <= reach + EPS) & (first == here)
            x, y = form[left][:, None], form[right][None, :]
            i, j = np.nonzero(near & ((x < y) if lo == hi else (x != y)))
            return form[left][i], form[right][j], d[i, j]

        far, found = 0 if lo == hi else height, []
        for i in range(0, height, BLOCK_ROWS):
            left = np.arange(i, min(i + BLOCK_ROWS, height))
            for j in range(i if lo == hi else far, size, BLOCK_ROWS):
                found.append(tile(left, left if lo == hi and i == j else np.arange(j, min(j + BLOCK_ROWS, size))))
        a, b, d = (np.concatenate(x) for x in zip(*found)) if found else (form[:0], form[:0], w[:0])
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "d": d})

    kind = dict(forms.dtypes)["form"]
    return met.groupBy("key", "lo", "hi").applyInArrow(measured, f"a {kind}, b {kind}, d double")


def _edges_by_load(forms: DataFrame, reach: float, alpha: float) -> DataFrame:
    """``a, b, d`` of the pairs without a common shingle: their loads must be equal."""
    some = F.filter(F.array_sort(F.map_entries("merch")), lambda e: e["value"] != 0)
    load = F.transform(some, lambda e: F.concat(F.length(e["key"]).cast("string"), F.lit(":"), e["key"], F.lit("="), e["value"].cast("string")))
    named = stored(forms.filter("w > 0").withColumn("load", F.md5(F.array_join(load, ";"))))
    same = F.array(F.struct(F.col("load").alias("token"), F.lit(1.0).alias("x")))
    pairs = similar_pairs(named, same, F.lit(1.0), [], PAYLOAD, unit=True)
    pairs = pairs.filter(~F.arrays_overlap("pa.shingles", "pb.shingles"))
    d = measures.fuse(F.lit(1.0), measures.merch_distance("jaccard", measures.pair_sums("pa", "pb")), "mean", alpha)
    return pairs.select(F.col("pa.form").alias("a"), F.col("pb.form").alias("b"), d.alias("d")).filter(F.col("d") <= reach + EPS)


def fused_edges(
    forms: DataFrame, reach: float, group: list[str], metric: str = "jaccard", alpha: float = 0.5, fusion: str = "mean"
) -> DataFrame:
    """All form pairs with fused distance <= reach: ``*group, a, b, d``.

    The pairs come from a join on shingles and, for those whose routes alone are
    not alike enough, from a join on merchandise (:func:`_least_similarity`). Without
    groups, a mean whose route part alone reaches ``reach`` needs a common shingle or equal loads.
    """
    if not 0 < reach < 1:
        raise ValueError("reach must lie between 0 and 1")
    if metric not in ("jaccard", "cosine"):
        raise ValueError("fused edges need a bounded merchandise metric")
    least, merch = _least_similarity(reach, metric, alpha, fusion)
    if least <= 0 or (merch is not None and merch <= 0):
        raise ValueError("the reach is too large for this metric and fusion")
    if not group and merch is not None and metric == "jaccard" and fusion == "mean" and reach <= alpha and _plain_loads(forms):
        return _edges_by_shingle(forms, reach, alpha).unionByName(_edges_by_load(forms, reach, alpha))
    found = jaccard_pairs(forms, least, group).select(*group, "pa", "pb", "jaccard")
    sums = measures.pair_sums("pa", "pb")
    if merch is not None:
        join = ruzicka_pairs if metric == "jaccard" else cosine_pairs
        loads = join(forms, merch, group).withColumn("jaccard", measures.jaccard(sums["inter"], sums["na"], sums["nb"]))
        found = found.unionByName(loads.filter(F.col("jaccard") < least - EPS).select(*group, "pa", "pb", "jaccard"))
    d = measures.fuse(1 - F.col("jaccard"), measures.merch_distance(metric, sums), fusion, alpha)
    return found.select(
        *group, F.col("pa.form").alias("a"), F.col("pb.form").alias("b"), d.alias("d")
    ).filter(F.col("d") <= reach + EPS)


@dataclass(frozen=True)
class Metric:
    """A distance of one's own that the joins can prune by.

    ``distance`` builds a column from the sums of :func:`measures.pair_sums`
    (``inter, na, nb, smin, dot, wa, wb, qa, qb``). ``least_jaccard`` and
    ``least_ruzicka`` map a reach to similarities of which every pair within that reach
    has at least one: shingle Jaccard, or weighted Jaccard of the loads. One of them
    may be missing if the other alone always holds.
    """

    distance: Callable[[Mapping[str, Column]], Column]
    least_jaccard: Callable[[float], float] | None = None
    least_ruzicka: Callable[[float], float] | None = None


def metric_edges(forms: DataFrame, metric: Metric, reach: float, group: list[str]) -> DataFrame:
    """All form pairs of a group with ``metric`` <= reach: ``*group, a, b, d``.

    A metric without a bound, or whose bounds say nothing at this reach (both
    similarities 0 or less), is refused, since it would need all pairs.
    """
    least = metric.least_jaccard(reach) if metric.least_jaccard else None
    merch = metric.least_ruzicka(reach) if metric.least_ruzicka else None
    if least is None and merch is None:
        raise ValueError("a metric needs a bound that the joins can use")
    if any(bound is not None and bound <= 0 for bound in (least, merch)):
        raise ValueError("the metric's bound says nothing at this reach")
    sums = measures.pair_sums("pa", "pb")
    parts = []
    if least is not None:
        parts.append(jaccard_pairs(forms, least, group).select(*group, "pa", "pb"))
    if merch is not None:
        loads = ruzicka_pairs(forms, merch, group)
        if least is not None:  # the pairs that the first join has already
            loads = loads.filter(measures.jaccard(sums["inter"], sums["na"], sums["nb"]) < least - EPS)
        parts.append(loads.select(*group, "pa", "pb"))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return found.select(
        *group, F.col("pa.form").alias("a"), F.col("pb.form").alias("b"), metric.distance(sums).alias("d")
    ).filter(F.col("d") <= reach + EPS)
