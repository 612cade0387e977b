"""Vector views of routes, kept sparse: ``rid, vec MAP<key, value>, q`` (squared length)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import Normalizer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom.functions import measures, shape
from roadloom.operators.features import dictionary, with_merch
from roadloom.operators.ordering import best_per
from roadloom.operators.similarity_join import EPS, similar_pairs
from roadloom.operators.standards import by_route
from roadloom.session import Scratch, broadcast_if_small, cut_lineage, stored

SVD_BROADCAST_ROWS = 50_000


def code_tables(*routes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """City and item dictionaries over all given tables, coded from 1 in sorted order."""
    stacked = routes[0].select("route")
    for other in routes[1:]:
        stacked = stacked.unionByName(other.select("route"))
    cities = stacked.select(F.explode(shape.nodes()).alias("city"))
    items = stacked.select(F.explode(shape.items()).alias("item"))
    return stored(dictionary(cities, "city")), stored(dictionary(items, "item"))


def _width(items: DataFrame) -> Column:
    """Slots per trip: start, end and one per item."""
    return items.agg(F.count("*") + 2).scalar()


def positional_rows(
    routes: DataFrame, cities: DataFrame, items: DataFrame, key: str = "rid", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``key, *keep, slot, value``: per trip the start code, the end code and each item's quantity.

    Slots that would hold padding zeros are simply absent.
    """
    parts = F.concat(
        F.array(
            F.struct(F.lit(0).alias("side"), F.col("t.from").alias("value"), F.lit(0).cast("bigint").alias("qty")),
            F.struct(F.lit(1).alias("side"), F.col("t.to").alias("value"), F.lit(0).cast("bigint").alias("qty")),
        ),
        F.transform(
            F.map_entries("t.merchandise"),
            lambda e: F.struct(F.lit(2).alias("side"), e["key"].alias("value"), e["value"].alias("qty")),
        ),
    )
    trips = routes.select(key, *keep, F.posexplode("route").alias("pos", "t"))
    long = trips.select(key, *keep, "pos", F.inline(parts)).withColumn("is_item", F.col("side") == 2)
    codes = cities.withColumn("is_item", F.lit(False)).unionByName(
        items.withColumn("is_item", F.lit(True))
    )
    offset = F.when(F.col("is_item"), F.col("code") + 1).otherwise(F.col("side"))
    value = F.when(F.col("is_item"), F.col("qty")).otherwise(F.col("code"))
    return long.join(broadcast_if_small(codes), ["is_item", "value"]).select(
        key, *keep, (F.col("pos") * _width(items) + offset).cast("int").alias("slot"), value.alias("value")
    )


def positional_vectors(
    routes: DataFrame, cities: DataFrame, items: DataFrame, key: str = "rid", keep: tuple[str, ...] = ()
) -> DataFrame:
    """The same as one sparse row per route; ``keep`` names columns that depend on the key."""
    pairs = F.map_from_entries(F.array_sort(F.collect_list(F.struct("slot", "value"))))
    return positional_rows(routes, cities, items, key, keep).groupBy(key, *keep).agg(
        pairs.alias("vec"), F.sum(F.col("value") * F.col("value")).alias("q")
    )


def decode_positional(rows: DataFrame, cities: DataFrame, items: DataFrame) -> DataFrame:
    """Back from ``rid, slot, value`` to ``rid, route``; only positive quantities are kept."""
    width = _width(items)
    placed = rows.select(
        "rid",
        F.floor(F.col("slot") / width).cast("int").alias("pos"),
        F.pmod(F.col("slot"), width).alias("offset"),
        "value",
    ).withColumn("is_item", F.col("offset") >= 2)
    codes = cities.withColumn("is_item", F.lit(False)).unionByName(
        items.withColumn("is_item", F.lit(True))
    ).withColumnRenamed("value", "name")
    code = F.when(F.col("is_item"), F.col("offset") - 1).otherwise(F.col("value"))
    named = placed.filter(~F.col("is_item") | (F.col("value") > 0)).withColumn("code", code).join(
        broadcast_if_small(codes), ["is_item", "code"]
    )
    item = F.when(F.col("is_item"), F.struct(F.col("name").alias("key"), F.col("value").cast("bigint").alias("value")))
    trips = named.groupBy("rid", "pos").agg(
        F.max(F.when(F.col("offset") == 0, F.col("name"))).alias("from"),
        F.max(F.when(F.col("offset") == 1, F.col("name"))).alias("to"),
        F.map_from_entries(F.array_sort(F.collect_list(item))).alias("merchandise"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", F.map_entries("merchandise").alias("m"), "from", "to")))
    return trips.groupBy("rid").agg(
        F.transform(
            ordered,
            lambda t: F.struct(
                t["from"].alias("from"),
                t["to"].alias("to"),
                F.map_from_entries(t["m"]).alias("merchandise"),
            ),
        ).alias("route")
    )


def pair_vectors(routes: DataFrame, *keep: str) -> DataFrame:
    """``vec``: 1 per distinct ``from,to`` pair and each item's share of the route's load.

    Narrow: a route without load has no item entries.
    """
    zero = F.lit(0.0)
    carried = with_merch(routes).select(*keep, shape.city_pairs().alias("pairs"), "merch")
    total = F.aggregate(F.map_values("merch"), F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    entries = F.concat(
        F.transform("pairs", lambda p: F.struct(F.concat(F.lit("p:"), p).alias("key"), F.lit(1.0).alias("value"))),
        F.transform(
            F.filter(F.map_entries("merch"), lambda e: (e["value"] > 0)),
            lambda e: F.struct(
                F.concat(F.lit("i:"), e["key"]).alias("key"),
                (e["value"] / F.col("total")).alias("value"),
            ),
        ),
    )
    return (
        shape.once(shape.once(carried, "total", total), "vec", F.map_from_entries(entries))
        .withColumn("q", F.aggregate(F.map_values("vec"), zero, lambda acc, x: acc + x * x))
        .drop("pairs", "merch", "total")
    )


def vector_cosine_pairs(
    vectors: DataFrame, threshold: float, group: list[str], payload: list[str]
) -> DataFrame:
    """Pairs ``(*group, pa, pb, cosine)`` with cosine >= threshold (> 0) of their ``vec``.

    vectors: ``form, vec, q`` and what ``payload`` names.
    """
    tokens = F.transform(
        F.map_entries("vec"),
        lambda e: F.struct(
            e["key"].alias("token"), (e["value"] * e["value"]).cast("double").alias("x")
        ),
    )
    need = F.lit(threshold * threshold) * F.col("q")
    pairs = similar_pairs(vectors, tokens, need, group, ["vec", "q", *payload])
    va, vb = F.col("pa.vec"), F.col("pb.vec")
    dot = F.aggregate(
        F.array_intersect(F.map_keys(va), F.map_keys(vb)),
        F.lit(0.0),
        lambda acc, k: acc + va[k] * vb[k],
    )
    value = measures.cosine(dot, F.col("pa.q"), F.col("pb.q"))
    return pairs.withColumn("cosine", value).filter(F.col("cosine") >= threshold - EPS)


def standard_cosine(actual: DataFrame, standard: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``rid, *keep, std_no, sim`` for sparse vectors that share a slot; the planned side is broadcast if small."""
    left = by_route(actual, standard).select(
        "rid", *keep, F.col("q").alias("qa"), F.explode("vec").alias("slot", "x")
    )
    right = standard.select("std_no", F.col("q").alias("qb"), F.explode("vec").alias("slot", "y"))
    return (
        left.join(broadcast_if_small(right), "slot")
        .groupBy("rid", *keep, "std_no", "qa", "qb")
        .agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
        .select("rid", *keep, "std_no", measures.cosine(F.col("dot"), F.col("qa"), F.col("qb")).alias("sim"))
    )


def ml_vectors(vectors: DataFrame, dimension: int, kept: Scratch | None = None) -> DataFrame:
    """``features`` as a sparse ML vector beside the other columns; no dense array is ever built.

    The column is written in the storage form of an ML vector (kind, size,
    positions, values) and read back as one, so positions are sorted, and K-means
    reads a table in its rounds instead of building the vectors again. The table is
    one of ``kept``, or else is checkpointed and removed.
    """
    if kept is None:
        with Scratch(vectors.sparkSession) as own:
            return cut_lineage(ml_vectors(vectors, dimension, own))
    entries = F.array_sort(F.filter(F.map_entries("vec"), lambda e: e["value"] != 0))
    stored = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(dimension).alias("size"),
        F.transform("_entries", lambda e: e["key"].cast("int")).alias("indices"),
        F.transform("_entries", lambda e: e["value"].cast("double")).alias("values"),
    )
    plain = shape.once(vectors, "_entries", entries).withColumn("features", stored).drop("_entries")
    return kept.read_as(plain, T.StructType([*vectors.schema.fields, T.StructField("features", VectorUDT())]))


def normalized(vectors: DataFrame) -> DataFrame:
    """Rows scaled to length 1 in ``unit``."""
    return Normalizer(inputCol="features", outputCol="unit", p=2.0).transform(vectors)


def kmeans(
    vectors: DataFrame, k: int, seed: int = 1, max_iter: int = 20, rows_per_part: int = 100_000
) -> tuple[KMeansModel, DataFrame]:
    """Model and the input with ``label``.

    The start is drawn per partition, so rows are dealt by ``rid`` to a number of
    parts that follows from their count alone and sorted there: the same seed
    gives the same start on any cluster and in any order of input.
    """
    parts = 1 + vectors.count() // rows_per_part
    dealt = vectors.repartition(parts, "rid").sortWithinPartitions("rid")
    model = KMeans(k=k, seed=seed, maxIter=max_iter, predictionCol="label").fit(dealt)
    return model, model.transform(dealt)


def nearest_center(centers: DataFrame, standard: DataFrame) -> DataFrame:
    """``std_no, label, dist``: nearest centre of every planned route by Euclidean distance.

    centers: ``label, vec, q``. |a-b|^2 = |a|^2 + |b|^2 - 2ab needs shared slots only.
    """
    a = standard.select("std_no", F.col("q").alias("qa"), F.explode("vec").alias("slot", "x"))
    b = centers.select("label", F.col("q").alias("qb"), F.explode("vec").alias("slot", "y"))
    dots = a.join(broadcast_if_small(b), "slot").groupBy("std_no", "label", "qa", "qb").agg(
        F.sum(F.col("x") * F.col("y")).alias("dot")
    )
    dist = measures.l2(F.col("dot"), F.col("qa"), F.col("qb"))
    return best_per(
        dots.select("std_no", "label", dist.alias("dist")),
        ["std_no"], F.round("dist", 9), F.col("label"), keep=["label", "dist"],
    )


def cluster_centers(vectors: DataFrame, label: str = "label") -> DataFrame:
    """``label, vec, q``: mean vector per label; slot sums combine map-side."""
    sizes = vectors.groupBy(label).agg(F.count("*").alias("n"))
    slots = vectors.select(label, F.explode("vec").alias("slot", "x")).groupBy(label, "slot").agg(
        F.sum("x").alias("total")
    )
    return (
        slots.join(sizes, label)
        .withColumn("mean", F.col("total") / F.col("n"))
        .groupBy(label)
        .agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("slot", "mean")))).alias("vec"),
            F.sum(F.col("mean") * F.col("mean")).alias("q"),
        )
    )


def _gram(rows: DataFrame, columns: list[str]) -> np.ndarray:
    """The products of all columns, added up by Spark; small whatever the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(columns), len(columns)))
        for batch in batches:
            block = np.stack([c.to_numpy() for c in batch.columns], axis=1)
            total += block.T @ block
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "g"])

    parts = rows.select(*columns).mapInArrow(run, "i long, j long, g double")
    out = np.zeros((len(columns), len(columns)))
    for r in parts.groupBy("i", "j").agg(F.sum("g").alias("g")).collect():  # the square of the columns
        out[r["i"], r["j"]] = r["g"]
    return out


def _turned(rows: DataFrame, key: str, columns: list[str], by: np.ndarray) -> DataFrame:
    """The columns times a small matrix."""
    names = [f"c{k}" for k in range(by.shape[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = np.stack([batch.column(c).to_numpy() for c in columns], axis=1) @ by if columns else np.zeros((batch.num_rows, 0))
            yield pa.RecordBatch.from_arrays([batch.column(key), *(pa.array(block[:, k]) for k in range(len(names)))], [key, *names])

    schema = ", ".join([f"`{key}` {dict(rows.dtypes)[key]}", *(f"{c} double" for c in names)])
    return rows.select(key, *columns).mapInArrow(run, schema)


def _whitening(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What makes columns with this Gram matrix orthonormal, largest first, without null directions; and its eigenvalues."""
    values, axes = np.linalg.eigh(gram)
    values, axes = values[::-1], axes[:, ::-1]
    some = values > max(float(values[0]), 0.0) * 1e-13 if len(values) else np.zeros(0, bool)
    return axes[:, some] / np.sqrt(values[some]), values[some]


def _times(long: DataFrame, table: DataFrame, on: str, to: str, columns: list[str]) -> DataFrame:
    """A sparse matrix (``rid, key, x``) times a table of columns: one row per ``to``."""
    sums = [F.sum(F.col("x") * F.col(c)).alias(c) for c in columns]
    if not sums:
        return long.select(to).distinct()
    return long.join(broadcast_if_small(table, SVD_BROADCAST_ROWS), on).groupBy(to).agg(*sums)


def _products(rows: DataFrame, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """With A the ``rows`` and S = A x axes: A' x S and S' x S, added up by Spark. S itself is held nowhere.

    rows: ``rid, entries``, an array of ``at`` (row of axes) and ``x``.
    """
    size, width = axes.shape
    sent = rows.sparkSession.sparkContext.broadcast(axes)
    names = [f"c{k}" for k in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + width, width))
        for batch in batches:
            row, at, x, scores = _scored(batch, sent.value)
            total[size:] += scores.T @ scores
            # as in a join on rid, rows without one add nothing here
            some = np.flatnonzero(batch.column("rid").is_valid().to_numpy(zero_copy_only=False)[row])
            order = some[np.argsort(at[some], kind="stable")]
            if len(order):
                first = np.flatnonzero(np.diff(at[order], prepend=-1))
                total[at[order][first]] += np.add.reduceat(x[order, None] * scores[row[order]], first)
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(total[used, k]) for k in range(width))], ["i", *names])

    parts = rows.mapInArrow(run, ", ".join(["i long", *(f"{c} double" for c in names)]))
    out = np.zeros((size + width, width))
    for r in parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect():  # at most SVD_BROADCAST_ROWS and the width
        out[r["i"]] = [r[c] for c in names]
    return out[:size], out[size:]


def _scored(batch: pa.RecordBatch, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch's entries the row, ``at`` and ``x``, and each row's product with the axes."""
    lists = batch.column("entries")
    count = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    at, x = (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
    row = np.repeat(np.arange(len(count)), count)
    scores = np.add.reduceat(x[:, None] * axes[at], np.cumsum(count) - count) if len(count) else np.zeros((0, axes.shape[1]))
    return row, at, x, scores


def truncated_svd(vectors: DataFrame, components: int, oversample: int = 10, rounds: int = 5) -> DataFrame:
    """``rid, component, value``: projection on the leading right singular vectors, by randomized subspace iteration.

    vectors: ``rid, vec``. A block of ``components + oversample`` columns, started from
    hashes of the features, is multiplied by the matrix and its transpose in
    turn and made orthonormal after each from its Gram matrix. Up to ``SVD_BROADCAST_ROWS``
    features the block is sent to the rows, which stay where they are: a round adds up
    one block per task. With more, the products are joins and sums and only matrices of the
    block's width reach the driver. In each component the feature of largest weight is positive.
    """
    long = vectors.select("rid", F.explode("vec").alias("key", "x")).filter("x <> 0")
    keys = stored(long.select("key").distinct())
    size = keys.limit(SVD_BROADCAST_ROWS + 1).count()
    if not 0 < size <= SVD_BROADCAST_ROWS:
        return _joined_svd(vectors, components, oversample, rounds)
    width = components + oversample
    block = keys.select("key", *_start(width)).orderBy("key").toArrow()
    axes = np.stack([block.column(f"c{j}").to_numpy() for j in range(width)], axis=1)
    at = pa.table({"key": block.column("key"), "at": pa.array(np.arange(size))})
    numbered = F.broadcast(vectors.sparkSession.createDataFrame(at, "key {}, at long".format(dict(keys.dtypes)["key"])))
    entry = F.struct("at", F.col("x").cast("double").alias("x"))
    rows = stored(long.join(numbered, "key").groupBy("rid").agg(F.collect_list(entry).alias("entries")))

    axes = axes @ _whitening(axes.T @ axes)[0]
    for _ in range(rounds):
        back, gram = _products(rows, axes)
        axes = back @ _whitening(gram)[0]  # the scores made orthonormal, then sent back
        axes = axes @ _whitening(axes.T @ axes)[0]
    values, turn = np.linalg.eigh(_products(rows, axes)[1])
    turn = turn[:, ::-1][:, : min(components, int((values > 0).sum()))]
    leading = axes @ turn
    weight = np.round(np.abs(leading), 9)
    largest = [leading[np.flatnonzero(w == w.max())[-1], k] for k, w in enumerate(weight.T)]
    sent = vectors.sparkSession.sparkContext.broadcast(leading * np.array([-1.0 if w < 0 else 1.0 for w in largest]))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scored(batch, sent.value)[3]
            offsets = pa.array((np.arange(len(scores) + 1) * scores.shape[1]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.ListArray.from_arrays(offsets, pa.array(scores.ravel()))], ["rid", "values"])

    kind = dict(rows.dtypes)["rid"]
    found = rows.mapInArrow(project, f"rid {kind}, values array<double>")
    return found.select("rid", F.posexplode("values").alias("component", "value"))


def _start(width: int) -> list[Column]:
    """Pseudo-random columns from hashes of the features."""
    return [(F.pmod(F.xxhash64("key", F.lit(j)), F.lit(1 << 20)) / float(1 << 19) - 1).alias(f"c{j}") for j in range(width)]


def _joined_svd(vectors: DataFrame, components: int, oversample: int, rounds: int) -> DataFrame:
    """The same for any number of features: products are joins and sums."""
    width = components + oversample
    with Scratch(vectors.sparkSession) as kept:
        long = kept(vectors.select("rid", F.explode("vec").alias("key", "x")).filter("x <> 0"))
        axes = kept(long.select("key").distinct().select("key", *_start(width)))

        def orthonormal(rows: DataFrame, key: str) -> DataFrame:
            names = [c for c in rows.columns if c != key]
            return kept(_turned(rows, key, names, _whitening(_gram(rows, names))[0]))

        axes = orthonormal(axes, "key")
        for _ in range(rounds):
            before = kept.count
            scores = orthonormal(kept(_times(long, axes, "key", "rid", axes.columns[1:])), "rid")
            axes = orthonormal(kept(_times(long, scores, "rid", "key", scores.columns[1:])), "key")
            kept.free(1, before)
            kept.free(before, kept.count - 1)
        scores = kept(_times(long, axes, "key", "rid", axes.columns[1:]))
        names = scores.columns[1:]
        values, turn = np.linalg.eigh(_gram(scores, names)) if names else (np.zeros(0), np.zeros((0, 0)))
        turn = turn[:, ::-1][:, : min(components, int((values > 0).sum()))]
        leading = _turned(axes, "key", names, turn)
        taken = leading.columns[1:]
        largest = leading.agg(*[F.max_by(c, F.struct(F.round(F.abs(c), 9), "key")).alias(c) for c in taken]).first() if taken else []
        signs = np.array([-1.0 if w is not None and w < 0 else 1.0 for w in largest])
        found = _turned(scores, "rid", names, turn * signs)
        pairs = F.posexplode(F.array(*[F.col(c) for c in taken]) if taken else F.array().cast("array<double>")).alias("component", "value")
        return stored(found.select("rid", pairs))
