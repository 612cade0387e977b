"""Embedding near-duplicates by lattice hashing.

In each of ``TABLES`` tables a random projection to eight dimensions, scaled and
shifted, is decoded to the nearest point of the E8 lattice, which is the
vector's home cell. A vector also visits the ``PROBES`` neighbouring cells,
among the 240 nearest points around its own, that its residual points to most.
Vectors that meet in a cell are compared exactly, in double precision. At a
cosine of 0.9 the tables together find 99 of 100 pairs, at 0.98 all but none.

Equal vectors are one row with a multiplicity. A cell with more than ``BLOCK``
rows is cut into blocks that meet in separate cells. A pair is counted in the
first table that finds it, which both rows' cells tell; counts and a spanning
forest of links leave a cell, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.common import Forest, key_groups, mixed, with_row_id
from roadloom.operators.components import connected_components
from roadloom.session import cut_lineage

TABLES, PROBES, SCALE, BLOCK, SEED = 6, 4, 0.2, 1024, 20240608
LEAST_COSINE = 0.9


@cache
def _neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: two of +-1, or all +-1/2 with an even number of minuses."""
    whole = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            whole.append(v)
    half = [v for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(whole + half)


@cache
def _projection(table: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.Philox([SEED, table * 65_536 + size]))
    wide = rng.normal(size=(max(size, 8), 8))
    return np.linalg.qr(wide)[0][:size] * np.sqrt(max(size, 8) / 64) / SCALE, 2 * rng.random(8)


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest whole points with an even sum."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """E8 is the even whole points and the same shifted by one half."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


def _name(points: np.ndarray, table: int) -> np.ndarray:
    """A 32-bit name of lattice points (twice a point is whole); points that share a name share a cell."""
    whole = (2 * points).astype(np.int64).view(np.uint64)
    out = np.full(points.shape[:-1], table + 1, np.uint64)
    for k in range(8):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + whole[..., k])
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def unit_vectors(raw: np.ndarray) -> np.ndarray:
    """Rows at length one, in double precision."""
    raw = raw.astype(np.float64)
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def cells(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Home cells (rows, tables) and visited cells (rows, tables, probes) of unit vectors."""
    homes, visits = [], []
    for table in range(TABLES):
        matrix, shift = _projection(table, units.shape[1])
        x = units @ matrix + shift
        home = nearest_e8(x)
        toward = (x - home) @ _neighbours().T
        best = np.argpartition(-toward, PROBES, axis=1)[:, :PROBES]
        homes.append(_name(home, table))
        visits.append(_name(home[:, None, :] + _neighbours()[best], table))
    return np.stack(homes, axis=1), np.stack(visits, axis=1)


def _compared(table: int, home: np.ndarray, visits: np.ndarray, cell: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs (x, y), y at home in the cell, this cell is the first to find."""
    first = np.ones(len(x), bool)
    for t in range(table):
        meet = (home[x, t] == home[y, t]) | (visits[x, t] == home[y, t][:, None]).any(axis=1) | (visits[y, t] == home[x, t][:, None]).any(axis=1)
        first &= ~meet
    mutual = (home[x, table] != cell) & (visits[y, table] == home[x, table][:, None]).any(axis=1)
    return first & ~(mutual & (home[x, table] < cell))


def _cell_links(group: pa.Table, tables: int, probes: int, least: float) -> tuple[np.ndarray, ...]:
    """Links found in a cell: per row the number of vectors newly linked, and a spanning forest."""
    n, table = group.num_rows, group.column("t")[0].as_py()
    cell, split = group.column("cell")[0].as_py(), group.column("i")[0].as_py() != group.column("j")[0].as_py()
    column = lambda c: group.column(c).combine_chunks()
    units = unit_vectors(column("vec").flatten().to_numpy().reshape(n, -1))
    home = column("home").flatten().to_numpy().reshape(n, tables)
    visits = column("visits").flatten().to_numpy().reshape(n, tables, probes)
    times, side = column("times").to_numpy(), column("side").to_numpy()
    here = home[:, table] == cell
    forest, counts = Forest(n), np.zeros(n, np.int64)
    for lo in range(0, n, 256):
        cosine = units[lo : lo + 256] @ units.T
        x, y = np.nonzero(cosine >= least)
        x += lo
        # y at home here; of two at home, each pair once
        ok = here[y] & (~here[x] | (x < y))
        if split:
            ok &= side[x] != side[y]
        x, y = x[ok], y[ok]
        if not len(x):
            continue
        forest.link(x, y)
        new = _compared(table, home, visits, cell, x, y)
        np.add.at(counts, x[new], times[y[new]])
        np.add.at(counts, y[new], times[x[new]])
    return counts, *forest.edges()


def linked(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Null and zero vectors, and vectors with null or non-finite components, link
    with nothing, and vectors of different sizes never with one another. A row
    with a null id keeps its links; component_id is null only where no row of the
    component has an id, and kept is then true for the first row. Rows of equal
    id and vector count as copies; kept is true for each of them with the smallest id.
    """
    number = "float" if dict(vectors.dtypes)["embedding"] == "array<float>" else "double"
    rows = with_row_id(vectors.select("vec_id", "embedding")).withColumn("vec", F.col("embedding").cast(f"array<{number}>"))
    sound = (
        F.col("vec").isNotNull()
        & F.coalesce(F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists("vec", lambda v: v != 0), F.lit(False))
    )
    rows = cut_lineage(
        rows.select("rid__", "vec_id", F.when(sound, F.col("vec")).alias("vec"))
        .withColumn("k1", F.xxhash64("vec"))
        .withColumn("k2", F.xxhash64(F.lit(1), "vec"))
    )
    name = F.struct(F.col("vec_id").isNull().alias("unnamed"), "vec_id", "rid__")
    distinct = (
        rows.filter("vec IS NOT NULL")
        .groupBy("k1", "k2", "vec")
        .agg(F.min(name).alias("best"), F.count("*").alias("times"))
        .withColumn("gid", F.monotonically_increasing_id())
    )
    distinct = cut_lineage(distinct)
    tables, probes = TABLES, PROBES

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("vec")).to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                home, visits = cells(unit_vectors(part.column("vec").flatten().to_numpy().reshape(-1, size)))
                lists = lambda a: pa.FixedSizeListArray.from_arrays(pa.array(a.reshape(-1)), a.size // len(a)).cast(pa.list_(pa.from_numpy_dtype(a.dtype)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("gid"), part.column("times"), part.column("vec"), lists(home), lists(visits)],
                    ["gid", "times", "vec", "home", "visits"],
                )

    placed = cut_lineage(
        distinct.select("gid", "times", "vec").mapInArrow(
            place, f"gid long, times long, vec array<{number}>, home array<int>, visits array<int>"
        )
    )
    at = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(tables - 1)),
            lambda t: F.transform(
                F.concat(F.array(F.get("home", t)), F.slice("visits", t * probes + 1, probes)),
                lambda c: F.struct(t.alias("t"), c.alias("cell")),
            ),
        )
    )
    # which cells have company is found without the vectors; each then moves once per such cell
    narrow = placed.select("gid", F.size("vec").alias("size"), F.explode(at).alias("at")).select("gid", "size", "at.t", "at.cell")
    crowds = narrow.groupBy("size", "t", "cell").agg(F.count("*").alias("n")).filter("n > 1")
    company = (
        narrow.join(crowds, ["size", "t", "cell"])
        .groupBy("gid")
        .agg(F.collect_list(F.struct("t", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))).alias("at"))
    )
    meets = placed.join(company, "gid").withColumn("size", F.size("vec")).withColumn("at", F.explode("at"))
    blocks = (
        meets.select("gid", "times", "vec", "home", "visits", "size", "at.t", "at.cell", "at.blocks")
        .withColumn("block", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .withColumn("side", (F.col("block") > F.col("other")).cast("int"))
    )
    key = ["size", "t", "cell", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_groups(batches, key):
            if group.num_rows < 2:
                continue
            gid = group.column("gid").to_numpy()
            counts, a, b = _cell_links(group, tables, probes, least)
            some = np.flatnonzero(counts)
            nothing = pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([gid[some], gid[a]])),
                    pa.chunked_array([nothing, pa.array(gid[b])]).combine_chunks(),
                    pa.array(np.concatenate([counts[some], np.zeros(len(a), np.int64)])),
                ],
                ["a", "b", "n"],
            )

    found = cut_lineage(
        blocks.select(*key, "side", "gid", "times", "vec", "home", "visits")
        .repartition(*key)
        .sortWithinPartitions(*key)
        .mapInArrow(compare, "a long, b long, n long")
    )
    counts = found.groupBy(F.col("a").alias("gid")).agg(F.sum("n").alias("others"))
    edges = cut_lineage(found.filter("b IS NOT NULL").select("a", "b").distinct())
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = connected_components(edges, nodes).select(F.col("node").alias("gid"), "component")
    grouped = cut_lineage(
        distinct.select("k1", "k2", "gid", "times", "best")
        .join(sets, "gid", "left")
        .join(counts, "gid", "left")
        .withColumn("component", F.coalesce("component", "gid"))
    )
    first = grouped.groupBy("component").agg(F.min("best").alias("first"))
    decided = grouped.join(first, "component").select(
        "k1", "k2", (F.coalesce("others", F.lit(0)) + F.col("times") - 1).alias("n_links"), "first", F.lit(True).alias("sound")
    )
    alone = F.col("sound").isNull()
    lowest = F.col("first.vec_id")
    return (
        rows.select("rid__", "vec_id", "k1", "k2")
        .join(decided, ["k1", "k2"], "left")
        .select(
            "vec_id",
            F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
            F.when(alone, F.col("vec_id")).otherwise(lowest).alias("component_id"),
            F.coalesce(F.when(alone, F.lit(True)).otherwise(F.col("vec_id") == lowest), F.col("rid__") == F.col("first.rid__"), F.lit(False)).alias("kept"),
        )
    )


def query(spark, sf_dir: str) -> DataFrame:
    return linked(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
