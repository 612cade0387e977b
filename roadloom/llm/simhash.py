"""SimHash near-duplicates by a self-join of the fingerprints' binary trie.

Two nodes of the trie are visited together, the bits in which their prefixes
differ are added up, and the pair is given up when the budget is exceeded. Two
fingerprints with at most four differing bits have a quarter (16 bits) with at
most one, so the join runs over four tries, each with another quarter in
front: within the first 16 bits the budget is one, then four. The top of the
tries is a shuffle: a fingerprint goes to its own node of depth ``p`` and to the
nodes one set bit away; the rest of each trie is walked in NumPy, a level of all
node pairs at a time. A node with more than ``BLOCK`` rows is cut into blocks
that meet in separate cells, so neither tasks nor memory grow with a crowd.

What leaves a cell is a spanning forest of its links, not the links.

Dropping near copies (:func:`drop_near_copies`) is by similarity, not by bits:
two texts are linked if their sets of five-word shingles have a Jaccard
similarity of 0.8 or more. The same walk proposes pairs, with a budget that
covers that similarity, and each proposed link is verified on the whole sets. A
pair at exactly 0.8 differs in 9.7 of 64 bits on average with a deviation of
2.9, so about 2 of 100 such pairs pass the budget of 15 bits unseen, and fewer
above. Up to a quarter of the budget may lie in the top of a trie, hence a
fingerprint also goes to the nodes two and three bits away.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.common import Forest, among, key_groups, mixed, only_rows, slices, with_fixed_id, with_row_id
from roadloom.operators.components import connected_components
from roadloom.session import cut_lineage

WORDS, MOST_BITS, SEED = 4, 4, 42
#: for dropping near copies; CHECK_BITS of a second, independent fingerprint are five deviations above the mean at 0.8
NEAR_WORDS, SIMILARITY, NEAR_BITS, CHECK_BITS = 5, 0.8, 15, 25
QUARTERS, QUARTER_BITS, BLOCK, PER_NODE = 4, 16, 4096, 512
LEAF, CHUNK, PAIRS_PER_ROW, VISITORS = 32, 1 << 21, 8, 32


# --- fingerprints --------------------------------------------------------------------------


def shingle_hashes(text: bytes, words: int = WORDS) -> np.ndarray:
    """The XXH64 of each shingle; of the whole text if it has fewer words, none without words."""
    from xxhash import xxh64_intdigest

    found = text.lower().split()  # bytes: ASCII letters and ASCII white space
    if not found:
        return np.zeros(0, np.uint64)
    line = b" ".join(found)
    length = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(length + 1) - 1
    starts = (ends - length).tolist()
    if len(found) < words:
        return np.array([xxh64_intdigest(line, SEED)], np.uint64)
    last = ends[words - 1 :].tolist()
    return np.fromiter((xxh64_intdigest(line[s:e], SEED) for s, e in zip(starts, last)), np.uint64, len(last))


def majority(hashes: np.ndarray) -> int:
    """64 majority bits over the hashes; zero without any."""
    if not len(hashes):
        return 0
    lanes = np.unpackbits(hashes.view(np.uint8), bitorder="little").view(np.uint64).reshape(-1, 8)
    sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)  # byte lanes hold up to 255
    votes = sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """64 majority bits over the XXH64 of each shingle; zero without words."""
    return majority(shingle_hashes(text, words))


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``rid__, doc_id, fp`` (a signed 64-bit integer) for every row; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                texts = batch.column("text").cast(pa.large_binary()).to_pylist()
                found = np.array([fingerprint(t or b"", words) for t in texts], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rid__"), batch.column("doc_id"), pa.array(found.view(np.int64))], ["rid__", "doc_id", "fp"]
                )

    kind = dict(docs.dtypes)["doc_id"]
    return with_row_id(docs.select("doc_id", "text")).mapInArrow(run, f"rid__ long, doc_id {kind}, fp long")


# --- the walk over pairs of nodes ------------------------------------------------------------


def _half(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where bit ``depth`` turns from 0 to 1 in each range of equal prefixes."""
    keep = np.uint64((0xFFFFFFFFFFFFFFFF << (64 - depth)) & 0xFFFFFFFFFFFFFFFF)
    pivot = (values[lo] & keep) | np.uint64(1 << (63 - depth))
    return np.clip(np.searchsorted(values, pivot), lo, hi)


def walk(left: np.ndarray, right: np.ndarray | None, depth: int, differ: int, most: int, head: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted fingerprints that differ in at most ``most`` bits, in bulk.

    right None: pairs within left, each once. The ranges given share their
    first ``depth`` bits, of which ``differ`` differ between the sides; within the
    first 16 bits at most ``head`` may.
    """
    same = right is None
    right = left if same else right
    if not len(left) or not len(right):
        return
    stack = [(depth, np.array([[0, len(left), 0, len(right), differ]]))]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs) > CHUNK:
            stack += [(depth, pairs[:CHUNK]), (depth, pairs[CHUNK:])]
            continue
        area = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        leaf = (area <= LEAF) | (depth == 64)
        if leaf.any():
            yield from _compare(left, right, pairs[leaf], area[leaf], most, same)
        pairs = pairs[~leaf]
        if not len(pairs):
            continue
        alo, ahi, blo, bhi, diff = pairs.T
        amid, bmid = _half(left, alo, ahi, depth), _half(right, blo, bhi, depth)
        twin = (alo == blo) & same
        budget = head if depth < QUARTER_BITS else most
        children = [
            (alo, amid, blo, bmid, diff, None),
            (amid, ahi, bmid, bhi, diff, None),
            (alo, amid, bmid, bhi, diff + 1, None),
            (amid, ahi, blo, bmid, diff + 1, ~twin),
        ]
        out = []
        for a0, a1, b0, b1, d, only in children:
            ok = (a1 > a0) & (b1 > b0) & (d <= budget)
            if only is not None:
                ok &= only
            out.append(np.stack([a0[ok], a1[ok], b0[ok], b1[ok], d[ok]], axis=1))
        stack.append((depth + 1, np.concatenate(out)))


def _compare(left, right, pairs, area, most, same) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs of the given ranges, compared in full, about ``CHUNK`` at a time."""
    total = np.cumsum(area)
    for lo in range(0, int(total[-1]), CHUNK):
        first, last = np.searchsorted(total, lo, side="right"), np.searchsorted(total, lo + CHUNK, side="left")
        part = slice(first, last + 1)
        n, wide = area[part], (pairs[part, 3] - pairs[part, 2])
        which = np.repeat(np.arange(len(n)), n)
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        inside = (at + np.repeat(total[part] - n, n) >= lo) & (at + np.repeat(total[part] - n, n) < lo + CHUNK)
        which, at = which[inside], at[inside]
        i, j = pairs[part, 0][which] + at // wide[which], pairs[part, 2][which] + at % wide[which]
        near = np.bitwise_count(left[i] ^ right[j]) <= most
        if same:
            near &= i < j
        if near.any():
            yield i[near], j[near]


def cell_links(turned: np.ndarray, probe: np.ndarray, side: np.ndarray, split: bool, depth: int, most: int, head: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in one cell, as pairs of turned fingerprints.

    probe: the row visits from a node one bit away. split: the cell is where
    two blocks (side 0, 1) of a crowded node meet, so only pairs across count.
    """
    order = np.argsort(turned, kind="stable")
    turned, probe, side = turned[order], probe[order], side[order]
    forest = Forest(len(turned))

    for i, j in _meetings(turned, probe, side, split, depth, most, head):
        forest.link(i, j)
    a, b = forest.edges()
    return turned[a], turned[b]


def _meetings(turned: np.ndarray, probe: np.ndarray, side: np.ndarray, split: bool, depth: int, most: int, head: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of near fingerprints in one cell of sorted ``turned``, in bulk."""

    def met(a: np.ndarray, b: np.ndarray | None, differ: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i, j in walk(turned[a], None if b is None else turned[b], depth, differ, most, head):
            yield a[i], (a if b is None else b)[j]

    rows = {(p, s): np.flatnonzero((probe == p) & (side == s)) for p in range(head + 1) for s in (0, 1)}
    if split:
        yield from met(rows[0, 0], rows[0, 1], 0)
    else:
        yield from met(rows[0, 0], None, 0)
    for p in range(1, head + 1):
        yield from met(rows[0, 0], rows[p, int(split)], p)
        if split:
            yield from met(rows[0, 1], rows[p, 0], p)


def thinned(forest: Forest, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs to take so that they join all that the pairs join, at most two per row; the forest learns them."""
    taken, left = [], np.arange(len(i))
    while len(left):
        a, b = forest.up[i[left]], forest.up[j[left]]
        left, a, b = left[a != b], a[a != b], b[a != b]
        if len(left):
            some = left[np.union1d(np.unique(a, return_index=True)[1], np.unique(b, return_index=True)[1])]
            forest.link(i[some], j[some])
            taken.append(some)
    return np.concatenate([np.zeros(0, np.int64), *taken])


# --- the operator --------------------------------------------------------------------------


def _turn(quarter: int):
    by = QUARTER_BITS * quarter
    return F.shiftleft("fp", by).bitwiseOR(F.shiftrightunsigned("fp", 64 - by)) if by else F.col("fp")


def _depth(n: int, head: int) -> int:
    """More bits on the way mean more visits, so nodes are larger then."""
    return min(QUARTER_BITS, max(6, (n // (PER_NODE if head < 2 else BLOCK)).bit_length()))


def _cells(fps: DataFrame, depth: int, head: int) -> DataFrame:
    """A row per visit of a fingerprint to a cell, with the other columns of ``fps``.

    A pair whose nodes differ in up to ``head`` bits meets at the lower node,
    where ``probe`` is the number of bits the visitor's own node is away.
    """
    rest = [c for c in fps.columns if c != "fp"]
    own = F.col("node")
    masks = [sum(1 << b for b in bits) for k in range(1, head + 1) for bits in combinations(range(depth), k)]
    visits = F.filter(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: own.bitwiseXOR(m) < own)
    turned = fps.select(
        *rest, F.explode(F.array(*[F.struct(F.lit(q).alias("trie"), _turn(q).alias("turned")) for q in range(QUARTERS)])).alias("x")
    ).select(*rest, "x.trie", "x.turned", F.shiftrightunsigned("x.turned", 64 - depth).alias("node"))
    rows = turned.select(
        "trie",
        "turned",
        *rest,
        F.explode(
            F.concat(
                F.array(F.struct(own.alias("node"), F.lit(0).alias("probe"))),
                F.transform(visits, lambda m: F.struct(own.bitwiseXOR(m).alias("node"), F.bit_count(m).alias("probe"))),
            )
            if head
            else F.array(F.struct(own.alias("node"), F.lit(0).alias("probe")))
        ).alias("at"),
    ).select("trie", "turned", *rest, "at.node", "at.probe")
    # visitors only meet a node's own rows, so with many visits per row a block has room for more of them
    n = F.count("*") if head < 2 else F.greatest(F.count_if(F.col("probe") == 0), F.ceil(F.count("*") / VISITORS))
    crowds = rows.groupBy("trie", "node").agg(n.alias("n")).filter(F.col("n") > BLOCK)
    blocks = F.ceil(F.coalesce("n", F.lit(1)) / BLOCK).cast("int")
    return (
        rows.join(crowds, ["trie", "node"], "left")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("turned", *rest[:1]), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "trie",
            "node",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            (F.col("block") > F.col("other")).cast("int").alias("side"),
            "probe",
            "turned",
            *rest,
        )
    )


_CELL = ["trie", "node", "i", "j"]


def links(fps: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """``a, b``: edges that connect just what links of at most ``most`` differing bits connect. fps: distinct ``fp``."""
    head = most // QUARTERS
    depth = _depth(fps.count(), head)
    cells = _cells(fps, depth, head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in key_groups(batches, _CELL):
            if cell.num_rows < 2:
                continue
            quarter, i, j = (cell.column(c)[0].as_py() for c in ("trie", "i", "j"))
            turned, probe, side = (cell.column(c).to_numpy() for c in ("turned", "probe", "side"))
            found = cell_links(turned.view(np.uint64), probe, side, i != j, depth, most, head)
            by = np.uint64(QUARTER_BITS * quarter)
            if quarter:
                found = [(x >> by) | (x << (np.uint64(64) - by)) for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in found], ["a", "b"])

    return cells.repartition(*_CELL).sortWithinPartitions(*_CELL).mapInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, words: int = WORDS, most: int = MOST_BITS) -> DataFrame:
    """``rid__, doc_id, fingerprint, component_id, kept`` for every row.

    ``kept`` marks one row of each component: the smallest doc_id, a null id
    last, of repeated rows the first. Null and empty texts have fingerprint zero
    and link like any other. component_id is null only where no row of the
    component has an id.
    """
    rows = cut_lineage(fingerprints(docs, words))
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid__")
    fps = cut_lineage(rows.groupBy("fp").agg(F.min(name).alias("best")))
    edges = cut_lineage(links(fps.select("fp"), most).distinct())
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = cut_lineage(connected_components(edges, nodes).select(F.col("node").alias("fp"), "component"))
    grouped = fps.join(sets, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    best = grouped.groupBy("component").agg(F.min("best").alias("first"))
    decided = grouped.select("fp", "component").join(best, "component").select("fp", "first")
    return rows.join(decided, "fp").select(
        "rid__",
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
        (F.col("rid__") == F.col("first.rid__")).alias("kept"),
    )


# --- dropping near copies by verified similarity -----------------------------------------------


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """``rid__, doc_id, key, fp, check, size``: the hash, two fingerprints and the size of each text's set of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                found = []
                for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                    shingles = np.unique(shingle_hashes(text or b"", words))
                    other = mixed(shingles)
                    key = mixed(np.array([other.sum(dtype=np.uint64) + np.uint64(len(other))]))[0]
                    found.append((key, majority(shingles), majority(other), len(shingles)))
                numbers = np.array(found, np.uint64).reshape(-1, 4).T
                columns = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in numbers]
                yield pa.RecordBatch.from_arrays([batch.column("rid__"), batch.column("doc_id"), *columns], ["rid__", "doc_id", "key", "fp", "check", "size"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("rid__", "doc_id", "text").mapInArrow(run, f"rid__ long, doc_id {kind}, key long, fp long, check long, size long")


def _centred(n: int, degree: np.ndarray, pairs) -> tuple[np.ndarray, np.ndarray]:
    """Of a crowd's pairs: each row's with its partner of most pairs, and some that join all that the pairs join.

    Variants of one text are often near to it and too far from each other, and
    the text is near to all of them, so it has most pairs. pairs: gives the pairs again, in bulk.
    """
    forest, best, taken = Forest(n), np.full(n, -1), []
    for i, j in pairs():
        for rows, partners in ((i, j), (j, i)):
            order = np.argsort(degree[partners], kind="stable")
            offer = np.full(n, -1)
            offer[rows[order]] = partners[order]  # the last, of most pairs, stays
            better = (offer >= 0) & (np.where(best >= 0, degree[best], -1) < degree[offer])
            best[better] = offer[better]
        some = thinned(forest, i, j)
        taken.append((i[some], j[some]))
    own = np.flatnonzero(best >= 0)
    return tuple(np.concatenate([x, *(t[k] for t in taken)]) for k, x in enumerate((own, best[own])))


def proposed(nodes: DataFrame, most: int, similarity: float, depth: int, crowded: DataFrame | None = None) -> DataFrame:
    """``a, b, trie, node, i, j``: pairs of keys within the bits and sizes of the similarity.

    nodes: ``fp, key, size, check`` and maybe ``label``; pairs with equal labels are left out, and
    those whose second fingerprints are too far apart. A cell with more than
    ``PAIRS_PER_ROW`` pairs for each of its rows only gives the pairs of :func:`_centred`,
    and its name. crowded: the only cells asked for, which give all pairs.
    """
    head = most // QUARTERS
    cells = _cells(nodes.select("fp", "key", "size", "check", *(["label"] if "label" in nodes.columns else [])), depth, head)
    if crowded is not None:
        cells = cells.join(crowded, _CELL, "left_semi")
    whole = crowded is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in key_groups(batches, _CELL):
            if cell.num_rows < 2:
                continue
            name = [cell.column(c)[0].as_py() for c in _CELL]
            order = np.argsort(cell.column("turned").to_numpy().view(np.uint64), kind="stable")
            turned, probe, side, key, size, check = (cell.column(c).to_numpy()[order] for c in ("turned", "probe", "side", "key", "size", "check"))
            label = cell.column("label").to_numpy()[order] if "label" in cell.column_names else key

            def likely() -> Iterator[tuple[np.ndarray, np.ndarray]]:
                for i, j in _meetings(turned.view(np.uint64), probe, side, name[2] != name[3], depth, most, head):
                    ok = (label[i] != label[j]) & (np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j]) - 1e-9)
                    ok &= np.bitwise_count((check[i] ^ check[j]).view(np.uint64)) <= CHECK_BITS
                    yield i[ok], j[ok]

            held, n, degree = [], 0, np.zeros(len(turned), np.int64)
            for i, j in likely():
                n += len(i)
                if whole:
                    yield from _pair_rows(key[i], key[j], None)
                    continue
                degree += np.bincount(i, minlength=len(turned)) + np.bincount(j, minlength=len(turned))
                if n <= PAIRS_PER_ROW * len(turned):
                    held.append((i, j))
            if whole:
                continue
            if n > PAIRS_PER_ROW * len(turned):
                i, j = _centred(len(turned), degree, likely)
                yield from _pair_rows(key[i], key[j], name)
            else:
                for i, j in held:
                    yield from _pair_rows(key[i], key[j], None)

    return cells.repartition(*_CELL).sortWithinPartitions(*_CELL).mapInArrow(run, "a long, b long, trie int, node long, i int, j int")


def _pair_rows(a: np.ndarray, b: np.ndarray, cell: list | None) -> Iterator[pa.RecordBatch]:
    """Pairs in the order of their keys; the cell is named if it holds more."""
    if len(a):
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32())
        names = [pa.array([None if cell is None else cell[k]] * len(a), kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), *names], ["a", "b", *_CELL])


def _verified(docs: DataFrame, likely: DataFrame, words: int, similarity: float) -> DataFrame:
    """``a, b``: the pairs of keys whose sets of shingles have at least the similarity. A key is the id of a row with the set."""
    asked = likely.select(F.explode(F.array("a", "b")).alias("rid__")).distinct()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                texts = batch.column("text").cast(pa.large_binary()).to_pylist()
                found = [np.unique(shingle_hashes(t or b"", words)).tobytes() for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.binary())], ["key", "shingles"])

    texts = among(docs.select("rid__", "text"), asked).withColumnRenamed("rid__", "key")
    shingles = cut_lineage(texts.mapInArrow(sets, "key long, shingles binary"))
    both = (
        likely.join(shingles.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a")
        .join(shingles.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")
        .select("a", "b", "x", "y")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                near[k] = common >= similarity * (len(x) + len(y) - common) - 1e-9
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return cut_lineage(both.mapInArrow(check, "a long, b long"))


def similar_groups(docs: DataFrame, words: int = NEAR_WORDS, most: int = NEAR_BITS, similarity: float = SIMILARITY) -> DataFrame:
    """``rid__, doc_id, component_id, kept`` for every row; linked are texts of at least the similarity.

    Texts with the same set of shingles are one node. A crowded cell first gives
    only pairs that would join all its rows, and once these are verified the
    pairs that are still in different components. ``kept`` as in
    :func:`near_groups`.
    """
    docs = with_fixed_id(docs)
    rows = cut_lineage(_sets(docs, words))
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid__")
    nodes = cut_lineage(
        rows.groupBy("key").agg(F.min(name).alias("best"), F.first("fp").alias("fp"), F.first("check").alias("check"), F.first("size").alias("size"))
    )
    one = nodes.select(F.col("best.rid__").alias("key"), "fp", "check", "size")  # a set goes by its first row
    depth = _depth(nodes.count(), most // QUARTERS)

    def joined(edges: DataFrame) -> DataFrame:
        ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        sets = connected_components(edges, ends).select(F.col("node").alias("key"), "component")
        return cut_lineage(one.join(sets, "key", "left").withColumn("label", F.coalesce("component", "key")).drop("component"))

    first = cut_lineage(proposed(one, most, similarity, depth))
    tried = cut_lineage(first.select("a", "b").distinct())
    edges = _verified(docs, tried, words, similarity)
    labelled = joined(edges)
    crowded = cut_lineage(first.filter("trie IS NOT NULL").select(*_CELL).distinct())
    if not crowded.isEmpty():
        rest = proposed(labelled, most, similarity, depth, crowded).select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
        rest = cut_lineage(rest)
        if not rest.isEmpty():
            labelled = joined(edges.unionByName(_verified(docs, rest, words, similarity)))
    grouped = nodes.select(F.col("key").alias("set"), "best", F.col("best.rid__").alias("key")).join(labelled.select("key", "label"), "key")
    best = grouped.groupBy("label").agg(F.min("best").alias("first"))
    decided = grouped.select(F.col("set").alias("key"), "label").join(best, "label").select("key", "first")
    return rows.join(decided, "key").select(
        "rid__", "doc_id", F.col("first.doc_id").alias("component_id"), (F.col("rid__") == F.col("first.rid__")).alias("kept")
    )


def drop_near_copies(docs: DataFrame, columns: list[str], **params) -> DataFrame:
    """One row of each component of similar texts, with the named columns."""
    docs = with_fixed_id(docs)
    return only_rows(docs, similar_groups(docs, **params).filter("kept"), columns)


def query(spark, sf_dir: str) -> DataFrame:
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("rid__")
