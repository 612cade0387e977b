"""Line deduplication by an exact set-similarity join.

A line's tokens are its distinct words, rarest first: rarity is the word's
count over all texts in a table of fixed size, ties in the order of hashes. Two
lines of Jaccard similarity t share one of their first n - ceil(t n) + 1
tokens; among lines meeting at such a token, lengths, positions and the parity
of their tokens in 64 bits rule out most pairs, and the rest are verified on
their whole sets. A line goes if it equals an earlier line or is similar to
one; the order is (doc_id, line number).

A line needs one earlier match only. So each line proposes, per shared token,
the ``ENOUGH`` earliest lines that pass the filters, and only lines that have
more of them and whose proposals all fail are matched with everything that
passes. A crowd of similar lines is therefore linear work. Equal lines are one entry per task before anything
moves; what moves are packed arrays, byte plane by byte plane, so that the high bytes of small numbers
cost nothing once compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.common import Words, key_groups, mixed, slices, whole_text, with_fixed_id
from roadloom.session import stored

#: the query takes every line that has a word; LEAST_WORDS is what the functions take if not told
SIMILARITY, LEAST_WORDS, EVERY_LINE, ENOUGH = 0.8, 5, 1, 4
SHARD_BITS, SKETCH_BITS, CHUNK_BITS = 6, 23, 6
TOKEN_BITS = 44
TOKEN_BYTES = (TOKEN_BITS + 7) // 8
_TOKEN = np.dtype((np.uint8, TOKEN_BYTES))
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_NO_ID = np.iinfo(np.int64).max


class Lines:
    """The lines of a batch of texts that have at least ``least`` words."""

    def __init__(self, batch: pa.RecordBatch, least: int) -> None:
        self.words = words = Words(batch.column("text"))
        breaks = np.flatnonzero(words.data == 10)
        number = np.searchsorted(breaks, words.start) + words.doc
        begin = np.flatnonzero(np.diff(number, prepend=-1))
        count = np.diff(np.append(begin, len(words)))
        self.hashes = words.hashes()
        place = np.arange(len(words)) - np.repeat(begin, count)
        parts = mixed(self.hashes + place.astype(np.uint64) * _GOLDEN)
        key = mixed(np.add.reduceat(parts, begin)) if len(begin) else np.zeros(0, np.uint64)
        keep = count >= least
        self.begin, self.count, self.key = begin[keep], count[keep], key[keep]
        self.doc = words.doc[self.begin]
        first = np.searchsorted(breaks, words.bounds[:-1]) + np.arange(words.n_docs)
        self.line = (number[self.begin] - first[self.doc]).astype(np.int32)
        ids = batch.column("doc_id").cast(pa.int64()).fill_null(_NO_ID).to_numpy()
        self.doc_id = ids[self.doc]

    def sets(self, which: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct tokens of the given lines, rarest first: tokens, where each line's begin, how many."""
        count = self.count[which]
        ends = np.cumsum(count)
        n = int(ends[-1]) if len(ends) else 0
        h = self.hashes[np.arange(n) + np.repeat(self.begin[which] - (ends - count), count)]
        rarity = sketch[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
        token = (rarity << np.uint64(TOKEN_BITS - 16)) | ((h * _GOLDEN) >> np.uint64(64 - TOKEN_BITS + 16))
        out_tokens, out_lines = [], []
        per = 1 << (64 - TOKEN_BITS)  # lines that fit beside a token in 64 bits
        line = np.repeat(np.arange(len(which)), count)
        for lo in range(0, len(which), per):
            part = slice(int(ends[lo] - count[lo]), int(ends[min(lo + per, len(which)) - 1]))
            both = np.sort(((line[part] - lo).astype(np.uint64) << np.uint64(TOKEN_BITS)) | token[part])
            both = both[np.concatenate([[True], both[1:] != both[:-1]])]
            out_tokens.append(both & np.uint64((1 << TOKEN_BITS) - 1))
            out_lines.append((both >> np.uint64(TOKEN_BITS)).astype(np.int64) + lo)
        if not out_tokens:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        tokens, lines = np.concatenate(out_tokens), np.concatenate(out_lines)
        sizes = np.bincount(lines, minlength=len(which))
        return tokens, np.cumsum(sizes) - sizes, sizes


def _whole(short: np.ndarray) -> np.ndarray:
    """Tokens of ``TOKEN_BYTES`` bytes as 64-bit numbers."""
    return np.pad(short, ((0, 0), (0, 8 - TOKEN_BYTES))).view(np.uint64).reshape(-1)


def _shards(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys) >> np.uint64(64 - SHARD_BITS)).astype(np.int64)


def _planes(values: np.ndarray) -> bytes:
    """All lowest bytes, then all next ones, and so on, compressed."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T), "zstd", asbytes=True)


def _values(packed: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(packed, n * width, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).reshape(-1).view(kind)


def _packed(shard: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A row per shard with the arrays' bytes (:func:`_planes`) and their length."""
    order = np.argsort(shard, kind="stable")
    found, first = np.unique(shard[order], return_index=True)
    bounds = np.append(first, len(order))
    if len(found):
        arrays = [[_planes(c[order[lo:hi]]) for lo, hi in zip(bounds, bounds[1:])] for c in columns]
        names = ["shard", "n", *(f"c{i}" for i in range(len(columns)))]
        numbers = [pa.array(found.astype(np.int32)), pa.array(np.diff(bounds).astype(np.int32))]
        yield pa.RecordBatch.from_arrays([*numbers, *(pa.array(a, pa.binary()) for a in arrays)], names)


def _schema(n: int) -> str:
    return "shard int, n int, " + ", ".join(f"c{i} binary" for i in range(n))


def _unpacked(group: pa.Table, kinds: list) -> list[np.ndarray]:
    sizes = group.column("n").to_pylist()
    return [np.concatenate([_values(b, n, k) for b, n in zip(group.column(f"c{i}").to_pylist(), sizes)]) for i, k in enumerate(kinds)]


def _dealt(packed: DataFrame) -> DataFrame:
    return packed.repartition(1 << SHARD_BITS, "shard").sortWithinPartitions("shard")


def _fixed_table(rows: DataFrame, add, bits: int) -> np.ndarray:
    """Counts, up to 65,535, in 2**bits cells; ``add`` gives a batch's cells. The size doesn't grow with the data."""
    size = 1 << (bits - CHUNK_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << bits, np.uint32)
        for whole in batches:
            for at in add(whole):
                found, n = np.unique(at, return_counts=True)
                cells[found] += n.astype(np.uint32)
        some = np.flatnonzero(cells)
        yield from _packed(some // size, [(some % size).astype(np.uint32), np.minimum(cells[some], 65_535).astype(np.uint16)])

    return _summed_table(rows.mapInArrow(count, _schema(2)), bits)


def _summed_table(counts: DataFrame, bits: int) -> np.ndarray:
    size = 1 << (bits - CHUNK_BITS)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_groups(batches, ["shard"]):
            at, n = _unpacked(group, [np.uint32, np.uint16])
            cells = np.minimum(np.bincount(at, n, size), 65_535).astype(np.uint16)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([group.column("shard")[0].as_py()], pa.int32()), "c0": pa.array([cells.tobytes()], pa.binary())})

    out = np.zeros((1 << CHUNK_BITS, size), np.uint16)
    for row in _dealt(counts).mapInArrow(total, "shard int, c0 binary").collect():
        out[row["shard"]] = np.frombuffer(row["c0"], np.uint16)
    return out.reshape(-1)


def _marks(table: np.ndarray) -> np.ndarray:
    """Which cells of a table are not empty, in bits: an eighth of a byte a cell goes to the tasks."""
    return np.packbits(table > 0)


def _marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the cells that ``keys`` fall into are marked."""
    at = (keys & np.uint64(8 * len(marks) - 1)).astype(np.int64)
    return (marks[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def _prefix(n: np.ndarray) -> np.ndarray:
    return n - np.ceil(n * SIMILARITY - 1e-9).astype(np.int64) + 1


def _least_overlap(m: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.ceil((m + n) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9).astype(np.int64)


#: token, line key, parity bits, doc_id, line, set size, position
_ENTRY = [np.uint64, np.uint64, np.uint64, np.int64, np.int32, np.int32, np.int32]


def _entries(docs: DataFrame, sketch, least: int, wanted=None) -> DataFrame:
    """Prefix entries of every line, by shards of tokens; words that occur once anywhere can't meet another.

    wanted: a table of the only tokens asked for (and some more that share its cells).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sketch.value
        for whole in batches:
            for batch in slices(whole):
                lines = Lines(batch, least)
                order = np.lexsort((lines.line, lines.doc_id, lines.key))
                key = lines.key[order]
                which = np.sort(order[np.concatenate([[True], key[1:] != key[:-1]])]) if len(order) else order
                tokens, begin, size = lines.sets(which, table)
                line = np.repeat(np.arange(len(which)), size)
                place = np.arange(len(tokens)) - begin[line]
                bits = np.uint64(1) << (mixed(tokens) & np.uint64(63))
                parity = np.bitwise_xor.reduceat(bits, begin) if len(begin) else np.zeros(0, np.uint64)
                use = (place < _prefix(size)[line]) & ((tokens >> np.uint64(TOKEN_BITS - 16)) > 1)
                if wanted is not None:
                    use &= _marked(wanted.value, mixed(tokens))
                token, line, place = tokens[use], line[use], place[use]
                at = which[line]
                columns = [token, lines.key[at], parity[line], lines.doc_id[at], lines.line[at], size[line].astype(np.int32), place.astype(np.int32)]
                yield from _packed(_shards(token), columns)

    return _dealt(docs.mapInArrow(run, _schema(len(_ENTRY))))


def _passes(x: np.ndarray, y: np.ndarray, bits, size, place) -> np.ndarray:
    """Length, position and parity filters for pairs of entries at one token."""
    m, n = size[x].astype(np.int64), size[y].astype(np.int64)
    need = _least_overlap(m, n)
    ok = (np.minimum(m, n) >= np.maximum(m, n) * SIMILARITY - 1e-9) & (1 + np.minimum(m - 1 - place[x], n - 1 - place[y]) >= need)
    return ok & (np.bitwise_count(bits[x] ^ bits[y]) <= m + n - 2 * need)


def _proposals(entries: list[np.ndarray], open_lines: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (later line, earlier line) at each token, and whether a later line has more of them.

    Per token the ``ENOUGH`` earliest lines that pass the filters; for open lines all that pass.
    """
    token, key, bits, doc, line, size, place = entries
    order = np.lexsort((key, line, doc, token))
    token, key, bits, doc, line, size, place = (c[order] for c in (token, key, bits, doc, line, size, place))
    # equal lines from several tasks: the earliest entry stands for them
    again = np.lexsort((np.arange(len(key)), key, token))
    fresh = np.ones(len(key), bool)
    a, b = again[:-1], again[1:]
    fresh[b[(token[a] == token[b]) & (key[a] == key[b])]] = False
    token, key, bits, size, place = (c[fresh] for c in (token, key, bits, size, place))
    if not len(token):
        return key, key, np.zeros(0, bool)
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    start = np.repeat(first, np.diff(np.append(first, len(token))))
    nth = np.arange(len(token)) - start
    later, earlier = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    active, turn, had = np.flatnonzero(nth > 0), 0, np.zeros(len(token), np.int64)
    if open_lines is not None:
        active = active[_marked(open_lines, key[active])]
    more = np.zeros(len(token), bool)
    while len(active):
        x = start[active] + turn
        ok = _passes(x, active, bits, size, place)
        later.append(active[ok])
        earlier.append(x[ok])
        had[active[ok]] += 1
        turn += 1
        active = active[nth[active] > turn]
        if open_lines is None:
            full = had[active] >= ENOUGH
            more[active[full]] = True
            active = active[~full]
    later = np.concatenate(later)
    return key[later], key[np.concatenate(earlier)], more[later]


def _candidates(entries: DataFrame, open_lines=None) -> DataFrame:
    """``later, earlier, more``: distinct pairs of line keys; more: the later line may have further matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_groups(batches, ["shard"]):
            y, x, more = _proposals(_unpacked(group, _ENTRY), None if open_lines is None else open_lines.value)
            yield pa.RecordBatch.from_arrays([pa.array(y.view(np.int64)), pa.array(x.view(np.int64)), pa.array(more)], ["later", "earlier", "more"])

    return entries.mapInArrow(run, "later long, earlier long, more boolean").groupBy("later", "earlier").agg(F.max("more").alias("more"))


def _cells_of(columns: list[str], bits: int):
    def add(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for c in columns:
            yield batch.column(c).to_numpy().view(np.uint64) & np.uint64((1 << bits) - 1)

    return add


def _token_cells(tokens: np.ndarray) -> np.ndarray:
    return (mixed(tokens) & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def _prefix_tokens(docs: DataFrame, sketch, least: int, open_lines) -> np.ndarray:
    """Marks of the leading tokens of open lines (and of some more that share their cells)."""

    def add(whole: pa.RecordBatch) -> Iterator[np.ndarray]:
        for batch in slices(whole):
            lines = Lines(batch, least)
            tokens, begin, size = lines.sets(np.flatnonzero(_marked(open_lines.value, lines.key)), sketch.value)
            place = np.arange(len(tokens)) - np.repeat(begin, size)
            yield _token_cells(tokens[place < np.repeat(_prefix(size), size)])

    return _marks(_fixed_table(docs, add, SKETCH_BITS))


def _verified(docs: DataFrame, pairs: DataFrame, sketch, least: int) -> DataFrame:
    """``key``: lines with a verified earlier match among the pairs."""
    needed = docs.sparkSession.sparkContext.broadcast(_marks(_fixed_table(pairs, _cells_of(["later", "earlier"], SKETCH_BITS), SKETCH_BITS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sent = needed.value, np.zeros(0, np.uint64)
        for whole in batches:
            for batch in slices(whole):
                lines = Lines(batch, least)
                which = np.flatnonzero(_marked(table, lines.key))
                which = which[np.unique(lines.key[which], return_index=True)[1]]
                which = np.sort(which[~np.isin(lines.key[which], sent)])
                sent = np.union1d(sent, lines.key[which])[-1_000_000:]
                tokens, begin, size = lines.sets(which, sketch.value)
                short = tokens.view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES]  # little-endian: the rest is zero
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lines.key[which].view(np.int64)), pa.array([short[b : b + n].tobytes() for b, n in zip(begin, size)], pa.binary())],
                    ["key", "tokens"],
                )

    # Both joins read the one shuffle of the sets that the removal of repeats makes.
    sets = docs.mapInArrow(run, "key long, tokens binary").dropDuplicates(["key"])
    both = (
        pairs.join(sets.select(F.col("key").alias("later"), F.col("tokens").alias("a")), "later")
        .join(sets.select(F.col("key").alias("earlier"), F.col("tokens").alias("b")), "earlier")
        .select("later", "a", "b")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.zeros(batch.num_rows, bool)
            for i, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
                a, b = np.frombuffer(a, _TOKEN), np.frombuffer(b, _TOKEN)
                common = len(np.intersect1d(_whole(a), _whole(b), assume_unique=True))
                near[i] = common >= SIMILARITY * (len(a) + len(b) - common) - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column("later").filter(pa.array(near))], ["key"])

    return both.mapInArrow(check, "key long").distinct()


def _similar_to_earlier(docs: DataFrame, sketch, least: int) -> DataFrame:
    """``key`` of every line that is similar to an earlier, different one."""
    context = docs.sparkSession.sparkContext
    first = stored(_candidates(_entries(docs, sketch, least)))
    found = stored(_verified(docs, first, sketch, least))
    left = stored(first.filter("more").select(F.col("later").alias("key")).distinct().join(found, "key", "left_anti"))
    if left.isEmpty():
        return found
    # the second round moves only entries at the tokens of lines that are still open
    cells = context.broadcast(_marks(_fixed_table(left, _cells_of(["key"], SKETCH_BITS), SKETCH_BITS)))
    wanted = context.broadcast(_prefix_tokens(docs, sketch, least, cells))
    rest = _candidates(_entries(docs, sketch, least, wanted), cells).join(left.withColumnRenamed("key", "later"), "later", "left_semi")
    rest = stored(rest.join(first, ["later", "earlier"], "left_anti"))
    return found if rest.isEmpty() else found.unionByName(_verified(docs, rest, sketch, least))


_WHERE = [np.uint64, np.int64, np.int64, np.int32]


def removed_lines(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``rid__, lines``: numbers, from 0, of the lines to remove, for rows that have any.

    Lines of fewer than ``least`` words stay, so at 1 only blank lines do. A null text has no lines; a
    null id comes after all others; of repeated rows the first keeps its lines.
    Lines are named by 64 bits of hash. doc_id must be a whole number.
    """
    rows = with_fixed_id(docs).select("rid__", "doc_id", "text")
    texts = rows.select("doc_id", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One reading of the texts: where lines are (shards from 0), and words' counts (shards from -1 down)."""
        cells = np.zeros(1 << SKETCH_BITS, np.uint32)
        for whole in batches:
            for batch in slices(whole):
                lines = Lines(batch, least)
                rid = batch.column("rid__").to_numpy()[lines.doc]
                yield from _packed(_shards(lines.key), [lines.key, lines.doc_id, rid, lines.line])
                found, n = np.unique((lines.hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), return_counts=True)
                cells[found] += n.astype(np.uint32)
        some = np.flatnonzero(cells)
        size = 1 << (SKETCH_BITS - CHUNK_BITS)
        none = np.zeros(len(some), np.uint8)
        yield from _packed(-1 - some // size, [(some % size).astype(np.uint32), np.minimum(cells[some], 65_535).astype(np.uint16), none, none])

    parts = stored(rows.mapInArrow(read, _schema(4)))
    counts = parts.filter("shard < 0").select((-1 - F.col("shard")).alias("shard"), "n", "c0", "c1")
    sketch = docs.sparkSession.sparkContext.broadcast(_summed_table(counts, SKETCH_BITS))
    similar = _similar_to_earlier(texts, sketch, least)

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy().view(np.uint64)
            yield from _packed(_shards(key), [key, np.full(len(key), -1), np.full(len(key), -1), np.full(len(key), -1, np.int32)])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_groups(batches, ["shard"]):
            key, doc, rid, line = _unpacked(group, _WHERE)
            gone = rid < 0
            marked = np.unique(key[gone])
            key, doc, rid, line = (c[~gone] for c in (key, doc, rid, line))
            order = np.lexsort((rid, line, doc, key))
            key, rid, line = key[order], rid[order], line[order]
            out = np.isin(key, marked)
            out[1:] |= key[1:] == key[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(rid[out]), pa.array(line[out])], ["rid__", "line"])

    both = parts.filter("shard >= 0").unionByName(similar.mapInArrow(flagged, _schema(4)))
    gone = _dealt(both).mapInArrow(decide, "rid__ long, line int")
    return gone.groupBy("rid__").agg(F.array_sort(F.collect_list("line")).alias("lines"))


def without_repeats(docs: DataFrame, columns: list[str], least: int = LEAST_WORDS) -> DataFrame:
    """All rows with the named columns; the text is without the lines to remove."""
    docs = with_fixed_id(docs)
    joined = docs.select("rid__", *columns).join(removed_lines(docs, least), "rid__", "left")
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("lines", i)), "\n")
    return joined.withColumn("text", F.when(F.col("lines").isNull(), F.col("text")).otherwise(kept)).select(*columns)


def query(spark, sf_dir: str) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed`` (line numbers from 0, joined by commas) for every document."""
    docs = with_fixed_id(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n_lines = F.when(F.length(whole_text()) == 0, 0).otherwise(F.length(whole_text()) - F.length(F.replace(whole_text(), F.lit("\n"), F.lit(""))) + 1)
    counted = docs.select("rid__", "doc_id", n_lines.cast("long").alias("n_lines"))
    return counted.join(removed_lines(docs, EVERY_LINE), "rid__", "left").select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.transform("lines", lambda x: x.cast("string")), ","), F.lit("")).alias("removed"),
    )
