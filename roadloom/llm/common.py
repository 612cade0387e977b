"""What the corpus operators share: reading tables, row identities, arrays of words.

Rows are named by a row id inside an operator, because doc_id may be null or
repeated. :func:`with_row_id` follows the input's partitions and so is for one
reading only: a second scan may be split otherwise. Where rows are decided on in
one reading and taken in another, :func:`with_fixed_id` names them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.session import cut_lineage, stored

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ROW_BITS = 36
MASKS_IN_MEMORY = 1_000_000  # of 64 rows each; more are not sent to every task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row_id(docs: DataFrame, name: str = "rid__") -> DataFrame:
    """The rows with an id that holds for one reading; an id they have stays."""
    return docs if name in docs.columns else docs.withColumn(name, F.monotonically_increasing_id())


def with_fixed_id(docs: DataFrame, name: str = "rid__") -> DataFrame:
    """The rows with an id that is the same in every reading, however the scan is split.

    Of a Parquet scan: the file's number, by path, and the row's number in the
    file. Any other input is materialised once, with its ids.
    """
    if name in docs.columns:
        return docs
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    try:
        if plan.nodeName() != "LogicalRelation":
            raise AnalysisException("not a scan of files")
        placed = docs.select("*", F.col("_metadata.file_path").alias("file__"), F.col("_metadata.row_index").alias("row__"))
    except AnalysisException:
        return cut_lineage(with_row_id(docs, name))
    files = sorted(r[0] for r in docs.select("_metadata.file_path").distinct().collect())
    numbers = docs.sparkSession.createDataFrame(list(enumerate(files)), "number__ long, file__ string")
    return placed.join(F.broadcast(numbers), "file__").select(*docs.columns, (F.shiftleft("number__", ROW_BITS) + F.col("row__")).alias(name))


def whole_text(column: str = "text") -> Column:
    """The text, a null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def fold(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def among(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The rows of ``docs`` (with fixed ids) whose row id is in ``asked``; texts stay where they are.

    Ids are dense, so those asked for go to every task as a bit per row, in masks of 64 rows.
    """
    bit = F.expr("shiftleft(1L, cast(rid__ & 63 AS int))")
    masks = stored(
        asked.select(F.shiftrightunsigned("rid__", 6).alias("mask__"), bit.alias("bit"))
        .filter("bit IS NOT NULL")
        .groupBy("mask__")
        .agg(F.bit_or("bit").alias("bits__"))
    )
    if masks.count() > MASKS_IN_MEMORY:
        return docs.join(asked.select("rid__"), "rid__", "left_semi")
    placed = docs.withColumn("mask__", F.shiftrightunsigned("rid__", 6)).join(F.broadcast(masks), "mask__")
    return placed.filter(bit.bitwiseAND(F.col("bits__")) != 0).select(*docs.columns)


def only_rows(docs: DataFrame, kept: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``docs`` (with fixed ids) whose row id is in ``kept``, with the named columns."""
    return among(docs.select("rid__", *columns), kept).select(*columns)


# --- words of whole Arrow columns, without a Python object per word ---------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_LONG = 4096  # words with more bytes are hashed one by one


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words:
    """Words of a batch of texts: ASCII letters lowered, cut at ASCII white space.

    ``data`` holds the bytes of all texts one after the other, ``start`` and
    ``end`` a word's bytes, ``doc`` its text's number in the batch.
    """

    def __init__(self, texts: pa.Array, lower: bool = True) -> None:
        texts = texts.cast(pa.large_binary())
        if texts.null_count:
            texts = texts.fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        body = texts.buffers()[2]
        raw = np.frombuffer(body, dtype=np.uint8)[offsets[0] : offsets[-1]] if body is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        self.data = _LOWER[raw] if lower else raw
        self.bounds = offsets - offsets[0]
        self.n_docs = len(texts)
        ink = ~_SPACE[self.data]
        first = ink.copy()
        if len(ink):
            first[1:] &= ~ink[:-1]
            edge = self.bounds[1:-1]
            edge = edge[edge < len(ink)]
            first[edge] |= ink[edge]
            last = ink.copy()
            last[:-1] &= ~ink[1:] | first[1:]
            self.start = np.flatnonzero(first)
            self.end = np.flatnonzero(last) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        #: the number of words before each text, and in all
        self.before = np.searchsorted(self.start, self.bounds)
        self.doc = np.repeat(np.arange(self.n_docs), np.diff(self.before))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, eight bytes of all words at a time."""
        length = self.end - self.start
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data) + 1,), "<u8", padded, strides=(1,))
        out = length.astype(np.uint64) * _GOLDEN
        which, at, left = slice(None), self.start, length
        while len(at):
            part = eight[at] & _LOW_BYTES[np.minimum(left, 8)]
            out[which] = mixed(out[which] ^ (part * _GOLDEN))
            more = np.flatnonzero((left > 8) & (length[which] <= _LONG))
            which = more if isinstance(which, slice) else which[more]
            at, left = at[more] + 8, left[more] - 8
        for i in np.flatnonzero(length > _LONG):
            out[i] = np.uint64(xxhash.xxh64_intdigest(self.data[self.start[i] : self.end[i]].tobytes()))
        return out


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a piece's texts have about ``most`` bytes; a longer text is a piece of its own."""
    size = np.asarray(pc.binary_length(batch.column(column).cast(pa.large_binary())).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    total, at = np.concatenate([[0], np.cumsum(size)]), 0
    while at < len(size):
        upto = max(at + 1, int(np.searchsorted(total, total[at] + most, side="right")) - 1)
        yield batch.slice(at, upto - at)
        at = upto


def key_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows with equal integer keys, from batches sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last: np.ndarray | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy() for k in keys], axis=1)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for lo, hi in zip(bounds, bounds[1:]):
            if held and (values[lo] != last).any():
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = values[lo]
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Sets of numbers joined by links in bulk; ``up`` names each number's set by its smallest member."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.up[a], self.up[b]
        while True:
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(self.up, high, low)
            while True:
                above = self.up[self.up]
                if np.array_equal(above, self.up):
                    break
                self.up = above
            a, b = self.up[low], self.up[high]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        moved = np.flatnonzero(self.up != np.arange(len(self.up)))
        return moved, self.up[moved]
