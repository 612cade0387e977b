"""Packing token sequences: linear grouping of lengths, few-size configurations, best fit for the small.

Lengths are whole numbers up to the capacity, so their histogram, at most
``capacity`` rows however large the corpus, says all that packing needs:

1. lengths above ``capacity // SMALL_PART`` are sorted and cut into ``GROUPS``
   groups of equal cardinality, each rounded up to its largest;
2. the configurations (which groups fill one sequence) are chosen by column
   generation on the linear programme with one row per group, rounded down;
3. the actual lengths take their groups' places, in order of length;
4. what is left over and the small lengths go, longest first, where they fit best.

The plan is a list of kinds of sequence with multiplicities. Spark numbers the
pieces of each length and looks their places up; no sequence is gathered anywhere.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, repeat
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadloom.llm.common import slices, with_fixed_id, with_row_id
from roadloom.operators.ordering import dense_index
from roadloom.session import cut_lineage

CAPACITY, END_ID, GROUPS, SMALL_PART, BUCKETS = 4096, 1, 16, 3, 1024
BUCKET_BITS = 20  # of row ids, which count a file's or a partition's rows
MEMO_WORDS = 600_000
_MEMO: dict[str, tuple] = {}


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- tokens --------------------------------------------------------------------------------


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies spell bytes: printable ones as they are, others from 256 up."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(others)}


class WordTokens:
    """Token ids of texts by way of their words, for tokenizers that drop white space.

    The vocabulary's splitting never joins across white space, so a text's ids
    are its words' ids in a row; each word is encoded once and remembered, up to
    ``MEMO_WORDS`` words. A word of Latin letters is lowered and split here, by
    the vocabulary's own pattern, and only its parts go to the model; other
    words go through the whole tokenizer. So do texts with special tokens'
    strings, or with characters on which Python's and the tokenizer's
    white space or lower case differ.
    """

    #: fixed values: the vocabulary's split pattern, for characters below U+0250
    PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|[\W_]+")

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.parts: dict[str, bytes] = {}
        self.lengths, self.starts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _part(self, part: str) -> bytes:
        spelled = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.letters)
        found = np.array([t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()
        if len(self.parts) < MEMO_WORDS:
            self.parts[part] = found
        return found

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = normalize("NFC", word)
            if max(word) >= "\u0250" or "\u0130" in word:
                return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        known = self.parts
        return b"".join([known.get(p) or self._part(p) for p in self.PARTS.findall(word.lower())])

    def _learn(self, words: list[str]) -> None:
        found = [self._word(w) for w in words]
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        self.memo.update(zip(words, range(len(self.memo), len(self.memo) + len(words))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(found), "<u4")])

    def whole(self, text: str) -> bool:
        if any(s in text for s in self.special):
            return True
        return not text.isascii() and "Σ" in text or any(c in text for c in "\x1c\x1d\x1e\x1f")

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        odd = {i: np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for i, t in enumerate(texts) if self.whole(t)}
        split = [[] if i in odd else t.split() for i, t in enumerate(texts)]
        words = list(chain.from_iterable(split))
        known = np.fromiter(map(self.memo.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(known < 0).tolist()
        if missing:
            fresh = list(dict.fromkeys(words[i] for i in missing))
            if len(self.memo) + len(fresh) > MEMO_WORDS:
                self.forget()
                fresh, missing = list(dict.fromkeys(words)), range(len(words))
            self._learn(fresh)
            known[missing] = [self.memo[words[i]] for i in missing]
        length = self.lengths[known]
        ends = np.cumsum(length)
        flat = self.flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[known] - (ends - length), length)]
        bounds = np.append(0, ends)[np.cumsum([0, *map(len, split)])]
        return [odd[i] if i in odd else flat[bounds[i] : bounds[i + 1]] for i in range(len(texts))]


def _word_tokens(path: str) -> WordTokens:
    """One per worker process, kept between tasks."""
    if path not in _MEMO:
        _MEMO[path] = WordTokens(path)
    return _MEMO[path]


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``rid__, doc_id, piece, start, length, ids_crc32`` (and ``ids``): each text's ids, then the end id, cut at the capacity."""
    path = path or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _word_tokens(path)
        for whole in batches:
            for batch in slices(whole, most=2 << 20):
                rows: list[tuple] = []
                for i, ids in enumerate(tokens.ids([t or "" for t in batch.column("text").to_pylist()])):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        part = ids[at : at + capacity]
                        rows.append((i, k, at, len(part), zlib.crc32(part.tobytes()), part if with_ids else None))
                take = pa.array([r[0] for r in rows], pa.int32())
                columns = [
                    batch.column("rid__").take(take),
                    batch.column("doc_id").take(take),
                    pa.array([r[1] for r in rows], pa.int32()),
                    *(pa.array([r[j] for r in rows], pa.int64()) for j in (2, 3, 4)),
                ]
                names = ["rid__", "doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([r[5].astype(np.int32) for r in rows], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"rid__ long, doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return with_row_id(docs.select("doc_id", "text", *[c for c in docs.columns if c == "rid__"])).mapInArrow(cut, schema)


# --- the plan ------------------------------------------------------------------------------


def equal_groups(hist: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """Runs of (length, count), longest first, cut into groups of equal cardinality."""
    left = sum(n for _, n in hist)
    each, out, room = -(-left // groups), [], 0
    for length, n in sorted(hist, reverse=True):
        while n:
            if not room:
                out.append([])
                room = each
            k = min(n, room)
            out[-1].append((length, k))
            n, room = n - k, room - k
    return out


def best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The multiset of sizes within the capacity of greatest worth, by the number of items."""
    layers, best = [np.zeros(capacity + 1)], []
    for _ in range(capacity // int(sizes.min())):
        value, choice = layers[-1].copy(), np.full(capacity + 1, -1)
        for i, (s, w) in enumerate(zip(sizes, worth)):
            more = layers[-1][: capacity + 1 - s] + w
            better = more > value[s:] + 1e-12
            value[s:][better], choice[s:][better] = more[better], i
        if np.array_equal(value, layers[-1]):
            break
        layers.append(value)
        best.append(choice)
    counts, c = np.zeros(len(sizes), np.int64), capacity
    for choice in reversed(best):
        if choice[c] >= 0:
            counts[choice[c]] += 1
            c -= sizes[choice[c]]
    return counts, float(layers[-1][capacity])


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 5000) -> list[tuple[np.ndarray, int]]:
    """Configurations with how often each is used: the linear programme's optimum, rounded down."""
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(rounds):
        worth = np.linalg.solve(basis.T, np.ones(len(sizes)))
        column, value = best_configuration(sizes, worth, capacity)
        if value <= 1 + 1e-7:
            break
        level, move = np.linalg.solve(basis, demand), np.linalg.solve(basis, column)
        ratio = np.where(move > 1e-9, np.maximum(level, 0) / np.where(move > 1e-9, move, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = column
    level = np.linalg.solve(basis, demand)
    out, left = [], demand.astype(np.int64).copy()
    for j in np.argsort(-level):
        column = basis[:, j].astype(np.int64)
        used = column > 0
        times = int(min(np.floor(max(level[j], 0) + 1e-9), (left[used] // column[used]).min()))
        if times > 0:
            out.append((column, times))
            left -= column * times
    return out


class _Sequences:
    """Kinds of sequence (lengths in them, how many), by the room they have left."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.room = capacity, defaultdict(list)
        self.some = np.zeros(capacity + 1, bool)

    def add(self, lengths: tuple[int, ...], times: int) -> None:
        if times:
            left = self.capacity - sum(lengths)
            self.room[left].append((lengths, times))
            self.some[left] = True

    def best_fit(self, length: int, n: int) -> None:
        while n:
            fits = np.flatnonzero(self.some[length:])
            if len(fits):
                left = length + int(fits[0])
                lengths, times = self.room[left].pop()
                self.some[left] = bool(self.room[left])
            else:
                left, lengths, times = self.capacity, (), n
            each = left // length
            full = min(times, n // each)
            self.add(lengths + (length,) * each, full)
            n -= full * each
            over = times - full
            if n and n < each and over:
                self.add(lengths + (length,) * n, 1)
                n, over = 0, over - 1
            if lengths:
                self.add(lengths, over)


def plan(hist: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[tuple[int, ...], int]]:
    """Kinds of sequence with how many there are of each; together they hold every piece."""
    kinds, least = _Sequences(capacity), capacity // SMALL_PART
    large = [(s, n) for s, n in hist.items() if s > least]
    rest: dict[int, int] = {s: n for s, n in hist.items() if s <= least}
    if large:
        queues = equal_groups(large, groups)
        sizes = np.array([q[0][0] for q in queues])
        demand = np.array([sum(n for _, n in q) for q in queues], float)
        # groups of one size are one row of the programme
        names, row = np.unique(sizes, return_inverse=True)
        merged = [[run for q, r in zip(queues, row) if r == i for run in q] for i in range(len(names))]
        queues = [list(reversed(q)) for q in merged]
        chosen = configurations(names, np.bincount(row, demand), capacity)
        for column, times in chosen:
            slots = [i for i, c in enumerate(column) for _ in range(c)]
            runs = [_taken(queues[i], times) for i in slots]
            while runs[0]:
                k = min(r[-1][1] for r in runs)
                kinds.add(tuple(r[-1][0] for r in runs), k)
                for r in runs:
                    length, n = r.pop()
                    if n > k:
                        r.append((length, n - k))
        for q in queues:
            for length, n in q:
                rest[length] = rest.get(length, 0) + n
    for length in sorted(rest, reverse=True):
        kinds.best_fit(length, rest[length])
    return [kind for left in sorted(kinds.room) for kind in kinds.room[left]]


def _taken(queue: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """Take n items from the end of a queue of runs; the runs taken, last one first."""
    out = []
    while n:
        length, have = queue.pop()
        k = min(have, n)
        out.append((length, k))
        if have > k:
            queue.append((length, have - k))
        n -= k
    return out[::-1]


def places(kinds: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Per length and interval of its pieces' numbers: the first sequence and the offset in it."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for lengths, times in kinds:
        offset = 0
        for length in lengths:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return {"key": (table[:, 0] << 44) + table[:, 1], "lo": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


# --- the operator --------------------------------------------------------------------------


def packed(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    groups: int = GROUPS,
    with_ids: bool = False,
    in_order: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``) for every piece.

    A null or empty text is the end id alone; a null id is kept; repeated rows
    are packed each. Texts longer than the capacity are cut, others never. An
    empty table gives no rows.

    ``in_order`` keeps to the order of the rows (files by path, rows in files): of pieces
    of one length the earlier ones come into the earlier sequences of a kind, and
    sequences are numbered by their earliest piece. As many sequences either way.
    """
    if in_order:
        docs = with_fixed_id(docs.select("doc_id", "text"))
    pieces = cut_lineage(token_pieces(docs, path, capacity, with_ids))
    hist = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    at = places(plan(hist, capacity, groups))
    bucket = F.shiftright("rid__", BUCKET_BITS) if in_order else F.pmod(F.xxhash64("rid__", "piece"), F.lit(BUCKETS))
    bucketed = pieces.withColumn("bucket", bucket)
    counts = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("rid__", "piece")
    numbered = (
        bucketed.withColumn("nth", F.row_number().over(inside) - 1)
        .join(starts, ["length", "bucket"])
        .withColumn("nth", F.col("first") + F.col("nth"))
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, nth = (batch.column(c).to_numpy() for c in ("length", "nth"))
            row = np.searchsorted(at["key"], (length << 44) + nth, side="right") - 1
            found = [pa.array(at["sequence"][row] + nth - at["lo"][row]), pa.array(at["offset"][row])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *found], [*kept, "sequence_id", "offset"])

    out = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kept = ["rid__"] * in_order + out
    kinds = dict(pieces.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in kept) + ", sequence_id long, offset long"
    found = numbered.select(*kept, "nth").mapInArrow(look_up, schema)
    if not in_order:
        return found
    found = cut_lineage(found)
    first = found.groupBy("sequence_id").agg(F.min(F.struct("rid__", "piece")).alias("first"))
    turns = dense_index(first, "first", "turn").select("sequence_id", "turn")
    return found.join(turns, "sequence_id").select(*out, F.col("turn").alias("sequence_id"), "offset")


def query(spark, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
