"""Perplexity of texts under an interpolated modified Kneser-Ney bigram model.

Counted in Spark, stored as sorted hash arrays in the shared folder, mapped into
memory by the workers. Words are named by a 64-bit hash; a word's id is its
place in the sorted hashes, a bigram's key the two ids in 64 bits, scrambled by a
bijection so that key ranges are shards of equal size. What moves between tasks
are packed arrays of distinct keys with counts, so a frequent word or pair is
one entry per task, however hot.

The shared folder (``spark.checkpoint.dir``, or ``model_dir``) must be mounted
on every machine for the arrays to be mapped; files appear under their names
only when complete, so lost tasks can run again. They are deleted after scoring.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.common import Words, fold, key_groups, mixed, slices
from roadloom.session import checkpoint_folder, cut_lineage

SHARD_BITS = 6
HELD_OUT_OF, HELD_OUT = 10, 0
END, BEGIN = np.uint64(1), np.uint64(2)  # names of the end token and of what precedes the first
MOST_HELD = 4_000_000  # distinct keys a counting task holds before it passes them on


# --- arrays on disk --------------------------------------------------------------------------


def _save(folder: str, name: str, array: np.ndarray) -> None:
    part = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
    array.tofile(part)
    os.replace(part, os.path.join(folder, name))


def _load(folder: str, name: str, dtype) -> np.ndarray:
    path = os.path.join(folder, name)
    return np.memmap(path, dtype, "r") if os.path.exists(path) and os.path.getsize(path) else np.zeros(0, dtype)


def _counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their counts."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def _shard_bounds(keys: np.ndarray) -> np.ndarray:
    edges = np.arange(1, 1 << SHARD_BITS, dtype=np.uint64) << np.uint64(64 - SHARD_BITS)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


class Table:
    """Sorted keys in shards by their top bits; finds the places of sorted keys."""

    def __init__(self, folder: str, name: str) -> None:
        self.keys = [_load(folder, f"{name}-{s}", np.uint64) for s in range(1 << SHARD_BITS)]
        self.first = np.cumsum([0, *map(len, self.keys)])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key among all shards' keys, or -1."""
        out, bounds = np.full(len(keys), -1, np.int64), _shard_bounds(keys)
        for s, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
            have = self.keys[s]
            if hi > lo and len(have):
                at = np.searchsorted(have, keys[lo:hi])
                at[at == len(have)] = 0
                hit = have[at] == keys[lo:hi]
                out[lo:hi][hit] = at[hit] + self.first[s]
        return out


class Values:
    """Numbers beside a table's keys, by place."""

    def __init__(self, folder: str, name: str, dtype, first: np.ndarray, width: int = 1) -> None:
        self.parts = [_load(folder, f"{name}-{s}", dtype).reshape(-1, width) for s in range(1 << SHARD_BITS)]
        self.first, self.width, self.dtype = first, width, dtype

    def at(self, places: np.ndarray) -> np.ndarray:
        """Rows at the places, which must be in order; zeros where a place is -1."""
        out = np.zeros((len(places), self.width), self.dtype)
        known = np.flatnonzero(places >= 0)
        order = known[np.argsort(places[known], kind="stable")]
        cuts = np.searchsorted(places[order], self.first)
        for s, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            if hi > lo:
                out[order[lo:hi]] = self.parts[s][places[order[lo:hi]] - self.first[s]]
        return out


# --- counting --------------------------------------------------------------------------------


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Names of all tokens, each text's words and then one end, and where texts begin."""
    words = Words(texts)
    begins = words.before[:-1] + np.arange(words.n_docs)
    names = np.full(len(words) + words.n_docs, END, np.uint64)
    names[np.arange(len(words)) + words.doc] = np.maximum(words.hashes(), np.uint64(3))
    return names, begins


class _Sums:
    """Distinct keys with counts, passed on as packed arrays by shard."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(_counted(keys))
        self.n += len(self.parts[-1][0])
        if self.n > MOST_HELD:
            self._merge()
            if self.n > MOST_HELD // 2:
                yield from self.out()

    def _merge(self) -> None:
        if self.parts:
            merged = _counted(np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts]))
            self.parts, self.n = [merged], len(merged[0])

    def out(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        for keys, counts in self.parts:
            bounds = _shard_bounds(keys)
            rows = [(s, keys[lo:hi].tobytes(), np.minimum(counts[lo:hi], 2**32 - 1).astype(np.uint32).tobytes()) for s, (lo, hi) in enumerate(zip(bounds, bounds[1:])) if hi > lo]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                ["shard", "keys", "counts"],
            )
        self.parts, self.n = [], 0


_PACKED = "shard int, keys binary, counts binary"


def _joined(group: pa.Table, column: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(group.column(column).to_pylist()), dtype)


def _sharded(packed: DataFrame) -> DataFrame:
    return packed.repartition(1 << SHARD_BITS, "shard").sortWithinPartitions("shard")


def _count_words(train: DataFrame, folder: str) -> tuple[int, int]:
    """Writes ``words-*`` (hashes) and ``count-*``; the number of tokens and of distinct ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for whole in batches:
            for batch in slices(whole):
                yield from sums.add(_tokens(batch.column("text"))[0])
        yield from sums.out()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_groups(batches, ["shard"]):
            shard = group.column("shard")[0].as_py()
            keys, counts = _counted(_joined(group, "keys", np.uint64), _joined(group, "counts", np.uint32).astype(np.int64))
            _save(folder, f"words-{shard}", keys)
            _save(folder, f"count-{shard}", counts)
            yield pa.RecordBatch.from_pydict({"n": pa.array([int(counts.sum())]), "v": pa.array([len(keys)])})

    made = _sharded(train.mapInArrow(count, _PACKED)).mapInArrow(write, "n long, v long").collect()  # a row a shard
    return sum(r["n"] for r in made), sum(r["v"] for r in made)


#: per word: how often it precedes, with how many distinct successors seen once, twice, more often; its distinct predecessors
_STATS = 5


def _count_pairs(train: DataFrame, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Writes ``pairs-*``, ``times-*`` and ``stats-*``; counts of counts (1 to 4) of pairs and of predecessors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, words = _Sums(), Table(folder, "words")
        for whole in batches:
            for batch in slices(whole):
                names, begins = _tokens(batch.column("text"))
                distinct, back = np.unique(names, return_inverse=True)
                yield from sums.add(_pairs(words.find(distinct)[back], begins))
        yield from sums.out()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = Table(folder, "words").first
        for group in key_groups(batches, ["shard"]):
            shard = group.column("shard")[0].as_py()
            keys, counts = _counted(_joined(group, "keys", np.uint64), _joined(group, "counts", np.uint32).astype(np.int64))
            _save(folder, f"pairs-{shard}", keys)
            _save(folder, f"times-{shard}", np.minimum(counts, 2**32 - 1).astype(np.uint32))
            plain = _unmixed(keys)
            before, after = (plain >> np.uint64(32)).astype(np.int64) - 1, (plain & np.uint64(0xFFFFFFFF)).astype(np.int64)
            of_counts = np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()
            rows = {c: [] for c in ("shard", "before", "stats", "after", "kinds", "of_counts")}
            history, which = np.unique(before, return_inverse=True)
            stats = np.stack([np.bincount(which, w, len(history)) for w in (counts, counts == 1, counts == 2, counts > 2)], axis=1).astype(np.uint32)
            word, kinds = np.unique(after, return_counts=True)
            cut_u, cut_w = np.searchsorted(history, first), np.searchsorted(word, first)
            begin = stats[history < 0].sum(axis=0)  # the begin of texts, kept beside the last shard
            for s in range(1 << SHARD_BITS):
                u, w = slice(cut_u[s], cut_u[s + 1]), slice(cut_w[s], cut_w[s + 1])
                rows["shard"].append(s)
                rows["before"].append((history[u] - first[s]).astype(np.uint32).tobytes())
                rows["stats"].append(np.ascontiguousarray(stats[u].T).tobytes())
                rows["after"].append((word[w] - first[s]).astype(np.uint32).tobytes())
                rows["kinds"].append(kinds[w].astype(np.uint32).tobytes())
                rows["of_counts"].append([*of_counts, *begin.tolist()] if s == shard else [0] * 8)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["shard"], pa.int32()), *(pa.array(rows[c], pa.binary()) for c in ("before", "stats", "after", "kinds")), pa.array(rows["of_counts"], pa.list_(pa.int64()))],
                list(rows),
            )

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = Table(folder, "words").first
        for group in key_groups(batches, ["shard"]):
            shard = group.column("shard")[0].as_py()
            stats = np.zeros((first[shard + 1] - first[shard], _STATS), np.int64)
            for u, s, w, k in zip(*(group.column(c).to_pylist() for c in ("before", "stats", "after", "kinds"))):
                at = np.frombuffer(u, np.uint32)
                stats[at, :4] += np.frombuffer(s, np.uint32).reshape(4, -1).T
                stats[np.frombuffer(w, np.uint32), 4] += np.frombuffer(k, np.uint32)
            _save(folder, f"stats-{shard}", stats)
            kinds = np.bincount(np.minimum(stats[:, 4], 5), minlength=6)[1:5].tolist() + [int(stats[:, 4].sum())]
            sums = np.sum(group.column("of_counts").to_pylist(), axis=0).tolist()
            yield pa.RecordBatch.from_pydict({"of_counts": pa.array([sums]), "kinds": pa.array([kinds])})

    parts = "shard int, before binary, stats binary, after binary, kinds binary, of_counts array<long>"
    made = (
        _sharded(_sharded(train.mapInArrow(count, _PACKED)).mapInArrow(write, parts))
        .mapInArrow(total, "of_counts array<long>, kinds array<long>")
        .collect()  # a row a shard
    )
    zero = np.zeros((1, 8), np.int64)
    return np.concatenate([zero, *[[r["of_counts"]] for r in made]]).sum(axis=0), np.concatenate([zero[:, :5], *[[r["kinds"]] for r in made]]).sum(axis=0)


def _pairs(ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Scrambled keys of each token with what precedes it; ids are known, a begin has number 0, words their id + 1."""
    before = np.empty(len(ids), np.int64)
    before[1:] = ids[:-1] + 1
    before[begins] = 0
    return mixed((before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64))


def _unmixed(h: np.ndarray) -> np.ndarray:
    """The inverse of :func:`mixed`."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(pow(0xC4CEB9FE1A85EC53, -1, 1 << 64))
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(pow(0xFF51AFD7ED558CCD, -1, 1 << 64))
    return h ^ (h >> np.uint64(33))


# --- the model -------------------------------------------------------------------------------


def discounts(of_counts: np.ndarray) -> np.ndarray:
    """D(1), D(2), D(3+) by counts of counts; where a class is empty, half its count's lower bound."""
    n1, n2, n3, n4 = (float(x) for x in of_counts[:4])
    if min(n1, n2, n3) <= 0:
        return np.array([0.0, 0.5, 0.75, 1.0])
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(d, 0.0), k) for k, d in enumerate(found, 1))])


@dataclass
class Model:
    """What scoring needs beside the arrays: a few numbers."""

    folder: str
    tokens: int
    vocabulary: int
    of_pairs: np.ndarray
    of_kinds: np.ndarray
    begin: np.ndarray
    _arrays: dict = field(default_factory=dict)

    def arrays(self) -> dict:
        if not self._arrays:
            words, pairs = Table(self.folder, "words"), Table(self.folder, "pairs")
            self._arrays = {
                "words": words,
                "pairs": pairs,
                "count": Values(self.folder, "count", np.int64, words.first),
                "stats": Values(self.folder, "stats", np.int64, words.first, _STATS),
                "times": Values(self.folder, "times", np.uint32, pairs.first),
            }
        return self._arrays

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_arrays": {}}

    def scores(self, texts: pa.Array) -> dict[str, np.ndarray]:
        """Per text: tokens, known tokens, base score, score (sums of log10 probabilities)."""
        a = self.arrays()
        names, begins = _tokens(texts)
        distinct, back = np.unique(names, return_inverse=True)
        places = a["words"].find(distinct)
        count, stats = a["count"].at(places)[:, 0], a["stats"].at(places)
        base = np.log10((count + 0.1) / (self.tokens + 0.1 * (self.vocabulary + 1)))

        # lower order: distinct predecessors, interpolated with the uniform distribution
        d1, kinds = discounts(self.of_kinds), stats[:, 4]
        all_kinds = float(self.of_kinds[4])
        many = self.vocabulary - self.of_kinds[0] - self.of_kinds[1]
        if all_kinds:
            left = (d1[1] * self.of_kinds[0] + d1[2] * self.of_kinds[1] + d1[3] * max(0, many)) / all_kinds
            lower = (kinds - d1[np.minimum(kinds, 3)]) / all_kinds + left / (self.vocabulary + 1)
        else:
            lower = np.full(len(distinct), 1 / (self.vocabulary + 1))

        # higher order: pairs, interpolated by what the history has left
        d2 = discounts(self.of_pairs)
        history = np.concatenate([stats[:, :4], self.begin[None, :]])
        seen = np.maximum(history[:, 0], 1)
        left = np.where(history[:, 0] > 0, (history[:, 1:4] @ d2[1:4]) / seen, 1.0)
        before = np.empty(len(names), np.int64)
        before[1:] = back[:-1]
        before[begins] = len(distinct)
        ids = np.append(places, -1)
        known = (ids[back] >= 0) & ((ids[before] >= 0) | (before == len(distinct)))
        keys = _pairs(np.where(ids[back] >= 0, ids[back], 0), begins)[known]
        pairs, which = np.unique(keys, return_inverse=True)
        times = np.zeros(len(names), np.int64)
        times[known] = a["times"].at(a["pairs"].find(pairs))[:, 0].astype(np.int64)[which]
        prob = (times - d2[np.minimum(times, 3)]) / seen[before] + left[before] * lower[back]
        add = lambda x: np.add.reduceat(x, begins) if len(begins) else np.zeros(0)
        return {
            "n_tokens": np.diff(np.append(begins, len(names))),
            "n_known": add((count > 0)[back].astype(np.int64)).astype(np.int64),
            "base_score": add(base[back]),
            "score": add(np.log10(prob)),
        }


def fit(train: DataFrame, folder: str) -> Model:
    """Counts the texts of ``train`` into arrays in ``folder``, a path that all machines share."""
    tokens, vocabulary = _count_words(train, folder)
    pairs, kinds = _count_pairs(train, folder)
    return Model(folder, tokens, vocabulary, pairs[:4], kinds, pairs[4:])


def scored(docs: DataFrame, model_dir: str | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    A null or empty text is the end token alone; a null id is in the held-out
    part (the crc32 of the empty text is 0); repeated rows count and are scored
    each. Without training rows every token has the probability one
    (a vocabulary of the unknown word alone).
    """
    spark = docs.sparkSession
    place = urlparse(model_dir or checkpoint_folder(spark))
    if place.scheme not in ("", "file"):
        raise ValueError("the model's arrays are memory-mapped: model_dir must be a mounted folder")
    folder = os.path.join(place.path, f"ngrams-{uuid.uuid4().hex}")
    os.makedirs(folder)
    rows = docs.select("doc_id", "text", (fold("doc_id", HELD_OUT_OF) == HELD_OUT).alias("held_out"))
    model = fit(rows.filter("NOT held_out").select("text"), folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                found = model.scores(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), *(pa.array(found[c]) for c in found)],
                    ["doc_id", "held_out", *found],
                )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    out = cut_lineage(rows.mapInArrow(run, schema))
    shutil.rmtree(folder)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"))
