"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's features are hashed counts of its words' outer shapes (runs of letters,
capitals, digits and each punctuation mark collapsed), of pairs of neighbouring
shapes, of words and of word ends, and how often a word is repeated one to
LAGS words later. A bounded, balanced sample of labelled rows
(``SAMPLE`` per class, by hash of the id) gives document frequencies, the
latent space (truncated SVD) and the labelled vectors, which are broadcast: at
most 2 * SAMPLE rows of RANK numbers. Every text is compared with all of them,
in blocks, and its NEIGHBOURS nearest vote with their cosine as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.common import Words, fold, mixed, slices, table

SAMPLE, HASHED, LAGS, RANK, NEIGHBOURS = 1024, 2048, 16, 48, 15
FEATURES = HASHED + LAGS
FOLDS, TEST_FOLD = 3, 1

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = 97, 65, 48, 97
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _shapes(words: Words) -> np.ndarray:
    """A hash of each word's run-collapsed character classes."""
    kinds = _SHAPE[words.data]
    turn = np.ones(len(kinds), bool)
    turn[1:] = kinds[1:] != kinds[:-1]
    turn[words.start] = True
    inside = np.zeros(len(kinds) + 1, np.int8)
    inside[words.start] += 1
    np.subtract.at(inside, words.end, 1)
    at = np.flatnonzero(turn & (np.cumsum(inside[:-1], dtype=np.int8) > 0))
    first = np.searchsorted(at, words.start)
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    parts = mixed((kinds[at].astype(np.uint64) << np.uint64(32)) + np.minimum(place, 6).astype(np.uint64))
    return mixed(np.add.reduceat(parts, first)) if len(first) else np.zeros(0, np.uint64)


def features(texts: pa.Array) -> np.ndarray:
    """Hashed counts, a row a text: logarithms, so that length counts little."""
    words = Words(texts, lower=False)
    out = np.zeros((words.n_docs, FEATURES), np.float32)
    if not len(words):
        return out
    shape = _shapes(words)
    pair = mixed(shape[1:] * _GOLDEN + shape[:-1])[words.doc[1:] == words.doc[:-1]]
    pair_doc = words.doc[1:][words.doc[1:] == words.doc[:-1]]
    last = words.data[words.end - 1].astype(np.uint64) * np.uint64(257) + words.data[np.maximum(words.end - 2, words.start)]
    named = words.hashes()
    share = HASHED // 4
    for k, (doc, h) in enumerate([(words.doc, shape), (pair_doc, pair), (words.doc, named), (words.doc, mixed(last + np.uint64(7)))]):
        at = doc * share + (h >> np.uint64(40)).astype(np.int64) % share
        counts = np.bincount(at, minlength=words.n_docs * share).reshape(words.n_docs, share)
        out[:, k * share : (k + 1) * share] = np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))
    n_words = np.maximum(1, np.diff(words.before))
    for lag in range(1, LAGS + 1):
        again = (named[lag:] == named[:-lag]) & (words.doc[lag:] == words.doc[:-lag])
        out[:, HASHED + lag - 1] = 3 * np.bincount(words.doc[lag:][again], minlength=words.n_docs) / n_words
    return out


@dataclass
class Voters:
    """The labelled vectors and the way into their space."""

    weight: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, rows: np.ndarray) -> np.ndarray:
        found = (rows * self.weight) @ self.axes
        return found / np.maximum(1e-12, np.linalg.norm(found, axis=1, keepdims=True))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """The similarity-weighted share of label 1 among the nearest; the prior for texts without features."""
        out = np.full(len(rows), self.prior)
        some = np.flatnonzero(rows.any(axis=1))
        if not len(self.vectors) or not len(some):
            return out
        k = min(NEIGHBOURS, len(self.vectors))
        for block in np.array_split(some, -(-len(some) // 512)):
            cosine = self.latent(rows[block]) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-6) ** 4
            out[block] = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def _sampled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """``doc_id, quality`` of the sample, and the share of label 1 among all training labels."""
    known = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", FOLDS) != TEST_FOLD))
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
        .join(docs.select("doc_id"), "doc_id", "left_semi")
    )
    lot = F.md5(F.col("doc_id").cast("string"))
    picked = [known.filter(F.col("quality") == q).orderBy(lot, "doc_id").limit(SAMPLE) for q in (0, 1)]
    prior = known.agg(F.avg("quality")).first()[0]
    return picked[0].unionByName(picked[1]), 0.5 if prior is None else float(prior)


def fit(docs: DataFrame, labels: DataFrame) -> Voters:
    """Learn from labelled rows outside the test fold; without any, every score is 0.5."""
    sample, prior = _sampled(docs, labels)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                rows = features(batch.column("text")).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("quality"), pa.array([r.tobytes() for r in rows], pa.binary())],
                    ["doc_id", "quality", "row"],
                )

    held = (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")  # at most 2 * SAMPLE rows
        .mapInArrow(run, f"doc_id {kind}, quality int, row binary")
        .dropDuplicates(["doc_id"])
        .orderBy("doc_id")
        .collect()
    )
    empty = np.zeros((0, RANK))
    if not held:
        return Voters(np.ones(FEATURES), np.zeros((FEATURES, RANK)), empty, np.zeros(0), prior)
    rows = np.stack([np.frombuffer(r["row"], np.float16) for r in held]).astype(np.float64)
    labels_of = np.array([r["quality"] for r in held], float)
    weight = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 1
    rng = np.random.Generator(np.random.Philox(7))
    weighed = rows * weight
    start = weighed @ rng.normal(size=(FEATURES, RANK + 16))
    for _ in range(4):  # subspace iteration
        start = np.linalg.qr(weighed @ (weighed.T @ start))[0]
    axes = np.linalg.svd(start.T @ weighed, full_matrices=False)[2][:RANK].T
    voters = Voters(weight.astype(np.float32), axes.astype(np.float32), empty, labels_of, prior)
    voters.vectors = voters.latent(rows.astype(np.float32)).astype(np.float32)
    return voters


def judged(docs: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns of every row, ``score`` and ``predicted`` (1 from a score of one half on).

    A null or empty text, or one of white space, gets the share of label 1 among
    the training labels; a null id is scored like any, and repeated rows each.
    """
    voters = fit(docs, labels)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(voters)
    frame = docs.select(*columns, F.col("text").alias("text__"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text__"):
                score = shared.value.scores(features(batch.column("text__"))).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in columns), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    [*columns, "score__", "predicted__"],
                )

    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in columns] + ["score__ double", "predicted__ int"])
    return frame.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    """The rows predicted to be of quality, with the named columns."""
    return judged(docs, labels, columns).filter("predicted__ = 1").select(*columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = judged(docs, table(spark, sf_dir, "labels"), ["doc_id"])
    return found.select(
        "doc_id", (fold("doc_id", FOLDS) == TEST_FOLD).alias("held_out"), F.col("score__").alias("score"), F.col("predicted__").alias("predicted")
    )
