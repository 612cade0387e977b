"""Language identification by language-bitmask n-gram filters.

An n-gram of letters belongs to a language if it is a fair part of what the
language writes (``RATE``) and is not far more at home in another (``SHARE``).
A Bloom filter of ``CELLS`` cells, each a mask of languages, holds them all: an
n-gram sets its languages' bits in ``HASHES`` cells, and the conjunction of these
cells gives back every language that holds it. A text's n-grams are looked up
together; per language the found ones are counted and corrected for the false
positives that the filter's fill gives, and the largest count decides.

At most ``1 / RATE`` n-grams of a language can reach ``RATE``, and the filter
has a fixed number of cells, so what the driver sees does not grow with the
corpus, while the counts cover all of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.common import fold, mixed, slices, table
from roadloom.session import broadcast_if_small, cut_lineage

FOLDS, TEST_FOLD = 4, 2
GRAMS = (2, 3, 4)
CELLS, HASHES = 1 << 19, 3
RATE, SHARE = 5e-6, 0.1
WORD = 63  # languages in a cell's word
NO_LANGUAGE = "und"
UNIT, HELD = 1 << 20, 300_000  # characters worked on at once; counts held before they are merged
_GAP = re.compile(r"[\W\d_]")
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point, the code of its lower-case letter, or 0."""
    if not _LETTERS:
        codes = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            letter = chr(c)
            if letter.isalpha():
                lower = letter.lower()
                codes[c] = ord(lower) if len(lower) == 1 else c
        _LETTERS.append(codes)
    return _LETTERS[0]


def _units(texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Texts' numbers and the texts, about ``UNIT`` characters at a time; a longer one is cut where no letter is."""
    numbers, parts, size = [], [], 0
    for k, text in enumerate(texts):
        at = 0
        while at < len(text or "") or at == 0:
            gap = _GAP.search(text, at + UNIT) if text and len(text) - at > UNIT else None
            upto = gap.start() if gap else len(text or "")
            numbers.append(k)
            parts.append((text or "")[at:upto])
            size += upto - at
            at = max(upto, 1)
            if size >= UNIT:
                yield np.array(numbers), parts
                numbers, parts, size = [], [], 0
    if parts:
        yield np.array(numbers), parts


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the texts' words with their ends, the text of each, and which texts have letters.

    A word is a run of letters, lower case; its ends are marked by a space.
    """
    raw = [(t or "").encode("utf-32-le", "surrogatepass") for t in texts]
    size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
    codes = _letters()[np.frombuffer(b"\0\0\0\0".join([*raw, b""]), "<u4")] if raw else np.zeros(0, np.uint32)
    doc = np.repeat(np.arange(len(raw), dtype=np.int32), size + 1)  # with the mark that ends each text
    letter = codes > 0
    lettered = np.bincount(doc[letter], minlength=len(raw)) > 0
    keep = letter.copy()
    keep[:-1] |= letter[1:]
    keep[1:] |= letter[:-1]
    codes, doc = codes[keep].astype(np.uint64), doc[keep]
    if len(codes) and codes[0]:
        codes, doc = np.append(np.uint64(0), codes), np.append(doc[0], doc)
    inner = codes == 0
    before = np.append(0, np.cumsum(inner))
    found, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
    for n in GRAMS:
        count = len(codes) - n + 1
        if count <= 0:
            continue
        gram = np.full(count, np.uint64(n))
        for k in range(n):
            gram = gram * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + count]
        # marks only at the ends; the last code is of the text
        plain = before[n - 1 : n - 1 + count] == before[1 : 1 + count]
        plain &= ~(inner[:count] & inner[n - 1 :]) | (n > 2)
        found.append(mixed(gram[plain]))
        last = np.where(inner[n - 1 :], doc[n - 2 : n - 2 + count], doc[n - 1 :])
        of.append(last[plain])
    return np.concatenate(found), np.concatenate(of), lettered


def _places(grams_: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    """Each n-gram's cells, one per hash."""
    step = (grams_ >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        yield ((grams_ + np.uint64(k) * step) & np.uint64(cells - 1)).astype(np.int64)


@dataclass
class Filter:
    """``masks``: words by cells; bit L % 63 of word L // 63 says that language L has an n-gram there."""

    languages: list[str]
    fallback: str
    masks: np.ndarray

    def __post_init__(self) -> None:
        words = self.masks
        self.chance = np.array([self._bit(words[k // WORD], k).mean() ** HASHES for k in range(len(self.languages))])

    @staticmethod
    def _bit(word: np.ndarray, k: int) -> np.ndarray:
        return (word >> np.uint64(k % WORD)) & np.uint64(1)

    def lookup(self, found: np.ndarray) -> np.ndarray:
        """Words by n-grams: all languages that contain each."""
        out = None
        for at in _places(found, self.masks.shape[1]):
            here = self.masks[:, at]
            out = here if out is None else out & here
        return out

    def judged(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text and a score from 0 to 1: how far its n-grams are that language's rather than the next one's."""
        size = len(texts)
        lettered, n, counts = np.zeros(size, bool), np.zeros(size), np.zeros((len(self.languages), size))
        for numbers, parts in _units(texts):
            found, of, has = grams(parts)
            lettered[numbers[has]] = True
            of = numbers[of]
            n += np.bincount(of, minlength=size)
            words = self.lookup(found)
            for k in range(len(self.languages)):
                counts[k] += np.bincount(of[self._bit(words[k // WORD], k) > 0], minlength=size)
        chance = self.chance[:, None]
        counts = np.maximum(0.0, counts - chance * n) / np.maximum(1e-9, 1 - chance)
        if not len(self.languages):
            return [NO_LANGUAGE] * len(texts), np.zeros(len(texts))
        best = counts.argmax(axis=0)
        top = counts.max(axis=0)
        second = np.partition(counts, -2, axis=0)[-2] if len(counts) > 1 else np.zeros(len(texts))
        score = np.where(top > 0, top / np.maximum(1e-9, top + second), 0.0)
        names = [(self.languages[k] if t > 0 else self.fallback) if has else NO_LANGUAGE for k, t, has in zip(best.tolist(), top.tolist(), lettered.tolist())]
        return names, np.where(lettered, np.clip(score, 0.0, 1.0), 0.0)


class _Counts:
    """Counts by n-gram that add up in place of their slices."""

    def __init__(self) -> None:
        self.values, self.n, self.waiting, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, found: np.ndarray) -> None:
        self.waiting.append(np.unique(found, return_counts=True))
        self.size += len(self.waiting[-1][0])
        if self.size > HELD:
            self.merge()

    def merge(self) -> None:
        values = np.concatenate([self.values, *(v for v, _ in self.waiting)])
        n = np.concatenate([self.n, *(c for _, c in self.waiting)])
        self.values, back = np.unique(values, return_inverse=True)
        self.n = np.bincount(back, n, len(self.values)).astype(np.int64)
        self.waiting, self.size = [], 0


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over whole texts; docs: ``lang, text``. A task adds up its own first, as far as memory goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Counts] = {}

        def told(names: list[str]) -> Iterator[pa.RecordBatch]:
            for name in names:
                counts = held.pop(name)
                counts.merge()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(counts.n), pa.string()), pa.array(counts.values.view(np.int64)), pa.array(counts.n)], ["lang", "gram", "n"]
                )

        for whole in batches:
            for batch in slices(whole, most=UNIT):
                names, of_row = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
                for numbers, parts in _units(batch.column("text").to_pylist()):
                    found, of, _ = grams(parts)
                    lang = of_row[numbers[of]]
                    for k, name in enumerate(names):
                        held.setdefault(name, _Counts()).add(found[lang == k])
                while sum(len(c.n) for c in held.values()) > 4 * HELD:
                    yield from told([max(held, key=lambda name: len(held[name].n))])
        yield from told(list(held))

    return docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> Filter:
    """Learn from rows with a language; docs: ``lang, text``. Without any, every text is ``und``.

    The fallback, for texts none of whose n-grams is known, is the language with
    the most letters learned from, by name among equals.
    """
    counts = cut_lineage(gram_counts(docs.filter("lang IS NOT NULL")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    known = totals.orderBy("lang").collect()  # a row per language
    languages = [r["lang"] for r in known]
    masks = np.zeros((max(1, -(-len(languages) // WORD)), CELLS), np.uint64)
    if not languages:
        return Filter([], NO_LANGUAGE, masks)
    fallback = min(known, key=lambda r: (-r["total"], r["lang"]))["lang"]
    spark = docs.sparkSession
    numbers = spark.createDataFrame([(r["lang"], k, r["total"]) for k, r in enumerate(known)], "lang string, k int, total long")
    rates = counts.join(broadcast_if_small(numbers), "lang").select("gram", "k", (F.col("n") / F.col("total")).alias("rate")).filter(F.col("rate") >= RATE)
    most = rates.groupBy("gram").agg(F.max("rate").alias("most"))
    held = rates.join(most, "gram").filter(F.col("rate") >= SHARE * F.col("most"))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram, k = batch.column("gram").to_numpy().view(np.uint64), batch.column("k").to_numpy()
            for at in _places(gram, CELLS):
                bit = np.left_shift(np.int64(1), (k % WORD).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array((k // WORD).astype(np.int32)), pa.array(bit)], ["cell", "word", "bits"])

    filled = held.select("gram", "k").mapInArrow(cells, "cell long, word int, bits long").groupBy("word", "cell").agg(F.bit_or("bits").alias("bits"))
    packed = filled.toArrow()  # at most CELLS rows a word of languages
    masks[packed.column("word").to_numpy(), packed.column("cell").to_numpy()] = packed.column("bits").to_numpy().view(np.uint64)
    return Filter(languages, fallback, masks)


def identified(docs: DataFrame, learned: Filter, columns: list[str]) -> DataFrame:
    """The named columns of every row, ``lang_pred`` and ``score``.

    A text that is null or has no letter is ``und`` with score 0; a text whose
    n-grams are all unknown gets the fallback language and score 0. Between equal
    counts the language that sorts first wins. Null ids, repeated rows and other
    columns make no difference; no rows give none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learned)
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text__", UNIT):
                names, score = shared.value.judged(batch.column("text__").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in columns), pa.array(names, pa.string()), pa.array(score)], [*columns, "lang_pred__", "score__"]
                )

    schema = ", ".join([f"`{c}` {kinds[c]}" for c in columns] + ["lang_pred__ string, score__ double"])
    frame = docs.select(*columns, F.col("text").alias("text__")).mapInArrow(run, schema)
    return frame.select(*columns, F.col("lang_pred__").alias("lang_pred"), F.col("score__").alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = fit(docs.filter(fold("doc_id", FOLDS) != TEST_FOLD).select(F.col("lang").cast("string").alias("lang"), "text"))
    found = identified(docs, learned, ["doc_id"])
    return found.select("doc_id", (fold("doc_id", FOLDS) == TEST_FOLD).alias("held_out"), "lang_pred", "score")
