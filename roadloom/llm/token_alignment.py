"""Alignment of two tokenizers' tokens by products of sparse incidence matrices.

Both tokenizers cut the same bytes. With A the incidence of one's tokens and
bytes and B that of the other's, ``A Bᵀ`` holds the overlap links: token pairs
that share bytes, with how many. Where no overlap bridges two neighbouring
tokens both end, and a group ends. With the incidences of token ids and groups,
their product holds the shared-group links. Matrices are rows of compressed
arrays (:class:`Csr`), and products are formed row by row (Gustavson), a block
of rows at a time.

Neither tokenizer joins a letter with white space after it, so a text is cut
into segments there, each is aligned once and remembered (up to ``MEMO``
segments), and a text is the sum of its segments. Where a vocabulary or a text
does not allow that, the whole text is one segment.

How many documents of the corpus hold a pair of ids is counted in Spark: a
slice of texts reports each of its pairs once with its number of documents and
gets each pair's count back once, so no table of pairs is held anywhere whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.common import slices, table
from roadloom.session import broadcast_if_small, cut_lineage

MEMO, MEMO_CHARACTERS, WINDOW, CHUNK, SLICE = 200_000, 16 << 20, 1 << 20, 1 << 21, 4 << 20
LONG = 256  # longer segments are not remembered
_ALIGNERS: dict[tuple[str, str], "Aligner"] = {}
_SEGMENT = re.compile(r"\s*\S+|\s+")
_END = re.compile(r"(?<=\S)(?=\s)")
_SPACE = "▁"
_LOW = (1 << 32) - 1


def vocabulary_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# --- sparse matrices -----------------------------------------------------------------------


@dataclass
class Csr:
    """Rows of column numbers and values, one after the other; row i is ``indptr[i] : indptr[i + 1]``."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    n_cols: int


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(values, first)


def product(left: Csr, right: Csr) -> Csr:
    """left x right by Gustavson's method: a row is the sum of the right rows that its entries name."""
    n_rows = len(left.indptr) - 1
    width = np.diff(right.indptr)[left.indices]
    grown = np.append(0, np.cumsum(width))[left.indptr]
    sizes, columns, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    lo = 0
    while lo < n_rows:
        hi = max(lo + 1, int(np.searchsorted(grown, grown[lo] + CHUNK, side="right")) - 1)
        part = slice(left.indptr[lo], left.indptr[hi])
        w = width[part]
        row = np.repeat(np.repeat(np.arange(hi - lo), np.diff(left.indptr[lo : hi + 1])), w)
        at = np.arange(len(row)) + np.repeat(right.indptr[left.indices[part]] - (np.cumsum(w) - w), w)
        keys, sums = _summed(row * right.n_cols + right.indices[at], np.repeat(left.values[part], w) * right.values[at])
        sizes.append(np.bincount(keys // right.n_cols, minlength=hi - lo))
        columns.append(keys % right.n_cols)
        values.append(sums)
        lo = hi
    return Csr(np.append(0, np.cumsum(np.concatenate(sizes))), np.concatenate(columns), np.concatenate(values), right.n_cols)


def incidence(lengths: np.ndarray) -> Csr:
    """Tokens by bytes, for tokens that lie one after the other."""
    n = int(lengths.sum())
    return Csr(np.append(0, np.cumsum(lengths)), np.arange(n), np.ones(n, np.int64), n)


def transposed(m: Csr) -> Csr:
    order = np.argsort(m.indices, kind="stable")
    row = np.repeat(np.arange(len(m.indptr) - 1), np.diff(m.indptr))[order]
    return Csr(np.append(0, np.cumsum(np.bincount(m.indices, minlength=m.n_cols))), row, m.values[order], len(m.indptr) - 1)


def groups(overlaps: Csr) -> tuple[np.ndarray, np.ndarray]:
    """The group of each row and of each column token: neighbours without a common token in ``overlaps`` are apart."""
    if len(overlaps.indptr) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = overlaps.indices[overlaps.indptr[:-1]], overlaps.indices[overlaps.indptr[1:] - 1]
    of_row = np.cumsum(np.append(0, first[1:] != last[:-1]))
    of_column = np.zeros(overlaps.n_cols, np.int64)
    of_column[overlaps.indices] = np.repeat(of_row, np.diff(overlaps.indptr))
    return of_row, of_column


def shared_group_links(ids_a: np.ndarray, group_a: np.ndarray, ids_b: np.ndarray, group_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """``group, a, b, links`` of each group's distinct id pairs, by the product of the ids' incidences with groups."""
    a, n_a = _summed(group_a << 32 | ids_a, np.ones(len(ids_a), np.int64))
    b, n_b = _summed(group_b << 32 | ids_b, np.ones(len(ids_b), np.int64))
    n_groups = int(group_a[-1]) + 1 if len(group_a) else 0
    of_group = np.append(0, np.cumsum(np.bincount(b >> 32, minlength=n_groups)))
    found = product(Csr(np.arange(len(a) + 1), a >> 32, n_a, n_groups), Csr(of_group, np.arange(len(b)), n_b, max(1, len(b))))
    row = np.repeat(np.arange(len(a)), np.diff(found.indptr))
    return a[row] >> 32, a[row] & _LOW, b[found.indices] & _LOW, found.values


# --- segments ------------------------------------------------------------------------------


class _Rows:
    """Arrays of rows that grow: numbers of a row in ``flat``, from ``start`` for ``size``."""

    def __init__(self) -> None:
        self.start, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((2, 0), np.int64)

    def add(self, size: np.ndarray, flat: np.ndarray) -> None:
        self.start = np.concatenate([self.start, self.flat.shape[1] + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, flat], axis=1)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the given rows one after the other, and which of the given rows each is of."""
        size = self.size[rows]
        which = np.repeat(np.arange(len(rows)), size)
        at = np.arange(len(which)) + np.repeat(self.start[rows] - (np.cumsum(size) - size), size)
        return self.flat[:, at], which


class Aligner:
    """Both tokenizers, and what is known of segments."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        from roadloom.llm.packing import _byte_letters

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {chr(b): b for b in range(256)} | {letter: b for b, letter in _byte_letters().items()}
        spelled = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(byte_of[c] for c in s) if all(c in byte_of for c in s) else s.encode() for s in spelled]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(t) for t in known], np.int64) for known in (self.bytes_a, self.bytes_b))
        self.names = [str(i) for i in range(max(len(spelled), len(pieces)))]
        self.lead = self.b.piece_to_id(_SPACE)
        made = json.loads(self.a.to_str())
        level = made.get("pre_tokenizer") or {}
        plain = made.get("normalizer") is None and level.get("type") == "ByteLevel" and level.get("use_regex") and not level.get("add_prefix_space")
        long = [p for p in pieces if len(p) > 1]
        words = not any(re.search(rf"[^{_SPACE}]{_SPACE}", p) for p in long) and self.lead != self.b.unk_id()
        #: characters of texts that are one segment: white space to Python only, or joined with others in a piece
        odd = "\x1c-\x1f" + "".join(sorted({re.escape(c) for p in long for c in p if c.isspace()}))
        self.odd = re.compile(f"[{odd}]" if plain and words else "")
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.pair_number: dict[int, int] = {}
        self.pair_keys = np.zeros(0, np.int64)
        self.sums = np.zeros((5, 0), np.int64)  # tokens of A, of B, groups, overlaps, links
        self.good = np.zeros(0, bool)
        self.spelled: list[str] = []
        self.characters = 0
        self.pairs = _Rows()

    def ids(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Both tokenizers' ids of segments; one that begins with a space has it from the second tokenizer."""
        a = [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        b = self.b.encode([s[1:] if s[:1] == " " else s for s in segments], num_threads=1)
        return a, [([self.lead] if s == " " else ids) if s[:1] == " " else ids[1:] for s, ids in zip(segments, b)]

    def aligned(self, segments: list[str]) -> dict[str, np.ndarray]:
        """Tokens, groups and links of segments; a segment with other bytes in its tokens is not ``good`` and has none."""
        ids = dict(zip("ab", self.ids(segments)))
        raw = [s.encode() for s in segments]
        good = np.ones(len(segments), bool)
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        for side, known, size in (("a", self.bytes_a, self.size_a), ("b", self.bytes_b, self.size_b)):
            flat = list(chain.from_iterable(ids[side]))
            of = np.repeat(np.arange(len(raw)), np.fromiter(map(len, ids[side]), np.int64, len(raw)))
            spelled = np.bincount(of, size[np.array(flat, np.int64)], len(raw)) if len(raw) else length
            if (spelled != length).any() or b"".join([known[i] for i in flat]) != b"".join(raw):
                good &= np.array([b"".join([known[i] for i in row]) == r for row, r in zip(ids[side], raw)], bool)
        out = {"good": good}
        for side, known in (("a", self.size_a), ("b", self.size_b)):
            rows = ids[side] if good.all() else [row if g else [] for row, g in zip(ids[side], good.tolist())]
            out[f"ids_{side}"] = np.array(list(chain.from_iterable(rows)), np.int64)
            out[f"n_{side}"] = np.fromiter(map(len, rows), np.int64, len(rows))
            out[f"len_{side}"] = known[out[f"ids_{side}"]]
        out["overlaps"] = product(incidence(out["len_a"]), transposed(incidence(out["len_b"])))
        out["group_a"], out["group_b"] = groups(out["overlaps"])
        out["links"] = shared_group_links(out["ids_a"], out["group_a"], out["ids_b"], out["group_b"])
        return out

    def _learn(self, segments: list[str]) -> None:
        found = self.aligned(segments)
        n = len(segments)
        seg_a = np.repeat(np.arange(n), found["n_a"])
        n_groups = int(found["group_a"][-1]) + 1 if len(seg_a) else 0
        seg_of = np.zeros(n_groups, np.int64)
        seg_of[found["group_a"]] = seg_a
        group, a, b, links = found["links"]
        seg = seg_of[group]
        total = np.zeros((5, n), np.int64)
        total[0], total[1], total[2] = found["n_a"], found["n_b"], np.bincount(seg_of, minlength=n)
        np.add.at(total[3], seg_a, np.diff(found["overlaps"].indptr))
        np.add.at(total[4], seg, links)
        keys, back = np.unique(a << 32 | b, return_inverse=True)
        known = self.pair_number
        numbers = np.array([known.setdefault(k, len(known)) for k in keys.tolist()], np.int64)
        if len(known) > len(self.pair_keys):
            fresh = numbers >= len(self.pair_keys)
            more = np.zeros(len(known) - len(self.pair_keys), np.int64)
            more[numbers[fresh] - len(self.pair_keys)] = keys[fresh]
            self.pair_keys = np.concatenate([self.pair_keys, more])
        rows, counts = _summed(seg << 32 | numbers[back], links)
        self.pairs.add(np.bincount(rows >> 32, minlength=n), np.stack([rows & _LOW, counts]))
        self.sums = np.concatenate([self.sums, total], axis=1)
        self.good = np.concatenate([self.good, found["good"]])
        self.spelled += _spelled(found, self.names, n_groups, seg_of, n)

    def learn(self, segments: list[str]) -> np.ndarray:
        """The segments' numbers, unknown ones learned."""
        fresh = [s for s in dict.fromkeys(segments) if s not in self.number]
        first = len(self.spelled)
        self.characters += sum(map(len, fresh))
        for lo in range(0, len(fresh), 20_000):
            self._learn(fresh[lo : lo + 20_000])
        self.number.update(zip(fresh, range(first, first + len(fresh))))
        out = np.fromiter(map(self.number.__getitem__, segments), np.int64, len(segments))
        for s in fresh:
            if len(s) > LONG:
                del self.number[s]
        return out


def _spelled(found: dict, names: list[str], n_groups: int, seg_of: np.ndarray, n: int) -> list[str]:
    """Each segment's groups as ``a1,a2|b1;a3|b2``."""
    sides = []
    for side in "ab":
        text = [names[i] for i in found[f"ids_{side}"].tolist()]
        ends = np.cumsum(np.bincount(found[f"group_{side}"], minlength=n_groups)).tolist()
        sides.append([",".join(text[lo:hi]) for lo, hi in zip([0, *ends], ends)])
    both = list(map("|".join, zip(*sides)))
    ends = np.cumsum(np.bincount(seg_of, minlength=n)).tolist()
    return [";".join(both[lo:hi]) for lo, hi in zip([0, *ends], ends)]


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process, kept between tasks."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _windows(text: str, odd: re.Pattern) -> Iterator[list[str]]:
    """The segments of space and text, in lists of about ``WINDOW`` characters."""
    text = " " + text
    if odd.search(text):
        yield [text]
        return
    at = 0
    while at < len(text):
        end = _END.search(text, at + WINDOW) if len(text) - at > WINDOW else None
        upto = end.start() if end else len(text)
        yield _SEGMENT.findall(text[at:upto] if at or end else text)
        at = upto


# --- the operator --------------------------------------------------------------------------

_TOTALS = ("n_a", "n_b", "n_groups", "n_overlaps", "n_links")
_HELD = "chunk long, doc_id {kind}, n_a long, n_b long, n_groups long, n_overlaps long, n_links long, groups_sha256 string, gaps binary, links binary, pairs array<long>, held array<int>"


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers in as few bytes as the largest takes, the width first."""
    width = 1
    while len(numbers) and int(numbers.max()) >> (8 * width):
        width *= 2
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _units(texts: list[str | None], odd: re.Pattern) -> Iterator[list[tuple[int, list[str]]]]:
    """Texts' numbers and segments, window by window, in lists of about ``SLICE`` characters."""
    held, size = [], 0
    for doc, text in enumerate(texts):
        for segments in _windows(text, odd) if text else ():
            held.append((doc, segments))
            size += min(len(text), WINDOW)
            if size >= SLICE:
                yield held
                held, size = [], 0
    yield held


def _slice_rows(known: Aligner, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Totals and digests of the texts, and their distinct pairs: text, pair's number and links."""
    n = len(texts)
    totals, good, none = np.zeros((5, n), np.int64), np.array([bool(t) for t in texts], bool), [np.zeros(0, np.int64)]
    digests: dict[int, "hashlib._Hash"] = {}
    keys, links = none, none
    for unit in _units(texts, known.odd):
        sizes = [len(segments) for _, segments in unit]
        numbers = known.learn([s for _, segments in unit for s in segments])
        doc = np.repeat(np.array([d for d, _ in unit], np.int64), sizes)
        good[doc[~known.good[numbers]]] = False
        at = 0
        listed = numbers.tolist()
        for (d, _), size in zip(unit, sizes):
            line = ";".join([known.spelled[i] for i in listed[at : at + size]])
            at += size
            if d in digests:
                digests[d].update((";" + line).encode())
            else:
                digests[d] = hashlib.sha256(line.encode())
        # a text's distinct segments, then its distinct pairs
        both, times = _summed(doc << 32 | numbers, np.ones(len(doc), np.int64))
        doc, numbers = both >> 32, both & _LOW
        for k in range(5):
            totals[k] += np.bincount(doc, known.sums[k, numbers] * times, n).astype(np.int64)
        (pair, held), which = known.pairs.take(numbers)
        both, held = _summed(doc[which] << 32 | pair, held * times[which])
        keys, links = [*keys, both], [*links, held]
    key, held = _summed(np.concatenate(keys), np.concatenate(links)) if len(keys) > 2 else (np.concatenate(keys), np.concatenate(links))
    keep = good[key >> 32]
    totals[:, ~good] = 0
    return totals, [digests[d].hexdigest() if good[d] else "" for d in range(n)], key[keep] >> 32, key[keep] & _LOW, held[keep]


def _held(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """A row per document with its pairs, numbered within its slice of texts, and one per slice with the pairs' names and documents."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(*paths)
        chunk = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, most=SLICE):
                if len(known.spelled) > MEMO or known.characters > MEMO_CHARACTERS:
                    known.forget()
                totals, digests, doc, pair, links = _slice_rows(known, batch.column("text").to_pylist())
                numbers, local, n_docs = np.unique(pair, return_inverse=True, return_counts=True)
                cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
                gaps = np.diff(local, prepend=0)
                starts = cuts[:-1][cuts[1:] > cuts[:-1]]
                gaps[starts] = local[starts]
                n = batch.num_rows
                spans = list(zip(cuts.tolist(), cuts[1:].tolist()))
                none = pa.nulls(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, chunk)), batch.column("doc_id"), *(pa.array(t) for t in totals), pa.array(digests, pa.string()),
                        pa.array([_packed(gaps[lo:hi]) for lo, hi in spans], pa.binary()), pa.array([_packed(links[lo:hi]) for lo, hi in spans], pa.binary()),
                        none.cast(pa.list_(pa.int64())), none.cast(pa.list_(pa.int32())),
                    ],
                    ["chunk", "doc_id", *_TOTALS, "groups_sha256", "gaps", "links", "pairs", "held"],
                )
                if len(numbers):
                    row = [[chunk], [None], *[[None]] * 5, [None], [None], [None], [known.pair_keys[numbers]], [n_docs.astype(np.int32)]]
                    kinds = [pa.int64(), batch.schema.field("doc_id").type, *[pa.int64()] * 5, pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, k) for v, k in zip(row, kinds)], ["chunk", "doc_id", *_TOTALS, "groups_sha256", "gaps", "links", "pairs", "held"]
                    )
                chunk += 1

    return docs.select("doc_id", "text").mapInArrow(run, _HELD.format(kind=kind))


def aligned(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """``doc_id``, its totals, ``groups_sha256``, ``n_best`` and ``count_sum`` for every row; ``n_overlaps`` counts pairs that share bytes.

    A null or empty text, and one whose tokens spell other bytes, has zeros and
    an empty ``groups_sha256``. A null doc_id is kept, repeated rows count as
    documents of their own, other columns are ignored, no rows give none.
    """
    held = cut_lineage(_held(docs, paths or vocabulary_paths()))
    named = held.filter("pairs IS NOT NULL")
    told = named.select("chunk", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "x")).select("chunk", "place", F.col("x.pairs").alias("pair"), F.col("x.held").alias("held"))
    counts = cut_lineage(told.groupBy("pair").agg(F.sum("held").alias("count")))
    left = F.shiftright("pair", 32)
    most = counts.groupBy(left.alias("a")).agg(F.max("count").alias("most"))  # as many rows as the first vocabulary at most
    graded = counts.withColumn("a", left).join(broadcast_if_small(cut_lineage(most)), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    grade = F.struct("place", F.when(F.col("best"), F.col("count")).otherwise(-F.col("count")).alias("grade"))
    back = told.select("chunk", "place", "pair").join(broadcast_if_small(cut_lineage(graded)), "pair").groupBy("chunk").agg(F.array_sort(F.collect_list(grade)).alias("x"))
    kind = dict(docs.dtypes)["doc_id"]
    empty = {"doc_id": kind, **{c: "long" for c in _TOTALS}, "groups_sha256": "string", "gaps": "binary", "links": "binary"}
    answers = back.select("chunk", *[F.lit(None).cast(k).alias(c) for c, k in empty.items()], F.col("x.grade").alias("grades"))
    asked = held.filter("pairs IS NULL").select("chunk", *empty, F.lit(None).cast("array<long>").alias("grades"))
    both = asked.unionByName(answers).repartition("chunk").sortWithinPartitions("chunk", F.col("grades").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grades, of = np.zeros(0, np.int64), None
        for batch in batches:
            chunk = batch.column("chunk").to_pylist()
            answer = batch.column("grades")
            keep, best, total = [], [], []
            for k, (gaps, links) in enumerate(zip(batch.column("gaps").to_pylist(), batch.column("links").to_pylist())):
                if gaps is None:
                    grades, of = answer[k].values.to_numpy(), chunk[k]
                    continue
                held = grades[np.cumsum(_unpacked(gaps))] if of == chunk[k] else np.zeros(0, np.int64)
                links = _unpacked(links)
                keep.append(k)
                best.append(int(links[held > 0].sum()))
                total.append(int((links * np.abs(held)).sum()))
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in ("doc_id", *_TOTALS, "groups_sha256")), pa.array(best, pa.int64()), pa.array(total, pa.int64())],
                ["doc_id", *_TOTALS, "groups_sha256", "n_best", "count_sum"],
            )

    totals = ", ".join(f"{c} long" for c in _TOTALS)
    return both.mapInArrow(run, f"doc_id {kind}, {totals}, groups_sha256 string, n_best long, count_sum long")


def links(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """``doc_id, ids_a, ids_b, ends_a, ends_b, group_a, group_b, overlap_a, overlap_b, overlap_bytes``: the alignment itself.

    Per row of ``docs``: both tokenizers' ids of space and text, where each ends
    in bytes and its group; the overlap links as places of tokens in the two
    lists with the bytes they share. Shared-group links are the token pairs of
    equal groups. Rows without tokens (see :func:`aligned`) have empty lists.
    """
    paths = paths or vocabulary_paths()
    kind = dict(docs.dtypes)["doc_id"]
    names = ["ids_a", "ids_b", "ends_a", "ends_b", "group_a", "group_b", "overlap_a", "overlap_b", "overlap_bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(*paths)
        for whole in batches:
            for batch in slices(whole, most=SLICE):
                rows = []
                for text in batch.column("text").to_pylist():
                    found = known.aligned([" " + text] if text else [])
                    overlaps = found["overlaps"]
                    token = np.repeat(np.arange(len(overlaps.indptr) - 1), np.diff(overlaps.indptr))
                    ends = [np.cumsum(found[f"len_{side}"]) for side in "ab"]
                    rows.append([found["ids_a"], found["ids_b"], *ends, found["group_a"], found["group_b"], token, overlaps.indices, overlaps.values])
                columns = [pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} array<long>" for n in names))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return aligned(docs.withColumn("doc_id", F.col("doc_id").cast("long"))).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"
    )
