"""Token alignment against whole texts encoded and linked pair by pair."""

from collections import Counter, defaultdict
from functools import cache
from hashlib import sha256
from itertools import accumulate

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadloom.llm import token_alignment as ta

PATHS = ta.vocabulary_paths()
ODD = [
    None, "", "x", " ", "  a\n\n  b \t c  ", "<|endoftext|> <s> </s> <0x41>", "a\x1cb !\x1c c", "▁ a", "a▁ b", "日本語　テスト　x", "é ß Σ", "\n",
    "\n\nfoo\n \nbar ", "don't I'll 3.14!!  x", "\0 z", "a\xa0b c", "    def f():\r\n        return 1;\r\n", "😀😀 👨‍👩‍👧 x", "ﬁ ＡＢ ①", "x" * 5000,
    "é" * 3000, "ab " * 3000, " " * 3000 + "x", "​ ﻿ a", "मानक हिन्दी ไทย", "x",
]


@cache
def tokenizers():
    a_of, b_of = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a_of.encode_special_tokens = True
    return a_of, b_of


def brute(texts):
    """Totals, digest and links of each text by the tokenizers' own output."""
    a_of, b_of = tokenizers()
    known = ta.aligner(*PATHS)
    per, documents = [], Counter()
    for text in texts:
        a = a_of.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_of.encode(text) if text else []
        bytes_a, bytes_b = [known.bytes_a[i] for i in a], [known.bytes_b[i] for i in b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            per.append(None)
            continue
        ends_a, ends_b = list(accumulate(map(len, bytes_a))), list(accumulate(map(len, bytes_b)))
        i = j = 0
        found, links = [], Counter()
        for cut in sorted(set(ends_a) & set(ends_b)):
            p, q = i, j
            while i < len(a) and ends_a[i] <= cut:
                i += 1
            while j < len(b) and ends_b[j] <= cut:
                j += 1
            found.append((a[p:i], b[q:j]))
            links.update((x, y) for x in a[p:i] for y in b[q:j])
        documents.update(set(links))
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in found)
        per.append((len(a), len(b), len(found), links.total(), links, sha256(spelled.encode()).hexdigest()))
    best = defaultdict(int)
    for (x, _), n in documents.items():
        best[x] = max(best[x], n)
    out = []
    for one in per:
        if one is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = one[4]
        n_best = sum(n for pair, n in links.items() if documents[pair] == best[pair[0]])
        out.append((*one[:4], n_best, sum(n * documents[pair] for pair, n in links.items()), one[5]))
    return out


def rows_of(frame):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in frame.orderBy("doc_id").collect()]


def test_whole_texts(spark, corpus):
    texts = ODD + [r.text for r in corpus.orderBy("doc_id").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    assert rows_of(ta.aligned(docs)) == brute(texts)


def test_slices_windows_and_forgetting_change_nothing(spark, corpus, monkeypatch):
    texts = [r.text for r in corpus.orderBy("doc_id").collect()]
    want = brute(texts)
    known = ta.aligner(*PATHS)
    monkeypatch.setattr(ta, "WINDOW", 50)
    monkeypatch.setattr(ta, "CHUNK", 10)
    assert [ta._slice_rows(known, [t])[1][0] for t in texts] == [w[-1] for w in want]
    totals = ta._slice_rows(known, texts)[0]
    known.forget()
    again = ta._slice_rows(known, texts)[0]
    assert (totals == again).all() and [tuple(totals[[0, 1, 2, 4], k]) for k in range(len(texts))] == [w[:4] for w in want]
    known.forget()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \n\t\rAé日1!'▁\x1d　", max_size=60))
def test_any_text(text):
    known = ta.aligner(*PATHS)
    want = brute([text])[0]
    totals, digests, _, _, links = ta._slice_rows(known, [text])
    assert (*totals[[0, 1, 2, 4], 0].tolist(), digests[0]) == (*want[:4], want[-1]) and links.sum() == want[3]


def test_product_is_the_matrix_product(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(ta, "CHUNK", 7)

    def csr(m):
        row, col = np.nonzero(m)
        return ta.Csr(np.append(0, np.cumsum(np.bincount(row, minlength=len(m)))), col, m[row, col], m.shape[1])

    for shape in [(5, 6, 7), (1, 9, 3), (12, 4, 12), (3, 0, 4)]:
        left, right = (rng.integers(0, 3, s) * (rng.random(s) < 0.4) for s in (shape[:2], shape[1:]))
        got = ta.product(csr(left), csr(right))
        dense = np.zeros((shape[0], shape[2]), int)
        dense[np.repeat(np.arange(shape[0]), np.diff(got.indptr)), got.indices] = got.values
        assert (dense == left @ right).all()


def test_links_are_the_tokens_that_share_bytes(spark):
    texts = ["Hello wörld, tokenization unaligned!", None, ""]
    rows = ta.links(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    first = rows[0]
    spans_a, spans_b = ([*zip([0, *e], e)] for e in (first.ends_a, first.ends_b))
    want = {(i, j): min(a[1], b[1]) - max(a[0], b[0]) for i, a in enumerate(spans_a) for j, b in enumerate(spans_b) if min(a[1], b[1]) > max(a[0], b[0])}
    assert dict(zip(zip(first.overlap_a, first.overlap_b), first.overlap_bytes)) == want
    assert first.ends_a[-1] == first.ends_b[-1] == len((" " + texts[0]).encode())
    assert rows[1].ids_a == [] and rows[2].group_b == []


def test_awkward_rows(spark, awkward, empty):
    clashing = awkward.withColumn("chunk", F.lit("x")).withColumn("n_a", F.lit("y")).withColumn("grades", F.lit(1))
    got = ta.aligned(clashing)
    want = brute([r.text for r in awkward.collect()])
    key = lambda r: str(r)
    assert sorted(((r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got.collect()), key=key) == sorted(want, key=key)
    assert got.filter("doc_id IS NULL").count() == awkward.filter("doc_id IS NULL").count()
    assert ta.aligned(empty).collect() == []
