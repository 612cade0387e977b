"""Language identification: the n-grams, the filter and its errors, and accuracy on held-out texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadloom.llm import language_id as li

SYLLABLES = {"aa": "ka ro mi te su na".split(), "bb": "schi ung eit ver ßen al".split(), "cc": "да но ми ре ка то".split(), "dd": "ção lho nha esto que ka".split()}


def text_in(lang: str, seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def learned(spark):
    rows = [(lang, text_in(lang, 1000 * k + i, 60)) for k, lang in enumerate(SYLLABLES) for i in range(40)]
    return li.fit(spark.createDataFrame(rows + [(None, "zzz"), ("aa", None), ("aa", "")], "lang string, text string"))


def plain_grams(text: str) -> list[str]:
    """Every n-gram of every word between spaces."""
    word, words = "", []
    for c in text + " ":
        if c.isalpha():
            low = c.lower()
            word += low if len(low) == 1 else c
        elif word:
            words.append(f" {word} ")
            word = ""
    return [w[i : i + n] for w in words for n in li.GRAMS for i in range(len(w) - n + 1)]


def test_grams_are_those_of_the_words():
    texts = ["Ab, c1d", "", None, "x", "É日本 -- ẞa", "  ", "İx 9", "long" * 50, "a b"]
    found, of, lettered = li.grams(texts)
    assert [len(plain_grams(t or "")) for t in texts] == np.bincount(of, minlength=len(texts)).tolist()
    assert lettered.tolist() == [any(c.isalpha() for c in t or "") for t in texts]
    apart = {}
    for k, text in enumerate(texts):
        own, _, _ = li.grams([text])
        assert sorted(own.tolist()) == sorted(found[of == k].tolist())
        for gram in plain_grams(text or ""):
            apart[gram] = None
    assert len(apart) == len(set(found.tolist()))


def test_units_change_nothing(monkeypatch):
    texts = ["ab cd1ef " * 30, None, "", "x", "nogap" * 20, "é日 " * 9]
    want, of, lettered = li.grams(texts)
    monkeypatch.setattr(li, "UNIT", 20)
    got = [[] for _ in texts]
    for numbers, parts in li._units(texts):
        found, which, _ = li.grams(parts)
        for g, k in zip(found.tolist(), numbers[which].tolist()):
            got[k].append(g)
    assert [sorted(g) for g in got] == [sorted(want[of == k].tolist()) for k in range(len(texts))]
    counts = li._Counts()
    monkeypatch.setattr(li, "HELD", 3)
    for part in np.array_split(want, 7):
        counts.add(part)
    counts.merge()
    values, n = np.unique(want, return_counts=True)
    assert (counts.values == values).all() and (counts.n == n).all()


def test_filter_never_misses_and_its_chance_is_its_false_positive_rate():
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    masks = np.zeros((1, 1 << 15), np.uint64)
    for at in li._places(grams[:6000], 1 << 15):
        masks[0, at] |= np.uint64(1)
    for at in li._places(grams[3000:9000], 1 << 15):
        masks[0, at] |= np.uint64(2)
    held = li.Filter(["x", "y"], "x", masks)
    found = held.lookup(grams)[0]
    assert ((found[:6000] & np.uint64(1)) == 1).all() and ((found[3000:9000] & np.uint64(2)) == 2).all()
    wrong = (found[9000:] & np.uint64(1)).mean()
    assert 0 < wrong and abs(wrong - held.chance[0]) < 0.02


def test_many_languages_take_more_words():
    masks = np.zeros((2, 1 << 10), np.uint64)
    names = [f"l{k:03}" for k in range(70)]
    found, _, _ = li.grams(["hello there"])
    for at in li._places(found, 1 << 10):
        masks[1, at] |= np.uint64(1 << (66 - li.WORD))
    assert li.Filter(names, "l000", masks).judged(["hello"])[0] == ["l066"]


def test_held_out_texts(spark, learned):
    rows = [(k, lang, text_in(lang, 9_000_000 + 97 * k, 25)) for k, lang in enumerate(list(SYLLABLES) * 25)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = li.identified(docs, learned, ["doc_id", "lang"]).collect()
    assert len(got) == 100 and all(r.lang == r.lang_pred and 0.5 < r.score <= 1 for r in got)


def test_undecided_texts(spark, learned, awkward, empty):
    got, score = learned.judged([None, "", " 12 !", "ωψξ", "kA ro"])
    assert got == ["und", "und", "und", learned.fallback, "aa"] and score[:4].tolist() == [0, 0, 0, 0]
    clashing = awkward.withColumn("text__", F.lit(1)).withColumn("lang_pred", F.lit("q"))
    out = li.identified(clashing, learned, ["doc_id", "source"])
    assert out.count() == awkward.count() and out.filter("text IS NULL AND lang_pred <> 'und'" if "text" in out.columns else "lang_pred IS NULL").count() == 0
    assert li.identified(empty, learned, ["doc_id"]).collect() == []
    nothing = li.fit(empty.select("lang", "text"))
    assert nothing.judged(["abc", None])[0] == ["und", "und"]


def test_counts_are_of_all_texts(spark):
    rows = [("a", "ab"), ("a", "ab x"), ("b", "ab"), ("a", None)]
    counts = li.gram_counts(spark.createDataFrame(rows * 20, "lang string, text string").repartition(5)).collect()
    own, _, _ = li.grams(["ab"])
    n = {(r.lang, r.gram): r.n for r in counts}
    assert all(n["a", int(g.view(np.int64))] == 40 and n["b", int(g.view(np.int64))] == 20 for g in own)
