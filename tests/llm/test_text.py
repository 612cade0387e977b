"""Language model, quality, secrets, pages, packing and mixing against brute force, and awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from roadloom.llm import html_extract, language_model, mixing, packing, quality, secret_scan


# --- language model --------------------------------------------------------------------------


def _brute_force_model(rows):
    begin, end = b"\0b", b"\0e"
    tokens = lambda t: (t or "").encode().lower().split() + [end]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    words, pairs = Counter(), Counter()
    for i, text in rows:
        if not held(i):
            words.update(tokens(text))
            pairs.update(zip([begin] + tokens(text)[:-1], tokens(text)))
    history, kinds = defaultdict(lambda: [0, 0, 0, 0]), Counter()
    for (u, w), c in pairs.items():
        history[u][0] += c
        history[u][min(c, 3)] += 1
        kinds[w] += 1
    d2 = language_model.discounts(np.array([sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)]))
    d1 = language_model.discounts(np.array([sum(c == k for c in kinds.values()) for k in (1, 2, 3, 4)]))
    total, n, v = sum(kinds.values()), sum(words.values()), len(words)
    rest = sum(d1[min(c, 3)] for c in kinds.values()) / total

    def prob(u, w):
        low = (kinds[w] - d1[min(kinds[w], 3)]) / total + rest / (v + 1)
        if u not in history:
            return low
        h, c = history[u], pairs[u, w]
        return (c - d2[min(c, 3)]) / h[0] + (d2[1] * h[1] + d2[2] * h[2] + d2[3] * h[3]) / h[0] * low

    out = []
    for i, text in rows:
        t = tokens(text)
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        score = sum(math.log10(prob(u, w)) for u, w in zip([begin] + t[:-1], t))
        out.append((i, held(i), len(t), sum(words[w] > 0 for w in t), n, round(base, 4), round(score, 4)))
    assert abs(sum(prob(b"one", w) for w in words) + prob(b"one", b"never") - 1) < 1e-9
    return Counter(out)


def test_language_model(awkward, corpus):
    both = awkward.unionByName(corpus)
    rows = [(r.doc_id, r.text) for r in both.select("doc_id", "text").collect()]
    found = language_model.scored(both).collect()
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4)) for r in found)
    assert got == _brute_force_model(rows)


def test_language_model_without_training_rows(empty, awkward):
    assert language_model.scored(empty).count() == 0
    alone = language_model.scored(awkward.filter("doc_id IS NULL")).collect()
    assert len(alone) == 2 and all(r.held_out and r.train_tokens == 0 and r.score == 0.0 for r in alone)


# --- quality ---------------------------------------------------------------------------------


def _judged_text(i, good):
    rng = random.Random(i)
    text = [rng.choice("the of and river stone lantern window garden paper".split()) + rng.choice(["", "", ","]) for _ in range(60)]
    return " ".join(text) if good else " ".join(w.upper() + "!!" for w in text)


def test_quality_votes(spark, awkward, empty):
    rows = [(i, _judged_text(i, i % 4 > 0), i % 4 > 0) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000, ""), (1001, None), (None, "LOUD!! LOUD!!")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(g), 0) for i, _, g in rows] + [(None, 1, 0), (5, None, 0), (77_777, 1, 0)], "doc_id long, quality int, toxic int")
    found = quality.judged(docs, labels, ["doc_id"]).collect()
    assert len(found) == docs.count()
    truth = {i: g for i, _, g in rows}
    held = [r for r in found if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([(r.predicted__ == 1) == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score__ <= 1 for r in found) and all(r.score__ > 0.5 for r in found if r.doc_id in (1000, 1001))
    assert all(r.score__ == 0.5 for r in quality.judged(awkward, labels.limit(0), ["doc_id", "text"]).collect())
    assert quality.judged(empty, labels, ["doc_id"]).count() == 0


# --- secrets ---------------------------------------------------------------------------------


def _base_spans(text):
    assign = re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A)
    out = [(m.start(), 0, m.end()) for m in assign if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_secret_spans(spark, awkward, empty):
    rng = random.Random(8)
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    noise = pick("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 40)
    texts = [
        f"é日 PassWord = \"{pick('abc123', 12)}\" and token=secret=abcdefghij api_key:'{pick('xyz789', 9)}'",
        f"AKIA{pick('ABCDEFGH0123', 16)} AKIA{pick('ABC', 11)}AKIA AKIAAKIA{pick('XYZ', 3)}",
        f"{pick('0123456789abcdef', 40)} {pick('0123456789abcdef', 31)} secret=token:abcdefghijkl passwd  =short",
        f"see {noise} in /usr/share/Doc1/thing-that-is-long and aaaaaaaaaaaaaaaaAAAAAAAA1111111111aaaaaaaaaaaaaaaaaaa",
        "plain words only, thatareverylongwithoutanydigitsinthematall",
        "",
        None,
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    found = {r.doc_id: r for r in secret_scan.secrets(docs).collect()}
    names = ["assign", "access", "hex"]
    for i, text in enumerate(texts):
        spans = _base_spans(text or "")
        listed = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)
        assert found[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [found[i].n_assign, found[i].n_access, found[i].n_hex] == [sum(k == j for _, k, _ in spans) for j in range(3)]
        assert all(s in found[i].spans.split(",") for s in listed.split(",") if s)
    assert found[3].spans == f"random:4:{4 + len(noise)}" and found[4].spans == ""
    assert secret_scan.secrets(awkward).count() == awkward.count() and secret_scan.secrets(empty).count() == 0


# --- pages -----------------------------------------------------------------------------------


def test_main_text(spark):
    article = "<article><h1>The &lt;title&gt; &amp more</h1><p><b>First  <i>para</i>\n graph<br>goes on.<p>Second &eacute;nd.</article>"
    chrome = "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/x'>Menu</a></ul></nav>"
    plain = (
        "<body><header>Site</header><div id=wrap><div class='post-12 content'><p>One two three.</p><div class='ad'>Buy</div><p>Four.</p>"
        "<aside>Side</aside><form><input>Go</form><div class='comments'><p>Nice!</p></div></div><div class='sidebar'>Links</div></div><footer>End</footer>"
    )
    pages = [
        (1, "https://a.example/x", chrome + article + "<footer>&copy; me</footer></body></html>"),
        (2, "https://a.example/y", chrome + "<!-- c --><div class=notice>Cookies</div>" + article),
        (3, "http://b.example/1", plain),
        (4, "http://b.example/2", plain.replace("post-12", "post-999")),
        (5, None, None), (6, "http://a.example", ""), (7, "nonsense", "just text & <3"), (None, "http://b.example/3", "<p"),
        (1, "https://a.example/x", chrome + article),
    ]
    table = spark.createDataFrame([(*p, "h", "p") for p in pages], "page_id long, url string, html string, host string, path string")
    found = html_extract.main_text(table).collect()
    assert len(found) == len(pages)
    want = "The <title> & more\nFirst para graph goes on.\nSecond énd."
    texts = defaultdict(set)
    for r in found:
        texts[r.page_id].add(r.text)
        assert r.n_chars == len(r.text)
    assert texts[1] == texts[2] == {want} and texts[3] == texts[4] == {"One two three.\nFour."}
    assert texts[5] == texts[6] == {""} and texts[7] == {"just text & <3"}
    assert html_extract.main_text(table.limit(0)).count() == 0


def test_names_alone_drop_no_article(spark):
    """Junk words inside longer names, and junk names around the article or most of the text, lose nothing."""
    body = "<p>" + "</p><p>".join(f"Sentence {i} of the story." for i in range(6)) + "</p>"
    want = "\n".join(f"Sentence {i} of the story." for i in range(6))
    side = "<div class='sidebar'>Links</div><div class='comments'><p>Nice!</p></div>"
    pages = [f"<div class='{c}'>{body}{side}</div>" for c in ("content has-sidebar", "no-sidebar", "with-comments", "post-header-wrap")]
    pages += [f"<div id=page class='sticky-header'><article>{body}</article></div>", f"<div class=widget><div class='banner'>{body}</div></div>{side}"]
    pages += [f"<p>Some text around that is far longer than all of the article taken together. {'So it is. ' * 30}</p><div class=modal><main>{body}</main></div>"]
    table = spark.createDataFrame([(i, f"http://h{i}.example/x", f"<html><body>{p}</body></html>") for i, p in enumerate(pages)], "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_extract.main_text(table).collect()}
    assert [found[i] for i in range(6)] == [want] * 6
    assert want in found[6]
    chrome = html_extract.Page(f"<article>{body}</article><div class=comments><article>Nice!</article></div><div class=related hidden>{body * 9}</div>")
    assert chrome.text(None) == want


# --- packing ---------------------------------------------------------------------------------


def test_packing(awkward, corpus, empty):
    both = awkward.unionByName(corpus)
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    want = Counter()
    for r in both.select("doc_id", "text").collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            want[r.doc_id, k, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())] += 1
    found = packing.packed(both, with_ids=True).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    inside = defaultdict(list)
    for r in found:
        inside[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == r.length
    for parts in inside.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(inside) <= math.ceil(sum(r.length for r in found) / 4096) + 1
    assert packing.packed(empty).count() == 0


def test_packing_plan_holds_everything_and_is_tight():
    rng = np.random.default_rng(1)
    for n, spread in ((1, 1.0), (50, 0.2), (5_000, 1.0), (60_000, 0.4)):
        lengths = np.minimum(4096, rng.lognormal(6.6, spread, n).astype(int) + 1)
        hist = Counter(lengths.tolist())
        kinds = packing.plan(dict(hist))
        held = Counter()
        for kind, times in kinds:
            assert sum(kind) <= 4096 and times > 0
            for length in kind:
                held[length] += times
        assert held == hist
        plain = packing._Sequences(4096)
        for length in sorted(hist, reverse=True):
            plain.best_fit(length, hist[length])
        best_fit = sum(t for kind in plain.room.values() for _, t in kind)
        assert sum(t for _, t in kinds) <= best_fit * 1.005 + 1


# --- mixing ----------------------------------------------------------------------------------


def test_mixing_windows_and_lag(awkward, corpus, empty):
    both = awkward.unionByName(corpus)
    weights = {"s0": 3.0, "s1": 1.0, "s2": 1.0, "a": 0.5}
    found = mixing.mixed_order(both, weights, block_chars=200, frame_slots=12).collect()
    assert len(found) == both.count()
    blocks = {}
    for r in found:
        assert r.release <= r.slot < r.due
        assert blocks.setdefault((r.source, r.block), r.slot) == r.slot
    assert len(set(blocks.values())) == len(blocks)
    whole = mixing._schedule(both.sparkSession.createDataFrame([("x", 500, 50), ("y", 300, 30), ("z", 200, 20)], "source string, blocks long, quota long")).collect()
    given, order = Counter(), sorted(whole, key=lambda r: r.slot)
    assert [r.slot for r in order] == list(range(1000))
    for t, r in enumerate(order, 1):
        given[r.source] += 1
        assert all(abs(given[s] - t * w) < 1 for s, w in (("x", 0.5), ("y", 0.3), ("z", 0.2)))
    assert mixing.mixed_order(empty).count() == 0


def test_mixed_rows_are_whole_and_in_order(awkward):
    out = mixing.in_mixed_order(awkward, ["doc_id", "text", "score"]).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, awkward.select("doc_id", "text", "score").collect()))
