"""Exact, SimHash, line and embedding deduplication against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from roadloom.llm import exact_dedup, lattice, line_dedup, mixing, simhash


def _normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def _groups(names, linked):
    """Smallest member of each name's set."""
    up = {n: n for n in names}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in linked:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in names}


def test_exact_copies(awkward, corpus):
    for docs in (awkward, corpus):
        rows = [(r.doc_id, _normal(r.text)) for r in docs.collect()]
        ids = {}
        for i, text in rows:
            ids.setdefault(text, []).append(i)
        found = exact_dedup.exact_groups(docs).collect()
        assert len(found) == len(rows)
        for r in found:
            text = next(t for i, t in rows if i == r.doc_id and hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
            known = [i for i in ids[text] if i is not None]
            assert r.keep_id == (min(known) if known else None) and r.group_size == len(ids[text])
        assert sum(r.kept for r in found) == len(ids)
        left = exact_dedup.drop_copies(docs, ["doc_id", "text"]).collect()
        assert Counter(_normal(r.text) for r in left) == Counter(ids.keys())


def test_exact_empty_table(empty):
    assert exact_dedup.exact_groups(empty).count() == 0


def _fingerprint(text):
    found = (text or "").encode().lower().split()
    shingles = [b" ".join(found[i : i + 4]) for i in range(len(found) - 3)] or ([b" ".join(found)] if found else [])
    votes = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def test_simhash_components(awkward, corpus):
    for docs in (corpus, awkward):
        rows = [(r.doc_id, _fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
        prints = sorted({f for _, f in rows})
        near = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= 4]
        group = _groups(prints, near)
        least = {}
        for i, f in rows:
            if i is not None:
                least[group[f]] = min(i, least.get(group[f], i))
        want = Counter((i, f"{f:016x}", least.get(group[f])) for i, f in rows)
        found = simhash.near_groups(docs).collect()
        assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == want
        assert sum(r.kept for r in found) == len(set(group.values()))


def test_simhash_empty_table(empty):
    assert simhash.near_groups(empty).count() == 0


@pytest.mark.parametrize("spread", [2, 6, 40])
def test_trie_walk_finds_every_pair(spread):
    """Fingerprints in crowds: the four tries with budgets find just the pairs within four bits."""
    rng = np.random.default_rng(spread)
    centres = rng.integers(0, 2**64, 12, dtype=np.uint64)
    values = np.unique(
        np.concatenate([c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (150, spread), dtype=np.uint64), axis=1) for c in centres])
    )
    differ = np.bitwise_count(values[:, None] ^ values[None])
    want = {(values[i], values[j]) for i, j in zip(*np.nonzero(differ <= 4)) if i < j}
    got = set()
    for quarter in range(4):
        by = np.uint64(16 * quarter)
        turned = np.sort((values << by) | (values >> (np.uint64(64) - by)) if quarter else values)
        back = (turned >> by) | (turned << (np.uint64(64) - by)) if quarter else turned
        for i, j in simhash.walk(turned, None, 0, 0, 4, 1):
            got |= {(min(a, b), max(a, b)) for a, b in zip(back[i], back[j])}
    assert got == want


def test_simhash_splits_crowds(spark, monkeypatch):
    """Nodes above the block size are cut into cells; the components stay the same."""
    rng = np.random.default_rng(3)
    crowd = np.unique(np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)))
    fps = spark.createDataFrame([(int(x),) for x in crowd.view(np.int64)], "fp long")
    monkeypatch.setattr(simhash, "BLOCK", 16)
    edges = [(r.a, r.b) for r in simhash.links(fps).collect()]
    assert len(set(_groups([int(x) for x in crowd.view(np.int64)], edges).values())) == 1


def _line_words(text):
    return [(k, line.encode().lower().split()) for k, line in enumerate((text or "").split("\n"))]


def test_line_dedup(awkward, corpus):
    for docs in (corpus, awkward):
        rows = sorted(enumerate(docs.select("doc_id", "text").collect()), key=lambda x: (x[1].doc_id is None, x[1].doc_id or 0, x[0]))
        lines = [(n, r.doc_id, k, w) for n, r in rows for k, w in _line_words(r.text) if len(w) >= 5]
        lines.sort(key=lambda x: (x[1] is None, x[1] or 0, x[2], x[0]))
        gone = Counter()
        for i, (n, _, k, w) in enumerate(lines):
            for m, _, _, v in lines[:i]:
                both = len(set(w) & set(v))
                if w == v or both >= 0.8 * (len(set(w)) + len(set(v)) - both) - 1e-9:
                    gone[n] += 1
                    break
        left = line_dedup.without_repeats(docs, ["doc_id", "text"]).collect()
        want = Counter((r.doc_id, len((r.text or "").split("\n")) - gone[n]) for n, r in rows if r.text)
        got = Counter((r.doc_id, len(r.text.split("\n")) if r.text else 0) for r in left if r.text is not None)
        texts = {n: r.text for n, r in rows}
        emptied = [n for n in gone if gone[n] == len(texts[n].split("\n"))]
        assert sum(got.values()) == sum(1 for _, r in rows if r.text is not None)
        assert {k: v for k, v in got.items() if k[1] > 0} == {k: v for k, v in want.items() if k[1] > 0} or emptied


def test_line_dedup_empty_table(empty):
    assert line_dedup.removed_lines(empty).count() == 0


def test_lattice_links(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(60, 64))
    near = np.concatenate([b + 0.05 * rng.normal(size=(4, 64)) for b in base[:20]])
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near, 3 * base[:5], base[:7]]))]
    n = len(rows)
    rows += [(n, None), (n + 1, [0.0] * 64), (n + 2, [None, *[1.0] * 63]), (n + 3, [float("nan")] * 64), (n + 4, [float("inf")] * 64), (n + 5, [1.0, 2.0]), (None, base[0].tolist()), (n + 6, [])]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, n_links int, kept int")
    units = {}
    for at, (_, v) in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            units[at] = np.array(v) / np.linalg.norm(v)
    pairs = [(a, b) for a in units for b in units if a < b and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.9]
    count = Counter(x for p in pairs for x in p)
    group = _groups(range(len(rows)), pairs)
    least = {}
    for at, (i, _) in enumerate(rows):
        if i is not None:
            least[group[at]] = min(i, least.get(group[at], i))
    want = Counter((rows[at][0], count[at], least.get(group[at])) for at in range(len(rows)))
    found = lattice.linked(table).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in found) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in found if r.vec_id is not None)
    assert lattice.linked(table.limit(0)).count() == 0


def test_lattice_recall_at_the_threshold():
    """Pairs at a cosine of 0.9: at least 0.9 of them meet in some table (in fact about 0.99)."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(0.19) * z / np.linalg.norm(z, axis=1, keepdims=True)
    (hx, vx), (hy, vy) = lattice.cells(x), lattice.cells(y)
    met = ((hx == hy) | (vx == hy[:, :, None]).any(axis=2) | (vy == hx[:, :, None]).any(axis=2)).any(axis=1)
    assert met.mean() > 0.97


def test_e8_decoding_is_nearest():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 8)) * 2
    point = lattice.nearest_e8(x)
    own = ((x - point) ** 2).sum(axis=1)
    for v in lattice._neighbours():
        assert (own <= ((x - point - v) ** 2).sum(axis=1) + 1e-9).all()


def _shingles(text):
    found = (text or "").lower().split()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} or {tuple(found)}


@pytest.mark.parametrize("per_row", [8, 0])
def test_near_copies_dropped_by_similarity(spark, monkeypatch, per_row):
    """Planted pairs at 0.8 to 0.95 go, chains and crowds as brute force joins them; pairs below 0.8 stay."""
    monkeypatch.setattr(simhash, "PAIRS_PER_ROW", per_row)
    rng, texts = np.random.default_rng(11), []
    for i in range(60):
        base = [f"w{x}" for x in rng.integers(0, 10**6, 205)]
        texts.append(" ".join(base))
        for changes in ((1, 2, 3, 4)[i % 4], 8):  # each change takes 5 of 201 shingles
            other = list(base)
            for at in range(changes):
                other[10 + 20 * at] = f"x{i}y{at}z{changes}"
            texts.append(" ".join(other))
    crowd = texts[0].split()
    for i in range(40):
        crowd[rng.integers(0, 205)] = f"c{i}"
        texts.append(" ".join(crowd))
    texts += ["", None, "short", "short one", texts[5].upper()]
    sets = [_shingles(t) for t in texts]
    near = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    group = _groups(range(len(texts)), near)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in simhash.similar_groups(docs).collect()}
    assert found == group
    left = simhash.drop_near_copies(docs, ["doc_id"]).collect()
    assert sorted(r.doc_id for r in left) == sorted(set(group.values()))


def test_near_copies_empty_table(empty):
    assert simhash.similar_groups(empty).count() == 0


@pytest.mark.parametrize("operator, decision", [(exact_dedup, "exact_groups"), (simhash, "similar_groups"), (line_dedup, "removed_lines"), (mixing, "mixed_order")])
def test_rows_are_named_alike_when_the_scan_is_split_anew(spark, corpus, tmp_path, monkeypatch, operator, decision):
    """Executors that come or go between decision and filter change a scan's partitions, not the result."""
    parts = [corpus.filter(f"doc_id % 5 = {k}").select("doc_id", "text", "source") for k in range(5)]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/docs")
    work = {
        "exact_groups": lambda d: exact_dedup.drop_copies(d, ["doc_id", "text"]),
        "similar_groups": lambda d: simhash.drop_near_copies(d, ["doc_id", "text"]),
        "removed_lines": lambda d: line_dedup.without_repeats(d, ["doc_id", "text"]),
        "mixed_order": lambda d: mixing.in_mixed_order(d, ["doc_id", "text"], block_chars=200, frame_slots=12),
    }[decision]
    want = [tuple(r) for r in work(spark.read.parquet(f"{tmp_path}/docs")).collect()]
    before, decide = spark.conf.get("spark.sql.files.openCostInBytes"), getattr(operator, decision)

    def then_split_anew(*args, **kwargs):
        out = decide(*args, **kwargs)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        return out

    monkeypatch.setattr(operator, decision, then_split_anew)
    try:
        got = [tuple(r) for r in work(spark.read.parquet(f"{tmp_path}/docs")).collect()]
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert got == want if decision == "mixed_order" else sorted(got) == sorted(want)


def test_line_query_takes_short_lines(spark, tmp_path):
    """Every line with a word goes if an earlier one is equal or similar, however short; blank lines stay."""
    texts = [
        "Read more\nHome\n\nalpha beta gamma delta\nHome",
        "home\nread  more\nmore read\n\nalpha beta gamma delta epsilon\nRead",
        "alpha beta gamma\nalpha beta beta\nbeta alpha\nx y z v\n \nHome page",
        None,
        "x y z\nRead\nalpha beta gamma delta zeta eta",
    ] + ["\n".join(f"{'abcde'[(i * k) % 5]} {'fgh'[(i + k) % 3]}" + f" w{i % 4} q" * (k % 2) for k in range(9)) for i in range(30)]
    lines, want = [], []
    for i, text in enumerate(texts):
        gone = []
        for k, w in _line_words(text):
            both = [len(set(w) & set(v)) / len(set(w) | set(v)) for v in lines] if w else []
            if any(x >= 0.8 - 1e-9 for x in both):
                gone.append(k)
            lines += [w] if w else []
        want.append((i, ",".join(map(str, gone))))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((r.doc_id, r.removed) for r in line_dedup.query(spark, str(tmp_path)).collect()) == want
