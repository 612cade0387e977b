"""The Merkle manifest against a tree built in plain Python."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from roadloom.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(doc_id, text, lang, source, n_chars) -> str:
    return digest(*map(field, (doc_id, source, lang, n_chars, text)))


def grown(digests: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and each leaf's siblings left and right of it, level by level."""
    steps, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for k, place in enumerate(at):
            lo = place - place % 3
            steps[k].append(("".join(level[lo:place]), "".join(level[place + 1 : lo + 3])))
        level = [digest(*level[i : i + 3]) for i in range(0, len(level), 3)]
        at = [place // 3 for place in at]
    return level[0], steps


def expected(rows: list[tuple], changed) -> list[tuple]:
    trees: dict = {}
    for row in rows:
        trees.setdefault(row[3], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = []
    for source in order:
        inside = sorted(trees[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        built.append((inside, *grown([leaf(*r) for r in inside])))
    if not built:
        return []
    root, above = grown([b[1] for b in built])
    out = []
    for (inside, subroot, steps), upper in zip(built, above):
        for row, own in zip(inside, steps):
            folded = leaf(row[0], changed(row), *row[2:])
            for left, right in own + upper:
                folded = digest(left, folded, right)
            proof = digest(*(left + right for left, right in own + upper))
            out.append((row[0], leaf(*row), subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def made(n_of: dict, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for source, n in n_of.items():
        for _ in range(n):
            rows.append((len(rows) * 7 % 1009, "a\nb" * rng.randint(0, 3) + "é", rng.choice(["en", None]), source, rng.choice([None, 5])))
    rng.shuffle(rows)
    return rows


def drop_lines(row):
    return row[1].replace("\n", "") if row[1] is not None and zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 2 == 0 else row[1]


def changed():
    """The same as a column."""
    even = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


@pytest.mark.parametrize("n_of", [{"a": 1}, {"a": 300, None: 1, "b": 2, "é": 3, "z": 82, "y": 81, "": 4}, {f"s{k}": 1 + k % 3 for k in range(90)}])
def test_manifest_equals_a_tree_in_python(spark, n_of):
    rows = made(n_of)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    got = sorted(map(tuple, merkle.manifest(docs, changed()).collect()), key=str)
    assert got == expected(rows, drop_lines)


def test_only_changed_texts_fail(spark):
    rows = made({"a": 40, "b": 9})
    docs = spark.createDataFrame(rows, DOCS)
    assert merkle.manifest(docs).filter("NOT verified").count() == 0
    wrong = merkle.manifest(docs, F.when(F.col("doc_id") == rows[3][0], F.lit("x")).otherwise(F.col("text"))).filter("NOT verified")
    assert [r[0] for r in wrong.select("doc_id").collect()] == [rows[3][0]]


def test_awkward_rows(spark, awkward, empty):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in awkward.collect()]
    clashing = awkward.withColumn("leaf", F.lit("x")).withColumn("tree", F.lit(1)).withColumn("lo", F.lit(2)).withColumn("root", F.lit(None))
    assert sorted(map(tuple, merkle.manifest(clashing, changed()).collect()), key=str) == expected(rows, drop_lines)
    assert merkle.manifest(empty).collect() == []
    assert merkle.manifest(empty).columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
