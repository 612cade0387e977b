import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, keep_id string, place int"


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls everywhere, empty, blank and very long texts, ties, repeated rows, columns with clashing names."""
    long_text = words(1, 30_000)
    base = words(2, 120)
    rows = [
        (1, base, "en", "a"), (2, base.upper(), "en", "a"), (3, base + " more", None, "b"), (4, base.replace(" ", " \n\t", 3), "en", None),
        (1, base, "en", "a"), (None, base, "en", "a"), (None, None, None, None), (7, "", "en", "a"), (8, None, "de", "b"),
        (9, " \n\t ", "en", "a"), (10, "one", "en", "a"), (11, long_text, "en", "a"), (12, long_text, "en", "b"), (13, words(3, 40), "fr", "b"),
        (14, "é ß Σ 日本 \x1c x y <|endoftext|> don't 3.14", "fr", "b"), (7, "", "en", "a"),
        (15, "a\nb\n" + words(4, 12) + "\n" + words(4, 12) + "\n\n" + words(4, 12) + " z", "en", "a"),
    ]
    return spark.createDataFrame([(*r, len(r[1] or ""), 0.5, "x", "y", 3) for r in rows], DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def corpus(spark):
    """Texts with exact and near copies."""
    rng = random.Random(5)
    rows = []
    for i in range(120):
        text = words(100 + i, rng.randint(20, 90))
        rows.append((len(rows), text))
        for _ in range(rng.choice([0, 0, 0, 1, 3])):
            near = text.split()
            if rng.random() < 0.6:
                near[rng.randrange(len(near))] = "zz"
            rows.append((len(rows), ("\n" if rng.random() < 0.3 else " ").join(near)))
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t), 0.5, "x", "y", 3) for i, t in rows], DOCS)
