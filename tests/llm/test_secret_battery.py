"""The randomness battery against plain Python, and on planted keys and ordinary names."""

import math
import random
import re

import pytest

from roadloom.llm import secret_scan

WORDS = """user account service impl test date formatter utils release build config manager factory stream reader default
session token value index buffer event handler order payment invoice customer address report export import query result table
column metric window network socket thread worker cache storage object bucket policy access control request response parser""".split()


def _name(rng):
    """An ordinary identifier of 20 or more characters that an encoding fits."""
    while True:
        parts = [rng.choice(WORDS) for _ in range(rng.randint(3, 5))]
        style = rng.randrange(3)
        if style == 0:
            out = "".join(p.capitalize() for p in parts) + str(rng.randint(1, 99))
        elif style == 1:
            out = "-".join(p.capitalize() for p in parts) + f"-v{rng.randint(1, 9)}"
        else:
            out = "_".join(parts) + f"_V{rng.randint(1, 9)}"
        if len(out) >= 20:
            return out


def _key(rng):
    alphabet = rng.choice(["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"])
    while True:
        out = "".join(rng.choice(alphabet) for _ in range(rng.randint(24, 31)))
        if any(re.match(shape, out) for _, shape, _ in secret_scan.ENCODINGS):
            return out


def _tail(z):
    return 1 / (1 + math.exp(min(700.0, 1.5976 * z + 0.07056 * z**3)))


def _p(body):
    """The battery for one run, written from its definition; None where no encoding fits."""
    core = body.rstrip("=")
    letters = next((a for _, shape, a in secret_scan.ENCODINGS if re.match(shape, core)), None)
    if letters is None:
        return None
    kind = lambda c: "d" if c.isdigit() else "U" if c.isupper() else "v" if c in "aeiou" else "c" if c.islower() else "s"
    codes, n, k = [letters.index(c) for c in core], len(core), len(letters)
    chi = (k / n * sum(core.count(c) ** 2 for c in set(core)) - n - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    kinds, shares = [kind(c) for c in core], [kind(c) for c in letters]
    value, free = 0.0, len(set(shares)) - 1
    for c in set(shares):
        due = shares.count(c) * n / k
        value += (kinds.count(c) - due) ** 2 / due
    class_z = ((value / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    coarse = ["c" if c == "v" else c for c in kinds]
    sizes = [coarse.count(c) for c in set(coarse)]
    runs = 1 + sum(a != b for a, b in zip(coarse, coarse[1:]))
    s2, s3 = sum(x**2 for x in sizes), sum(x**3 for x in sizes)
    spread = math.sqrt(max(0.0, (s2 * (s2 + n * (n + 1)) - 2 * n * s3 - n**3) / (n**2 * (n - 1))))
    runs_z = abs(runs - 1 - (n * n - s2) / n) / spread if spread else 9.0
    mean = sum(codes) / n
    variance = sum((c - mean) ** 2 for c in codes)
    product = sum((a - mean) * (b - mean) for a, b in zip(codes, codes[1:]))
    serial = abs(product / variance + 1 / n) * math.sqrt(n) if variance else 9.0
    tails = (_tail(chi), _tail(class_z), 2 * _tail(runs_z), 2 * _tail(serial))
    logs = -sum(math.log(max(1e-12, min(1.0, t))) for t in tails)
    return math.exp(-logs) * (1 + logs + logs**2 / 2 + logs**3 / 6)


def test_battery_is_that_of_the_definition(spark):
    rng = random.Random(4)
    bodies = [_name(rng) for _ in range(60)] + [_key(rng) for _ in range(60)] + ["A1" * 12 + "b", "0a" * 15, "Zz9" * 9 + "=="]
    runs = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)] + [(999, "plainwordsonlyhereandthere")], "i int, body string")
    got = {r.i: r.p for r in secret_scan._tested(runs).select("i", "p").collect()}
    assert got.keys() == set(range(len(bodies)))
    for i, b in enumerate(bodies):
        assert got[i] == pytest.approx(_p(b), rel=1e-6, abs=1e-30)


def test_planted_keys_are_reported_and_ordinary_names_set_aside(spark):
    """Of keys at most about the stated rate is lost; of names most are told from noise."""
    rng = random.Random(11)
    keys, names = [_key(rng) for _ in range(50)], [_name(rng) for _ in range(400)]
    rows = [(i, f"see {k} here") for i, k in enumerate(keys)] + [(100 + i, f"call {n} now") for i, n in enumerate(names)]
    rows.append((900, f"password={keys[0]} and token: {names[0]}"))
    out = {r.doc_id: r for r in secret_scan.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[i].n_tested == 1 for i in range(50))
    kept = sum(out[i].n_random for i in range(50))
    alarms = sum(out[100 + i].n_random for i in range(400))
    print("kept", kept, "of 50; alarms", alarms, "of 400")
    assert kept >= 48 and alarms <= 0.15 * 400
    claimed = out[900]
    assert claimed.n_assign == 2 and claimed.n_random == 0 and claimed.n_tested == 2 and claimed.n_base_noise in (1, 2)
