r"""Secrets in texts: named patterns, and strings that a battery of randomness tests can't tell from noise.

Candidates are runs of 20 or more characters of ``[A-Za-z0-9+/_-]``, with up to
two ``=`` behind. The encoding is inferred from the characters used (hex, base32,
base36, base62, base64); a run that fits none, such as a word, a number or
a path in one case, is not tested.

Four tests ask whether the characters could be uniform noise over the inferred
alphabet: chi-squared of the single characters and of their classes (digits,
capitals, vowels, consonants, signs: with few characters to a letter, classes tell a
name from noise where letters don't), Wald-Wolfowitz runs of digits, capitals,
small letters and signs given how many there are of each, and serial correlation
of neighbours. Fisher's method joins the p-values. Structured strings are those
whose p-value is discovered by Benjamini-Hochberg within their band of lengths
(powers of two), at rate ``FALSE_RATE``: of what is set aside as ordinary, at most
that share is expected to be noise, and short strings are not judged by the power
of long ones. What is not set aside is reported as kind ``random``. Runs that a
named pattern claims are judged with the others: their spans stay whatever the
verdict, which is in ``n_base_noise``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.llm.common import whole_text, with_row_id
from roadloom.session import cut_lineage

FALSE_RATE = 0.01
GRID = 100  # p-values are rounded up to this many steps a decade

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: name, what the whole run must match, alphabet; the first that fits is taken
ENCODINGS = [
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", _DIGITS + "abcdef"),
    ("hex_upper", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", _UPPER + "234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", _DIGITS + _LOWER),
    ("base36_upper", r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$", _DIGITS + _UPPER),
    ("base62", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9a-zA-Z]+$", _UPPER + _LOWER + _DIGITS),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9a-zA-Z+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64_url", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9a-zA-Z_-]+$", _UPPER + _LOWER + _DIGITS + "-_"),
]
_VOWELS = "aeiou"
#: the class of every character an encoding may hold: digit, capital, vowel, consonant, sign
_LETTERS = _DIGITS + _UPPER + _LOWER + "+/-_"
_KINDS = "d" * 10 + "U" * 26 + "".join("v" if c in _VOWELS else "c" for c in _LOWER) + "s" * 4
ORDER = {"assign": 0, "access": 1, "hex": 2, "random": 3}
_SPANS = "array<struct<start:int,kind:int,end:int,body:string>>"


def _spans(text: Column, pattern: str, kind: int, long_enough=None) -> Column:
    """Where the pattern's leftmost matches lie: the pieces between them give the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if long_enough else found
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    parts = F.arrays_zip(gaps.alias("gap"), found.alias("body"), value.alias("value"))

    def step(state: Column, part: Column) -> Column:
        start = (state["at"] + part["gap"]).cast("int")
        end = (start + F.length(part["body"])).cast("int")
        span = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), part["body"].alias("body")))
        keep = part["body"].isNotNull()
        if long_enough:
            keep = keep & (F.length(part["value"]) >= long_enough)
        return F.struct(
            F.coalesce(end, state["at"]).alias("at"),
            F.when(keep, F.concat(state["out"], span)).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {_SPANS})").alias("out"))
    spans = F.aggregate(parts, start, step, lambda state: state["out"])
    return F.when(text.rlike(pattern), spans).otherwise(F.expr(f"cast(array() as {_SPANS})"))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal (logistic approximation, error below 0.0002)."""
    return 1 / (1 + F.exp(F.least(F.lit(700.0), 1.5976 * z + 0.07056 * F.pow(z, 3))))


def _alphabet(body: Column) -> Column:
    fits = F.lit(None).cast("string")
    for _, shape, letters in reversed(ENCODINGS):
        fits = F.when(body.rlike(shape), F.lit(letters)).otherwise(fits)
    return fits


def _tested(runs: DataFrame) -> DataFrame:
    """Adds ``p`` to rows with ``body``: the p-value of "uniform noise over the inferred alphabet".

    Rows that fit no encoding go. A column a step, so that each is computed once.
    """
    square = lambda x: x * x
    total = lambda a, of: F.aggregate(a, F.lit(0.0), lambda s, x: s + of(x))
    steps = runs.withColumn("core", F.regexp_replace("body", "=+$", "")).withColumn("letters", _alphabet(F.col("core")))
    steps = (
        steps.filter("letters IS NOT NULL")
        .withColumn("codes", F.transform(F.split("core", "", -1), lambda c: (F.position(c, F.col("letters")) - 1).cast("double")))
        .withColumn("codes", F.filter("codes", lambda c: c >= 0))
        .withColumn("n", F.size("codes").cast("double"))
        .withColumn("k", F.length("letters").cast("double"))
        .withColumn("later", F.slice("codes", F.lit(2), F.size("codes")))
        .withColumn("kinds", F.split(F.translate("core", _LETTERS, _KINDS), "", -1))
        .withColumn("kinds", F.filter("kinds", lambda c: c != ""))
        .withColumn("counts", F.transform(F.array_distinct("codes"), lambda c: F.size(F.filter("codes", lambda x: x == c)).cast("double")))
        .withColumn("mean", total("codes", lambda c: c) / F.col("n"))
    )
    n, k, mean = F.col("n"), F.col("k"), F.col("mean")
    steps = (
        steps.withColumn("squares", total("counts", square))
        .withColumn("coarse", F.transform("kinds", lambda c: F.when(c == "v", F.lit("c")).otherwise(c)))
        .withColumn("next_kind", F.slice("coarse", F.lit(2), F.size("coarse")))
        .withColumn("runs", 1 + total(F.zip_with("coarse", "next_kind", lambda a, b: F.when(b.isNotNull() & (a != b), 1.0).otherwise(0.0)), lambda x: x))
        .withColumn("sizes", F.transform(F.array_distinct("coarse"), lambda c: F.size(F.filter("coarse", lambda x: x == c)).cast("double")))
        .withColumn("s2", total("sizes", square))
        .withColumn("s3", total("sizes", lambda x: x * x * x))
        .withColumn("shares", F.split(F.translate("letters", _LETTERS, _KINDS), "", -1))
        .withColumn("cells", F.transform(F.array_distinct(F.filter("shares", lambda c: c != "")), lambda c: F.struct(
            F.size(F.filter("kinds", lambda x: x == c)).cast("double").alias("seen"),
            (F.size(F.filter("shares", lambda x: x == c)) * n / k).alias("due"))))
        .withColumn("variance", total("codes", lambda c: square(c - mean)))
        .withColumn("product", total(F.zip_with("codes", "later", lambda a, b: F.coalesce((a - mean) * (b - mean), F.lit(0.0))), lambda x: x))
        .withColumn("expected", 1 + (n * n - F.col("s2")) / n)
        .withColumn("spread", F.sqrt(F.greatest(
            F.lit(0.0), (F.col("s2") * (F.col("s2") + n * (n + 1)) - 2 * n * F.col("s3") - n * n * n) / (n * n * (n - 1)))))
        .withColumn("free", F.size("cells") - F.lit(1.0))
        .withColumn("class_chi", total("cells", lambda c: square(c["seen"] - c["due"]) / c["due"]))
    )
    chi = (k / n * F.col("squares") - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    # Wilson and Hilferty: the cube root of a chi-squared value over its degrees of freedom is nearly normal
    class_z = (F.pow(F.col("class_chi") / F.col("free"), F.lit(1 / 3)) - (1 - 2 / (9 * F.col("free")))) / F.sqrt(2 / (9 * F.col("free")))
    runs_z = F.when(F.col("spread") > 0, F.abs(F.col("runs") - F.col("expected")) / F.col("spread")).otherwise(F.lit(9.0))
    serial = F.when(F.col("variance") > 0, F.abs(F.col("product") / F.col("variance") + 1 / n) * F.sqrt(n)).otherwise(F.lit(9.0))
    tail = lambda p: F.log(F.greatest(F.lit(1e-12), F.least(F.lit(1.0), p)))
    logs = F.col("logs")
    return (
        steps.withColumn("logs", -(tail(_upper_tail(chi)) + tail(_upper_tail(class_z)) + tail(2 * _upper_tail(runs_z)) + tail(2 * _upper_tail(serial))))
        .withColumn("p", F.exp(-logs) * (1 + logs + logs * logs / 2 + logs * logs * logs / 6))
    )


def _candidates(scanned: DataFrame) -> DataFrame:
    """``rid__, start, end, claimed, band, grid``: tested runs with their length band and p-value on the grid.

    ``claimed`` says that a named pattern has a part of the run.
    """
    judged = F.transform("runs", lambda r: F.struct(
        r["start"].alias("start"), r["end"].alias("end"), r["body"].alias("body"),
        F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])).alias("claimed")))
    runs = scanned.select("rid__", F.explode(judged).alias("r")).select("rid__", "r.*")
    return _tested(runs).select(
        "rid__",
        "start",
        "end",
        "claimed",
        F.floor(F.log2("n")).cast("int").alias("band"),
        F.floor(-F.log10(F.greatest(F.lit(1e-30), "p")) * GRID).cast("int").alias("grid"),
    )


def _set_aside(candidates: DataFrame) -> dict[int, int]:
    """Per band the smallest grid value that Benjamini-Hochberg discovers; at most 31 bands."""
    counts = candidates.groupBy("band", "grid").agg(F.count("*").alias("n"))
    # cumulative counts per band: the grid has at most 30 * GRID values, whatever the number of candidates
    totals = counts.groupBy("band").agg(F.sum("n").alias("m"), F.collect_list(F.struct("grid", "n")).alias("steps"))
    ranked = totals.select("band", "m", F.explode("steps").alias("s"), "steps").select(
        "band", "m", "s.grid", F.aggregate("steps", F.lit(0).cast("long"), lambda a, x: a + F.when(x["grid"] >= F.col("s.grid"), x["n"]).otherwise(0)).alias("rank")
    )
    hit = F.pow(F.lit(10.0), -F.col("grid") / GRID) <= FALSE_RATE * F.col("rank") / F.col("m")
    return {r["band"]: r["least"] for r in ranked.filter(hit).groupBy("band").agg(F.min("grid").alias("least")).collect()}


def _listed(spans: Column) -> Column:
    kinds = F.create_map(*[F.lit(x) for name, i in ORDER.items() for x in (i, name)])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random, n_tested, n_base_noise`` for every row.

    A span is a whole match, in code points, its end exclusive. A null text is
    empty and has no spans (the digest is then that of the empty string); a null
    id stays null; repeated rows are scanned each by itself.
    """
    text = whole_text()
    base = F.array_sort(F.concat(_spans(text, ASSIGN, 0, long_enough=8), _spans(text, ACCESS, 1), _spans(text, HEX, 2)))
    scanned = cut_lineage(
        with_row_id(docs.select("doc_id", "text")).select("rid__", "doc_id", base.alias("base"), _spans(text, RUN, 3).alias("runs"))
    )
    candidates = cut_lineage(_candidates(scanned))
    ordinary = _set_aside(candidates)
    least = F.lit(1 << 30)
    for band, grid in ordinary.items():  # at most 31
        least = F.when(F.col("band") == band, F.lit(grid)).otherwise(least)
    is_noise = F.col("grid") < least
    noise = candidates.groupBy("rid__").agg(
        F.collect_list(F.when(is_noise & ~F.col("claimed"), F.struct("start", F.lit(3).alias("kind"), "end"))).alias("random"),
        F.count("*").alias("n_tested"),
        F.count(F.when(is_noise & F.col("claimed"), 1)).alias("n_base_noise"),
    )
    spans = lambda a: F.transform(a, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    found = scanned.select("rid__", "doc_id", spans("base").alias("base")).join(noise, "rid__", "left").withColumn("random", F.coalesce("random", none))
    count = lambda kind: F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "random"))).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_tested", "n_base_noise")],
    )


def query(spark, sf_dir: str) -> DataFrame:
    return secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
