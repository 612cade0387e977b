"""MinHash signatures and their comparison."""

from __future__ import annotations

import random

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadloom.functions.shape import stable_hash

# Fixed value: the Mersenne prime 2^31 - 1 keeps a*x + b inside a signed 64-bit integer.
MODULUS = 2_147_483_647


def hash_family(size: int, seed: int = 17) -> list[tuple[int, int]]:
    """``size`` reproducible pairs (a, b) of the family x -> (a*x + b) mod MODULUS, a > 0."""
    rng = random.Random(seed)
    return [(rng.randrange(1, MODULUS), rng.randrange(MODULUS)) for _ in range(size)]


def set_tokens(shingles: str | Column) -> Column:
    """Set members as integers below MODULUS."""
    return F.transform(shingles, lambda s: stable_hash(s) % F.lit(MODULUS))


def unit_tokens(merch: str | Column) -> Column:
    """One token per carried unit: the Jaccard index of these sets is the weighted Jaccard."""
    return F.flatten(
        F.transform(
            F.filter(F.map_entries(merch), lambda e: e["value"] > 0),
            lambda e: F.transform(
                F.sequence(F.lit(1).cast("bigint"), e["value"]),
                lambda j: stable_hash(F.concat_ws("#", e["key"], j.cast("string")))
                % F.lit(MODULUS),
            ),
        )
    )


def signature(tokens: str, size: int, seed: int = 17) -> Column:
    """MinHash signature of an array column, or an empty array for an empty set.

    One SQL text, because building hundreds of literals one call at a time is slow.
    """
    family = ", ".join(f"struct({a}L AS a, {b}L AS b)" for a, b in hash_family(size, seed))
    return F.expr(
        f"""CASE WHEN size({tokens}) > 0 THEN
            transform(array({family}),
                p -> array_min(transform({tokens}, x -> (p.a * x + p.b) % {MODULUS}L)))
            ELSE cast(array() AS array<bigint>) END"""
    )


def sampling_parameters(item: str, position: str) -> Column:
    """What consistent weighted sampling draws per (item, position): ``r, c`` ~ Gamma(2, 1) and ``beta`` in (0, 1).

    Five numbers of 24 bits each from one md5; a Gamma(2, 1) is the negative
    logarithm of a product of two of them.
    """
    digest = F.md5(F.concat_ws("#", F.lit("w"), F.col(item), F.col(position).cast("string")))

    def uniform(i: int) -> Column:
        return (F.conv(F.substring(digest, 6 * i + 1, 6), 16, 10).cast("double") + 0.5) / float(1 << 24)

    return F.struct(
        (-F.log(uniform(0) * uniform(1))).alias("r"),
        (-F.log(uniform(2) * uniform(3))).alias("c"),
        uniform(4).alias("beta"),
    )


def weighted_sample(weight: str, r: Column, c: Column, beta: Column) -> Column:
    """Level ``t`` and rank ``a`` of one item at one position; per position the item of least rank is the sample.

    Two loads draw the same (item, level) with the probability of their weighted
    Jaccard. The work does not depend on the weight, which may be fractional.
    """
    t = F.floor(F.log(F.col(weight).cast("double")) / r + beta)
    return F.struct((F.log(c) - r * (t - beta + 1)).alias("a"), t.alias("t"))


def matching_share(left: str, right: str, size: int) -> Column:
    """MinHash estimate of the Jaccard index: share of equal positions."""
    equal = F.filter(F.zip_with(left, right, lambda x, y: x == y), lambda z: z)
    return F.size(equal) / F.lit(size)


def signature_ruzicka(left: str, right: str) -> Column:
    """Sum of minima over sum of maxima of the signature values; 0 for empty signatures."""
    zero = F.lit(0).cast("bigint")
    low = F.aggregate(F.zip_with(left, right, lambda x, y: F.least(x, y)), zero, lambda acc, x: acc + x)
    high = F.aggregate(F.zip_with(left, right, lambda x, y: F.greatest(x, y)), zero, lambda acc, x: acc + x)
    return F.when(
        (F.size(left) > 0) & (F.size(right) > 0), F.coalesce(F.try_divide(low, high), F.lit(0.0))
    ).otherwise(F.lit(0.0))


def band_keys(sig: str, bands: int, rows: int) -> Column:
    """One 64-bit key per band, its number hashed in; none for an empty signature."""
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda i: F.xxhash64(i, F.slice(F.col(sig), i * rows + 1, F.lit(rows))),
    )
    return F.when(F.size(sig) > 0, keys).otherwise(F.array().cast("array<bigint>"))
