"""Rules for the MinHash, the bands and the clusters.

Those that look at counts are suggestions (see ``recommend.size_up``): the plans
take their parameters from the caller, whatever the number of routes.
"""

from __future__ import annotations

import math

# Fixed values: (upper bound of a count, setting below it); the last entry has no bound.
THRESHOLD_BY_PAIRS = (
    (100_000_001, 0.0),  # up to 100,000,000 pairs
    (500_000_000, 0.1),
    (1_000_000_000, 0.2),
    (10_000_000_000, 0.4),
    (math.inf, 0.9),
)
# Vocabulary tiers: below the bound, divide the vocabulary by the second value ...
SIZE_BY_SMALL_VOCABULARY = ((125, 1), (500, 2), (1_000, 4))
# ... or use a fixed signature length.
SIZE_BY_LARGE_VOCABULARY = ((10_000, 300), (100_000, 420), (math.inf, 510))
MAX_DENSE_SHINGLES = 100_000_000


def _divisor_count(n: int) -> int:
    return sum(1 for d in range(1, n + 1) if n % d == 0)


def most_divisible_near(n: int) -> int:
    """Number in [n - 14, n + 15] with the most divisors, the larger one on ties."""
    return max(range(max(1, n - 14), n + 16), key=lambda m: (_divisor_count(m), m))


def signature_size(vocabulary: int) -> int:
    """Number of hash functions for a vocabulary, rounded up to an even number."""
    size = next((s for bound, s in SIZE_BY_LARGE_VOCABULARY if vocabulary < bound))
    for bound, divisor in SIZE_BY_SMALL_VOCABULARY:
        if vocabulary < bound:
            size = most_divisible_near(vocabulary // divisor)
            break
    return size + size % 2


def lsh_threshold(left_rows: int, right_rows: int) -> float:
    """Suggested threshold: the more pairs, the stricter."""
    pairs = left_rows * right_rows
    return next(t for bound, t in THRESHOLD_BY_PAIRS if pairs < bound)


def share_threshold(bands: int, rows: int) -> float:
    """Similarity at which a pair becomes a likely candidate."""
    return (1 / bands) ** (1 / rows)


def bands_and_rows(columns: int, threshold: float) -> tuple[int, int]:
    """Divisor split of the signature whose threshold is nearest from either side."""
    splits = [(b, columns // b) for b in range(1, columns + 1) if columns % b == 0]
    reached = next((i for i, s in enumerate(splits) if share_threshold(*s) <= threshold), None)
    if reached is None:
        return columns, 1
    if reached == 0:
        return splits[0]
    around = splits[reached - 1 : reached + 1]
    gaps = [abs(share_threshold(*s) - threshold) for s in around]
    return around[0] if gaps[0] < gaps[1] else around[1]


def usable_k(k: int, shortest_route: int, distinct_shingles: int, routes: int) -> int:
    """Suggested shingle length: pairs of cities when routes are too short or the vocabulary too large."""
    return 2 if shortest_route < 2 or distinct_shingles * routes > MAX_DENSE_SHINGLES else k


def forward_expansion(actual_rows: int, standard_rows: int) -> int:
    return actual_rows // standard_rows


def cluster_bounds(expansion: int) -> tuple[int, int]:
    """Minimum and maximum cluster size for the recommendation."""
    return max(2, expansion // 3), max(2, expansion)
