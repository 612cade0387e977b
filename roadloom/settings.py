"""Parameters shared by the plans, with the defaults and checks users know."""

from __future__ import annotations

from dataclasses import dataclass

METRICS = ("jaccard", "cosine", "L2")
FUSIONS = ("mean", "product", "weighted product")


@dataclass(frozen=True)
class Settings:
    """k: shingle length; metric: merchandise measure; fusion and alpha: how both parts mix."""

    k: int = 3
    metric: str = "jaccard"
    fusion: str = "mean"
    alpha: float = 0.5

    def __post_init__(self) -> None:
        if self.k < 2:
            raise ValueError("k must be at least 2")
        if not 0 <= self.alpha <= 1:
            raise ValueError("alpha must lie between 0 and 1")
        if self.metric not in METRICS:
            raise ValueError(f"metric must be one of {METRICS}")
        if self.fusion not in FUSIONS:
            raise ValueError(f"fusion must be one of {FUSIONS}")
