"""Settings of the linkage engine."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    """Defaults are fixed values that results depend on."""

    seed: int = 42
    sample: float = 1.0
    n_folds: int = 5
    stage2_folds: int = 3
    holdout_country: str | None = None
    blocker: str = "tfidf"  # tfidf, lsh or both
    ngrams: tuple[int, ...] = (3, 4)
    k_name: int = 15
    k_full: int = 10
    threshold: float = 0.15
    key_cap: int = 100
    lsh_bands: int = 12
    lsh_rows: int = 4
    lsh_cap: int = 200
    k_lsh: int = 20
    use_dense: bool = False
    k_dense: int = 10
    prune_recall: float = 0.995
    eps_floor: float = 0.005
    eps_ceiling: float = 0.5
    kmax: int = 10
    neg_rate: float = 0.3
    hard_assign: bool | None = None
    country_block: bool | None = None
    beta: float = 0.5
    temperatures: tuple[float, ...] = (0.7, 0.85, 1.0, 1.2, 1.5)
    scales: tuple[float, ...] = (0.7, 0.85, 1.0, 1.15, 1.3)
    thresholds: tuple[float, ...] = (0.4, 0.5, 0.6, 0.7, 0.8)
    mined_min_count: int = 5
    drop_groups: tuple[str, ...] = ()
    rounds: int = 30
    depth: int = 5
