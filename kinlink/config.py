"""Constants and their overrides from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Config:
    # Defaults that results depend on.
    bm25_k1: float = 1.5
    bm25_b: float = 0.75
    bm25_epsilon: float = 0.25
    ngram: int = 3
    self_score_floor: float = 1e-9
    rrf_k_name: int = 60
    rrf_k_addr: int = 60
    rrf_k_vector: int = 60
    k_base: int = 20
    max_seen: int = 90
    min_cycles: int = 3
    null_name: str = "nullname"
    null_addr: str = "nulladdr"
    threshold_start: float = 0.50
    threshold_end: float = 0.99
    threshold_step: float = 0.01
    beta: float = 0.5
    folds: int = 5
    encoder_folds: int = 5
    seed: int = 42
    trials: int = 100
    trial_seconds: int = 3600
    negative_ratio: float = 1.0
    scale_pos_weight: float = -1.0

    @property
    def max_rank(self) -> int:
        """The deepest rank a cycle can ask for: a cycle starts below max_seen and asks for k_base more."""
        return self.k_base + self.max_seen - 1

    @classmethod
    def from_env(cls, prefix: str = "KINLINK_", **given) -> Config:
        """Environment values by upper-case name, falling back where absent or malformed; given ones win."""
        out = {}
        for f in fields(cls):
            text = os.environ.get(prefix + f.name.upper())
            if text is not None:
                try:
                    out[f.name] = type(getattr(cls, f.name))(text)
                except ValueError:
                    continue
        return replace(cls(**out), **given)
