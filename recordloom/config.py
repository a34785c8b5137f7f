"""Settings of both generations, with files and dotted overrides that take effect."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any


@dataclass
class LegacyBlocking:
    enabled: tuple[str, ...] = ("exact_name", "token_name", "tfidf_name", "address_token", "country_aware")
    exact_name_max_per_s1: int = 200
    token_name_min_score: float = 0.30
    token_name_max_per_s1: int = 150
    tfidf_name_ngram_min: int = 2
    tfidf_name_ngram_max: int = 5
    tfidf_name_top_k: int = 40
    tfidf_name_min_score: float = 0.20
    address_token_min_score: float = 0.35
    address_token_max_per_s1: int = 100
    country_aware_top_k: int = 15
    country_aware_min_score: float = 0.25
    country_aware_min_pool_size: int = 5
    country_aware_fallback_top_k: int = 20
    max_candidates_per_s1: int | None = 400
    min_candidates_per_s1: int = 5


@dataclass
class Scale:
    token_min_length: int = 2
    min_df: int = 2
    max_df: int = 5000
    exact_block_cap: int = 1000
    sn_prefix_bytes: int = 6
    sn_window: int = 50
    sn_min_ratio: float = 0.55
    posting_budget_name: int = 3000
    posting_budget_address: int = 1500
    max_terms_per_query: int = 3
    max_candidates_per_s1: int = 100
    min_candidates_per_s1: int = 3
    country_top_k: int = 50


@dataclass
class Models:
    candidates: tuple[str, ...] = ("logistic_regression", "random_forest", "gradient_boosting")
    seed: int = 42
    n_splits: int = 4
    max_iter: int = 100
    trees: int = 60
    depth: int = 8
    boosting_rounds: int = 30


@dataclass
class Thresholds:
    grid_start: float = 0.01
    grid_stop: float = 0.99
    grid_step: float = 0.01
    use_score_breakpoints: bool = True
    max_breakpoints: int = 400
    min_macro_precision: float = 0.0


@dataclass
class Config:
    legacy: LegacyBlocking = field(default_factory=LegacyBlocking)
    scale: Scale = field(default_factory=Scale)
    models: Models = field(default_factory=Models)
    thresholds: Thresholds = field(default_factory=Thresholds)

    def to_dict(self) -> dict[str, Any]:
        return dataclasses.asdict(self)

    def dump(self, path: str | Path) -> None:
        Path(path).write_text(json.dumps(self.to_dict(), indent=2, sort_keys=True))

    @classmethod
    def load(cls, path: str | Path | None = None, overrides: dict[str, Any] | None = None) -> Config:
        """Defaults, then a JSON file, then overrides such as {"scale.max_df": 100}. Unknown keys are errors."""
        out = cls()
        for section, values in (json.loads(Path(path).read_text()) if path else {}).items():
            for key, value in values.items():
                out.set(f"{section}.{key}", value)
        for key, value in (overrides or {}).items():
            out.set(key, value)
        return out

    def set(self, dotted: str, value: Any) -> None:
        section, _, key = dotted.partition(".")
        part = getattr(self, section, None)
        if part is None or not hasattr(part, key):
            raise KeyError(dotted)
        now = getattr(part, key)
        if isinstance(now, tuple) and isinstance(value, (list, tuple, str)):
            value = tuple(value.split(",")) if isinstance(value, str) else tuple(value)
        elif isinstance(value, str) and isinstance(now, bool):
            value = value.lower() in ("1", "true", "yes")
        elif isinstance(value, str) and isinstance(now, (int, float)):
            value = type(now)(value)
        setattr(part, key, value)
