"""Policy as data: rules, quality contract and ensemble, with defaults that a TOML or YAML file overrides."""

from __future__ import annotations

import dataclasses
import tomllib
from dataclasses import dataclass, field
from pathlib import Path

SEVERITIES = ("HIGH", "MEDIUM")


@dataclass(frozen=True)
class RulesConfig:
    # Thresholds, windows, severities and weights of the six rules.
    high_amount_usd: int = 10000
    structuring_min_usd: int = 8000
    structuring_max_usd: int = 9999
    structuring_count: int = 3
    structuring_seconds: int = 3600
    travel_seconds: int = 1800
    mule_seconds: int = 1800
    mule_ratio: str = "0.85"
    mule_min_deposit_usd: int = 3000
    velocity_count: int = 6
    velocity_seconds: int = 300
    new_device_usd: int = 4000
    new_device_seconds: int = 2592000
    home_country: str = "Egypt"
    far_countries: tuple[str, ...] = ("USA", "Canada", "Australia", "UK", "Germany", "France", "Italy", "Spain")
    severity: dict[str, str] = field(default_factory=lambda: {"HIGH_AMOUNT": "HIGH", "STRUCTURING": "HIGH", "IMPOSSIBLE_TRAVEL": "HIGH", "MULE": "HIGH", "VELOCITY": "MEDIUM", "NEW_DEVICE_HIGH_VALUE": "MEDIUM"})
    weights: dict[str, int] = field(default_factory=lambda: {"HIGH": 45, "MEDIUM": 20})

    def __post_init__(self) -> None:
        known = {"HIGH_AMOUNT", "STRUCTURING", "IMPOSSIBLE_TRAVEL", "MULE", "VELOCITY", "NEW_DEVICE_HIGH_VALUE"}
        if set(self.severity) != known:
            raise ValueError(f"rules must be exactly {sorted(known)}, got {sorted(self.severity)}")
        if bad := [x for x in self.severity.values() if x not in SEVERITIES]:
            raise ValueError(f"unknown severity: {bad}")


@dataclass(frozen=True)
class QualityContract:
    not_null: tuple[str, ...] = ("transaction_id", "client_id", "event_time", "currency", "country_src")
    #: (column, least value, whether that value itself is out)
    bounded: tuple[tuple[str, float, bool], ...] = (("amount_usd", 0, False),)

    def __post_init__(self) -> None:
        if not self.not_null and not self.bounded:
            raise ValueError("the quality contract has no expectations")


@dataclass(frozen=True)
class EnsembleConfig:
    members: tuple[str, ...] = ("logistic_regression", "random_forest", "gbt")
    min_auc: float = 0.65
    threshold: float = 0.70


def _document(path: str | Path) -> dict:
    path = Path(path)
    if path.suffix in (".yml", ".yaml"):
        import yaml

        return yaml.safe_load(path.read_text()) or {}
    return tomllib.loads(path.read_text())


def _fill(kind: type, values: dict):
    names = {f.name for f in dataclasses.fields(kind)}
    if unknown := set(values) - names:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    frozen = {k: tuple(tuple(x) if isinstance(x, list) else x for x in v) if isinstance(v, list) else v for k, v in values.items()}
    return kind(**frozen)


def load_rules(path: str | Path | None = None) -> RulesConfig:
    """Defaults, or a file with a ``rules`` table that overrides some of them."""
    return RulesConfig() if path is None else _fill(RulesConfig, _document(path).get("rules", {}))


def load_contract(path: str | Path | None = None) -> QualityContract:
    """Defaults, or a file with a ``quality`` table, which then is the whole contract."""
    if path is None:
        return QualityContract()
    held = _document(path).get("quality", {})
    return _fill(QualityContract, {"not_null": [], "bounded": []} | held)


def load_ensemble(path: str | Path | None = None) -> EnsembleConfig:
    return EnsembleConfig() if path is None else _fill(EnsembleConfig, _document(path).get("ensemble", {}))
