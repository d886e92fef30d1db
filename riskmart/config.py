"""Project settings, read once from YAML into a frozen object."""

from __future__ import annotations

from dataclasses import dataclass, field

# Default split fractions and seed.
DEFAULT_SPLITS = {"train": 0.40, "validation": 0.10, "test": 0.10, "production": 0.40}
DEFAULT_SEED = 42


@dataclass(frozen=True)
class Settings:
    project: str = "riskmart"
    root: str = ""
    database: str = "riskmart"
    feature_table: str = "encounter_features"
    seed: int = DEFAULT_SEED
    splits: dict[str, float] = field(default_factory=lambda: dict(DEFAULT_SPLITS))

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *(p.strip("/") for p in parts)])


def load_settings(path: str) -> Settings:
    import yaml

    with open(path) as handle:
        raw = yaml.safe_load(handle) or {}
    known = {k: raw[k] for k in Settings.__dataclass_fields__ if k in raw}
    return Settings(**known)
