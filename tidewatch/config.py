"""Brand dictionary and detection settings (plain driver-side configuration)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from pathlib import Path

import yaml


@dataclass(frozen=True)
class Brand:
    """A monitored brand. ``communities`` is carried along but never filters anything."""

    name: str
    keywords: tuple[str, ...]
    communities: tuple[str, ...] = ("all",)


@dataclass(frozen=True)
class Thresholds:
    """Detector settings; also what a brand may override."""

    # The defaults.
    alpha: float = 0.3
    spike_k: float = 3.0
    min_volume: int = 25
    min_neg_ratio: float = 0.45
    cooldown_seconds: int = 15 * 60


@dataclass(frozen=True)
class Detection:
    """Window geometry, lateness and thresholds of one monitor."""

    window_seconds: int = 5 * 60
    slide_seconds: int = 60
    lateness_seconds: int = 30
    thresholds: Thresholds = field(default_factory=Thresholds)
    per_brand: Mapping[str, Thresholds] = field(default_factory=dict)

    @property
    def lateness(self) -> str:
        return f"{self.lateness_seconds} seconds"


# The setting names used in detection files and what one unit is worth here.
_WINDOW_KEYS = {
    "window_size_minutes": ("window_seconds", 60),
    "window_slide_minutes": ("slide_seconds", 60),
    "out_of_orderness_seconds": ("lateness_seconds", 1),
}
_THRESHOLD_KEYS = {
    "ewma_alpha": ("alpha", float),
    "spike_k": ("spike_k", float),
    "min_volume": ("min_volume", int),
    "neg_ratio_threshold": ("min_neg_ratio", float),
    "cooldown_minutes": ("cooldown_seconds", lambda minutes: int(minutes) * 60),
}


def _thresholds(settings: Mapping | None, base: Thresholds) -> Thresholds:
    known = {
        name: convert(settings[key])
        for key, (name, convert) in _THRESHOLD_KEYS.items()
        if settings and settings.get(key) is not None
    }
    return replace(base, **known)


def detection_from_mapping(document: Mapping | None) -> Detection:
    """Settings from a parsed document; what it leaves out keeps its default."""
    section = (document or {}).get("detection") or {}
    defaults = section.get("defaults") or {}
    base = _thresholds(defaults, Thresholds())
    geometry = {
        name: int(defaults[key]) * unit
        for key, (name, unit) in _WINDOW_KEYS.items()
        if defaults.get(key) is not None
    }
    overrides = {
        str(brand): _thresholds(values, base)
        for brand, values in (section.get("per_brand") or {}).items()
    }
    return Detection(thresholds=base, per_brand=overrides, **geometry)


def load_detection(paths: Iterable[str | Path]) -> Detection:
    """Settings from the first of ``paths`` that exists, or the defaults if none does."""
    for path in map(Path, paths):
        if path.exists():
            return detection_from_mapping(yaml.safe_load(path.read_text(encoding="utf-8")))
    return Detection()


def load_brands(path: str | Path) -> list[Brand]:
    """The brand dictionary, in file order (the order decides ties between brands)."""
    document = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    return [brand_from_mapping(entry) for entry in document.get("brands") or []]


def brand_from_mapping(entry: Mapping) -> Brand:
    keywords: Sequence[str] = entry.get("keywords") or []
    communities: Sequence[str] = entry.get("subreddits", ["all"])
    return Brand(str(entry["name"]), tuple(str(k).lower() for k in keywords), tuple(communities))


