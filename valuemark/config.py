"""Typed settings of the provider-value engine; overrides come as (key, text) pairs."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping

TRUTHY = {"true", "t", "yes", "y", "1"}


@dataclasses.dataclass(frozen=True)
class Settings:
    # The defaults that published results rest on.
    counties: tuple[str, ...] = ("New York", "Manhattan", "Kings", "Queens", "Bronx", "Richmond")
    service_area: str = "New York City"
    procedure_codes: tuple[int, ...] = (324, 326)
    hip_code: int = 324
    knee_code: int = 326
    apr_codes: tuple[str, ...] = ("324", "326")
    apr_legacy_codes: tuple[str, ...] = ("301", "302")
    ms_code: str = "470"
    procedure_of_code: tuple[tuple[int, str], ...] = ((324, "hip"), (301, "hip"), (326, "knee"), (302, "knee"))
    elective_only: bool = True
    exclude_extreme_risk: bool = True
    benchmark_scope: str = "statewide"
    oe_metric: str = "composite"
    min_volume: int = 10
    weight_clinical: float = 2.0
    weight_financial: float = 1.0
    weight_experience: float = 1.0
    los_censor: int = 120
    match_cutoff: float = 60.0
    auto_accept: float = 95.0
    measure_match_cutoff: float = 82.0

    @property
    def procedure_floor(self) -> int:
        return max(self.min_volume // 2, 5)


def words(text: str | None) -> tuple[str, ...]:
    """A comma list, trimmed, blanks dropped."""
    return tuple(p.strip() for p in (text or "").split(",") if p.strip())


def settings_from(pairs: Mapping[str, str]) -> Settings:
    """Settings with text values read by the type of the field they replace; unknown keys are an error."""
    fields = {f.name: f.type for f in dataclasses.fields(Settings)}
    if unknown := set(pairs) - set(fields):
        raise KeyError(f"unknown settings: {sorted(unknown)}")
    read = {
        "bool": lambda v: v.strip().lower() in TRUTHY,
        "int": lambda v: int(float(v)),
        "float": float,
        "str": str.strip,
        "tuple[int, ...]": lambda v: tuple(int(x) for x in words(v)),
        "tuple[str, ...]": words,
    }
    return Settings(**{k: read[fields[k]](v) for k, v in pairs.items()})


def resolve_releases(years: str | None, known: Mapping[int, str], explicit: str | None = None) -> dict[str, str]:
    """Release label -> dataset for configured years; an explicit dataset overrides, an unknown year is an error."""
    if explicit:
        return {"explicit": explicit}
    wanted = [int(y) for y in words(years)] if years else sorted(known)
    if missing := [y for y in wanted if y not in known]:
        raise ValueError(f"no dataset is known for {missing}; known years: {sorted(known)}")
    return {str(y): known[y] for y in wanted}
