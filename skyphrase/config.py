"""Region configuration: fixed domains, YAML loading and strict checks."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, fields
from pathlib import Path

RESOURCES = Path(__file__).parent / "resources"

# The closed sets of labels.
PHASES = ["ground", "tower", "approach", "center", "ramp"]
TOWERED = ["ground", "tower", "approach", "center"]
TIMES = ["day", "night", "dawn", "dusk"]
DENSITIES = ["light", "moderate", "heavy"]
CLASSES = ["commercial", "cargo", "ga", "business", "military", "training", "rotorcraft", "medevac"]
REGIONS = ["us", "canada", "uk", "europe_west", "europe_east", "asia_east", "asia_se", "oceanic", "me", "lat_am", "africa", "other"]
EVENTS = [
    "routine", "go_around", "missed_approach", "runway_change", "hold", "traffic_advisory", "weather_deviation", "pirep", "equipment_issue",
    "navigation_issue", "emergency_medical", "emergency_mechanical", "emergency_fuel", "emergency_bird_strike", "emergency_fire",
    "emergency_pressurization", "emergency_hydraulic", "emergency_electrical", "emergency_flight_control", "nordo", "minimum_fuel_advisory",
    "diversion", "priority_handling",
]
CONDITIONS = ["VMC", "IMC"]
WAKES = {"L": "light", "M": "medium", "H": "heavy", "J": "super"}
RESERVED_SQUAWKS = ["7500", "7600", "7700"]
LIMITS = {"wind_dir_deg": (0, 360), "wind_kt": (0, 80), "vis_sm": (0, 10), "ceiling_ft": (0, 50000), "altimeter_inhg": (28.0, 31.5)}


class ConfigNotFound(FileNotFoundError):
    pass


@dataclass(frozen=True)
class Weather:
    vmc_imc_weights: dict[str, float]
    vmc_vis_sm: tuple[float, float]
    imc_vis_sm: tuple[float, float]
    vmc_ceiling_chance: float
    vmc_ceiling_ft: tuple[int, int]
    imc_ceiling_ft: tuple[int, int]
    altimeter_inhg: tuple[float, float]
    wind_dir_deg: tuple[int, int]
    wind_kt_buckets: list[dict]


@dataclass(frozen=True)
class RegionConfig:
    name: str
    allowed_regions: list[str]
    tier_weights: dict[str, float]
    airport_tiers: dict[str, int]
    operator_weights: dict[str, float]
    operator_prefixes: dict[str, list[str]]
    event_weights: dict[str, float]
    traffic_density_weights: dict[str, float]
    traffic_aircraft_range: dict[str, tuple[int, int]]
    phase_weights: dict[str, float]
    phase_frequency_bands: dict[str, tuple[float, float]]
    time_of_day_weights: dict[str, float]
    runway_suffix_weights: dict[str, float]
    sid_star_none_chance: float
    weather: Weather


_DOMAINS = {
    "allowed_regions": REGIONS, "operator_weights": CLASSES, "operator_prefixes": CLASSES, "event_weights": EVENTS, "traffic_density_weights": DENSITIES,
    "traffic_aircraft_range": DENSITIES, "phase_weights": PHASES, "phase_frequency_bands": PHASES, "time_of_day_weights": TIMES,
}


def _exact(model: type, given: dict, where: str) -> dict:
    wanted = {f.name for f in fields(model)}
    if wanted != given.keys():
        raise ValueError(f"{where}: missing {sorted(wanted - given.keys())}, unknown {sorted(given.keys() - wanted)}")
    return given


def parse(raw: dict) -> RegionConfig:
    """Checks sections, labels and probabilities; nothing unknown is let through."""
    raw = dict(_exact(RegionConfig, raw, "config"))
    for section, domain in _DOMAINS.items():
        if odd := [k for k in raw[section] if k not in domain]:
            raise ValueError(f"{section}: unknown {odd}")
    weather = Weather(**_exact(Weather, raw["weather"], "weather"))
    if odd := [k for k in weather.vmc_imc_weights if k not in CONDITIONS]:
        raise ValueError(f"weather: unknown {odd}")
    for name, p in (("sid_star_none_chance", raw["sid_star_none_chance"]), ("vmc_ceiling_chance", weather.vmc_ceiling_chance)):
        if not 0 <= p <= 1:
            raise ValueError(f"{name} is {p}, not within 0 and 1")
    return RegionConfig(**raw | {"weather": weather, "tier_weights": {str(k): float(v) for k, v in raw["tier_weights"].items()}})


def available(folder: Path = RESOURCES) -> list[str]:
    return sorted(p.stem for p in folder.glob("*.yaml"))


def digest(name: str = "us", folder: Path = RESOURCES) -> str:
    """What a region's file says, as the first 16 hex digits of its SHA-1."""
    return hashlib.sha1((folder / f"{name}.yaml").read_bytes()).hexdigest()[:16]


def load(name: str = "us", folder: Path = RESOURCES) -> RegionConfig:
    """The configuration of a region; dropping a YAML file into the folder adds one."""
    import yaml

    path = folder / f"{name}.yaml"
    if not path.is_file():
        raise ConfigNotFound(f"no config {name!r}; there are {', '.join(available(folder))}")
    return parse(yaml.safe_load(path.read_text(encoding="utf-8")))
