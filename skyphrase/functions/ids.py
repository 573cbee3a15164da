"""Stable identifiers as Columns, and the run fingerprint."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fields that make a scenario's identity, in alphabetical order at each level.
_AIRCRAFT = ["aircraft_type", "callsign", "operator_class", "wake"]
_WEATHER = ["altimeter_inhg", "ceiling_ft", "vis_sm", "vmc_imc", "wind_dir_deg", "wind_kt"]


def canonical_json(scenario: Column) -> Column:
    """Compact JSON with sorted keys and nulls kept, without the derived fields; ASCII values."""
    craft = F.transform(scenario["aircraft"], lambda a: F.struct(*[a[f].alias(f) for f in _AIRCRAFT]))
    weather = F.struct(*[scenario["weather"][f].alias(f) for f in _WEATHER])
    plain = ["event", "frequency_mhz", "icao", "phase", "region", "runway", "sid_star", "squawk", "time_of_day", "traffic_density"]
    parts = {f: scenario[f] for f in plain} | {"aircraft": craft, "weather": weather}
    return F.to_json(F.struct(*[parts[f].alias(f) for f in sorted(parts)]), {"ignoreNullFields": "false"})


def scenario_id(scenario: Column) -> Column:
    return F.sha1(canonical_json(scenario).cast("binary"))


def voice_id(source: Column, speaker: Column) -> Column:
    """The first 12 hex digits of sha1("source:speaker")."""
    return F.substring(F.sha1(F.concat_ws(":", source, speaker).cast("binary")), 1, 12)


FINGERPRINTED = ["config_name", "model", "prompt_version", "regions", "seed", "taxonomy_version", "weighter_name"]


def fingerprint(model: str, seed: int, prompt_version: str, taxonomy_version: str, weighter_name: str, regions: Iterable[str], config_name: str, **more) -> str:
    """The key that runs must share to be resumed: 16 hex digits.  ``more`` settings count unless they are None."""
    payload = {
        "model": model, "seed": seed, "prompt_version": prompt_version, "taxonomy_version": taxonomy_version,
        "weighter_name": weighter_name, "regions": sorted(regions), "config_name": config_name,
    }
    payload |= {k: v for k, v in more.items() if v is not None}
    return hashlib.sha1(json.dumps(payload, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]


def fingerprints(settings: Mapping[str, Column]) -> Column:
    """``fingerprint`` of rows: Columns of the seven settings, the regions as an array."""
    parts = {**settings, "regions": F.array_sort(settings["regions"])}
    text = F.to_json(F.struct(*[parts[k].alias(k) for k in FINGERPRINTED]), {"ignoreNullFields": "false"})
    return F.substring(F.sha1(text.cast("binary")), 1, 16)
