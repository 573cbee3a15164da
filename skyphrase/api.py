"""The names that users of the engine work with, in one place."""

from __future__ import annotations

from .config import RegionConfig, available, load
from .functions.ids import canonical_json, fingerprint, scenario_id, voice_id
from .functions.prompt import PROMPT_VERSION, briefing, messages
from .functions.turns import MIN_TURNS, parse_turns, speakers, turn_error
from .plans.generate import RunConfig, Stats, TransportError, answers, chat_client, outcomes, rerun, run, stub_client, sweep
from .plans.scenario import TAXONOMY_VERSION, Sampler
from .plans.voices import Filter, build
from .sinks.shards import FingerprintMismatch, Manifest, ShardSink, notice, push
from .sources.dims import airports, countries, custom_weights, tier_weights, uniform_weights, with_region
from .sources.registry import Source, get, register

__all__ = [
    "MIN_TURNS", "PROMPT_VERSION", "TAXONOMY_VERSION", "Filter", "FingerprintMismatch", "Manifest", "RegionConfig", "RunConfig", "Sampler", "ShardSink", "Source", "Stats",
    "TransportError", "airports", "answers", "available", "briefing", "build", "canonical_json", "chat_client", "countries", "custom_weights", "fingerprint", "get", "load", "messages", "notice",
    "outcomes", "parse_turns", "push", "register", "rerun", "run", "scenario_id", "speakers", "stub_client", "sweep", "tier_weights", "turn_error", "uniform_weights", "voice_id", "with_region",
]
