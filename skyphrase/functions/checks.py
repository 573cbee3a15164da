"""Domain and range checks as Columns: what a row breaks, as an array of texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CLASSES, CONDITIONS, DENSITIES, EVENTS, LIMITS, PHASES, REGIONS, RESERVED_SQUAWKS, TIMES, WAKES


def broken(rules: Mapping[str, Column]) -> Column:
    """The names of the rules that don't hold, in order; a rule that can't be decided doesn't hold."""
    return F.filter(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())


def within(value: Column, low: float, high: float, optional: bool = False) -> Column:
    inside = value.between(low, high)
    return value.isNull() | inside if optional else inside


def one_of(value: Column, domain: Sequence[str]) -> Column:
    return value.isin(list(domain))


def scenario_errors(s: Column) -> Column:
    """Rules of a scenario that it breaks: closed sets, ranges, shapes, and the columns that follow from others."""
    w = s["weather"]
    every = lambda test: F.forall(s["aircraft"], test)
    rules = {
        "icao": s["icao"].rlike("^[A-Z0-9]{4}$"), "region": one_of(s["region"], REGIONS), "phase": one_of(s["phase"], PHASES), "time_of_day": one_of(s["time_of_day"], TIMES),
        "traffic_density": one_of(s["traffic_density"], DENSITIES), "event": one_of(s["event"], EVENTS), "squawk": s["squawk"].rlike("^[0-7]{4}$") & ~one_of(s["squawk"], RESERVED_SQUAWKS),
        "aircraft": F.size(s["aircraft"]) >= 1, "aircraft.wake": every(lambda a: one_of(a["wake"], list(WAKES))), "aircraft.operator_class": every(lambda a: one_of(a["operator_class"], CLASSES)),
        "weather.vmc_imc": one_of(w["vmc_imc"], CONDITIONS),
    }
    rules |= {f"weather.{name}": within(w[name], *limits, optional=name == "ceiling_ft") for name, limits in LIMITS.items()}
    rules |= {"n_aircraft": s["n_aircraft"] == F.size(s["aircraft"]), "callsign": s["callsign"] == F.get(s["aircraft"], F.lit(0))["callsign"]}
    return broken(rules)
