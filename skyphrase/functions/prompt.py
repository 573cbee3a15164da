"""Chat messages for a scenario, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import WAKES

#: The system text is this engine's own, and so is its version: it enters the run fingerprint.
PROMPT_VERSION = "sky1"
SYSTEM = """\
You write realistic radio exchanges between air traffic control and pilots from a scenario briefing.
Follow ICAO/FAA phraseology: pilots read back clearances, headings, altitudes, runways and squawk codes; controllers
begin with the callsign they address; heavy aircraft append "heavy" to their callsign and super aircraft "super".
The briefing lists every aircraft on the frequency and marks one [FOCAL]; the event is about that one. Use only the
callsigns given. Write at least 4 turns: 4-8 for a routine exchange, 6-15 for an abnormal one, 12-30 for an emergency.
End at a natural close: a frequency handoff with its readback, or a point after which nothing more is due.

Output plain text only, one turn per line, in the form

SPEAKER: utterance

where SPEAKER is ATC, a facility tag such as KSFO_TWR, or a callsign exactly as given. The focal aircraft must speak.
No JSON, markdown, headings or comments.
"""
# The request's sentence here, and below the labels of a briefing's lines.
REQUEST = "Generate an ATC exchange for this scenario. Plaintext only, one `SPEAKER: utterance` per line.\n\n"


def roster(scenario: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in WAKES.items() for x in pair])

    def line(craft: Column, k: Column) -> Column:
        mark = F.when(k == 0, "[FOCAL]").otherwise("       ")
        return F.concat(F.lit("  "), mark, F.lit(" "), craft["callsign"], F.lit(" ("), craft["aircraft_type"], F.lit(", "), names[craft["wake"]], F.lit(", "), craft["operator_class"], F.lit(")"))

    return F.concat(F.lit("Aircraft on this frequency:\n"), F.array_join(F.transform(scenario["aircraft"], line), "\n"))


def _decimal(value: Column) -> Column:
    """A double as plain decimal text with at least one place."""
    return value.cast("string")


def briefing(scenario: Column) -> Column:
    w, focal = scenario["weather"], scenario["aircraft"][0]
    ceiling = F.when(w["ceiling_ft"].isNull(), "ceiling unlimited").otherwise(F.concat(F.lit("ceiling "), w["ceiling_ft"].cast("string"), F.lit(" ft")))
    weather = F.concat(
        F.lit("Weather: "), w["vmc_imc"], F.format_string(", wind %03d at %d kt, visibility ", w["wind_dir_deg"], w["wind_kt"]), _decimal(w["vis_sm"]), F.lit(" SM, "),
        ceiling, F.format_string(", altimeter %.2f", w["altimeter_inhg"]),
    )
    pair = lambda label, value: F.concat(F.lit(f"{label}: "), value)
    return F.concat_ws(
        "\n", pair("Airport (ICAO)", scenario["icao"]), pair("Phase", scenario["phase"]), F.format_string("Frequency: %.2f MHz", scenario["frequency_mhz"]),
        pair("Time of day", scenario["time_of_day"]), pair("Traffic density", scenario["traffic_density"]), weather, F.lit(""), roster(scenario), F.lit(""),
        F.concat(F.lit("Focal aircraft: "), focal["callsign"], F.lit(" ("), focal["aircraft_type"], F.lit(")")), pair("Focal runway in use", scenario["runway"]),
        pair("Focal SID/STAR", F.when(F.coalesce(scenario["sid_star"], F.lit("")) == "", "none").otherwise(scenario["sid_star"])),
        pair("Focal assigned squawk", scenario["squawk"]), pair("Event (centered on focal aircraft)", scenario["event"]),
    )


def messages(scenario: Column) -> Column:
    """array<struct<role, content>>: the system's and the user's."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(message("system", F.lit(SYSTEM)), message("user", F.concat(F.lit(REQUEST), briefing(scenario))))
