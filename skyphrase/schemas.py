"""Schemas of persisted rows, and a compiler from Python annotations to Spark types."""

from __future__ import annotations

import dataclasses
import types
import typing
from datetime import datetime

from pyspark.sql import types as T

PRIMITIVES = {str: T.StringType(), int: T.LongType(), float: T.DoubleType(), bool: T.BooleanType(), bytes: T.BinaryType(), datetime: T.StringType()}


def spark_type(annotation) -> T.DataType:
    """The Spark type of an annotation; datetimes are kept as ISO text.  TypeError for what has no persisted form."""
    if annotation in PRIMITIVES:
        return PRIMITIVES[annotation]
    origin, args = typing.get_origin(annotation), typing.get_args(annotation)
    if origin in (typing.Union, types.UnionType):
        rest = [a for a in args if a is not type(None)]
        if len(rest) != 1:
            raise TypeError(f"no type for the union {annotation!r}")
        return spark_type(rest[0])
    if origin is typing.Literal:
        kinds = {type(a) for a in args}
        if len(kinds) != 1:
            raise TypeError(f"no type for the mixed literal {annotation!r}")
        return spark_type(kinds.pop())
    if origin is list:
        return T.ArrayType(spark_type(args[0]))
    if dataclasses.is_dataclass(annotation):
        return struct_of(annotation)
    raise TypeError(f"no type for {annotation!r}")


def struct_of(model: type) -> T.StructType:
    """Declared fields, then properties with a return annotation, all nullable."""
    hints = typing.get_type_hints(model)
    fields = [T.StructField(f.name, spark_type(hints[f.name])) for f in dataclasses.fields(model)]
    for name, member in vars(model).items():
        if isinstance(member, property):
            fields.append(T.StructField(name, spark_type(typing.get_type_hints(member.fget)["return"])))
    return T.StructType(fields)


AIRCRAFT = "struct<callsign string, aircraft_type string, wake string, operator_class string>"
WEATHER = "struct<wind_dir_deg bigint, wind_kt bigint, vis_sm double, ceiling_ft bigint, altimeter_inhg double, vmc_imc string>"
TURNS = "array<struct<speaker string, text string>>"
SCENARIO = (
    f"struct<icao string, region string, phase string, aircraft array<{AIRCRAFT}>, runway string, sid_star string, squawk string, frequency_mhz double, "
    f"weather {WEATHER}, time_of_day string, traffic_density string, event string, callsign string, aircraft_type string, wake string, operator_class string, "
    "n_aircraft bigint, is_emergency boolean, is_towered boolean>"
)
TRANSCRIPT = f"scenario_id string, scenario {SCENARIO}, turns {TURNS}, model string, generated_at string, prompt_version string, taxonomy_version string"
FAILURE = f"scenario_id string, scenario {SCENARIO}, error string, at string"
AUDIO = "struct<bytes binary, path string>"
VOICE = f"voice_id string, audio {AUDIO}, text string, source_clip_id string"
VOICE_RECORD = (
    "voice_id string, source string, source_speaker_id string, source_clip_id string, duration_s double, sample_rate bigint, license string, attribution string, "
    "selected_at string, sub_pool string, gender_hint string, language string, text string"
)
CANDIDATE = "ord bigint, source string, source_speaker_id string, source_clip_id string, bytes binary, text string, license string, attribution string, gender_hint string, language string"
AIRPORT = "icao string, country string"
COUNTRY = "country string, region string"
AIRCRAFT_ROW = "icao_type string, manufacturer string, model string, wake string, operator_classes string"
WEIGHT = "icao string, weight double"
