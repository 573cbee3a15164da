"""The ``SPEAKER: text`` grammar as Columns.

Java's idea of white space is narrower than the grammar's: patterns use Unicode classes and name the four separators
that they lack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_TURNS = 4
_SPACE = r"[\s\x1c-\x1f]"
_EDGES = rf"(?U)^{_SPACE}+|{_SPACE}+$"
_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
# Fixed value: a tag of 1 to 32 capitals, digits, space, _ - /, a colon, and some text.
_TURN = rf"(?U)^{_SPACE}*([A-Z0-9][A-Z0-9 _\-/]{{0,31}}?){_SPACE}*:{_SPACE}*(.+?){_SPACE}*$"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _EDGES, "")


def parse_turns(raw: Column) -> Column:
    """array<struct<speaker, text>> of the lines that match the grammar; other lines are skipped."""
    lines = F.split(F.coalesce(raw, F.lit("")), _BREAK)
    # a tag is never empty and, as short as can be, ends in no space
    found = F.transform(lines, lambda line: F.struct(F.regexp_extract(line, _TURN, 1).alias("speaker"), strip(F.regexp_extract(line, _TURN, 2)).alias("text")))
    return F.filter(found, lambda t: t["speaker"] != "")


def speakers(turns: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(turns, lambda t: F.upper(t["speaker"]))))


def turn_error(turns: Column, focal: Column, least: int = MIN_TURNS) -> Column:
    """Null if the turns are acceptable, else why they aren't."""
    few = F.format_string("only %d turns parsed (min %d)", F.size(turns), F.lit(least))
    absent = F.concat(F.lit("focal callsign '"), F.upper(focal), F.lit("' not found among speakers ['"), F.array_join(speakers(turns), "', '"), F.lit("']"))
    present = F.exists(turns, lambda t: F.upper(t["speaker"]) == F.upper(focal))
    return F.when(F.size(turns) < least, few).when(~F.coalesce(present, F.lit(False)), absent)
