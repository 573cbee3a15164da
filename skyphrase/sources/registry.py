"""Named sources: functions from a session to a DataFrame of candidate clips."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Source:
    """``candidates`` gives rows of schemas.CANDIDATE; ``ord`` is the order in which they are considered."""

    name: str
    sub_pool: str
    candidates: Callable[[SparkSession], DataFrame]


_SOURCES: dict[str, Source] = {}


def register(source: Source) -> Source:
    if source.name in _SOURCES:
        raise ValueError(f"there is a source {source.name!r} already")
    _SOURCES[source.name] = source
    return source


def get(name: str) -> Source:
    if name not in _SOURCES:
        raise KeyError(f"no source {name!r}; there are {', '.join(available())}")
    return _SOURCES[name]


def sub_pool(name: str) -> str:
    return get(name).sub_pool


def available() -> list[str]:
    return sorted(_SOURCES)


def unregister(name: str) -> None:
    _SOURCES.pop(name, None)
