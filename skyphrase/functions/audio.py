"""Clip measures.  Durations come from file headers, in SQL; only loudness needs samples.

WAV of any chunk layout is read here (whole numbers of 8 to 32 bits, floats, the extensible header); durations of FLAC too,
from its header.  Samples of other formats need a decoder, which is a parameter: bytes to (mono samples, rate) or None.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, LongType, StructType

Decoder = Callable[[bytes], tuple[np.ndarray, int] | None]
_MEASURES = StructType().add("seconds", DoubleType()).add("rate", LongType()).add("rms", DoubleType())


def wav_layout(head: bytes, size: int) -> tuple[int, int, int, int, int, int] | None:
    """(format, channels, rate, bits, first byte of the samples, their size) of a WAV file of ``size`` bytes."""
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        return None
    at, kind = 12, None
    while at + 8 <= len(head):
        name, length = head[at : at + 4], int.from_bytes(head[at + 4 : at + 8], "little")
        if name == b"fmt " and length >= 16 and at + 24 <= len(head):
            tag, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", head, at + 8)
            if tag == 0xFFFE and length >= 26:  # extensible: the format comes first in the sub-format's name
                tag = int.from_bytes(head[at + 32 : at + 34], "little")
            kind = (tag, channels, rate, bits)
        elif name == b"data":
            return (*kind, at + 8, min(length, size - at - 8)) if kind and kind[1] and kind[2] and kind[3] >= 8 else None
        at += 8 + length + (length & 1)
    return None


#: Chunks that a first look at a WAV file walks over; the few files with more before their samples get a second one.
LOOK = 12


def _hex(data: Column, at: Column | int, size: int) -> Column:
    return F.hex(F.substring(data, (F.lit(at) if isinstance(at, int) else at).cast("int") + 1, F.lit(size)))


def _little(digits: Column, size: int) -> Column:
    """The whole number whose bytes, the least first, are these hex digits."""
    pairs = [F.substring(digits, 2 * k + 1, 2) for k in reversed(range(size))]
    return F.conv(F.concat(*pairs), 16, 10).cast("long")


def _walk(data: Column, size: Column, state: Column) -> Column:
    """One step over the chunks of a WAV file, from the chunk at ``state.at``; ``state.over`` is 1 once the samples are found,
    2 at the end of the file."""
    head = _hex(data, state["at"], 8)
    name, length = F.substring(head, 1, 8), _little(F.substring(head, 9, 8), 4)
    form = (name == "666D7420") & (length >= 16) & (state["at"] + 24 <= size)
    fields = _hex(data, state["at"] + 8, 16)
    samples = name == "64617461"
    more = F.struct(
        F.when(samples, state["at"]).otherwise(state["at"] + 8 + length + length % 2).alias("at"),
        F.when(form, _little(F.substring(fields, 5, 4), 2)).otherwise(state["channels"]).alias("channels"),
        F.when(form, _little(F.substring(fields, 9, 8), 4)).otherwise(state["rate"]).alias("rate"),
        F.when(form, _little(F.substring(fields, 29, 4), 2)).otherwise(state["bits"]).alias("bits"),
        F.when(samples, F.least(length, size - state["at"] - 8)).otherwise(state["bytes"]).alias("bytes"),
        F.when(samples, F.lit(1)).otherwise(F.lit(0)).alias("over"),
    )
    end = F.struct(*[state[c].alias(c) for c in ("at", "channels", "rate", "bits", "bytes")], F.lit(2).alias("over"))
    return F.when(state["over"] > 0, state).when(state["at"] + 8 > size, end).otherwise(more)


def _wav_seconds(data: Column, size: Column) -> Column:
    zero = F.lit(0).cast("long")
    start = F.struct(F.lit(12).cast("long").alias("at"), *[zero.alias(c) for c in ("channels", "rate", "bits", "bytes")], F.lit(0).alias("over"))
    step = lambda state, _: _walk(data, size, state)

    def seconds(state: Column) -> Column:
        wide = state["channels"] * F.floor((state["bits"] + 7) / 8)
        ok = (state["over"] == 1) & (state["channels"] > 0) & (state["rate"] > 0) & (state["bits"] >= 8)
        return F.when(ok, F.floor(state["bytes"] / wide).cast("double") / state["rate"])

    def further(state: Column) -> Column:
        """A chunk takes eight bytes at least, so the second look reaches the end of any file."""
        steps = F.sequence(F.lit(0).cast("long"), F.greatest(zero, F.floor((size - state["at"]) / 8)))
        return F.when(state["over"] > 0, seconds(state)).otherwise(F.aggregate(steps, state, step, seconds))

    return F.aggregate(F.sequence(F.lit(1), F.lit(LOOK)), start, step, further)


def clip_seconds(data: Column) -> Column:
    """Duration of a clip by its header, in SQL; null for what can't be read.  The chunks of a WAV file are walked over
    wherever they lie; a FLAC file has its rate and number of samples at a fixed place."""
    size = F.octet_length(data).cast("long")
    info = _hex(data, 18, 8)  # rate in 20 bits, channels and depth in 8, samples in 36
    rate, samples = F.conv(F.substring(info, 1, 5), 16, 10).cast("long"), F.conv(F.substring(info, 8, 9), 16, 10).cast("long")
    flac = F.when((size >= 26) & (rate > 0) & (samples > 0), samples.cast("double") / rate)
    wav = (_hex(data, 0, 4) == "52494646") & (_hex(data, 8, 4) == "57415645")
    return F.when(_hex(data, 0, 4) == "664C6143", flac).when(wav, _wav_seconds(data, size))


def decode_wav(data: bytes) -> tuple[np.ndarray, int] | None:
    """Mono float samples and the rate of a WAV file; channels are averaged.  None if it can't be read."""
    layout = wav_layout(data, len(data))
    if layout is None:
        return None
    tag, channels, rate, bits, at, length = layout
    wide = (bits + 7) // 8 * channels
    raw = data[at : at + length // wide * wide]
    if tag == 1 and bits == 8:
        own = (np.frombuffer(raw, dtype=np.uint8).astype(np.float32) - 128) / 128
    elif tag == 1 and bits in (16, 32):
        own = (np.frombuffer(raw, dtype=f"<i{bits // 8}") / float(1 << (bits - 1))).astype(np.float32)
    elif tag == 1 and bits == 24:
        parts = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 3).astype(np.int32)
        own = ((parts[:, 0] << 8 | parts[:, 1] << 16 | parts[:, 2] << 24) / float(1 << 31)).astype(np.float32)
    elif tag == 3 and bits in (32, 64):
        own = np.frombuffer(raw, dtype=f"<f{bits // 8}").astype(np.float32)
    else:
        return None
    return own.reshape(-1, channels).mean(axis=1), rate


def measure(data: Column, decode: Decoder = decode_wav) -> Column:
    """Struct of seconds, sample rate and root mean square of each clip; nulls where it can't be read."""

    @pandas_udf(_MEASURES)
    def measured(blobs: pd.Series) -> pd.DataFrame:
        rows = []
        for blob in blobs:
            clip = decode(bytes(blob)) if blob is not None else None
            if clip is None or not len(clip[0]):
                rows.append((None, None, None))
            else:
                rows.append((len(clip[0]) / clip[1], clip[1], float(np.sqrt(np.mean(clip[0].astype(np.float64) ** 2)))))
        return pd.DataFrame(rows, columns=["seconds", "rate", "rms"])

    return measured(data)


def rms(samples: Column) -> Column:
    """Root mean square of an array of samples, in SQL; null of an empty one."""
    total = F.aggregate(samples, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return F.when(F.size(samples) > 0, F.sqrt(total / F.size(samples)))


def accepted(seconds: Column, loudness: Column, shortest: float = 10.0, longest: float = 30.0, floor_dbfs: float = -40.0) -> Column:
    """Duration within bounds, both included, not silent, and loud enough."""
    ok = seconds.between(shortest, longest) & (loudness > 0) & (20 * F.log10(F.when(loudness > 0, loudness)) >= floor_dbfs)
    return F.coalesce(ok, F.lit(False))
