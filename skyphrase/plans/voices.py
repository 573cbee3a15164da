"""The voice pool: candidates of sources in order, one accepted clip per speaker, up to a target."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import audio, ids
from ..operators import select
from ..scratch import owned, written
from ..sinks.shards import ShardSink, notice, now_iso
from ..sources import registry

#: Candidates that a first look takes for each voice still wanted; each further look takes four times as many.
AHEAD = 4


@dataclass(frozen=True)
class Filter:
    min_seconds: float = 20.0
    max_seconds: float = 30.0
    min_rms_dbfs: float = -40.0


@dataclass(frozen=True)
class Stats:
    """``skipped`` counts the candidates passed over before the target was met, ``unreadable`` those no decoder could read."""

    kept: int
    skipped: int
    unreadable: int = 0


def as_is(samples_wav: bytes) -> bytes:
    """The encoder in use where none is given: the clip's own bytes."""
    return samples_wav


def chosen(candidates: DataFrame, existing: DataFrame | None, params: Filter, target: int, decode: audio.Decoder = audio.decode_wav) -> DataFrame:
    """Slim rows of all candidates with voice_id, seconds, rate, kept, processed and skipped; no audio bytes.  Clips are
    decoded once: their measures are written before the choice reads them again and again."""
    measured = candidates.withColumn("m", audio.measure(F.col("bytes"), decode)).drop("bytes").select("*", "m.seconds", "m.rate", "m.rms").drop("m")
    measured = written(measured)
    measured = measured.withColumn("voice_id", ids.voice_id(F.col("source"), F.col("source_speaker_id")))
    stored = 0
    if existing is None:
        measured = measured.withColumn("_there", F.lit(False))
    else:
        old = existing.select("voice_id").distinct().withColumn("_there", F.lit(True))
        stored = old.count()
        measured = measured.join(old, "voice_id", "left").withColumn("_there", F.coalesce("_there", F.lit(False)))
    ok = audio.accepted(F.col("seconds"), F.col("rms"), params.min_seconds, params.max_seconds, params.min_rms_dbfs)
    return select.up_to_target(measured, ["source", "source_speaker_id"], "ord", ok, F.col("_there"), target - stored).drop("_there")


def build(
    spark: SparkSession, sources: list[registry.Source], out: str, target: int = 100, params: Filter | None = None, *, shard_size: int = 500, resume: bool = True, overwrite: bool = False,
    encode: Callable[[bytes], bytes] = as_is, decode: audio.Decoder = audio.decode_wav, hook: Callable[[Stats], None] | None = None,
    seed: int = 42,
) -> Stats:
    """Fills ``out`` up to ``target`` voices: shards of (voice_id, audio, text, source_clip_id), full records beside them, NOTICE.md.

    Candidates are looked at in their order, a few for each voice wanted at first, so that clips beyond the target are
    hardly decoded; the choice is that of a loop that stops at the target.  ``seed`` is part of the pool's manifest, and a
    pool is resumed under its own only; the choice has no draws.
    """
    sink = ShardSink(spark, out, shard_size, {"kind": "voices", "seed": seed, "target": target, "sources": [s.name for s in sources]}, resume=resume, overwrite=overwrite)
    candidates = select.concatenated([s.candidates(spark) for s in sources])
    pools = F.create_map(*[F.lit(x) for s in sources for x in (s.name, s.sub_pool)])
    existing, at, aside = sink.existing(), now_iso(), f"{sink.folder.path}/.picked"
    room = target - (existing.select("voice_id").distinct().count() if existing is not None else 0)
    many = AHEAD * max(room, 1)
    while True:
        seen = candidates.select("ord").orderBy("ord").limit(many).agg(F.max("ord").alias("last"), F.count("*").alias("n")).first()
        near = candidates.where(F.col("ord") <= F.lit(seen["last"])) if seen["n"] == many else candidates
        with owned():
            records = chosen(near, existing, params or Filter(), target, decode).select(
                "ord", "voice_id", "source", "source_speaker_id", "source_clip_id", F.col("seconds").alias("duration_s"), F.col("rate").alias("sample_rate"), "license", "attribution",
                F.lit(at).alias("selected_at"), F.coalesce(pools[F.col("source")], F.lit("")).alias("sub_pool"), "gender_hint", "language", "text", "kept", "skipped",
            )
            records.where("kept or skipped").write.mode("overwrite").parquet(aside)
        records = spark.read.parquet(aside)
        new = records.where("kept")
        found = records.agg(F.count_if("kept").alias("kept"), F.count_if("skipped").alias("skipped"), F.count_if(F.col("duration_s").isNull()).alias("unreadable")).first()
        if hook:
            hook(Stats(sink.manifest.total_rows + found["kept"], found["skipped"], found["unreadable"]))
        if found["kept"] >= room or seen["n"] < many:
            break
        many *= AHEAD

    @F.pandas_udf("binary")
    def encoded(data: pd.Series) -> pd.Series:
        return data.map(lambda b: encode(bytes(b)))

    # records first: those of a run that breaks off before its shards are left out of the report, and written again
    new.drop("ord", "kept", "skipped").write.mode("append").parquet(f"{sink.folder.path}/records")
    bodies = candidates.select("ord", "bytes").join(new.select("ord", "voice_id", "text", "source_clip_id"), "ord")
    rows = bodies.select("ord", "voice_id", F.struct(encoded("bytes").alias("bytes"), F.lit(None).cast("string").alias("path")).alias("audio"), "text", "source_clip_id")
    sink.append(rows, "ord", drop=["ord"])
    sink.folder.drop(".picked")
    held = sink.existing()
    kept = spark.read.parquet(f"{sink.folder.path}/records").dropDuplicates(["voice_id"])
    sink.folder.write("NOTICE.md", notice(select.among(kept, held, "voice_id") if held is not None else kept.limit(0)))
    return Stats(sink.manifest.total_rows, found["skipped"], found["unreadable"])
