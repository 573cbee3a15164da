"""Speech corpora as candidate clips: metadata first, audio bytes carried along undecoded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import audio
from ..operators import select
from .registry import Source, register
from .remote import remote_clips

# Splits in order, bounds in seconds, the licence and the attribution texts of both corpora.
SPLITS = ["train.clean.100", "train.clean.360", "train.other.500"]
LONGEST = (1.0, 30.0)
PREFILTER = (8.0, 35.0)
LICENSE = "CC-BY-4.0"
LIBRITTS = "LibriTTS-R: A Restored Multi-Speaker Text-to-Speech Corpus (Koizumi et al., 2023). Licensed CC BY 4.0."
MLS = "Multilingual LibriSpeech (MLS) English split (Pratap et al., 2020). Parler-TTS distribution. Licensed CC BY 4.0."


def longest_clips(rows: DataFrame) -> DataFrame:
    """One clip per speaker: the longest readable one of 1 to 30 s, the earlier on a tie, in order of first valid clips.

    ``rows``: ord, speaker_id, id, text_normalized, audio<bytes, path>.  The choice is made on slim metadata; bytes
    are joined back for the clips that won.
    """
    probed = rows.select("ord", "speaker_id", audio.clip_seconds(F.col("audio.bytes")).alias("seconds")).where(F.col("seconds").between(*LONGEST))
    won = select.longest_per_key(probed, "speaker_id", "seconds", "ord")
    return rows.join(won.select("ord", F.col("first_ord").alias("place"), "seconds"), "ord")


def first_clips(rows: DataFrame) -> DataFrame:
    """The first clip of each speaker whose stated duration is within 8 to 35 s or missing; rejected later, it isn't replaced."""
    near = rows.where(F.col("audio_duration").isNull() | F.col("audio_duration").between(*PREFILTER)).where(F.length("audio.bytes") > 0)
    won = select.first_per_key(near.select("ord", "speaker_id"), "speaker_id", "ord")
    return rows.join(won.select("ord"), "ord").withColumn("place", F.col("ord"))


def candidate(rows: DataFrame, source: str, clip: Column, text: Column, attribution: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return rows.select(
        F.col("place").cast("long").alias("ord"), F.lit(source).alias("source"), F.col("speaker_id").cast("string").alias("source_speaker_id"), clip.cast("string").alias("source_clip_id"),
        F.col("audio.bytes").alias("bytes"), text.alias("text"), F.lit(LICENSE).alias("license"), F.lit(attribution).alias("attribution"), none.alias("gender_hint"), F.lit("en").alias("language"),
    )


#: Files up to which their numbers are broadcast (some 10 MB).
BROADCAST_FILES = 1 << 16


def numbered(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of Parquet files with ord: the place of the file in the list of paths, its name, and the row within it.  Places
    come from the listing that Spark's reader makes on the driver; no row is read for them."""
    files, out = [], None
    for k, path in enumerate(paths):
        own = spark.read.parquet(path)
        files += [(k, name.replace(":///", ":/")) for name in sorted(own.inputFiles())]  # both ways to write a path without a host
        own = own.select("*", F.lit(k).alias("_path"), F.replace(F.col("_metadata.file_path"), F.lit(":///"), F.lit(":/")).alias("_file"), F.col("_metadata.row_index").alias("_row"))
        out = own if out is None else out.unionByName(own)
    rank = spark.createDataFrame([(k, name, place) for place, (k, name) in enumerate(files)], "_path int, _file string, _rank long")
    rank = F.broadcast(rank) if len(files) <= BROADCAST_FILES else rank.hint("merge")
    return out.join(rank, ["_path", "_file"]).withColumn("ord", F.shiftleft("_rank", 32) + F.col("_row")).drop("_path", "_file", "_row", "_rank")


def libritts(folder: str) -> Source:
    """A source over a folder with one subfolder per split; other folders aren't read."""

    def candidates(spark: SparkSession) -> DataFrame:
        rows = numbered(spark, [f"{folder}/{s}" for s in SPLITS]).select("ord", "speaker_id", "id", "text_normalized", "audio")
        return candidate(longest_clips(rows), "libritts-r", F.col("id"), F.col("text_normalized"), LIBRITTS)

    return Source("libritts-r", "controller", candidates)


def mls(folder: str) -> Source:
    """A source over a folder, or over the listing of remote files at an address: durations outside of the bounds are
    rejected before their bytes are fetched, and the choice of clips fetches none."""

    def local(spark: SparkSession) -> DataFrame:
        rows = numbered(spark, [folder])
        if "audio_duration" not in rows.columns:
            rows = rows.withColumn("audio_duration", F.lit(None).cast("double"))
        return first_clips(rows.select("ord", "speaker_id", "original_path", "audio_duration", "audio"))

    def streamed(spark: SparkSession) -> DataFrame:
        won = select.first_per_key(remote_clips(spark, folder, PREFILTER, audio=False).select("ord", "speaker_id"), "speaker_id", "ord")
        return remote_clips(spark, folder, PREFILTER).join(won.select("ord"), "ord", "left_semi").where(F.length("audio.bytes") > 0).withColumn("place", F.col("ord"))

    def candidates(spark: SparkSession) -> DataFrame:
        rows = streamed(spark) if folder.startswith(("http://", "https://")) else local(spark)
        return candidate(rows, "mls-eng", F.col("original_path"), F.lit(None).cast("string"), MLS)

    return Source("mls-eng", "controller", candidates)


def register_corpora(libritts_folder: str | None = None, mls_folder: str | None = None) -> None:
    if libritts_folder:
        register(libritts(libritts_folder))
    if mls_folder:
        register(mls(mls_folder))
