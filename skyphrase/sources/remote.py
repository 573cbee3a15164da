"""Clips of Parquet files behind HTTP, read in ranges: a Python data source whose partitions come from a listing.

The listing is a JSON array of URLs, or of objects with a ``url``; each file is a partition.  A task reads a file's
footer and, by row group, the slim columns first; clips that the filter rejects by their stated duration cost no audio
bytes, and a row group without any other isn't fetched at all.  Audio stays undecoded.

Options: ``listing``; ``seconds`` ("8,35": bounds of the duration, both included; a missing duration passes); ``audio``
("false" leaves the bytes out, null); ``retries``.  With ``push``
comparisons of ``audio_duration`` and ``speaker_id`` in a query are taken too; it needs a session that pushes filters to
Python sources (``spark.sql.python.filterPushdown.enabled``).
"""

from __future__ import annotations

import io
import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

#: ``ord`` is the place of the file in the listing, then the row within it.
SCHEMA = "ord bigint, speaker_id string, original_path string, transcript string, audio_duration double, audio struct<bytes binary, path string>"
SLIM = ["speaker_id", "original_path", "transcript", "audio_duration"]
_COMPARE = {EqualTo: pc.equal, GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal}


def ask(url: str, headers: dict[str, str] | None = None, method: str = "GET", retries: int = 4) -> tuple[bytes, dict]:
    """Body and headers of an answer; tries again, a little later each time, after what may pass."""
    for attempt in range(retries + 1):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=headers or {}, method=method), timeout=60) as answer:
                return answer.read(), dict(answer.headers)
        except urllib.error.HTTPError as error:
            if attempt == retries or not (error.code == 429 or error.code >= 500):
                raise
        except OSError:
            if attempt == retries:
                raise
        time.sleep(min(10.0, 0.2 * 2**attempt))
    raise AssertionError


class Ranged(io.RawIOBase):
    """A remote file; each read is a request for its range."""

    def __init__(self, url: str, retries: int):
        super().__init__()
        self.url, self.retries, self.place = url, retries, 0
        self.size = int({k.lower(): v for k, v in ask(url, method="HEAD", retries=retries)[1].items()}["content-length"])

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.place

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self.place = offset + (0, self.place, self.size)[whence]
        return self.place

    def read(self, size: int = -1) -> bytes:
        end = self.size if size < 0 else min(self.size, self.place + size)
        if end <= self.place:
            return b""
        data, _ = ask(self.url, {"Range": f"bytes={self.place}-{end - 1}"}, retries=self.retries)
        if len(data) != end - self.place:
            raise OSError(f"{self.url} gave {len(data)} bytes for {end - self.place}: no range requests")
        self.place = end
        return data

    def readinto(self, room) -> int:
        data = self.read(len(room))
        room[: len(data)] = data
        return len(data)


@dataclass
class File(InputPartition):
    place: int
    url: str


class RemoteClips(DataSource):
    @classmethod
    def name(cls) -> str:
        return "skyphrase_remote"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        options = {k.lower(): v for k, v in self.options.items()}
        return (FilteringReader if options.get("push") == "true" else RemoteReader)(options)


class RemoteReader(DataSourceReader):
    def __init__(self, low: dict[str, str]):
        self.listing, self.retries = low["listing"], int(low.get("retries", 4))
        self.bounds = tuple(float(x) for x in low["seconds"].split(",")) if low.get("seconds") else None
        self.audio = low.get("audio", "true").lower() != "false"
        self.taken: list[tuple] = []

    def partitions(self) -> list[File]:
        found = json.loads(ask(self.listing, retries=self.retries)[0])
        return [File(k, x["url"] if isinstance(x, dict) else x) for k, x in enumerate(found)]

    def _kept(self, slim: pa.Table) -> pa.Array:
        ok = pa.array([True] * slim.num_rows, pa.bool_())
        if self.bounds:
            length = slim.column("audio_duration")
            inside = pc.and_(pc.greater_equal(length, self.bounds[0]), pc.less_equal(length, self.bounds[1]))
            ok = pc.and_(ok, pc.fill_null(pc.or_kleene(pc.is_null(length), inside), False))
        for kind, name, value in self.taken:
            own = slim.column(name)
            held = pc.is_valid(own) if kind is IsNotNull else pc.is_in(own, pa.array(list(value))) if kind is In else _COMPARE[kind](own, value)
            ok = pc.and_(ok, pc.fill_null(held, False))
        return ok.combine_chunks() if isinstance(ok, pa.ChunkedArray) else ok

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        source = pq.ParquetFile(pa.PythonFile(Ranged(partition.url, self.retries), mode="r"), pre_buffer=False)
        there, at = set(source.schema_arrow.names), partition.place << 32
        for group in range(source.num_row_groups):
            many = source.metadata.row_group(group).num_rows
            slim = source.read_row_group(group, columns=[c for c in SLIM if c in there])
            for name in SLIM:
                kind = pa.float64() if name == "audio_duration" else pa.string()
                own = slim.column(name).cast(kind) if name in there else pa.nulls(many, kind)
                slim = slim.set_column(slim.schema.get_field_index(name), name, own) if name in there else slim.append_column(name, own)
            rows = pa.array(range(at, at + many), pa.int64())
            at += many
            kept = self._kept(slim)
            if not pc.any(kept).as_py():
                continue
            slim, rows = slim.filter(kept), rows.filter(kept)
            if self.audio:
                audio = source.read_row_group(group, columns=["audio"]).column("audio").filter(kept).combine_chunks()
                parts = [audio.field(n).cast(t) for n, t in (("bytes", pa.binary()), ("path", pa.string()))]
            else:
                parts = [pa.nulls(len(rows), pa.binary()), pa.nulls(len(rows), pa.string())]
            columns = [rows, *(slim.column(c).combine_chunks() for c in SLIM), pa.StructArray.from_arrays(parts, names=["bytes", "path"])]
            yield pa.RecordBatch.from_arrays(columns, names=["ord", *SLIM, "audio"])


class FilteringReader(RemoteReader):
    """For sessions that push filters to Python sources; in others Spark refuses a reader that takes them."""

    def pushFilters(self, filters):
        """Takes comparisons of slim columns; the others stay with Spark."""
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else ""
            if name in ("audio_duration", "speaker_id") and isinstance(f, (*_COMPARE, In, IsNotNull)):
                self.taken.append((type(f), name, getattr(f, "value", None)))
            else:
                yield f


PUSH = "spark.sql.python.filterPushdown.enabled"


def remote_clips(spark: SparkSession, listing: str, seconds: tuple[float, float] | None = None, audio: bool = True) -> DataFrame:
    """The clips of a listing; ``seconds`` rejects by stated duration before bytes are fetched."""
    spark.dataSource.register(RemoteClips)
    reader = spark.read.format(RemoteClips.name()).options(listing=listing, audio=str(audio).lower(), push=spark.conf.get(PUSH, "false"))
    return (reader.option("seconds", f"{seconds[0]},{seconds[1]}") if seconds else reader).load()
