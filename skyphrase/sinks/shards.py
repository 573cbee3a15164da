"""Sharded Parquet output with a manifest, resumable by a ledger of settled ids; failures as JSON lines; an attribution report.

A commit has two phases.  Tasks of a data source writer (``ShardSource``) write the shards aside, under names of their
own attempt, and report number, rows, length and digest of each; the writer's commit puts these into one record, and
from then on the rows are stored.  The driver then moves the shards to their names, adds the record to the digests
and writes the manifest.  Whoever opens a folder carries out records that it finds, and drops shards without a
record, so a run may break off anywhere; neither phase needs a rename that is atomic.
"""

from __future__ import annotations

import base64
import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators import select
from .folder import Digesting, Folder, Opener
from .ledger import Ledger


class FingerprintMismatch(RuntimeError):
    """The folder holds rows of a run with other settings."""


def now_iso() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


@dataclass
class Manifest:
    """``settled`` has the ids that are stored, as rows or failures; None in a folder that never kept them."""

    total_rows: int = 0
    last_shard_index: int = -1
    started_at: str = ""
    updated_at: str = ""
    settled: Ledger | None = None
    last_part: str | None = None
    meta: dict | None = None

    def dump(self) -> str:
        own = asdict(self) | {"settled": self.settled.intervals if self.settled is not None else None}
        own.pop("meta")
        return json.dumps(own | (self.meta or {}), indent=2, sort_keys=True)

    @classmethod
    def load(cls, text: str) -> Manifest:
        raw = json.loads(text)
        own = {k: raw.pop(k) for k in ("total_rows", "last_shard_index", "started_at", "updated_at")}
        settled = raw.pop("settled", None)
        return cls(**own, settled=Ledger(settled) if settled is not None else None, last_part=raw.pop("last_part", None), meta=raw)


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: number, file, rows, length and digest of each shard."""

    shards: list[dict] = field(default_factory=list)


class ShardSource(DataSource):
    """Writes rows with a ``shard_id``, ordered by it within partitions, as a Parquet file each into ``aside`` of ``folder``."""

    @classmethod
    def name(cls) -> str:
        return "skyphrase_shards"

    def writer(self, schema, overwrite):
        options = self.options
        return ShardWriter(cloudpickle.loads(base64.b64decode(options["folder"])), options["aside"], json.loads(options["note"]))


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, folder: Folder, aside: str, note: dict):
        self.folder, self.aside, self.note = folder, aside, note

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        done, own, attempt = Written(), None, uuid.uuid4().hex[:12]

        def finish() -> None:
            if own is not None:
                number, name, out, stream, rows, writer = own
                writer.close()
                stream.close()
                done.shards.append({"shard": number, "file": name, "rows": rows, "bytes": out.size, "sha256": out.total.hexdigest()})

        for batch in iterator:
            at = batch.schema.get_field_index("shard_id")
            number = batch.column(at).to_numpy(zero_copy_only=False)
            rest = batch.select([c for c in batch.schema.names if c != "shard_id"])
            cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if own is None or own[0] != int(number[a]):
                    finish()
                    name = f"{int(number[a]):06d}-{attempt}.parquet"
                    self.folder.fs.create_dir(self.folder.at(self.aside), recursive=True)
                    stream = self.folder.fs.open_output_stream(self.folder.at(f"{self.aside}/{name}"), compression=None)
                    out = Digesting(stream)
                    own = [int(number[a]), name, out, stream, 0, pq.ParquetWriter(out, rest.schema, compression="zstd")]
                own[5].write_batch(rest.slice(a, b - a))
                own[4] += b - a
        finish()
        return done

    def commit(self, messages) -> None:
        shards = sorted((s for m in messages if m is not None for s in m.shards), key=lambda s: s["shard"])
        self.folder.write(f"{self.aside}/{RECORD}", json.dumps(self.note | {"shards": shards}))

    def abort(self, messages) -> None:
        self.folder.drop(self.aside)


RECORD = "_COMMIT.json"
COMMIT, DIGESTS, WORKERS = ".commit-", "digests", 16


def shard_name(number: int) -> str:
    return f"shard-{number:06d}.parquet"


class ShardSink:
    """shard-000000.parquet and on, ``shard_size`` rows each, zstd; digests and manifest.json after each commit."""

    def __init__(self, spark: SparkSession, out: str, shard_size: int, meta: dict | None = None, *, resume: bool = True, overwrite: bool = False, opener: Opener | None = None):
        self.folder, self.shard_size = Folder(spark, out, opener), shard_size
        if overwrite:
            self.folder.drop()
        if self.folder.exists("manifest.json"):
            if not resume:
                raise FileExistsError(f"{out} holds a run; resume it or overwrite it")
            self.manifest = self._load()
            for key in ("fingerprint", "seed"):
                if meta and key in meta and (self.manifest.meta or {}).get(key, meta[key] if key == "seed" else None) != meta[key]:
                    raise FingerprintMismatch(f"{key} is {meta[key]}, the folder's {(self.manifest.meta or {}).get(key)}")
            self.manifest.meta = (self.manifest.meta or {}) | (meta or {})
        else:
            self.manifest = Manifest(started_at=now_iso(), settled=Ledger(), meta=meta or {})
        self.recover()

    def _load(self) -> Manifest:
        """The manifest, or its copy where the manifest itself was cut off."""
        try:
            return Manifest.load(self.folder.read("manifest.json"))
        except (ValueError, KeyError):
            return Manifest.load(self.folder.read(".manifest.copy"))

    def recover(self) -> None:
        """After a run that broke off: carries out commits that have their record, and drops the others.  Shards beyond the
        manifest are those of a folder without records; they are counted."""
        for name in self.folder.names(COMMIT):
            if self.folder.exists(f"{name}/{RECORD}"):
                self._carry_out(name)
            else:
                self.folder.drop(name)
        late = [n for n in self.shards() if int(n[len("shard-") : -len(".parquet")]) > self.manifest.last_shard_index]
        if late:
            with ThreadPoolExecutor(WORKERS) as pool:
                self.manifest.total_rows += sum(pool.map(lambda n: pq.read_metadata(self.folder.at(n), filesystem=self.folder.fs).num_rows, late))
            self.manifest.last_shard_index = max(int(n[len("shard-") : -len(".parquet")]) for n in late)
            self.manifest.settled = None
            self.close()

    def shards(self) -> list[str]:
        return self.folder.names("shard-")

    def existing(self) -> DataFrame | None:
        return self.folder.spark.read.parquet(f"{self.folder.path}/shard-*.parquet") if self.shards() else None

    def append(self, df: DataFrame, order: str, drop: list[str] | None = None, settled: Ledger | None = None, part: str | None = None, most: int | None = None) -> int:
        """Commits the rows in order, as shards after those that exist, and ``settled`` ids with them; how many rows there
        were.  A run that breaks off leaves all of the rows or none.  ``most`` rows, where that is known to fit a shard,
        are written by one task, without counts and ranges of the order."""
        spark = self.folder.spark
        aside = f"{COMMIT}{uuid.uuid4().hex}"
        first = self.manifest.last_shard_index + 1
        if most is not None and most <= self.shard_size:
            rows = df.withColumn("shard_id", F.lit(first).cast("long")).coalesce(1).sortWithinPartitions(order).drop(*(drop or []))
        else:
            placed = select.sharded(df, order, self.shard_size, first)
            rows = placed.repartition("shard_id").sortWithinPartitions("shard_id", order).drop(*(drop or []))
        self._write(rows, aside, {"settled": settled.intervals if settled else [], "part": part})
        return self._carry_out(aside)

    def _write(self, rows: DataFrame, aside: str, note: dict) -> None:
        spark = self.folder.spark
        if not getattr(spark, "_skyphrase_shards", False):
            spark.dataSource.register(ShardSource)
            spark._skyphrase_shards = True
        folder = base64.b64encode(cloudpickle.dumps(self.folder)).decode()
        rows.write.format(ShardSource.name()).options(folder=folder, aside=aside, note=json.dumps(note)).mode("append").save()

    def write_aside(self, rows: DataFrame, order: str, drop: list[str], aside: str) -> list[dict]:
        """Writes rows, a ``shard_id`` of which lies in one partition, as a file for each into ``aside``; the entries of these.  They
        aren't stored before they are adopted."""
        self._write(rows.sortWithinPartitions("shard_id", order).drop(*drop), aside, {})
        shards = json.loads(self.folder.read(f"{aside}/{RECORD}"))["shards"]
        if len({s["shard"] for s in shards}) < len(shards):
            raise ValueError("rows of a shard lie in several partitions")
        return shards

    def adopt(self, shard: dict | None, aside: str, settled: Ledger, part: str) -> int:
        """Commits a file that was written aside, as the next shard, and ``settled`` ids with it, or these alone."""
        commit, shards = f"{COMMIT}{uuid.uuid4().hex}", []
        if shard:
            self.folder.fs.create_dir(self.folder.at(commit), recursive=True)
            self.folder.move(f"{aside}/{shard['file']}", f"{commit}/{shard['file']}")
            shards = [shard | {"shard": self.manifest.last_shard_index + 1}]
        self.folder.write(f"{commit}/{RECORD}", json.dumps({"settled": settled.intervals, "part": part, "shards": shards}))
        return self._carry_out(commit)

    def _carry_out(self, aside: str) -> int:
        """Moves the shards of a record to their names and enters them; can be repeated at any point."""
        record = json.loads(self.folder.read(f"{aside}/{RECORD}"))
        shards = record["shards"]

        def place(s: dict) -> None:
            name = shard_name(s["shard"])
            if self.folder.exists(name) and self.folder.size(name) != s["bytes"]:  # a copy that broke off
                self.folder.drop(name)
            if not self.folder.exists(name):
                self.folder.move(f"{aside}/{s['file']}", name)

        with ThreadPoolExecutor(WORKERS) as pool:
            list(pool.map(place, shards))
        if shards:
            lines = [json.dumps({"name": shard_name(s["shard"]), "rows": s["rows"], "bytes": s["bytes"], "sha256": s["sha256"]}) for s in shards]
            self.folder.write(f"{DIGESTS}/{shards[0]['shard']:06d}.json", "\n".join(lines) + "\n")
        new = [s for s in shards if s["shard"] > self.manifest.last_shard_index]
        self.manifest.total_rows += sum(s["rows"] for s in new)
        self.manifest.last_shard_index = max([self.manifest.last_shard_index, *(s["shard"] for s in new)])
        if self.manifest.settled is not None:
            self.manifest.settled = self.manifest.settled.plus(record["settled"])
        self.manifest.last_part = record["part"]
        self.close()
        self.folder.drop(aside)
        return sum(s["rows"] for s in shards)

    def close(self) -> None:
        self.manifest.updated_at = now_iso()
        self.folder.write(".manifest.copy", self.manifest.dump())
        self.folder.write("manifest.json", self.manifest.dump())

    def add_failures(self, failed: DataFrame, part: str = "all") -> None:
        """Records the failures of a part; those of one that is worked off again replace the ones of its first time."""
        failed.write.mode("overwrite").json(f"{self.folder.path}/failures.jsonl/part={part}", ignoreNullFields=False)

    def rotate_failures(self) -> str | None:
        """Sets the failures aside under the time of day; the new name, or None without any."""
        if not self.folder.exists("failures.jsonl"):
            return None
        stem = f"failures.{datetime.now(UTC):%Y%m%dT%H%M%SZ}"
        name = f"{stem}.jsonl"
        for k in range(1, 1000):  # several within a second
            if not self.folder.exists(name):
                break
            name = f"{stem}-{k}.jsonl"
        self.folder.rename("failures.jsonl", name)
        return name


def listed(spark: SparkSession, folder: Folder) -> DataFrame:
    """(name, bytes, sha256) of a folder's shards by its digests; nulls for those of a folder without."""
    known = spark.createDataFrame([], "name string, bytes long, sha256 string")
    if folder.exists(DIGESTS):
        known = spark.read.schema("name string, rows long, bytes long, sha256 string").json(f"{folder.path}/{DIGESTS}").select("name", "bytes", "sha256").dropDuplicates(["name"])
    there = spark.createDataFrame([(n,) for n in folder.names("shard-")], "name string")
    return there.join(known, "name", "left")


def push(spark: SparkSession, out: str, to: str, opener: Opener | None = None) -> list[str]:
    """Copies the shards of ``out`` and then its digests and manifest, and nothing else, to another folder; the names copied.

    Tasks compare and copy, a shard each: one that is there with the digest that this run has for it isn't sent again, and
    what was sent is read back and compared.  Only names come to the driver.  Shards that the target's own digests name
    and that this run doesn't have are removed once the manifest is in place.
    """
    source, target = Folder(spark, out, opener), Folder(spark, to, opener)
    target.fs.create_dir(target.at(), recursive=True)
    stale = {r["name"] for r in listed(spark, target).where("sha256 is not null").select("name").collect()} - set(source.names("shard-"))
    plain = (cloudpickle.loads(cloudpickle.dumps(source)), cloudpickle.loads(cloudpickle.dumps(target)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, new = plain
        for batch in batches:
            sent = []
            for row in batch.to_pylist():
                name = row["name"]
                own = (row["bytes"], row["sha256"]) if row["sha256"] else old.digest(name)
                if new.exists(name) and new.size(name) == own[0] and new.digest(name) == own:
                    continue
                with old.fs.open_input_stream(old.at(name), compression=None) as a, new.fs.open_output_stream(new.at(name), compression=None) as b:
                    while block := a.read(1 << 20):
                        b.write(block)
                if new.digest(name) != own:
                    raise OSError(f"{name} was altered on its way to {new.path}")
                sent.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(sent, pa.string())], names=["name"])

    names = listed(spark, source)
    many = max(1, len(source.names("shard-")))
    sent = sorted(r["name"] for r in names.repartition(min(many, 10 * spark.sparkContext.defaultParallelism), "name").mapInArrow(send, "name string").collect())
    if source.exists(DIGESTS):
        target.drop(DIGESTS)
        for name in source.sub(DIGESTS).names():
            target.put(f"{DIGESTS}/{name}", source.get(f"{DIGESTS}/{name}"))
    for name in source.names("manifest.json"):
        target.put(name, source.get(name))
        sent.append(name)
    for name in sorted(stale):
        target.drop(name)
    return sent


def notice_rows(records: DataFrame) -> DataFrame:
    """(source, voices, licenses, attributions): counts and sorted distinct texts."""
    return records.groupBy("source").agg(
        F.count("*").alias("voices"), F.array_sort(F.collect_set("license")).alias("licenses"), F.array_sort(F.collect_set("attribution")).alias("attributions")
    )


def notice(records: DataFrame, title: str = "Voice pool: source attribution") -> str:
    """The attribution report in Markdown; one row per source is collected."""
    lines = [f"# {title}", "", "This voice pool holds clips of the datasets below; each source's licence applies to its clips.", ""]
    for r in notice_rows(records).orderBy("source").collect():
        lines += [f"## {r['source']}", "", f"- {r['voices']} voice(s)", f"- License(s): {', '.join(r['licenses'])}", "- Attribution:", *[f"  - {a}" for a in r["attributions"]], ""]
    return "\n".join(lines)
