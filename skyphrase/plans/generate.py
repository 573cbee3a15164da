"""Transcript generation: prompts to a pluggable text client, with retries, then parsing and checks.

The client is the one stage outside Catalyst.  Its answers are put down as they come, before they are parsed and split
into accepted and failed rows, so that no downstream read asks the endpoint again.
"""

from __future__ import annotations

import hashlib
import io
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import asdict, dataclass, field, replace
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import ids, prompt, turns
from ..operators import select
from ..sinks.folder import Folder
from ..sinks.ledger import Ledger
from ..sinks.shards import ShardSink
from ..sources import replay
from .scenario import TAXONOMY_VERSION, Sampler

Client = Callable[[list[dict]], str]


@dataclass(frozen=True)
class RunConfig:
    model: str
    count: int
    base_url: str = "http://localhost:30000/v1"
    api_key: str = "EMPTY"
    concurrency: int = 96
    temperature: float = 0.9
    max_tokens: int = 2048
    shard_size: int = 10_000
    seed: int = 42
    weighter_name: str = "tier_v1"
    regions: tuple[str, ...] = ("us",)
    config_name: str = "us"
    config_contents: str | None = None
    prompt_version: str = prompt.PROMPT_VERSION
    taxonomy_version: str = TAXONOMY_VERSION
    max_retries: int = 5
    max_parse_retries: int = 5
    extra: dict = field(default_factory=dict)

    def fingerprint(self) -> str:
        return ids.fingerprint(
            self.model, self.seed, self.prompt_version, self.taxonomy_version, self.weighter_name, self.regions, self.config_name,
            config_contents=self.config_contents, temperature=self.temperature, max_tokens=self.max_tokens,
        )

    def dump(self) -> dict:
        return asdict(self)


class TransportError(Exception):
    """A failure that may pass: too many requests, no connection, or a server error."""

    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.passing = status is None or status == 429 or status >= 500


def with_retries(call: Callable[[], str], most: int, pause: Callable[[float], None] = time.sleep) -> str:
    """Tries again after passing failures, waiting 1 to 30 seconds, twice as long each time."""
    for attempt in range(1, max(1, most) + 1):
        try:
            return call()
        except TransportError as error:
            if not error.passing or attempt >= most:
                raise
            pause(min(30.0, max(1.0, 2.0 ** (attempt - 1))))
    raise AssertionError


def chat_client(config: RunConfig) -> Client:
    """A client of a chat completions endpoint, by the standard library alone."""
    import json
    import urllib.error
    import urllib.request

    def ask(messages: list[dict]) -> str:
        body = {"model": config.model, "messages": messages, "temperature": config.temperature, "max_tokens": config.max_tokens} | config.extra
        body.setdefault("chat_template_kwargs", {"enable_thinking": False})
        request = urllib.request.Request(f"{config.base_url}/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {config.api_key}"})
        try:
            with urllib.request.urlopen(request, timeout=600) as answer:
                return json.load(answer)["choices"][0]["message"]["content"] or ""
        except urllib.error.HTTPError as error:
            raise TransportError(f"status {error.code}", error.code) from error
        except OSError as error:
            raise TransportError(str(error)) from error

    return ask


def stub_client(config: RunConfig) -> Client:
    """Deterministic answers for tests: four turns between ATC and the focal aircraft; by the digest of the request, one
    in ten is prose."""

    def ask(messages: list[dict]) -> str:
        user = messages[-1]["content"]
        focal = user.split("Focal aircraft: ")[1].split(" (")[0]
        if hashlib.sha1(user.encode()).hexdigest()[:2] < "1a":
            return "I would rather not."
        return f"ATC: {focal}, cleared.\n{focal}: Cleared, {focal}.\n\nATC: {focal}, contact departure.\n{focal}: Departure, good day."

    return ask


def acceptable(raw: str, focal: str) -> bool:
    """The check inside the retry loop, on the same grammar as functions.turns."""
    import re

    found = [m for line in raw.splitlines() if (m := re.match(r"^\s*([A-Z0-9][A-Z0-9 _\-/]{0,31}?)\s*:\s*(.+?)\s*$", line))]
    return len(found) >= turns.MIN_TURNS and focal.upper() in {m[1].strip().upper() for m in found}


def windowed(items: Iterable, work: Callable, inflight: int, tick: float = 1.0, more: Callable[[], bool] = lambda: True) -> Iterator:
    """(item, result) as answers come.  ``inflight`` items are in work at any time, until there are no more: each answer
    makes room for the next item, whichever came first.  None about every ``tick`` seconds, so that the caller can act;
    once ``more`` is false no item is begun."""
    flying: dict = {}
    source = iter(items)
    open_, last = True, time.monotonic()
    with ThreadPoolExecutor(inflight) as pool:
        while open_ or flying:
            while open_ and len(flying) < inflight:
                item = next(source, _END) if more() else _END
                if item is _END:
                    open_ = False
                else:
                    flying[pool.submit(work, item)] = item
            done, _ = wait(flying, timeout=tick, return_when=FIRST_COMPLETED)
            for future in done:
                yield flying.pop(future), future.result()
            if time.monotonic() - last >= tick:
                last = time.monotonic()
                yield None


_END = object()


def asker(config: RunConfig, client: Callable[[RunConfig], Client]) -> Callable[[str, str], tuple[str | None, str | None]]:
    """(raw, error) of the messages of a scenario, tried again until the answer is acceptable or tries run out."""
    import json

    ask = client(config)

    def one(messages: str, focal: str) -> tuple[str | None, str | None]:
        raw, error = None, None
        try:
            for _ in range(max(1, config.max_parse_retries)):
                raw = with_retries(lambda: ask(json.loads(messages)), config.max_retries)
                if acceptable(raw, focal):
                    break
        except Exception as failure:  # noqa: BLE001  any failure is the row's result
            error = f"{type(failure).__name__}: {failure}"
        return raw, error

    return one


def _shares(spark: SparkSession, config: RunConfig, partitions: int) -> tuple[int, int]:
    """Partitions that ask, and how many requests each has in flight."""
    partitions = max(1, min(config.concurrency, partitions))
    return partitions, max(1, config.concurrency // partitions)


def _questions(scenarios: DataFrame, *more: str) -> DataFrame:
    return scenarios.select("id", "scenario_id", "scenario", F.col("scenario.callsign").alias("focal"), F.to_json(prompt.messages(F.col("scenario"))).alias("messages"), *more)


def answers(scenarios: DataFrame, config: RunConfig, client: Callable[[RunConfig], Client] = chat_client, partitions: int | None = None) -> DataFrame:
    """(id, scenario_id, scenario, raw, error): the last answer of each scenario, or the failure of its call.

    Partitions share the concurrency; each keeps its part of it in flight until it runs out of scenarios.
    """
    spark = scenarios.sparkSession
    partitions, inflight = _shares(spark, config, partitions or spark.sparkContext.defaultParallelism)
    asked = _questions(scenarios).repartition(partitions, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = asker(config, client)
        held: list = []
        for found in windowed(_rows(batches), lambda row: one(row.messages, row.focal), inflight):
            if found is not None:
                held.append(found)
            if len(held) >= FLUSH_ROWS:
                yield _answered(held)
                held = []
        if held:
            yield _answered(held)

    return asked.mapInArrow(run, ANSWERED)


class Question(NamedTuple):
    batch: pa.RecordBatch
    row: int
    id: int
    focal: str
    messages: str
    part: int | None


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[Question]:
    for batch in batches:
        have = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()  # noqa: B023, E731
        parts = have("part") if "part" in batch.schema.names else [None] * batch.num_rows
        for k, row in enumerate(zip(have("id"), have("focal"), have("messages"), parts, strict=True)):
            yield Question(batch, k, *row)


def _answered(held: list[tuple[Question, tuple[str | None, str | None]]]) -> pa.RecordBatch:
    """The answered rows: id, scenario_id and scenario as they came, and what was answered."""
    names = ["id", "scenario_id", "scenario"]
    held = sorted(held, key=lambda found: id(found[0].batch))  # the rows of a batch are taken at once
    taken = [[q for q, _ in own] for _, own in groupby(held, lambda found: id(found[0].batch))]
    table = pa.Table.from_batches([own[0].batch.select(names).take(pa.array([q.row for q in own])) for own in taken]).combine_chunks()
    (own,) = table.to_batches()
    more = [pa.array([raw for _, (raw, _) in held], pa.string()), pa.array([error for _, (_, error) in held], pa.string())]
    return pa.RecordBatch.from_arrays([*own.columns, *more], names=[*names, "raw", "error"])


def outcomes(answered: DataFrame, config: RunConfig, *more: str) -> tuple[DataFrame, DataFrame]:
    """(accepted transcripts, failures) of written answers; ``more`` columns of these come along."""
    # generated, one row for each: projected turns would be parsed again by each mention in the filters below, which are pushed down
    parsed = answered.select("*", F.explode(F.array(turns.parse_turns(F.col("raw")))).alias("turns"))
    wrong = turns.turn_error(F.col("turns"), F.col("scenario.callsign"))
    parsed = parsed.withColumn("error", F.coalesce("error", F.concat(F.lit("TranscriptParseError: "), wrong)))
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")
    good = parsed.where("error is null").select(
        "id", "scenario_id", "scenario", "turns", F.lit(config.model).alias("model"), F.concat(now, F.lit("Z")).alias("generated_at"),
        F.lit(config.prompt_version).alias("prompt_version"), F.lit(config.taxonomy_version).alias("taxonomy_version"), *more,
    )
    return good, parsed.where("error is not null").select("id", "scenario_id", "scenario", "error", F.concat(now, F.lit("+00:00")).alias("at"), *more)


@dataclass(frozen=True)
class Stats:
    ok: int
    failed: int


Hook = Callable[[Stats], None]
ANSWERS, STOP, DONE, READY = ".answers", "_stop", "_done", ".ready-"
BATCH = 512  # parts that are made ready by one job, at most
FLUSH_ROWS, FLUSH_SECONDS, POLL = 200, 2.0, 0.25
ANSWERED = f"id long, scenario_id string, scenario {schemas.SCENARIO}, raw string, error string"


@dataclass(frozen=True)
class Part:
    """Ids that are settled at once: those of one stretch of ``size`` ids that the ledger lacks.  ``ready`` is the folder in the
    outbox that holds its outcomes, once they are made, and ``shard`` the entry of its shard there, if it has accepted rows."""

    key: str
    ids: Ledger
    ready: str | None = None
    shard: dict | None = None

    @property
    def low(self) -> int:
        return self.ids.intervals[0][0]


def parts_of(todo: Ledger, size: int) -> list[Part]:
    return [Part(f"{own.intervals[0][0]:012d}x{size}", own) for own in todo.cut(size)]


class Outbox:
    """Where tasks leave answers: files of a few rows, ``part=<key>/<rows>-<accepted>-<...>.parquet``, put in one step."""

    def __init__(self, folder: Folder):
        self.folder = folder.sub(ANSWERS)

    def counts(self) -> dict[str, list[int]]:
        """By part: rows (more where a task was run twice) and accepted ones, from the names of the files."""
        out: dict[str, list[int]] = {}
        for name in self.folder.names("part=", deep=True):
            head, _, tail = name.partition("/")
            if tail.endswith(".parquet") and not tail.startswith("."):
                rows, ok, _ = tail.split("-", 2)
                own = out.setdefault(head[len("part=") :], [0, 0])
                own[0] += int(rows)
                own[1] += int(ok)
        return out

    def known(self) -> set[int]:
        """Ids that are answered and not yet settled: those of a run that broke off or of a task's first attempt."""
        out: set[int] = set()
        for name in self.folder.names("part=", deep=True):
            if name.endswith(".parquet") and "/." not in name:
                with self.folder.fs.open_input_file(self.folder.at(name)) as source:
                    out.update(pq.read_table(source, columns=["id"]).column("id").to_pylist())
        return out

    def leave(self, key: str, held: list) -> None:
        ok = sum(error is None and acceptable(raw, q.focal) for q, (raw, error) in held)
        out = io.BytesIO()
        pq.write_table(pa.Table.from_batches([_answered(held)]), out, compression="zstd")
        self.folder.put(f"part={key}/{len(held)}-{ok}-{uuid.uuid4().hex}.parquet", out.getvalue())

    def read(self, spark: SparkSession, key: str) -> DataFrame:
        return spark.read.schema(ANSWERED).parquet(f"{self.folder.path}/part={key}").dropDuplicates(["id"])

    def parts(self, spark: SparkSession, keys: list[str]) -> DataFrame:
        """The answers of parts, whose keys are the column ``part``; rows of a task that was run twice are there twice."""
        return spark.read.schema(f"{ANSWERED}, part string").option("basePath", self.folder.path).parquet(*[f"{self.folder.path}/part={k}" for k in keys])


def fill(questions: DataFrame, outbox: Outbox, keys: list[str], config: RunConfig, client: Callable[[RunConfig], Client], inflight: int) -> None:
    """Asks all questions, whose ``part`` is the place of their part among the keys, and leaves the answers in the outbox.

    One job asks for all parts, so requests never run dry between two of them.  A task that is run again, and a run
    after one that broke off, pass over what was left before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, known, held, last = asker(config, client), outbox.known(), {}, time.monotonic()
        fresh = (q for q in _rows(batches) if q.id not in known)
        stopped, looked = False, 0.0

        def more() -> bool:
            nonlocal stopped, looked
            if time.monotonic() - looked > 1:
                looked, stopped = time.monotonic(), stopped or outbox.folder.exists(STOP)
            return not stopped

        many, leaving = 0, []
        with ThreadPoolExecutor(1) as clerk:  # files are written beside the window, which goes on
            for found in windowed(fresh, lambda q: one(q.messages, q.focal), inflight, 0.5, more):
                if found is not None:
                    held.setdefault(found[0].part, []).append(found)
                    many += 1
                if time.monotonic() - last >= FLUSH_SECONDS or (found is not None and len(held[found[0].part]) >= FLUSH_ROWS):
                    leaving = [f for f in leaving if not (f.done() and f.result() is None)]
                    leaving += [clerk.submit(outbox.leave, keys[part], own) for part, own in held.items()]
                    held, last = {}, time.monotonic()
            leaving += [clerk.submit(outbox.leave, keys[part], own) for part, own in held.items()]
            for f in leaving:
                f.result()
        yield pa.RecordBatch.from_arrays([pa.array([many])], names=["n"])

    questions.mapInArrow(run, "n long").agg(F.sum("n")).collect()


def made_ready(sink: ShardSink, parts: list[Part], config: RunConfig) -> list[Part]:
    """The parts whose answers are all there, with their outcomes written aside by one job for all: a shard and a file of
    failures each.  Nothing is stored before a part is settled, which then moves two files."""
    spark, outbox = sink.folder.spark, Outbox(sink.folder)
    rows = outbox.parts(spark, [p.key for p in parts])  # files are listed once, so what is counted is what is read
    many = rows.groupBy("part").agg(F.count_distinct("id").alias("n"), F.count("*").alias("rows")).collect()  # a row for each part
    there, twice = {r["part"]: r["n"] for r in many}, any(r["rows"] > r["n"] for r in many)
    whole = [p for p in parts if there.get(p.key, 0) >= len(p.ids)]
    fit = [p for p in whole if len(p.ids) <= sink.shard_size]
    if not fit:
        return whole
    name = f"{READY}{uuid.uuid4().hex}"
    aside = f"{ANSWERS}/{name}"
    answered = rows.where(F.col("part").isin([p.key for p in fit]))
    if twice:  # of an id that was asked twice both jobs below take the same answer
        first = F.min_by(F.struct("scenario_id", "scenario", "raw", "error"), F.struct(F.col("error").isNotNull(), F.coalesce("raw", F.lit(""))))
        answered = answered.groupBy("part", "id").agg(first.alias("row")).select("part", "id", "row.*")
    good, failed = outcomes(answered, config, "part")
    dealt = min(len(fit), 4 * spark.sparkContext.defaultParallelism)  # a part's outcomes to one task
    failed.drop("id").repartition(dealt, "part").write.partitionBy("part").json(f"{sink.folder.path}/{aside}/failures", ignoreNullFields=False)
    lows = F.substring_index("part", "x", 1).cast("long")
    shards = {s["shard"]: s for s in sink.write_aside(good.withColumn("shard_id", lows).drop("part").repartition(dealt, "shard_id"), "id", ["id"], f"{aside}/shards")}
    made = [replace(p, ready=name, shard=shards.get(p.low)) for p in fit]
    return [*made, *[p for p in whole if len(p.ids) > sink.shard_size]]


def _settle_ready(sink: ShardSink, part: Part) -> Stats:
    """Stores the outcomes of a part that lie ready."""
    failures, aside = f"failures.jsonl/part={part.key}", f"{ANSWERS}/{part.ready}"
    sink.folder.drop(failures)
    ok = part.shard["rows"] if part.shard else 0
    if ok < len(part.ids):
        sink.folder.fs.create_dir(sink.folder.at("failures.jsonl"), recursive=True)
        sink.folder.move(f"{aside}/failures/part={part.key}", failures)
    sink.adopt(part.shard, f"{aside}/shards", part.ids, part.key)
    Outbox(sink.folder).folder.drop(f"part={part.key}")
    return Stats(ok, len(part.ids) - ok)


def settle(sink: ShardSink, part: Part, config: RunConfig) -> Stats:
    """Stores the outcomes of a part whose answers are all there.  Failures go into a file of the part's own, rows and
    ledger into one commit: a part that breaks off is settled again, with the same result."""
    if part.ready:
        return _settle_ready(sink, part)
    outbox = Outbox(sink.folder)
    answered = outbox.read(sink.folder.spark, part.key)
    total = len(part.ids) or answered.count()
    good, failed = outcomes(answered, config)
    sink.add_failures(failed.drop("id"), part.key)
    ok = sink.append(good, "id", drop=["id"], settled=part.ids, part=part.key, most=total)
    if ok == total:
        sink.folder.drop(f"failures.jsonl/part={part.key}")
    outbox.folder.drop(f"part={part.key}")
    return Stats(ok, total - ok)


def recorded(sink: ShardSink) -> DataFrame | None:
    if not any(n.endswith(".json") or n.endswith(".jsonl") for n in sink.folder.names("failures.jsonl", deep=True)):
        return None
    return replay.failures(sink.folder.spark, f"{sink.folder.path}/failures.jsonl")[0]


def left_over(sink: ShardSink, config: RunConfig) -> Stats:
    """Settles a replay that was answered in full, and drops answers of parts that are settled or that were cut otherwise."""
    outbox, stats = Outbox(sink.folder), Stats(0, 0)
    for name in sink.folder.sub(ANSWERS).names("part=replay-"):
        key = name[len("part=") :]
        if key != sink.manifest.last_part and outbox.folder.exists(f"{name}/{DONE}"):
            more = settle(sink, Part(key, Ledger()), config)
            stats = Stats(stats.ok + more.ok, stats.failed + more.failed)
        outbox.folder.drop(name)
    for name in outbox.folder.names(READY):  # made ready and not settled: made once more, of the same answers
        outbox.folder.drop(name)
    outbox.folder.drop(STOP)
    return stats


def adopted(sampler: Sampler, sink: ShardSink, count: int) -> Ledger:
    """The ledger of a folder that never kept one: ids of the stored scenarios, drawn once more.  Neighbours are joined into
    intervals by the tasks' side, so an interval comes to the driver for each gap."""
    known = None
    for have in (sink.existing(), recorded(sink)):
        if have is not None:
            known = have.select("scenario_id") if known is None else known.unionByName(have.select("scenario_id"))
    if known is None:
        return Ledger()
    own = select.among(sampler.rows(count).select("id", "scenario_id"), known, "scenario_id").select("id").distinct()
    edge = own.join(own.select((F.col("id") + 1).alias("id")), "id", "left_anti").select("id", F.lit(1).alias("low"))
    end = own.select((F.col("id") + 1).alias("id")).join(own, "id", "left_anti").select("id", F.lit(0).alias("low"))
    marks = sorted((r["id"], r["low"]) for r in edge.unionByName(end).collect())
    lows, highs = [k for k, low in marks if low], [k for k, low in marks if not low]
    return Ledger(zip(lows, highs, strict=True))


def _numbered(spark: SparkSession, parts: list[Part], partitions: int) -> DataFrame:
    """(id, part) of all parts in order, dealt to ``partitions`` tasks in turn, so that all work on the same parts."""
    import json

    listed = json.dumps([{"part": k, "low": a, "high": b} for k, p in enumerate(parts) for a, b in p.ids.intervals])
    rows = spark.range(0, partitions, 1, partitions).select(F.col("id").alias("turn"), F.explode(F.from_json(F.lit(listed), "array<struct<part: int, low: long, high: long>>")).alias("i"))
    first = F.col("i.low") + F.pmod(F.col("turn") - F.col("i.low"), F.lit(partitions))
    rows = rows.withColumn("first", first).where("first < i.high")
    return rows.select(F.explode(F.sequence("first", F.col("i.high") - 1, F.lit(partitions).cast("long"))).alias("id"), "i.part")


def _beside(asking: Callable[[], None], step: Callable[[], bool], outbox: Outbox) -> None:
    """Takes steps while another thread asks, and once more after it; a step that fails lets the tasks put down what they
    have before it is raised."""
    failed: list[BaseException] = []

    def ask() -> None:
        try:
            asking()
        except BaseException as error:  # noqa: BLE001  raised by the caller
            failed.append(error)

    thread = InheritableThread(target=ask)
    thread.start()
    try:
        while thread.is_alive():
            if not step():
                thread.join(POLL)
        step()
    except BaseException:
        outbox.folder.put(STOP, b"")
        thread.join()
        raise
    if failed:
        raise failed[0]


def run(
    sampler: Sampler, out: str, config: RunConfig, client: Callable[[RunConfig], Client] = chat_client, *, resume: bool = True, overwrite: bool = False,
    part_rows: int | None = None, hook: Hook | None = None, watch: Hook | None = None,
) -> Stats:
    """Draws, answers and stores the scenarios that ``out`` doesn't hold yet, as rows or as failures.

    What is left is read off the manifest's ledger; no stored row is looked at.  One job asks for all of it while parts
    of ``part_rows`` ids (a shard, unless said otherwise) are settled as soon as their answers are there; ``hook`` is told
    the counts after each, ``watch`` those of all answers so far, while they come.  Answers are kept until they are
    settled, so a run that breaks off asks again for those in flight and the few that weren't put down yet.
    """
    spark = sampler.spark
    sink = open_sink(spark, out, config, resume=resume, overwrite=overwrite)
    stats = left_over(sink, config)
    if sink.manifest.settled is None:
        sink.manifest.settled = adopted(sampler, sink, config.count)
        sink.close()
    waiting = parts_of(sink.manifest.settled.missing(config.count), part_rows or config.shard_size)
    outbox = Outbox(sink.folder)
    for key in set(outbox.counts()) - {p.key for p in waiting}:
        outbox.folder.drop(f"part={key}")
    # half of the slots ask, the other half settles
    partitions, inflight = _shares(spark, config, max(1, spark.sparkContext.defaultParallelism // 2))
    questions = _questions(sampler.of(_numbered(spark, waiting, partitions)), "part")
    left, settled = {p.key: p for p in waiting}, Stats(0, 0)

    def step() -> bool:
        """Settles what is complete; whether anything was."""
        nonlocal settled
        counts, moved = outbox.counts(), False
        if watch:
            own = [counts[k] for k in left if k in counts]
            watch(Stats(stats.ok + settled.ok + sum(c[1] for c in own), stats.failed + settled.failed + sum(c[0] - c[1] for c in own)))
        full = [p for k, p in left.items() if k in counts and counts[k][0] >= len(p.ids)]
        for k in range(0, len(full), BATCH):
            made = made_ready(sink, full[k : k + BATCH], config)
            for part in made:
                left.pop(part.key)
                more = settle(sink, part, config)
                settled, moved = Stats(settled.ok + more.ok, settled.failed + more.failed), True
                if hook:
                    hook(Stats(stats.ok + settled.ok, stats.failed + settled.failed))
            for name in {p.ready for p in made if p.ready}:
                outbox.folder.drop(name)
        return moved

    if waiting:
        step()
    if left:
        _beside(lambda: fill(questions, outbox, [p.key for p in waiting], config, client, inflight), step, outbox)
    sink.folder.drop(ANSWERS)
    sink.close()
    return Stats(stats.ok + settled.ok, stats.failed + settled.failed)


def rerun(spark: SparkSession, out: str, config: RunConfig, client: Callable[[RunConfig], Client] = chat_client, hook: Hook | None = None, watch: Hook | None = None) -> Stats:
    """Answers the recorded failures again.  The old file is set aside only once the new answers are written.  ``watch`` is told
    the counts while answers come, ``hook`` those at the end."""
    sink = open_sink(spark, out, config, resume=True)
    stats = left_over(sink, config)
    failed = recorded(sink)
    if failed is None:
        return stats
    rows = failed.select("scenario_id", "scenario").dropDuplicates(["scenario_id"])
    done = sink.existing()
    if done is not None:
        rows = select.without(rows, done, "scenario_id")
    key = f"replay-{uuid.uuid4().hex}"
    outbox = Outbox(sink.folder)
    partitions, inflight = _shares(spark, config, spark.sparkContext.defaultParallelism)
    asked = rows.withColumn("id", F.monotonically_increasing_id()).withColumn("part", F.lit(0)).repartition(partitions, "scenario_id")
    # numbered once: a task that runs again must meet the same ids
    asked.write.parquet(f"{outbox.folder.path}/.replay-{key}")
    questions = _questions(spark.read.parquet(f"{outbox.folder.path}/.replay-{key}"), "part")

    def step() -> bool:
        rows, ok = outbox.counts().get(key, (0, 0))
        if watch:
            watch(Stats(ok, rows - ok))
        return False

    _beside(lambda: fill(questions, outbox, [key], config, client, inflight), step, outbox)
    outbox.folder.put(f"part={key}/{DONE}", b"")
    sink.rotate_failures()
    stats = settle(sink, Part(key, Ledger()), config) if outbox.counts().get(key) else Stats(0, 0)
    sink.folder.drop(ANSWERS)
    if hook:
        hook(stats)
    return stats


def open_sink(spark: SparkSession, out: str, config: RunConfig, **how) -> ShardSink:
    meta = config.dump() | {"fingerprint": config.fingerprint()}
    meta.pop("api_key")
    return ShardSink(spark, out, config.shard_size, meta, **how)


def point(ok: int, failed: int, wall: float, concurrency: int) -> dict:
    """One row of a sweep: rate and share of failures, 0 where there is nothing to divide by."""
    count = ok + failed
    return {
        "concurrency": concurrency, "ok": ok, "fail": failed, "wall_sec": round(wall, 2), "rate_per_sec": round(ok / wall, 3) if wall else 0.0,
        "fail_pct": round(100 * failed / count, 2) if count else 0.0,
    }


def sweep(sampler: Sampler, config: RunConfig, concurrencies: list[int], per_point: int, client: Callable[[RunConfig], Client] = chat_client) -> dict:
    """Times ``per_point`` scenarios at each concurrency; the best point is the first of the highest rate."""
    points = []
    for c in concurrencies:
        own, began = replace(config, concurrency=c, count=per_point), time.monotonic()
        good = F.count_if(turns.turn_error(turns.parse_turns(F.col("raw")), F.col("scenario.callsign")).isNull() & F.col("error").isNull())
        row = answers(sampler.rows(per_point), own, client).agg(good.alias("ok"), F.count("*").alias("n")).first()
        points.append(point(row["ok"], row["n"] - row["ok"], time.monotonic() - began, c))
    return {"points": points, "best": max(points, key=lambda p: p["rate_per_sec"]) if points else None}
