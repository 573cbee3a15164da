"""Ledger, two-phase commits, pushes, the window of requests, progress, header walks and remote clips."""

import http.server
import io
import json
import struct
import threading
import time

import numpy as np
import pyarrow as pa
import pyarrow.fs as arrow_fs
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from skyphrase import config
from skyphrase.cli import main
from skyphrase.functions import audio
from skyphrase.operators import select
from skyphrase.plans import generate, voices
from skyphrase.plans.scenario import Sampler
from skyphrase.scratch import owned, shared_dir
from skyphrase.sinks.folder import Folder
from skyphrase.sinks.ledger import Ledger
from skyphrase.sinks.shards import Manifest, ShardSink, push
from skyphrase.sources import corpora, remote

from .test_pipelines import Broken, clips_source, tone


def test_ledger_against_sets():
    rng = np.random.default_rng(1)
    for _ in range(200):
        pairs = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 60, 8), rng.integers(0, 9, 8), strict=True)]
        own, plain = Ledger(pairs), {k for a, b in pairs for k in range(a, b)}
        assert {k for k in range(80) if k in own} == plain and len(own) == len(plain)
        assert all(a[1] < b[0] for a, b in zip(own.intervals, own.intervals[1:], strict=False))
        count, size = int(rng.integers(0, 80)), int(rng.integers(1, 30))
        todo = own.missing(count)
        assert {k for k in range(90) if k in todo} == set(range(count)) - plain
        cut = list(todo.cut(size))
        assert sorted(k for p in cut for a, b in p.intervals for k in range(a, b)) == sorted(set(range(count)) - plain)
        assert all(len({k // size for a, b in p.intervals for k in range(a, b)}) == 1 for p in cut)


class NoRename(arrow_fs.FileSystemHandler):
    """The local file system without renames, as an object store is; files are there once they are closed."""

    def __init__(self):
        self.own = arrow_fs.LocalFileSystem()

    def get_type_name(self):
        return "no-rename"

    def __eq__(self, other):
        return isinstance(other, NoRename)

    def __ne__(self, other):
        return not self == other

    def normalize_path(self, path):
        return path

    def get_file_info(self, paths):
        return self.own.get_file_info(paths)

    def get_file_info_selector(self, selector):
        return self.own.get_file_info(selector)

    def create_dir(self, path, recursive):
        self.own.create_dir(path, recursive=recursive)

    def delete_dir(self, path):
        self.own.delete_dir(path)

    def delete_dir_contents(self, path, missing_dir_ok=False):
        self.own.delete_dir_contents(path, missing_dir_ok=missing_dir_ok)

    def delete_root_dir_contents(self):
        raise NotImplementedError

    def delete_file(self, path):
        self.own.delete_file(path)

    def move(self, src, dest):
        raise NotImplementedError("no renames here")

    def copy_file(self, src, dest):
        self.own.copy_file(src, dest)

    def open_input_stream(self, path):
        return self.own.open_input_stream(path, compression=None)

    def open_input_file(self, path):
        return self.own.open_input_file(path)

    def open_output_stream(self, path, metadata):
        return self.own.open_output_stream(path, compression=None)

    def open_append_stream(self, path, metadata):
        raise NotImplementedError


def no_rename(uri):
    return arrow_fs.PyFileSystem(NoRename()), uri.removeprefix("file://")


def named(df):
    return df.selectExpr("id", "cast(id as string) AS name")


@pytest.mark.parametrize("opener", [None, no_rename], ids=["rename", "no-rename"])
@pytest.mark.parametrize("after", [0, 1, 2, 3, 4])
def test_commits_that_break_off(spark, tmp_path, monkeypatch, after, opener):
    """Breaks before the commit's record (0), while shards are moved (1, 2), before the digests (3), or within the manifest (4)."""
    out = (tmp_path / "s").as_uri()
    ShardSink(spark, out, 5, opener=opener).append(named(spark.range(3)), "id", settled=Ledger([(0, 3)]))
    sink, calls = ShardSink(spark, out, 5, opener=opener), []
    move, write = Folder.move, Folder.write

    def failing_move(self, *args):
        calls.append(1)
        if len(calls) == after:
            raise Broken
        return move(self, *args)

    def failing_write(self, name, text):
        if after == 3 and name.startswith("digests/"):
            raise Broken
        if after == 4 and name == "manifest.json":
            self.put(name, text[: len(text) // 2].encode())
            raise Broken
        return write(self, name, text)

    def failing_carry(self, aside):
        self.folder.drop(f"{aside}/_COMMIT.json")
        raise Broken

    with monkeypatch.context() as patch, pytest.raises(Broken):
        patch.setattr(Folder, "move", failing_move)
        patch.setattr(Folder, "write", failing_write)
        if after == 0:
            patch.setattr(ShardSink, "_carry_out", failing_carry)
        sink.append(named(spark.range(100, 112)), "id", settled=Ledger([(3, 15)]))
    again = ShardSink(spark, out, 5, opener=opener)
    want = [0, 1, 2] if after == 0 else [0, 1, 2, *range(100, 112)]
    assert sorted(r["id"] for r in again.existing().collect()) == want and again.manifest.total_rows == len(want)
    assert again.manifest.settled == Ledger([(0, 3)] if after == 0 else [(0, 15)]) and not again.folder.names(".commit-")
    digests = spark.read.json(f"{out}/digests").collect()
    assert sorted(r["name"] for r in digests) == again.shards() and all(again.folder.digest(r["name"]) == (r["bytes"], r["sha256"]) for r in digests)


def test_tasks_report_their_shards(spark, tmp_path):
    """Failing tasks leave nothing; rows are in order within shards, whose types are those of the rows."""
    sink = ShardSink(spark, (tmp_path / "s").as_uri(), 4)
    rows = spark.range(11).selectExpr("id", "named_struct('a', id, 'b', array(cast(id as string), null)) AS s", "cast(null as double) AS d", "cast('x' as binary) AS raw").repartition(3)
    with pytest.raises(Exception, match="(?i)odd"):
        sink.append(rows.withColumn("bad", F.when(F.col("id") == 10, F.raise_error(F.lit("odd"))).otherwise(F.lit(1))), "id")
    assert ShardSink(spark, sink.folder.path, 4).shards() == []
    assert sink.append(rows, "id") == 11
    assert [[r["id"] for r in spark.read.parquet(f"{sink.folder.path}/{n}").collect()] for n in sink.shards()] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10]]
    got = sink.existing()
    assert got.schema.simpleString() == rows.schema.simpleString() and sorted(map(str, got.collect())) == sorted(map(str, rows.collect()))


def test_push_compares_contents(spark, tmp_path):
    out, to = (tmp_path / "run").as_uri(), (tmp_path / "there").as_uri()
    rows = lambda word, n: spark.range(n).select("id", F.lit(word).alias("name"))
    ShardSink(spark, out, 5).append(rows("aaaa", 12), "id")
    assert push(spark, out, to) == ["shard-000000.parquet", "shard-000001.parquet", "shard-000002.parquet", "manifest.json"]
    assert push(spark, out, to) == ["manifest.json"]
    before = (tmp_path / "there" / "shard-000000.parquet").stat().st_size
    ShardSink(spark, out, 5, overwrite=True).append(rows("bbbb", 8), "id")
    assert (tmp_path / "run" / "shard-000000.parquet").stat().st_size == before, "equal lengths, other contents"
    assert push(spark, out, to) == ["shard-000000.parquet", "shard-000001.parquet", "manifest.json"]
    got = spark.read.parquet(f"{to}/shard-*.parquet")
    assert got.count() == 8 and {r["name"] for r in got.collect()} == {"bbbb"}
    Folder(spark, to).put("shard-000001.parquet", b"cut")
    assert push(spark, out, to) == ["shard-000001.parquet", "manifest.json"] and spark.read.parquet(f"{to}/shard-*.parquet").count() == 8


def test_push_of_a_folder_without_digests(spark, tmp_path):
    out, to = (tmp_path / "run").as_uri(), (tmp_path / "there").as_uri()
    sink = ShardSink(spark, out, 5)
    sink.append(named(spark.range(7)), "id")
    sink.folder.drop("digests")
    assert len(push(spark, out, to)) == 3 and push(spark, out, to) == ["manifest.json"]


SETTINGS = generate.RunConfig(model="stub", count=60, concurrency=4, shard_size=25)


def test_a_resumed_run_reads_no_shard(spark, tmp_path, monkeypatch):
    out, sampler = (tmp_path / "g").as_uri(), Sampler(spark, config.load(), 3)
    first = generate.run(sampler, out, SETTINGS, generate.stub_client)
    assert first.ok + first.failed == 60
    sink = generate.open_sink(spark, out, SETTINGS)
    assert sink.manifest.settled == Ledger([(0, 60)])
    monkeypatch.setattr(ShardSink, "existing", lambda self: (_ for _ in ()).throw(AssertionError("a shard was read")))
    monkeypatch.setattr(generate, "recorded", lambda sink: (_ for _ in ()).throw(AssertionError("failures were read")))
    more = generate.run(sampler, out, generate.replace(SETTINGS, count=85), generate.stub_client)
    assert more.ok + more.failed == 25
    monkeypatch.undo()
    sink = generate.open_sink(spark, out, SETTINGS)
    stored = [r["scenario_id"] for r in sink.existing().collect()] + [r["scenario_id"] for r in generate.recorded(sink).collect()]
    assert sorted(stored) == sorted(r["scenario_id"] for r in sampler.rows(85).collect()) and sink.manifest.settled == Ledger([(0, 85)])


def test_a_folder_without_a_ledger_gets_one(spark, tmp_path):
    out, sampler = (tmp_path / "g").as_uri(), Sampler(spark, config.load(), 3)
    generate.run(sampler, out, SETTINGS, generate.stub_client)
    sink = generate.open_sink(spark, out, SETTINGS)
    kept = sink.manifest
    kept.settled = None
    sink.close()
    assert Manifest.load(sink.folder.read("manifest.json")).settled is None
    more = generate.run(sampler, out, generate.replace(SETTINGS, count=70), generate.stub_client)
    assert more.ok + more.failed == 10 and generate.open_sink(spark, out, SETTINGS).manifest.settled == Ledger([(0, 70)])


def test_window_refills_whichever_answer_comes(tmp_path):
    """One slow answer in ten: as many requests as the limit are in work until the last item is begun."""
    lock, now, seen = threading.Lock(), [0], []

    def work(k):
        with lock:
            now[0] += 1
            seen.append((k, now[0]))
        time.sleep(0.3 if k % 10 == 0 else 0.01)
        with lock:
            now[0] -= 1
        return -k

    began = time.monotonic()
    got = [x for x in generate.windowed(iter(range(200)), work, 8) if x is not None]
    assert sorted(k for k, _ in got) == list(range(200)) and all(a == -b for a, b in got)
    assert time.monotonic() - began < 2.5  # draining 25 windows would take 6 s and more
    assert sorted(k for k, _ in seen) == list(range(200)) and sum(n >= 7 for _, n in seen[8:]) > 180


def test_requests_in_flight_across_batches_and_parts(spark, tmp_path):
    """One slow answer in ten, parts of 30, batches of 16: each task holds its share until its last scenario."""
    marks = tmp_path / "marks"
    marks.mkdir()

    def slow(settings):
        own = generate.stub_client(settings)

        def ask(messages):
            import os
            import uuid

            slow = int(generate.hashlib.sha1(messages[-1]["content"].encode()).hexdigest(), 16) % 10 == 0
            begun = time.time()
            time.sleep(0.8 if slow else 0.05)
            (marks / f"{os.getpid()}-{uuid.uuid4().hex}").write_text(json.dumps([begun, time.time()]))
            return own(messages)

        return ask

    settings = generate.replace(SETTINGS, count=240, concurrency=12, shard_size=30, max_parse_retries=1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        stats = generate.run(Sampler(spark, config.load(), 4), (tmp_path / "g").as_uri(), settings, slow)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert stats.ok + stats.failed == 240
    tasks = {}
    for name in marks.iterdir():
        tasks.setdefault(name.name.split("-")[0], []).append(json.loads(name.read_text()))
    assert len(tasks) == 2 and sum(map(len, tasks.values())) == 240
    for calls in tasks.values():
        calls.sort()
        last = calls[-1][0]
        at = [t for t in np.linspace(calls[5][0] + 0.05, last, 60)]
        flying = [sum(a <= t < b for a, b in calls) for t in at]
        assert np.mean(flying) > 5.2 and np.percentile(flying, 10) >= 4, flying  # of 6


def test_progress_within_a_part_and_after_a_resume(spark, tmp_path):
    out = (tmp_path / "run").as_uri()

    base = ["data", "generate", "--model", "stub", "--out", out, "--concurrency", "4", "--log-every", "0"]
    assert main([*base, "--count", "20"], spark) == 0
    log = tmp_path / "run" / "run.log"
    first = log.read_text().splitlines()
    assert "done=20/20 pct=100.0" in first[-1]
    assert main([*base, "--count", "40"], spark) == 0
    later = log.read_text().splitlines()[len(first) :]
    assert "done=20/40 pct=50.0 rate=0.00/s" in later[0] and "done=40/40 pct=100.0" in later[-1]

    def slow(settings):
        own = generate.stub_client(settings)
        return lambda messages: (time.sleep(0.2), own(messages))[1]

    told = []
    settings = generate.RunConfig(model="stub", count=120, concurrency=4, shard_size=1000, max_parse_retries=1)
    stats = generate.run(Sampler(spark, config.load(), 5), (tmp_path / "one").as_uri(), settings, slow, watch=told.append)
    counts = [s.ok + s.failed for s in told]
    assert stats.ok + stats.failed == 120 and counts == sorted(counts) and len({c for c in counts if 0 < c < 120}) >= 2, "several counts within the one part"


def test_clips_are_decoded_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def decode(data):
        seen.add(1)
        return audio.decode_wav(data)

    rows = [(f"s{k}", f"c{k}", tone(21, rate=800)) for k in range(40)]
    stats = voices.build(spark, [clips_source(rows)], (tmp_path / "v").as_uri(), target=40, decode=decode)
    assert stats.kept == 40 and seen.value == 40


def test_voice_progress_after_a_resume(spark, tmp_path):
    for k in range(3):
        (tmp_path / "mls").mkdir(exist_ok=True)
        rows = [{"speaker_id": f"s{k}-{j}", "original_path": f"c{j}", "audio_duration": 22.0, "audio": {"bytes": tone(22, rate=800), "path": None}} for j in range(4)]
        pq.write_table(pa.Table.from_pylist(rows), tmp_path / "mls" / f"{k}.parquet")
    out = (tmp_path / "v").as_uri()
    from skyphrase.sources import registry

    base = ["voices", "build", "--out", out, "--sources", "mls-eng", "--mls", (tmp_path / "mls").as_uri(), "--log-every", "0"]
    try:
        assert main([*base, "--target", "4"], spark) == 0
        registry.unregister("mls-eng")
        assert main([*base, "--target", "8"], spark) == 0
        registry.unregister("mls-eng")
        assert main([*base, "--target", "9", "--seed", "7"], spark) == 2, "a pool of another seed"
    finally:
        registry.unregister("mls-eng")
    lines = [x for x in (tmp_path / "v" / "run.log").read_text().splitlines() if "done=" in x]
    rate = float(lines[-1].split("rate=")[1].split("/s")[0])
    assert "done=8/8 pct=100.0" in lines[-1] and rate > 0
    later = [x for x in lines if "/8 " in x]
    assert all(float(x.split("rate=")[1].split("/s")[0]) < 50 for x in later)


def chunked(*chunks, seconds=10, rate=800):
    raw = np.zeros(seconds * rate, dtype="<i2").tobytes()
    body = b"WAVE" + b"fmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, 2 * rate, 2, 16)
    for n in chunks:
        body += b"LIST" + struct.pack("<I", n) + bytes(n + n % 2)
    body += b"data" + struct.pack("<I", len(raw)) + raw
    return b"RIFF" + struct.pack("<I", len(body)) + body


def test_headers_with_any_chunks_before_the_samples(spark):
    flac = b"fLaC" + b"\x80\x00\x00\x22" + bytes(10) + ((44100 << 44) | (1 << 41) | (15 << 36) | ((1 << 35) + 5)).to_bytes(8, "big") + bytes(16)
    clips = [chunked(), chunked(8000), chunked(5001, 0, 3), chunked(*[1] * 300), chunked(*[0] * 3000), chunked(70_000), chunked(8000)[:9000], chunked(8000)[:5000], b"RIFF____WAVE", b"RIFF____WAVEfmt ", b"fLaC", flac, b"", None]
    clips.append(b"RIFF" + bytes(4) + b"WAVE" + b"data" + struct.pack("<I", 4) + bytes(4))  # samples before any format
    clips.append(chunked()[:30] + b"\0\0" + chunked()[32:])
    df = spark.createDataFrame(list(enumerate(clips)), "k int, b binary").repartition(3)
    got = df.select("k", audio.clip_seconds(F.col("b")).alias("s"))
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    found = {r["k"]: r["s"] for r in got.collect()}

    def plain(data):
        if data is None:
            return None
        if data[:4] == b"fLaC":
            bits = int.from_bytes(data[18:26], "big") if len(data) >= 26 else 0
            return (bits & (1 << 36) - 1) / (bits >> 44) if bits >> 44 and bits & (1 << 36) - 1 else None
        layout = audio.wav_layout(data, len(data))
        return layout and layout[5] // (layout[1] * ((layout[3] + 7) // 8)) / layout[2]

    assert found == {k: plain(b) for k, b in enumerate(clips)}
    assert [found[k] for k in range(6)] == [10.0] * 6 and found[6] is not None and found[7] is None


def test_clip_behind_a_long_chunk_is_kept(spark):
    rows = [(0, "a", "x", "t", (chunked(8000, seconds=12), None)), (1, "a", "y", "t", (chunked(seconds=5), None))]
    df = spark.createDataFrame(rows, "ord long, speaker_id string, id string, text_normalized string, audio struct<bytes binary, path string>")
    assert [r["id"] for r in corpora.longest_clips(df).collect()] == ["x"]


def test_numbers_come_from_the_listing(spark, tmp_path, monkeypatch):
    for split, files in (("b one", 3), ("a", 2)):
        (tmp_path / split).mkdir()
        for k in range(files):
            pq.write_table(pa.table({"k": [f"{split}-{k}-{j}" for j in range(5)]}), tmp_path / split / f"f{k}.parquet")
    ran = []
    frame = type(spark.range(1))
    for name in ("collect", "count", "first", "toLocalIterator"):
        monkeypatch.setattr(frame, name, lambda self, *a, **k: ran.append(1))
    got = corpora.numbered(spark, [f"file://{tmp_path}/b one", str(tmp_path / "a")])
    assert not ran, "nothing is read"
    monkeypatch.undo()
    assert [(r["ord"] >> 32, r["ord"] & 0xFFFFFFFF, r["k"]) for r in got.orderBy("ord").collect()] == [
        (place, j, f"{split}-{k}-{j}") for place, (split, k) in enumerate([("b one", 0), ("b one", 1), ("b one", 2), ("a", 0), ("a", 1)]) for j in range(5)
    ]


class Server(http.server.BaseHTTPRequestHandler):
    """Files by path, in ranges; counts what is sent of each, and fails every seventh time."""

    files: dict = {}
    sent: dict = {}
    asked = [0]

    def answer(self, body):
        data = self.files.get(self.path)
        self.asked[0] += 1
        if self.asked[0] % 7 == 0:
            self.send_error(503)
            return
        if data is None:
            self.send_error(404)
            return
        span = self.headers.get("Range")
        if span:
            a, b = span.removeprefix("bytes=").split("-")
            part = data[int(a) : int(b) + 1]
        else:
            part = data
        self.send_response(206 if span else 200)
        self.send_header("Content-Length", str(len(part)))
        self.end_headers()
        if body:
            self.sent[self.path] = self.sent.get(self.path, 0) + len(part)
            self.wfile.write(part)

    def do_GET(self):
        self.answer(True)

    def do_HEAD(self):
        self.answer(False)

    def log_message(self, *args):
        pass


@pytest.fixture
def server():
    Server.files, Server.sent = {}, {}
    own = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=own.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{own.server_address[1]}"
    own.shutdown()


def hosted(address, files):
    """files: lists of (speaker, seconds, bytes); two rows to a row group."""
    for k, rows in enumerate(files):
        table = pa.table({
            "speaker_id": pa.array([s for s, _, _ in rows]), "original_path": pa.array([f"c{k}-{j}" for j in range(len(rows))]), "audio_duration": pa.array([d for _, d, _ in rows], pa.float64()),
            "audio": pa.array([{"bytes": b, "path": None} for _, _, b in rows], pa.struct([("bytes", pa.binary()), ("path", pa.string())])),
        })
        out = io.BytesIO()
        pq.write_table(table, out, row_group_size=2, compression="none", use_dictionary=False)
        Server.files[f"/{k}.parquet"] = out.getvalue()
    Server.files["/list.json"] = json.dumps([f"{address}/{k}.parquet" if k % 2 else {"url": f"{address}/{k}.parquet"} for k in range(len(files))]).encode()
    return f"{address}/list.json"


def test_remote_clips_fetch_no_rejected_bytes(spark, server):
    noise = lambda n: np.random.default_rng(n).bytes(200_000)
    listing = hosted(server, [[("a", 9.0, noise(1)), ("b", 1.0, noise(2)), ("c", 2.0, noise(3)), ("d", 40.0, noise(4))], [("e", None, noise(5)), ("f", 35.0, noise(6))], [("g", 3.0, noise(7)), ("h", 7.99, noise(8))]])
    got = sorted(remote.remote_clips(spark, listing, (8.0, 35.0)).collect(), key=lambda r: r["ord"])  # one scan
    assert [(r["ord"] >> 32, r["ord"] & 0xFFFF, r["speaker_id"]) for r in got] == [(0, 0, "a"), (1, 0, "e"), (1, 1, "f")]
    assert [r["audio"]["bytes"] for r in got] == [noise(1), noise(5), noise(6)] and got[0]["transcript"] is None
    assert Server.sent["/2.parquet"] < 100_000, "no row group of the third file has a clip that passes"
    assert Server.sent["/0.parquet"] < 500_000, "the second row group's audio isn't fetched"
    before = dict(Server.sent)
    assert remote.remote_clips(spark, listing, audio=False).where("audio.bytes is null").count() == 8
    assert all(Server.sent[k] - before[k] < 100_000 for k in ("/0.parquet", "/1.parquet", "/2.parquet"))


def test_remote_clips_take_filters(spark, server):
    listing = hosted(server, [[("a", 9.0, b"x" * 150_000), ("b", 10.0, b"y")], [("c", 3.0, b"z" * 150_000), ("d", None, b"w")]])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = remote.remote_clips(spark, listing).where("audio_duration >= 9.5 AND speaker_id IN ('b', 'c')")
        assert [r["speaker_id"] for r in got.collect()] == ["b"] and Server.sent["/1.parquet"] < 100_000
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert [r["speaker_id"] for r in remote.remote_clips(spark, listing).where("audio_duration < 9.5").orderBy("ord").collect()] == ["a", "c"]
    with pytest.raises(Exception, match="404"):
        remote.remote_clips(spark, f"{server}/none.json").collect()


def test_voices_from_a_remote_source(spark, server, tmp_path):
    listing = hosted(server, [[("a", 22.0, tone(22, rate=800)), ("b", 5.0, tone(5, rate=800))], [("c", None, tone(25, rate=800)), ("a", 23.0, tone(23, rate=800))]])
    stats = voices.build(spark, [corpora.mls(listing)], (tmp_path / "v").as_uri(), target=5)
    assert stats == voices.Stats(kept=2, skipped=0, unreadable=0)


def test_intermediates_have_an_owner(spark):
    local = Folder(spark, shared_dir(spark))
    before = set(local.names())

    def other():
        select.written(spark.range(3))

    with owned():
        kept = select.written(spark.range(5))
        thread = threading.Thread(target=other)
        thread.start()
        thread.join()
        assert kept.count() == 5 and len(set(local.names()) - before) == 2
    (left,) = set(local.names()) - before  # the other thread's, which has no owner
    local.drop(left)


def test_generated_folders_are_not_the_drivers(spark, tmp_path):
    """A pickled folder works without a session."""
    from pyspark import cloudpickle

    own = cloudpickle.loads(cloudpickle.dumps(Folder(spark, f"file://{tmp_path}/x y")))
    own.put("a/b.txt", b"1")
    assert own.spark is None and own.get("a/b.txt") == b"1" and own.names(deep=True) == ["a/b.txt"] and own.digest("a/b.txt")[0] == 1 and (tmp_path / "x y" / "a" / "b.txt").exists()


def test_airports_of_ones_own(spark, tmp_path, capsys):
    (tmp_path / "ports.csv").write_text("icao,country\nQAAA,US\nQBBB,US\nbad1,US\nQCCC,FR\n")
    own = ["data", "sample", "-n", "20", "--airports", (tmp_path / "ports.csv").as_uri()]
    assert main([*own, "--weighter", "uniform"], spark) == 0
    assert {json.loads(x)["icao"] for x in capsys.readouterr().out.splitlines()} == {"QAAA", "QBBB"}
    (tmp_path / "w.csv").write_text("icao,weight\nQAAA,1\nQCCC,1\n")
    assert main([*own, "--weighter", "custom", "--airports-weights", (tmp_path / "w.csv").as_uri()], spark) == 0
    assert {json.loads(x)["icao"] for x in capsys.readouterr().out.splitlines()} == {"QAAA"}


def test_fingerprints_in_rows_and_by_hand(spark):
    from skyphrase.functions import ids

    rows = [("m", 1, ["us", "canada"]), ("n", -5, ["us"])]
    df = spark.createDataFrame(rows, "model string, seed long, regions array<string>")
    fixed = {k: F.lit(v) for k, v in (("prompt_version", "p"), ("taxonomy_version", "t"), ("weighter_name", "w"), ("config_name", "c"))}
    got = [r[0] for r in df.select(ids.fingerprints({"model": F.col("model"), "seed": F.col("seed"), "regions": F.col("regions"), **fixed})).collect()]
    assert got == [ids.fingerprint(m, s, "p", "t", "w", r, "c") for m, s, r in rows]
    base = generate.RunConfig(model="m", count=1)
    others = [generate.replace(base, temperature=0.1), generate.replace(base, max_tokens=9), generate.replace(base, config_contents="x"), generate.replace(base, seed=1)]
    assert len({c.fingerprint() for c in [base, *others]}) == 5 and generate.replace(base, count=7, concurrency=1).fingerprint() == base.fingerprint()


def test_lines_from_inside_a_job(spark):
    from skyphrase.progress import watched

    lines = []
    slow = F.udf(lambda k: (time.sleep(0.4), k)[1], "long")
    with watched(spark, lines.append, 0.3):
        spark.range(0, 12, 1, 12).select(slow("id").alias("k")).agg(F.sum("k")).collect()
    done = [int(x.split("tasks=")[1].split("/")[0]) for x in lines if "/12" in x or "/13" in x]
    assert len(set(done)) >= 2 and done == sorted(done), lines
    many = len(lines)
    time.sleep(0.7)
    assert len(lines) == many


def test_replay_tells_counts_meanwhile(spark, tmp_path):
    out, sampler = (tmp_path / "g").as_uri(), Sampler(spark, config.load(), 3)
    first = generate.run(sampler, out, SETTINGS, generate.stub_client)

    def better(settings):
        def ask(messages):
            time.sleep(0.5)
            focal = messages[-1]["content"].split("Focal aircraft: ")[1].split(" (")[0]
            return f"ATC: {focal}, go.\n{focal}: Going.\nATC: Bye.\n{focal}: Bye."

        return ask

    told, ended = [], []
    assert first.failed > 2
    again = generate.rerun(spark, out, generate.replace(SETTINGS, concurrency=1), better, ended.append, told.append)
    assert again == generate.Stats(first.failed, 0) and ended == [again] and told[-1].ok == first.failed
    sink = generate.open_sink(spark, out, SETTINGS)
    assert sink.existing().select("scenario_id").distinct().count() == 60 and generate.recorded(sink) is None
