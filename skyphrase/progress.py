"""Progress lines at most every few seconds: count, rate, time left, share done."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import InheritableThread
from pyspark.sql import SparkSession

from .sinks.folder import Folder
from .sinks.shards import now_iso


class Progress:
    """``started_at`` rows were there before, and count toward the share but not the rate."""

    def __init__(self, total: int, write: Callable[[str], None] = print, every: float = 5.0, started_at: int = 0, clock: Callable[[], float] = time.monotonic):
        self.total, self.write, self.every, self.start, self.clock = total, write, every, started_at, clock
        self.began = clock()
        self.last = self.began - every

    def log(self, done: int, force: bool = False, **extras) -> bool:
        now = self.clock()
        if not force and now - self.last < self.every:
            return False
        self.last = now
        rate = (done - self.start) / max(now - self.began, 1e-9)
        left = max(0, self.total - done) / rate if rate > 0 else 0.0
        share = 100 * done / self.total if self.total else 100.0
        more = "".join(f" {k}={v}" for k, v in extras.items())
        self.write(f"done={done}/{self.total} pct={share:.1f} rate={rate:.2f}/s eta={left:.0f}s{more}")
        return True


@contextmanager
def watched(spark: SparkSession, write: Callable[[str], None], every: float = 5.0) -> Iterator[None]:
    """Lines about the tasks of the jobs that run meanwhile, every so many seconds, from Spark's own status."""
    ended = threading.Event()
    tracker = spark.sparkContext.statusTracker()

    def look() -> None:
        while not ended.wait(every):
            jobs = [j for j in map(tracker.getJobInfo, tracker.getActiveJobsIds()) if j is not None]
            stages = [x for x in (tracker.getStageInfo(k) for j in jobs for k in j.stageIds) if x is not None]
            if stages:
                write(f"running tasks={sum(x.numCompletedTasks for x in stages)}/{sum(x.numTasks for x in stages)} jobs={len(jobs)}")

    thread = InheritableThread(target=look, daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()


def log_file(spark, path: str) -> Callable[[str], None]:
    """A ``write`` that adds each line, after its time, to a file; where the file system can't add to files, the lines of this
    run are written as a whole each time."""
    folder, _, name = path.rpartition("/")
    own = Folder(spark, folder or ".")
    kept: list[str] | None = None

    def write(line: str) -> None:
        nonlocal kept
        text = f"{now_iso()} {line}\n"
        if kept is None:
            try:
                own.fs.create_dir(own.at(), recursive=True)
                with own.fs.open_append_stream(own.at(name), compression=None) as out:
                    out.write(text.encode())
                return
            except (NotImplementedError, OSError):
                kept = [own.read(name)] if own.exists(name) else []
        kept.append(text)
        own.write(name, "".join(kept))

    return write
