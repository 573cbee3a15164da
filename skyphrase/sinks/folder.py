"""A folder that driver and tasks reach alike: small files put in one step, listings, moves.

Paths are qualified once, on the driver, by Hadoop's configuration; files are then read and written through pyarrow's
file systems (local, HDFS, S3, GCS), so tasks need no JVM.  ``opener`` replaces the file system of a path by one's own.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Callable

from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession

Opener = Callable[[str], tuple[arrow_fs.FileSystem, str]]


def located(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return ("file://" + whole[len("file:") :] if whole.startswith("file:/") and not whole.startswith("file://") else whole).rstrip("/")


def opened(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path and the path in it.  Local paths are taken as they are, as Spark does, not as encoded."""
    return (arrow_fs.LocalFileSystem(), path[len("file://") :]) if path.startswith("file://") else arrow_fs.FileSystem.from_uri(path)


class Folder:
    """``spark`` may be None for a path that is qualified already; a pickled folder is without its session."""

    def __init__(self, spark: SparkSession | None, path: str, opener: Opener | None = None):
        self.spark, self.opener = spark, opener
        self.path = located(spark, path) if spark is not None else path.rstrip("/")
        self._found: tuple[arrow_fs.FileSystem, str] | None = None

    def __getstate__(self) -> dict:
        return {"spark": None, "path": self.path, "opener": self.opener, "_found": None}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)

    @property
    def fs(self) -> arrow_fs.FileSystem:
        if self._found is None:
            self._found = (self.opener or opened)(self.path)
        return self._found[0]

    def at(self, name: str = "") -> str:
        self.fs  # noqa: B018  opens the file system
        return f"{self._found[1]}/{name}" if name else self._found[1]

    def sub(self, name: str) -> Folder:
        return Folder(None, f"{self.path}/{name}", self.opener)

    def exists(self, name: str = "") -> bool:
        return self.fs.get_file_info(self.at(name)).type != arrow_fs.FileType.NotFound

    def size(self, name: str) -> int:
        return self.fs.get_file_info(self.at(name)).size

    def names(self, prefix: str = "", deep: bool = False) -> list[str]:
        """Names in the folder that begin so, sorted; with ``deep`` those of all files below it, as paths from here."""
        top = self.at()
        found = self.fs.get_file_info(arrow_fs.FileSelector(top, allow_not_found=True, recursive=deep))
        names = [f.path[len(top) :].lstrip("/") for f in found if not deep or f.type == arrow_fs.FileType.File]
        return sorted(n for n in names if n.startswith(prefix))

    def get(self, name: str) -> bytes:
        with self.fs.open_input_stream(self.at(name), compression=None) as source:
            return source.read()

    def put(self, name: str, data: bytes) -> None:
        """Put in the old file's place in one step: a reader sees the old file or the new one.  A store without renames is
        taken for one whose files appear once they are closed, as those of object stores do."""
        self.fs.create_dir(self.at(name).rpartition("/")[0], recursive=True)
        if not self._renames():
            with self.fs.open_output_stream(self.at(name), compression=None) as out:
                out.write(data)
            return
        head, _, tail = name.rpartition("/")
        aside = f"{head}/.{tail}.{uuid.uuid4().hex}".lstrip("/")
        with self.fs.open_output_stream(self.at(aside), compression=None) as out:
            out.write(data)
        if isinstance(self.fs, arrow_fs.HadoopFileSystem) and self.exists(name):
            self.fs.delete_file(self.at(name))
        self.fs.move(self.at(aside), self.at(name))

    def _renames(self) -> bool:
        return isinstance(self.fs, (arrow_fs.LocalFileSystem, arrow_fs.HadoopFileSystem))

    def read(self, name: str) -> str:
        return self.get(name).decode()

    def write(self, name: str, text: str) -> None:
        self.put(name, text.encode())

    def move(self, old: str, new: str) -> None:
        """A file or folder to a new name; one that breaks off can be repeated.  OSError if the new name is taken."""
        if self.exists(new):
            raise OSError(f"{old} couldn't be renamed to {new} in {self.path}: there is one")
        if self._renames():
            self.fs.move(self.at(old), self.at(new))
        elif self.fs.get_file_info(self.at(old)).type == arrow_fs.FileType.Directory:
            for name in self.sub(old).names(deep=True):
                self.put(f"{new}/{name}", self.get(f"{old}/{name}"))
            self.drop(old)
        else:
            self.fs.copy_file(self.at(old), self.at(new))
            self.drop(old)

    def rename(self, old: str, new: str) -> None:
        self.move(old, new)

    def drop(self, name: str = "") -> None:
        kind = self.fs.get_file_info(self.at(name)).type
        if kind == arrow_fs.FileType.Directory:
            self.fs.delete_dir(self.at(name))
        elif kind == arrow_fs.FileType.File:
            self.fs.delete_file(self.at(name))

    def digest(self, name: str) -> tuple[int, str]:
        """Length and SHA-256 of a file, read in blocks."""
        total, size = hashlib.sha256(), 0
        with self.fs.open_input_stream(self.at(name), compression=None) as source:
            while block := source.read(1 << 20):
                total.update(block)
                size += len(block)
        return size, total.hexdigest()


class Digesting(io.RawIOBase):
    """An output stream that digests what passes."""

    def __init__(self, out):
        super().__init__()
        self.out, self.total, self.size = out, hashlib.sha256(), 0

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        held = bytes(data)
        self.out.write(held)
        self.total.update(held)
        self.size += len(held)
        return len(held)

    def tell(self) -> int:
        return self.size
