"""Row lists by file: which rows of a table of files are meant, read by the very tasks that scan those files.

Whole texts don't travel to meet a long list of ids.  The ids are joined to the narrow rows (id, file, place in the
file) of the table, and the places written, a folder for each file; a scan task then reads the list of its own file,
which is no longer than the file has rows.  This serves tables that are read straight from Parquet files, with columns
chosen and rows filtered; ``placed`` says None of others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.folder import Folder, located
from . import common
from .common import Scratch, col, sized

PLACE = ("_f", "_r")


def placed(df: DataFrame) -> DataFrame | None:
    """``df`` with _f, a name for each row's file, and _r, the row's place in it; None where rows aren't those of files."""
    node = df._jdf.queryExecution().analyzed()
    while node.children().size() == 1 and node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().apply(0)
    if node.children().size() or "Relation" not in node.nodeName():
        return None
    try:
        return df.select("*", F.md5(F.col("_metadata.file_path").cast("binary")).alias("_f"), F.col("_metadata.row_index").alias("_r"))
    except AnalysisException:
        return None


class Lists:
    """Written row lists; pickled into tasks, which hold the list of one file at a time."""

    def __init__(self, folder: Folder):
        self.folder, self.name, self.rows = folder, None, np.zeros(0, dtype=np.int64)

    def _load(self, name: str) -> np.ndarray:
        if name != self.name:
            own = self.folder.sub(f"f={name}")
            parts = [np.zeros(0, dtype=np.int64)]
            for file in own.names("part-"):
                with own.fs.open_input_file(own.at(file)) as source:
                    parts.append(pq.read_table(source, columns=["r"]).column("r").to_numpy())
            self.name, self.rows = name, np.sort(np.concatenate(parts))
        return self.rows

    def holds(self, batch: pa.RecordBatch) -> np.ndarray:
        """Which rows of a batch (_f, _r, ...) are listed."""
        place = col(batch, "_r").to_numpy(zero_copy_only=False)
        files = col(batch, "_f").dictionary_encode()
        which, out = files.indices.to_numpy(zero_copy_only=False), np.zeros(len(place), dtype=bool)
        for k, name in enumerate(files.dictionary.to_pylist()):
            rows, own = self._load(name), which == k
            if len(rows):
                at = np.minimum(np.searchsorted(rows, place[own]), len(rows) - 1)
                out[own] = rows[at] == place[own]
        return out


def written_lists(rows: DataFrame, scratch: Scratch) -> Lists:
    """The lists of rows (_f, _r)."""
    scratch.count += 1
    path = f"{scratch.top}/lists-{scratch.count}"
    named = rows.select(F.col("_f").alias("f"), F.col("_r").alias("r")).distinct()
    named.repartition("f").sortWithinPartitions("f", "r").write.partitionBy("f").parquet(path)
    return Lists(Folder(None, located(scratch.spark, path)))


def listed(table: DataFrame, key: str, wanted: DataFrame, scratch: Scratch) -> Lists:
    """The lists of a placed table's rows whose ``key`` is in the one column of ``wanted``; only keys and places are moved."""
    (name,) = wanted.columns
    keys = wanted.select(F.col(name).alias("_wanted"))
    return written_lists(table.select(F.col(key).alias("_key"), *PLACE).join(keys, F.col("_key") == F.col("_wanted"), "left_semi"), scratch)


def without_place(batch: pa.RecordBatch) -> pa.RecordBatch:
    return batch.select([c for c in batch.schema.names if c not in PLACE])


def filtered(df: DataFrame, table: DataFrame, lists: Lists, keep: bool) -> DataFrame:
    """The rows of ``df``, whose placed form is ``table``, that are listed (``keep``) or that aren't; names of columns are
    plain ones, or shielded."""

    def run(batches):
        for batch in batches:
            own = lists.holds(batch)
            yield without_place(batch.filter(pa.array(own if keep else ~own)))

    return table.mapInArrow(run, df.schema)


def among(df: DataFrame, key: str, wanted: DataFrame, scratch: Scratch, keep: bool = True) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in the one column of ``wanted``, a written table of distinct keys (or, without
    ``keep``, the others, null keys included).  Few keys are broadcast, more are listed by file; only where rows aren't
    those of files are they shuffled to meet the keys."""
    (name,) = wanted.columns
    narrow = sized(wanted)
    table = None if wanted.count() <= common.BROADCAST_ROWS else placed(df)
    if table is None:
        return df.join(narrow, df[key] == narrow[name], "left_semi" if keep else "left_anti")
    return filtered(df, table, listed(table, key, wanted, scratch), keep)
