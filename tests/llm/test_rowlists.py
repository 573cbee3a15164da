"""Operators beyond the bounds of their broadcasts: rows are listed by file, and no text is shuffled."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyphrase.llm import common, decontaminate, near_dup, quality_rules, rowlists
from skyphrase.llm.common import Scratch

from .helpers import awkward, documents, prose


@pytest.fixture
def docs(spark, tmp_path):
    rng = random.Random(5)
    rows = [r[:2] for r in awkward()] + [(100 + k, prose(rng, 40)) for k in range(60)]
    rows += [(300 + k, rows[20 + k % 9][1] + " tail") for k in range(30)] + [(100, prose(rng, 12)), (101, rows[21][1])]
    rng.shuffle(rows)
    documents(spark, rows, extra=True).repartition(7).write.parquet(f"{tmp_path}/docs")
    return spark.read.parquet(f"{tmp_path}/docs")


def rows_of(df):
    return sorted(map(str, df.collect()))


def text_shuffles(df):
    """Exchanges of the plan that carry a text."""
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(k) for k in range(node.children().size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.inputPlan())
        if "Exchange" in node.nodeName() and "text#" in node.output().toString():
            found += 1
    return found


def test_lists_of_any_rows(spark, docs):
    docs = docs.select("doc_id", "text", "lang")
    table = rowlists.placed(docs)
    assert table is not None and table.select("_f").distinct().count() > 1
    for wanted in ([], [100], [100, 101, 150, 301, 9999], list(range(0, 400))):
        scratch = Scratch(spark)
        keys = scratch.write(spark.createDataFrame([(k,) for k in wanted], "k long"))
        lists = rowlists.listed(table, "doc_id", keys, scratch)
        for keep in (True, False):
            plain = docs.where(F.col("doc_id").isin(wanted)) if keep else docs.where(F.col("doc_id").isNull() | ~F.col("doc_id").isin(wanted))
            assert rows_of(rowlists.filtered(docs, table, lists, keep)) == rows_of(plain)
        scratch.release()


def test_only_rows_of_files_have_places(spark, docs):
    assert rowlists.placed(docs.where("doc_id > 3").select("doc_id", "text")) is not None
    assert rowlists.placed(spark.range(3)) is None and rowlists.placed(docs.join(docs.select("doc_id"), "doc_id")) is None
    assert rowlists.placed(docs.groupBy("doc_id").count()) is None and rowlists.placed(docs.unionByName(docs)) is None


def test_near_duplicates_beyond_the_bound(spark, docs, monkeypatch):
    plain, left = rows_of(near_dup.near_duplicates(docs)), rows_of(near_dup.distinct_documents(docs))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 3)
    assert rows_of(near_dup.near_duplicates(docs)) == plain
    got = near_dup.distinct_documents(docs)
    assert rows_of(got) == left and got.columns == docs.columns
    # rows that share a doc_id are told apart by their words, one of each: only these few meet in a shuffle
    assert text_shuffles(got) <= 1


def test_quality_beyond_the_bound(spark, docs, monkeypatch):
    trusted = docs.where("doc_id % 3 = 0").select("doc_id")
    scratch = Scratch(spark)
    ids = scratch.write(trusted.where("doc_id is not null").distinct())
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tables = quality_rules.marked(narrow, ids, ids.count(), 3, scratch)
    assert len(tables) == 1 and text_shuffles(tables[0]) == 0, "one pass to count, whatever the ids"
    assert rows_of(tables[0]) == rows_of(narrow.select("text", F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False)).alias("trusted")))
    assert np.array_equal(quality_rules.fit(narrow, trusted, 3), quality_rules.fit(narrow, trusted))
    shuffled = narrow.repartition(3)  # not the rows of files any more: ranges, as before
    assert len(quality_rules.marked(shuffled, ids, ids.count(), 20, scratch)) > 1
    assert np.array_equal(quality_rules.fit(shuffled, trusted, 20), quality_rules.fit(narrow, trusted))
    scratch.release()


def test_decontamination_in_blocks(spark, docs):
    items = docs.where("doc_id % 5 = 0 and doc_id > 100").select(F.col("doc_id").alias("item_id"), "text")
    whole = decontaminate.uncontaminated(docs, items)
    pieces = decontaminate.uncontaminated(docs, items, block_bytes=8000)
    assert rows_of(whole) == rows_of(pieces) and pieces.columns == docs.columns and whole.count() < docs.count()
    assert text_shuffles(pieces) == 0
    assert rows_of(decontaminate.uncontaminated(docs.repartition(3), items, block_bytes=8000)) == rows_of(whole)


def test_empty_tables(spark, docs, monkeypatch, tmp_path):
    docs.limit(0).write.parquet(f"{tmp_path}/none")
    none = spark.read.parquet(f"{tmp_path}/none")
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert near_dup.distinct_documents(none).count() == 0 and near_dup.near_duplicates(none).count() == 0
