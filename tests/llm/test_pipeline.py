import hashlib

import pytest

import corpus_pipeline
from skyphrase.llm import common, pii
from skyphrase.llm.common import shared_dir, table

from .helpers import awkward, documents
from .test_decontaminate import brute as leaks
from .test_near_dup import brute as near
from .test_pii import brute as base

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_on_its_own_input(spark, tmp_path):
    """Each stage's output against a plain version of its decision on what the stage before it wrote."""
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    kept = [docs.collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = (tmp_path / str(k)).as_uri()
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        if k < 4:
            assert docs.columns == COLUMNS
        kept.append(docs.collect())
    ids = [{r["doc_id"] for r in rows} for rows in kept]
    quality = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    assert ids[1] < ids[0] and all(d in ids[1] for d, q in quality.items() if q == 1 and d in ids[0]) and not any(d in ids[1] for d, q in quality.items() if q == 0)
    rows = [(r["doc_id"], r["text"]) for r in kept[1]]
    assert ids[2] == {d for d, _, _, keep in near(rows) if keep}
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    held = {d for d, *_ in leaks([(r["doc_id"], r["text"]) for r in kept[2]], items)}
    assert held and ids[3] == ids[2] - held
    assert ids[4] == ids[3] == ids[5]
    before = {r["doc_id"]: r["text"] for r in kept[3]}
    for r in kept[4]:
        assert r["n_chars"] == len(r["text"])
        if base(before[r["doc_id"]]):
            assert not base(r["text"]) and "[" in r["text"]
        elif not any(c.isdigit() or c == "@" for c in before[r["doc_id"]]):
            assert r["text"] == before[r["doc_id"]]
    masked = {r["doc_id"]: r["text"] for r in kept[4]}
    assert all(r["decoded_sha256"] == hashlib.sha256(masked[r["doc_id"]].encode()).hexdigest() and r["exact"] for r in kept[5])
    assert pii.mask("a 1 b", [(3, 2, 3)]) == "a [PHONE] b"


def test_run_is_the_stages_one_after_the_other(spark):
    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    assert "n_tokens" in out.columns and 0 < out.count() < table(spark, sf, "documents").count()


def folders(spark):
    """What lies in the session's shared folder."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    return {x.getPath().getName() for x in top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(top)}


def test_run_leaves_the_last_stage_only(spark, tmp_path):
    before = folders(spark)
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    new = folders(spark) - before
    assert len(new) == 1 and out.count() > 0
    (name,) = new
    left = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    assert [x.getPath().getName() for x in left.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(left)] == ["4-byte_bpe"]


def tables(spark, folder, rows, labels, items):
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, (tmp_path / "none").as_uri(), [], [], [])).count() == 0
    rows = [r[:2] for r in awkward()]
    out = corpus_pipeline.run(spark, tables(spark, (tmp_path / "odd").as_uri(), rows, [], [])).collect()
    kept = {(d, t) for (d, t), (_, _, _, keep) in zip(rows, near(rows), strict=True) if keep}
    assert len(out) == len(kept) + sum(r == (None, None) for r in rows) - 1


def test_texts_are_not_shuffled_for_ids_or_sites(spark, tmp_path):
    """Without broadcasts by Spark's own choice, the joins of whole texts still leave them in place, by a checked size."""
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for stage in (corpus_pipeline.keep_good, corpus_pipeline.drop_near_copies):
            plan = stage(spark, docs, sf)._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        with pytest.MonkeyPatch.context() as patch:  # beyond the bound: rows by file, neither a shuffle nor a broadcast
            patch.setattr(common, "BROADCAST_ROWS", 3)
            far = corpus_pipeline.drop_near_copies(spark, docs, sf)
            plan = far._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan and "hashpartitioning" not in plan
            ids = {r["doc_id"] for r in far.collect()}
        assert ids == {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, sf).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), {}

    Session.conf = type("Conf", (), {"get": lambda self, key, default=None: default})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {"pipeline", *(f"op{n}" for n in range(1, 11))} <= {n.split("_")[0] for n in names}
    assert set(__spark_entry__.oracle_sql()) <= set(names)
