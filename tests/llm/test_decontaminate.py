import random

from skyphrase.llm import decontaminate
from skyphrase.llm.queries import op7_decontamination

from ..compare import duck, same
from .helpers import awkward, documents, prose
from .test_near_dup import shingles

ITEM = "item_id long, text string"


def brute(docs, items):
    out = []
    for d, text in docs:
        own = shingles(text)
        for i, q in items:
            want = shingles(q)
            if want and 100 * len(own & want) >= 75 * len(want):
                out.append((d, i, len(want), len(own & want)))
    return out


def key(rows):
    return sorted(rows, key=lambda r: tuple(-1 if x is None else x for x in r))


def case(seed=1):
    rng = random.Random(seed)
    items = [(k, prose(rng, rng.choice([5, 9, 15, 40, 70, 150, 400]))) for k in range(30)] + [(30, None), (31, ""), (32, "one two three"), (None, prose(rng, 20))]
    docs = [r[:2] for r in awkward()] + [(100, "one two three"), (101, "zero one two three")]
    for k, (_, text) in enumerate(items[:28]):
        words = text.split()
        part = words[: max(5, int(len(words) * rng.choice([1, 1, 0.8, 0.5])))]
        docs.append((200 + k, prose(rng, rng.choice([0, 30, 3000])) + " " + " ".join(part).upper() + " " + prose(rng, 20)))
        edited = list(words)
        edited[rng.randrange(len(edited))] = "changed"
        docs.append((300 + k, prose(rng, 200) + " " + " ".join(edited)))
    docs.append((400, items[3][1] + " " + items[5][1]))
    docs.append((None, items[2][1]))
    docs.append((200, docs[-1][1]))
    return docs, items + [items[0]]


def test_against_brute_force(spark):
    docs, items = case()
    wanted = key(brute(docs, items))
    assert len(wanted) > 40
    for block in (decontaminate.BLOCK_BYTES, 20_000):
        out = decontaminate.contamination(documents(spark, docs, extra=True), spark.createDataFrame(items, ITEM), block_bytes=block)
        assert key([(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in out.collect()]) == wanted
        assert all(r["containment"] == r["n_shared"] / r["n_item"] for r in out.collect())


def test_stage_drops_what_holds_an_item(spark):
    docs, items = case(2)
    bad = {(d, i) for d, i, _, _ in brute(docs, items)}
    left = decontaminate.uncontaminated(documents(spark, docs, extra=True), spark.createDataFrame(items, ITEM))
    hit = {d for d, _ in bad if d is not None}
    assert {r["doc_id"] for r in left.collect()} == {d for d, t in docs if not brute([(d, t)], items)} and hit
    assert left.columns == documents(spark, [], extra=True).columns


def test_ids_of_any_type(spark):
    import datetime
    import decimal

    text = prose(random.Random(5), 40)
    docs = documents(spark, [(1, "before " + text)])
    for kind, value in (("short", 7), ("int", 8), ("string", "a"), ("decimal(5,1)", decimal.Decimal("1.5")), ("date", datetime.date(2024, 1, 2)), ("binary", b"x"), ("struct<a:int,b:string>", (1, "z"))):
        items = spark.createDataFrame([(value, text), (None, text)], f"item_id {kind}, text string")
        got = decontaminate.contamination(docs, items).collect()
        assert sorted(str(r["item_id"]) for r in got) == sorted([str(value) if kind[:6] != "struct" else "Row(a=1, b='z')", "None"]) if kind != "binary" else {bytes(r["item_id"]) if r["item_id"] else None for r in got} == {b"x", None}


def test_many_short_items_in_blocks_of_bounded_size(spark):
    """100,000 items of five words: no index is larger than its bound, and each item's document is found once."""
    rng = random.Random(6)
    items = [(k, f"w{k} " + prose(rng, 4)) for k in range(100_000)]
    picked = rng.sample(items, 60)
    docs = documents(spark, [(k, prose(rng, 30) + " " + t + " " + prose(rng, 30)) for k, t in picked])
    sizes = []
    for index in decontaminate.indexes(spark.createDataFrame(items, ITEM)):
        own = index.value
        sizes.append(sum(low.nbytes + at.nbytes for low, at in own.parts.values()) + sum(s.nbytes for s in own.sets))
    assert len(sizes) >= 3 and max(sizes) <= 1.1 * decontaminate.BLOCK_BYTES
    got = decontaminate.contamination(docs, spark.createDataFrame(items, ITEM)).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == sorted((k, k) for k, _ in picked)


def test_scattered_items_are_found(spark):
    """Items in pieces of 20 to 25 words, far apart, in any order: exact containment still reaches the threshold."""
    rng = random.Random(7)
    items, docs = [], []
    for k in range(300):
        words = prose(rng, rng.choice([60, 120, 400])).split()
        size = rng.randint(20, 25)
        pieces = [words[a : a + size] for a in range(0, len(words), size)]
        rng.shuffle(pieces)
        items.append((k, " ".join(words)))
        docs.append((k, " ".join(prose(rng, rng.randint(40, 400)) + " " + " ".join(p) for p in pieces)))
    wanted = [(d, i) for d, i, _, _ in brute(docs[:40], items[:40])]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contamination(documents(spark, docs), spark.createDataFrame(items, ITEM)).collect()}
    assert set(wanted) <= got and len([p for p in got if p[0] == p[1]]) >= 0.99 * len([k for k in range(300) if brute([docs[k]], [items[k]])])


def test_empty_tables(spark):
    docs, items = case(3)
    none = spark.createDataFrame([], ITEM)
    assert decontaminate.contamination(documents(spark, docs), none).count() == 0
    assert decontaminate.contamination(documents(spark, []), spark.createDataFrame(items, ITEM)).count() == 0
    assert decontaminate.uncontaminated(documents(spark, docs), none).count() == len(docs)


def test_query_against_sql(spark, sf_dir):
    from skyphrase.llm.oracle import oracle_sql

    same(op7_decontamination(spark, sf_dir), duck(sf_dir), oracle_sql()["op7_decontamination"])


def test_blocks_do_not_nest(spark):
    """Many blocks of items: the same rows, and no plan with more Python stages than one block has."""
    docs, items = case(3)
    table, own = documents(spark, docs, extra=True), spark.createDataFrame(items, ITEM)
    stages = lambda df: df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
    whole = decontaminate.uncontaminated(table, own)
    pieces = decontaminate.uncontaminated(table, own, block_bytes=4000)
    assert stages(whole) == 1 and stages(pieces) == 0
    as_rows = lambda df: sorted(map(str, df.collect()))
    assert as_rows(whole) == as_rows(pieces) and pieces.columns == table.columns
    assert stages(decontaminate.contamination(table, own, block_bytes=4000)) == 0
    assert decontaminate.uncontaminated(table, own.limit(0)).count() == len(docs)
