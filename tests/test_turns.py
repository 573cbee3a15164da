import random
import re

import pytest
from pyspark.sql import functions as F

from skyphrase.functions import turns

LINE = re.compile(r"^\s*([A-Z0-9][A-Z0-9 _\-/]{0,31}?)\s*:\s*(.+?)\s*$")


def plain(raw):
    found = [LINE.match(line) for line in raw.splitlines() if line.strip()]
    return [(m[1].strip(), m[2].strip()) for m in found if m]


def parsed(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, raw string").select("k", turns.parse_turns(F.col("raw")).alias("t")).orderBy("k").collect()
    return [[(t["speaker"], t["text"]) for t in r["t"]] for r in rows]


CASES = [
    "ATC: hello\nUAL12: hi", "ATC: one\n\nnot a turn\nKSFO_TWR: two\nUAL1: three", "D-AIBC: willco", "ATC:   ", "ATC:", "A" * 32 + ": x", "A" * 33 + ": x", "atc: lower",
    "ATC: a\r\nUAL1: b", "　ATC: wide", "\x1fATC: us", "ATC: a\x0bUAL: b\x0cX: c", "ATC: a\x1cB: b\x85C: c D: d", "ATC: one: two", "", " : x",
]


def test_cases(spark):
    assert parsed(spark, CASES) == [plain(c) for c in CASES]


def test_random_texts(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("AB9 _-/:\t\n\r\x0b\x1c\x1f\x85\xa0 　aé") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    assert parsed(spark, texts) == [plain(t) for t in texts]


@pytest.mark.parametrize(
    ("raw", "focal", "error"),
    [
        ("A: 1\nB: 2\nA: 3", "B", "only 3 turns parsed (min 4)"),
        ("A: 1\nB: 2\nA: 3\nB: 4", "b", None),
        ("A: 1\nB: 2\nA: 3\nB: 4", "C1", "focal callsign 'C1' not found among speakers ['A', 'B']"),
    ],
)
def test_checks(spark, raw, focal, error):
    df = spark.createDataFrame([(raw, focal)], "raw string, focal string").withColumn("t", turns.parse_turns(F.col("raw")))
    assert df.select(turns.turn_error(F.col("t"), F.col("focal"))).first()[0] == error
