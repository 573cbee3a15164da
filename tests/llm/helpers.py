"""Small tables for the operators, with every awkward row at once."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


def documents(spark, rows, extra: bool = False):
    """rows: (doc_id, text) or longer; with ``extra`` columns that clash with names in use inside the operators."""
    full = [(*r, *("en", "src0", len(r[1]) if r[1] is not None else None)[len(r) - 2 :]) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:
        for name in ("node", "cid", "digest", "score", "kept", "words", "path", "host", "trusted", "rep", "component_id", "key", "held_out", "_host", "_path", "_logit", "_id", "_kept", "_n", "_d1", "_extra", "quality", "a.b"):
            df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df


def awkward(seed: int = 1) -> list[tuple]:
    """Nulls, empty and white-space texts, ties, repeated rows, multi-byte characters, one very long text."""
    rng = random.Random(seed)
    a, b = prose(rng, 60), prose(rng, 40)
    return [
        (1, a), (1, a), (2, a), (3, a + " end"), (None, a), (4, None), (5, ""), (6, " \n\t\x0b "), (7, "one two three"), (8, "One  TWO three"), (9, b), (10, b.upper()),
        (11, "é" * 50 + " ß ñ 😀 " + a), (12, prose(rng, 30_000)), (13, "x" * 200_000), (14, b + " " + prose(rng, 3)), (None, None),
    ]
